"""Code-to-name lookups."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_CODES = 1_000_000


def code_lookup(
    df: DataFrame,
    code: str,
    names: Mapping[str, str],
    name: str,
    default: str | None = None,
) -> DataFrame:
    """Add the name of each code; codes not listed, and NULL, get ``default``.

    The names are a dictionary the caller already holds. They are broadcast up
    to a checked number of entries and joined by shuffle beyond it.
    """
    table = df.sparkSession.createDataFrame(
        pa.table(
            {
                "_code": pa.array(list(names.keys()), pa.string()),
                "_name": pa.array(list(names.values()), pa.string()),
            }
        )
    )
    if len(names) <= MAX_BROADCAST_CODES:
        table = F.broadcast(table)
    kept = [column for column in df.columns if column != name]
    return df.join(table, F.col(code) == F.col("_code"), "left").select(
        *kept, F.coalesce("_name", F.lit(default)).alias(name)
    )
