"""Texts of an Arrow batch, some at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes of text worked on at a time, and bytes Spark hands over at once.
PART_BYTES = 1 << 20
BATCH_BYTES = 8 << 20


def parts(texts: pa.Array, limit: int = PART_BYTES) -> Iterator[pa.Array]:
    """Consecutive pieces of ``texts`` of at most ``limit`` bytes, or of one longer text.

    What a task holds while it works on texts is many times their size. It
    follows the piece, and not the batch, however many rows that has.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = done = 0
    while first < len(texts):
        last = max(int(np.searchsorted(ends, done + limit, side="right")), first + 1)
        yield texts.slice(first, last - first)
        first, done = last, int(ends[last - 1])


def by_parts(work: Callable[[pa.Array], pa.Array], texts: pa.Array, limit: int = PART_BYTES) -> pa.Array:
    """``work``, which gives a row for a row, over the pieces of ``texts``."""
    made = [work(part) for part in parts(texts, limit)]
    return pa.concat_arrays(made) if made else work(texts)


def batches_by_bytes(spark: SparkSession) -> None:
    """Let Spark end a batch for Python at ``BATCH_BYTES`` too, unless the submitter chose a bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(BATCH_BYTES))
