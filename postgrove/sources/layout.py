"""Tables laid out on disk for the questions that are asked of them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.sources.files import read_parquet

# Files of a range read are named one by one up to this number; beyond, the filter alone skips row groups.
MOST_FILES = 100_000


def write_ranges(df: DataFrame, path: str, keys: Sequence[str], files: int) -> None:
    """Parquet in order of ``keys``, cut into about ``files`` ranges, with a table of what each file holds.

    Rows are dealt by ranges that Spark samples. A hash of the row stands behind the keys, so a
    value that most rows have is spread over many files instead of filling one; within a file rows
    are sorted, so that row groups can be skipped too.
    """
    salt = F.xxhash64(*df.columns)
    dealt = df.withColumn("_salt", salt).repartitionByRange(files, *keys, "_salt").sortWithinPartitions(*keys)
    dealt.drop("_salt").write.mode("overwrite").parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    bounds = [
        bound.alias(f"{name}{i}")
        for i, key in enumerate(keys)
        for name, bound in (("low", F.min(key)), ("high", F.max(key)), ("nulls", F.count_if(F.col(key).isNull())))
    ]
    files_held = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"), *bounds)
    files_held.write.mode("overwrite").parquet(f"{path}/files")


def read_ranges(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], **wanted: tuple[object, object]
) -> DataFrame:
    """Rows of a table of :func:`write_ranges` whose named keys lie between two values, both included.

    Only files that may hold such rows are listed and opened. NULL lies between no values.
    """
    unknown = set(wanted) - set(keys)
    if unknown:
        raise ValueError(f"not laid out by {sorted(unknown)}")

    def overlap(name: str, low: object, high: object) -> Column:
        i = list(keys).index(name)
        kind = schema[name].dataType
        return (F.col(f"high{i}") >= F.lit(low).cast(kind)) & (F.col(f"low{i}") <= F.lit(high).cast(kind))

    index = read_parquet(spark, f"{path}/files")
    good = reduce(and_, (overlap(name, *bounds) for name, bounds in wanted.items()), F.lit(True))
    held = index.where(good).select("file").limit(MOST_FILES + 1).toArrow()["file"].to_pylist()
    if not held:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/rows/{name}" for name in held] if len(held) <= MOST_FILES else [f"{path}/rows"]
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.where(reduce(and_, (F.col(x).between(*map(F.lit, b)) for x, b in wanted.items()), F.lit(True)))


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Parquet in ``buckets`` by a hash of ``keys``, sorted by them, for joins and counts on these keys.

    Tables with equal buckets are joined without a shuffle. All rows of a key are in one bucket, which
    one task reads: for keys of which none has a large share of the rows.
    """
    name = f"buckets_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    # The files stay; the name was needed to write them.
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """A table of :func:`write_buckets`, known to Spark as bucketed, under a name of its own in the session's catalog."""
    name = f"buckets_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    by = ", ".join(f"`{key}`" for key in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
