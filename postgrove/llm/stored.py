"""Intermediate tables in the folder executors share, and unions of linked rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.functions.batches import batches_by_bytes
from postgrove.session import shared_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a new folder under spark.checkpoint.dir, and read from there.

    What follows neither computes ``df`` again nor depends on the executors
    that computed it.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, purpose: str, first: int = 0) -> tuple[DataFrame, int]:
    """``df``, stored, with the numbers from ``first`` on in a column ``name``, and how many rows there are.

    Every task counts its own rows while it writes them; the sizes of the tasks,
    one row each, then tell where each begins.
    """
    rows = stored(df.withColumn("_at", F.monotonically_increasing_id()), purpose)
    own, task = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("_at", 33)
    begins, total = {}, first
    for row in rows.groupBy(task.alias("task")).count().orderBy("task").collect():
        begins[row["task"]], total = total, total + row["count"]
    if not begins:
        return rows.select(*df.columns, F.lit(None).cast("long").alias(name)), 0
    starts = df.sparkSession.createDataFrame(list(begins.items()), "_task bigint, _begin bigint")
    placed = rows.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return placed.select(*df.columns, (F.col("_begin") + own).alias(name)), total - first


# Bits of a filter: so many for each key, up to this many (32 MB) whatever the number of keys.
BITS_PER_KEY, MOST_BITS = 64, 1 << 28


def maybe_among(df: DataFrame, column: str, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only where ``column`` is surely none of ``keys``, a table of one column.

    The keys set bits at their hashes; these, never more than ``MOST_BITS``, are broadcast,
    so the rows stay where they are. About one other row in ``BITS_PER_KEY`` is true as well,
    more once the bits are at their bound. NULL is none of the keys. Both sides are
    compared in the type of the keys.
    """
    key = keys.columns[0]
    kind = keys.schema[0].dataType
    bits = min(max(keys.count() * BITS_PER_KEY, 1), MOST_BITS)

    def spot(of: str) -> Column:
        return F.pmod(F.xxhash64(F.col(of).cast(kind)), F.lit(bits).cast("long")) + 1

    part = F.bitmap_bucket_number(spot(key)).alias("_part")
    maps = keys.where(F.col(key).isNotNull()).groupBy(part).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot(key))).alias("_bits")
    )
    at = F.bitmap_bit_position(spot(column)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.col(column).isNotNull() & (F.getbit(byte, at % 8) == 1)
    here = df.withColumn("_part", F.bitmap_bucket_number(spot(column))).join(F.broadcast(maps), "_part", "left")
    return here.select(*df.columns, F.coalesce(found, F.lit(False)).alias(name))


def parted(rows: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` is among ``keys``, a table of one column, and the others, also those with NULL.

    Only rows that a filter of bits lets through are joined; the others are not moved.
    """
    marked = maybe_among(rows, column, keys, "_maybe")
    unsure = marked.where("_maybe").drop("_maybe")
    keys = keys.select(F.col(keys.columns[0]).alias(column))
    inside, others = (unsure.join(keys, column, kind).select(rows.columns) for kind in ("left_semi", "left_anti"))
    return inside, others.union(marked.where("not _maybe").drop("_maybe"))


ROWS_PER_BATCH = 1_000


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python a thousand at a time, unless the submitter chose a number.

    Texts are long: ten thousand of them, Spark's default, are held by the executor
    and by its Python process several times over. A batch also ends at some bytes.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(ROWS_PER_BATCH))
    batches_by_bytes(spark)


def layout(id: T.DataType, rest: str) -> T.StructType:
    """The columns of a task's result: an id of any type, also a whole row, and those named in ``rest``."""
    return T.StructType([T.StructField("id", id), *T.StructType.fromDDL(rest).fields])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the smallest node names a component.

    Alternates the two star operations of Kiveris et al., "Connected Components
    in MapReduce and Beyond" (2014): neighbours above a node move to its
    smallest neighbour, then those below it. The rounds grow with the logarithm
    of the longest path. A hub is one row of minima joined with its many edges,
    so its rows may be split over tasks. Rows with a NULL end, and loops, are
    left out.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    while not _is_stars(links):
        # Every node with its neighbours, and the smallest of itself and them.
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
            .select("x.u", F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        links = stored(small, "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select("v", "v").distinct()
    )


def _is_stars(links: DataFrame) -> bool:
    """Whether every node is a centre or has one link, to a centre."""
    ends = links.select("u", F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    node = ends.groupBy("u").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not node.where("below > 1 or (below = 1 and above = 1)").limit(1).count()
