"""Mixing sources to target weights, with whole documents repeated or left out.

The words of every source are summed, the words the mix should hold are shared
among the sources by weight, and the ratio of the two is how often a source is
repeated. A document is taken floor(ratio) times, and once more if a number
drawn from a hash of its id, text, source and a seed is below the fraction: no order or state,
and a rerun takes the same documents. Rows that are equal in all three are numbered,
so that each has a draw of its own; they alone are looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.llm.stored import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
SEED = 17
# Sources are broadcast up to this number, and joined by a shuffle beyond.
MAX_BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code point order, NULL last, weigh ``weights`` in turn and get
    ``share`` of all sizes in that proportion. No target exceeds ``cap`` times
    its source; what is above is shared again among the others by weight. In
    order of the share a source can take per weight, that is one running sum:
    the sources that are full come first. One row per source goes through one
    task here, never the documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
        .withColumn("room", F.lit(cap) * F.col("source_size"))
    )
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    # What remains, and the weights it is shared by, once all sources before this one are full.
    rest = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("room").over(before), F.lit(0)
    )
    among = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stepped = sources.select("*", rest.alias("rest"), among.alias("among"), F.row_number().over(fill).alias("step"))
    is_open = F.col("room") * F.col("among") > F.col("weight") * F.col("rest")
    first = F.min(F.when(is_open, F.struct("step", "rest", "among"))).over(everything)
    target = F.when(
        F.col("step") >= F.col("first.step"),
        F.col("weight") * F.col("first.rest") / F.col("first.among"),
    ).otherwise(F.col("room").cast("double"))
    return stepped.withColumn("first", first).select("source", "source_size", target.alias("target"))


def name_of(id: Column, text: Column, source: Column, seed: int = SEED) -> Column:
    """What a draw follows from: seed, id, text and source."""
    parts = [F.coalesce(x.cast("string"), F.lit("")) for x in (id, F.md5(text), source)]
    return F.concat_ws(":", F.lit(str(seed)), *parts)


def draw(name: Column, number: Column) -> Column:
    """A number from 0 to below 1 that follows from the name and the number among rows of that name."""
    digest = F.md5(F.concat(name, F.when(number > 1, F.concat(F.lit(":"), number.cast("string"))).otherwise(F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def copies(size: Column, target: Column) -> Column:
    """How often a document, by its ``name`` and ``number``, of a source of this size and target is taken."""
    rate = F.when(size > 0, target / size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw(F.col("name"), F.col("number")) < rate - F.floor(rate)).cast("long")).cast("long")


def _numbered_equals(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``number`` among those of equal ``name``, from 1 on.

    Most names have one row. Rows of the others are stored, each task numbers its own,
    and the counts of the tasks before are added: which of two equal rows comes first
    may change, that there is a first and a second does not. A name that very many rows
    share is so numbered by many tasks.
    """
    one = F.lit(1).cast("long")
    often = stored(rows.groupBy("name").count().where("count > 1").select(F.col("name").alias("_name")), "equal")
    number = often.count()
    if not number:
        return rows.withColumn("number", one)
    often = F.broadcast(often) if number <= MAX_BROADCAST_SOURCES else often
    equal = F.col("name") == F.col("_name")
    marked = rows.join(often, equal, "left_semi").withColumn("_task", F.spark_partition_id())
    several = stored(marked.withColumn("_at", F.monotonically_increasing_id()), "several")
    own = F.row_number().over(Window.partitionBy("name", "_task").orderBy("_at"))
    before = Window.partitionBy("_own").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    tasks = several.groupBy(F.col("name").alias("_own"), F.col("_task").alias("_number")).count().select(
        "_own", "_number", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    placed = several.withColumn("_mine", own).join(
        tasks, (F.col("name") == F.col("_own")) & (F.col("_task") == F.col("_number"))
    )
    placed = placed.select(*rows.columns, (F.col("_before") + F.col("_mine")).cast("long").alias("number"))
    return rows.join(often, equal, "left_anti").withColumn("number", one).union(placed)


def _with_source(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    named = sources.withColumnRenamed("source", "_source")
    named = F.broadcast(named) if few else named
    return rows.join(named, rows["source"].eqNullSafe(named["_source"]), "left").drop("_source")


def mix_plan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: int = SEED,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every row.

    ``taken`` is the words the mix takes of the row, ``copies`` times its
    ``size``. A NULL or empty text has size 0. NULL is a source of its own, and
    a source without words has target 0. Rows without an id, with the same id, or
    equal rows each have a draw of their own. Other columns are not read. An empty table
    gives an empty result.
    """
    sizes = docs.select(
        F.col(id).alias("id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"),
        name_of(F.col(id), F.col(text), F.col(source), seed).alias("name"),
    )
    sizes = stored(sizes, "sizes")
    sources = stored(targets(sizes, weights, share, cap), "targets")
    few = sources.count() <= MAX_BROADCAST_SOURCES
    taken = copies(F.col("source_size"), F.col("target"))
    return _with_source(_numbered_equals(sizes), sources, few).select(
        F.col("id").alias(id), "size", "source_size", "target", taken.alias("copies"),
        (F.col("size") * taken).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: int = SEED,
) -> DataFrame:
    """The rows of the mix with all their columns, each as often as :func:`mix_plan` says.

    Only sizes and sources are summed; texts stay where they are, so a source
    that holds most rows does not matter.
    """
    sizes = docs.select(F.col(source).alias("source"), size_of(F.col(text)).alias("size"))
    sources = stored(targets(sizes, weights, share, cap), "targets")
    few = sources.count() <= MAX_BROADCAST_SOURCES
    packed = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("source"),
        name_of(F.col(id), F.col(text), F.col(source), seed).alias("name"),
    )
    often = copies(F.col("source_size"), F.col("target"))
    return (
        _with_source(_numbered_equals(packed), sources, few)
        .withColumn("copies", often)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
