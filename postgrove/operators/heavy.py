"""The most frequent words of each group without a shuffle of all words.

Every task keeps a summary of its words and sends only the most frequent of each
group, with a bound on how many occurrences of any one word it left out. Added up, the
summaries give for every word a least count and, with the sum of the bounds, a
greatest one. If nothing was left out, the counts are exact. Otherwise the
words that may be among the first k are counted in a second pass, of which only their
rows are shuffled. A word that no summary has cannot be more frequent than the sum
of the bounds: where that is below the k-th least count, no word is lost;
the few groups where it is not are counted in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from postgrove.functions.batches import batches_by_bytes
from postgrove.operators.terms import top_k
from postgrove.session import shared_folder
from postgrove.sources.files import read_parquet, write_parquet

# Words of all groups a task remembers, and words of a group it sends, for each of the k wanted.
REMEMBERED, SENT = 1 << 18, 32
# Groups and candidates are broadcast up to this number, and joined by a shuffle beyond.
MAX_BROADCAST = 1_000_000
# Words of a batch a task counts at a time, or those of one longer text.
WORDS_AT_ONCE = 1 << 17

Batches = Iterator[pa.RecordBatch]


def _summary(remembered: int, sent: int) -> Callable[[Batches], Batches]:
    """Of batches of (key, group, words): rows of (key, word, n), where no word stands for the bound of the group."""

    def counted(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["group", "word"]).aggregate([("n", "sum")]).rename_columns(
            ["group", "word", "n"]
        )

    def run(batches: Batches) -> Batches:
        numbers: dict[str, int] = {}
        keys: list[pa.Scalar] = []
        state: list[pa.Table] = []
        lost = 0
        for batch in batches:
            names = batch.column(1).dictionary_encode()
            own = []
            for i, name in enumerate(names.dictionary.to_pylist()):
                if name not in numbers:
                    numbers[name] = len(keys)
                    keys.append(batch.column(0)[pc.index(names.indices, i).as_py()])
                own.append(numbers[name])
            group = np.array(own, np.int64)[names.indices.to_numpy()]
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(), dtype=np.int64)
            first = done = 0
            while first < len(ends):
                last = max(int(np.searchsorted(ends, done + WORDS_AT_ONCE, side="right")), first + 1)
                words = batch.column(2).slice(first, last - first)
                text = pc.list_parent_indices(words).to_numpy() + first
                word = pc.list_flatten(words).cast(pa.string())
                first, done = last, int(ends[last - 1])
                rows = pa.table({"group": group[text], "word": word, "n": np.ones(len(word), np.int64)})
                state = [counted([*state, rows])]
                if len(state[0]) > remembered:
                    # The rarest go; none of them loses more than the threshold.
                    n = state[0]["n"].to_numpy()
                    threshold = int(np.partition(n, len(n) - remembered // 2 - 1)[len(n) - remembered // 2 - 1])
                    state = [state[0].filter(pa.array(n > threshold))]
                    lost += threshold
        if not keys:
            return
        table = counted(state).sort_by([("group", "ascending"), ("n", "descending"), ("word", "ascending")])
        group, n = table["group"].to_numpy(), table["n"].to_numpy()
        starts = np.searchsorted(group, np.arange(len(keys)))
        rank = np.arange(len(group)) - starts[group]
        bounds = np.full(len(keys), lost)
        cut = np.flatnonzero(rank == sent)
        bounds[group[cut]] += n[cut]
        table = table.filter(pa.array(rank < sent))
        group = np.append(table["group"].to_numpy(), np.arange(len(keys)))
        words = pa.concat_arrays([table["word"].combine_chunks(), pa.nulls(len(keys), pa.string())])
        held = pa.array(keys, keys[0].type)
        yield pa.record_batch(
            [held.take(pa.array(group)), words, pa.array(np.append(table["n"].to_numpy(), bounds))],
            names=["key", "word", "n"],
        )

    return run


def frequent_terms(
    df: DataFrame,
    keys: Sequence[str],
    words: Column,
    k: int = 10,
    word: str = "word",
    remembered: int = REMEMBERED,
    sent: int = SENT,
) -> DataFrame:
    """(*keys, word, count): the ``k`` most frequent of ``words``, an array, in every group; equal counts in word order.

    NULL keys are groups like any other. ``remembered`` and ``sent`` bound what a task
    holds and sends, and change no result. ``df`` is read up to three times.
    """
    spark = df.sparkSession
    batches_by_bytes(spark)
    rows = df.select(F.struct(*keys).alias("key"), words.alias("words")).where(F.size("words") > 0)
    schema = T.StructType(
        [T.StructField("key", rows.schema["key"].dataType), T.StructField("word", T.StringType()),
         T.StructField("n", T.LongType())]
    )
    told = rows.select("key", F.to_json("key", {"ignoreNullFields": "false"}).alias("group"), "words")
    summed = told.mapInArrow(_summary(remembered, sent * k), schema).groupBy("key", "word").agg(F.sum("n").alias("n"))
    folder = shared_folder(spark, "summaries")
    write_parquet(summed, folder)
    merged = read_parquet(spark, folder, schema)
    least = merged.where("word is not null")
    first = top_k(least, ["key"], [F.desc("n"), F.asc("word")], k, unique=["word"])
    kth = first.groupBy("key").agg(F.when(F.count("*") == k, F.min("n")).otherwise(0).alias("kth"))
    bounds = merged.where("word is null").select("key", F.col("n").alias("lost"))
    groups = bounds.join(kth, bounds["key"].eqNullSafe(kth["key"]), "left").select(
        bounds["key"], "lost", F.coalesce("kth", F.lit(0)).alias("kth")
    )
    folder = shared_folder(spark, "groups")
    write_parquet(groups, folder)
    groups = read_parquet(spark, folder, groups.schema)
    kinds = groups.agg(
        F.count("*"), F.count_if(F.col("lost") > 0), F.count_if((F.col("lost") > 0) & (F.col("lost") >= F.col("kth")))
    ).head()

    def among(part: DataFrame, chosen: DataFrame, number: int, *more: str) -> DataFrame:
        """Rows of ``part`` whose key, and whatever else is named, is among those chosen."""
        chosen = chosen.select(F.col("key").alias("_key"), *(F.col(x).alias(f"_{x}") for x in more))
        if number <= MAX_BROADCAST:
            chosen = F.broadcast(chosen)
        same = part["key"].eqNullSafe(chosen["_key"])
        for name in more:
            same &= part[name] == chosen[f"_{name}"]
        return part.join(chosen, same, "left_semi")

    def counts(part: DataFrame, condition: Callable[[DataFrame], DataFrame]) -> DataFrame:
        exploded = condition(part.select("key", F.explode("words").alias("word")))
        return exploded.groupBy("key", "word").agg(F.count("*").alias("n"))

    found = among(first, groups.where("lost = 0"), kinds[0])
    if kinds[1] > kinds[2]:
        proven = groups.where("lost > 0 and lost < kth").withColumnRenamed("key", "_key")
        proven = F.broadcast(proven) if kinds[0] <= MAX_BROADCAST else proven
        candidates = least.join(proven, least["key"].eqNullSafe(proven["_key"])).where("n + lost >= kth")
        number = candidates.count()
        found = found.union(counts(rows, lambda x: among(x, candidates, number, "word")))
    if kinds[2]:
        unproven = groups.where("lost > 0 and lost >= kth")
        found = found.union(counts(among(rows, unproven, kinds[2]), lambda x: x))
    ranked = top_k(found, ["key"], [F.desc("n"), F.asc("word")], k, unique=["word"])
    return ranked.select("key.*", F.col("word").alias(word), F.col("n").alias("count"))
