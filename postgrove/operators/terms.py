"""Word counts and the top words of each group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.dimensions import STOP_WORDS
from postgrove.functions.text import tokens

# Up to this k Spark cuts every task's groups to k rows before the shuffle.
SPARK_GROUP_LIMIT = 1000
SALTS = 64


def explode_terms(
    df: DataFrame,
    keys: Sequence[str],
    text: Column,
    stop_words: Sequence[str] = STOP_WORDS,
    full_mentions: bool = False,
    word: str = "word",
) -> DataFrame:
    """One row per word of a raw ``text``, noise and stop words dropped."""
    return df.select(*keys, F.explode(tokens(text, stop_words, full_mentions)).alias(word))


def term_counts(terms: DataFrame, keys: Sequence[str], word: str = "word") -> DataFrame:
    return terms.groupBy(*keys, word).agg(F.count("*").alias("count"))


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    unique: Sequence[str],
) -> DataFrame:
    """The first ``k`` rows of every group; ``order`` must leave no ties.

    Small k: tasks cut their groups to k before the shuffle, so one huge group
    still sends only k rows per task. For a k too large for that, groups are
    cut in salted pieces first; a row among the first k of its group is among
    the first k of its piece, so nothing is lost. ``unique`` names the columns
    that spread a group's rows over the pieces.
    """
    def cut(rows: DataFrame, *by: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k)

    if k > SPARK_GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*unique), F.lit(SALTS)))
        df = cut(salted, *keys, "_salt").drop("_salt", "_rank")
    return cut(df, *keys).drop("_rank")


def top_terms(counts: DataFrame, keys: Sequence[str], k: int = 10, word: str = "word") -> DataFrame:
    """The ``k`` most frequent words per group; equal counts in word order."""
    return top_k(counts, keys, [F.desc("count"), F.asc(word)], k, unique=[word])


def union_tagged(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """All parts one below the other, each row carrying the name of its part."""
    tagged = [part.withColumn(tag, F.lit(label)) for label, part in parts.items()]
    return reduce(DataFrame.unionByName, tagged)
