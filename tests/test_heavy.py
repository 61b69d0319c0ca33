"""Top words from summaries equal a full count, whatever the tasks forget."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postgrove.operators import heavy

def by_hand(rows, k):
    counts = {}
    for group, words in rows:
        counts.setdefault(group, Counter()).update(words)
    return sorted(
        (group, word, n)
        for group, found in counts.items()
        for word, n in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]
    )


@pytest.mark.parametrize("seed, k, remembered, sent", [(1, 1, 2, 1), (2, 3, 5, 1), (3, 2, 6, 4), (4, 3, 1000, 4)])
def test_equals_a_full_count(spark, seed, k, remembered, sent):
    draw = random.Random(seed)
    rows = [(draw.choice(["x", "y", ""]), draw.choices("abcdefgh", k=draw.randint(0, 9))) for _ in range(40)]
    df = spark.createDataFrame(rows, "g string, words array<string>").repartition(3)
    df = df.withColumn("g", F.nullif("g", F.lit("")))  # NULL is a group too
    got = heavy.frequent_terms(df, ["g"], F.col("words"), k, remembered=remembered, sent=sent)
    assert sorted((r.g or "", r.word, r["count"]) for r in got.collect()) == by_hand(rows, k)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_all_three_ways_in_one_call(spark, monkeypatch, most):
    """A group counted in the summaries, one by its candidates, one in full."""
    monkeypatch.setattr(heavy, "MAX_BROADCAST", most)
    rows = [("few", ["a", "b", "a"])]
    rows += [("clear", ["often"] * 40 + ["next"] * 30 + [f"w{i}"]) for i in range(50)]
    rows += [("flat", [f"w{i}", f"w{i + 1}"]) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, words array<string>").repartition(4)
    got = heavy.frequent_terms(df, ["g"], F.col("words"), 2, remembered=100, sent=3)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, 2)


def test_only_summaries_are_shuffled(spark):
    """Tasks send at most ``sent`` words for each wanted one, and a bound, for every group."""
    words = F.transform(F.sequence(F.lit(0), F.lit(50)), lambda i: (i * F.col("id") % 997).cast("string"))
    df = spark.range(0, 2000, 1, 4).select((F.col("id") % 3).alias("g"), words.alias("words"))
    rows = df.select(F.struct("g").alias("key"), F.col("g").cast("string").alias("group"), "words")
    sent = rows.mapInArrow(heavy._summary(500, 20), "key struct<g: bigint>, word string, n bigint")
    assert sent.count() <= 4 * 3 * 21
    # Every count, with the bound of its group and task, is at least the true one.
    counted = df.select("g", F.explode("words").alias("word"), F.spark_partition_id().alias("p")).groupBy("g", "word").count()
    low = sent.where("word is not null").groupBy("key.g", "word").agg(F.sum("n").alias("low"))
    lost = sent.where("word is null").groupBy("key.g").agg(F.sum("n").alias("lost"))
    joined = counted.join(low, ["g", "word"], "left").join(lost, "g")
    assert not joined.where("coalesce(low, 0) > count or coalesce(low, 0) + lost < count").count()


def test_nothing(spark):
    df = spark.createDataFrame([("x", []), ("y", None)], "g string, words array<string>")
    assert heavy.frequent_terms(df, ["g"], F.col("words")).collect() == []
    assert heavy.frequent_terms(df.where("false"), ["g"], F.col("words")).collect() == []


def test_words_counted_a_few_at_a_time_give_a_full_count(spark, monkeypatch):
    monkeypatch.setattr(heavy, "WORDS_AT_ONCE", 3)
    draw = random.Random(5)
    rows = [(draw.choice("xy"), draw.choices("abcdefgh", k=draw.randint(0, 9))) for _ in range(40)]
    df = spark.createDataFrame(rows, "g string, words array<string>").coalesce(1)
    got = heavy.frequent_terms(df, ["g"], F.col("words"), 3, remembered=6, sent=2)
    assert sorted((r.g, r.word, r["count"]) for r in got.collect()) == by_hand(rows, 3)
