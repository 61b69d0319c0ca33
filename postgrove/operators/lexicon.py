"""A polarity lexicon learnt from seed words and the company they keep.

Words that stand near each other more often than by chance are neighbours, weighed by
their pointwise mutual information. Polarity spreads from the seeds along these
links: in every round a word takes the mean of its neighbours, and the seeds keep theirs
(label propagation; Zhu, Ghahramani, 2002). Weights and polarities are whole numbers,
so sums, and with them the lexicon, do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postgrove.functions.batches import batches_by_bytes, parts
from postgrove.operators.sentiment import WORD_GAP
from postgrove.session import shared_folder
from postgrove.sources.files import read_parquet, write_parquet

WINDOW, LEAST_WORDS, LEAST_PAIRS, ROUNDS = 5, 20, 5, 4
# Units of a polarity and of a weight.
POLARITY_UNITS, WEIGHT_UNITS = 1_000_000, 1_000
# Words are broadcast up to this number, and joined by a shuffle beyond.
MAX_BROADCAST_WORDS = 1_000_000
# Different pairs a task adds up before it sends them on.
HELD_PAIRS = 1 << 21

Batches = Iterator[pa.RecordBatch]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, small, and the number of the text each is in."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), pattern=WORD_GAP)
    words, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(words, "")
    return words.filter(some).cast(pa.string()), text.filter(some).to_numpy()


def _word_counter(batches: Batches) -> Batches:
    for batch in batches:
        for texts in parts(batch.column(0)):
            counts = pc.value_counts(_words(texts)[0])
            yield pa.record_batch([counts.field(0), counts.field(1)], names=["word", "n"])


def _near(code: np.ndarray, text: np.ndarray, listed: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different words of a text at most ``window`` apart, as smaller code x ``size`` + larger, and how often.

    ``listed`` tells which words have pairs.
    """
    found = []
    for step in range(1, window + 1):
        one, two = code[:-step], code[step:]
        good = (text[:-step] == text[step:]) & (one != two) & listed[:-step] & listed[step:]
        found.append(np.minimum(one, two)[good] * size + np.maximum(one, two)[good])
    return np.unique(np.concatenate(found), return_counts=True)


def _pair_counter(window: int) -> Callable[[Batches], Batches]:
    """Pairs of words no further apart than ``window``, as (a, b, n) with a before b in the alphabet."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for texts in parts(batch.column(0)):
                words, text = _words(texts)
                coded = words.dictionary_encode()
                names = coded.dictionary
                order = pc.array_sort_indices(names).to_numpy()
                place = np.empty(len(names), np.int64)
                place[order] = np.arange(len(names))
                code = place[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
                names = names.take(pa.array(order))
                size = max(len(names), 1)
                pairs, n = _near(code, text, np.ones(len(code), bool), size, window)
                yield pa.record_batch(
                    [names.take(pa.array(pairs // size)), names.take(pa.array(pairs % size)), pa.array(n)],
                    names=["a", "b", "n"],
                )

    return run


def _known_pair_counter(shared, window: int, held: int) -> Callable[[Batches], Batches]:
    """The same as (pair, n) for the words ``shared`` lists: a pair is place of a x number of words + place of b.

    A task adds pairs up, and sends them on when it holds more than ``held``.
    """

    def run(batches: Batches) -> Batches:
        known = pa.array(shared.value, pa.string())
        size = max(len(known), 1)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            pairs, n = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(pairs)
            pairs, n = pairs[order], n[order]
            opens = np.flatnonzero(np.diff(pairs, prepend=-1))
            return pairs[opens], np.add.reduceat(n, opens) if len(opens) else n

        for batch in batches:
            for texts in parts(batch.column(0)):
                words, text = _words(texts)
                # Words of the texts are looked up once each.
                coded = words.dictionary_encode()
                place = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy().astype(np.int64)
                code = place[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
                found.append(_near(code, text, code >= 0, size, window))
                waiting += len(found[-1][0])
                if waiting > 2 * held:
                    found = [added()]
                    waiting = len(found[0][0])
                    if waiting > held:
                        yield pa.record_batch([pa.array(x) for x in found[0]], names=["pair", "n"])
                        found, waiting = [], 0
        if found:
            yield pa.record_batch([pa.array(x) for x in added()], names=["pair", "n"])

    return run


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, purpose)
    write_parquet(df, folder)
    return read_parquet(df.sparkSession, folder, df.schema)


def neighbours(
    df: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    least_pairs: int = LEAST_PAIRS,
) -> DataFrame:
    """(word, other, weight) of words that stand together more often than by chance, both ways round.

    Words occur ``least_words`` times or more and stand within ``window`` words of each other
    ``least_pairs`` times or more. The weight is the pointwise mutual information
    in thousandths, rounded down.
    """
    spark = df.sparkSession
    batches_by_bytes(spark)
    texts = df.select(F.col(text).alias("text")).where("text is not null")
    words = texts.mapInArrow(_word_counter, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    frequent = _kept(words.where(F.col("n") >= least_words).select("word"), "words")
    few = frequent.count() <= MAX_BROADCAST_WORDS
    send = F.broadcast if few else (lambda x: x)
    if few:
        listed = sorted(frequent.toArrow()["word"].to_pylist())
        counted = texts.mapInArrow(
            _known_pair_counter(spark.sparkContext.broadcast(listed), window, HELD_PAIRS), "pair bigint, n bigint"
        ).groupBy("pair").agg(F.sum("n").alias("n"))
        size = F.lit(max(len(listed), 1)).cast("long")
        pairs = counted.select(F.call_function("div", "pair", size).alias("a"), (F.col("pair") % size).alias("b"), "n")
    else:
        pairs = (
            texts.mapInArrow(_pair_counter(window), "a string, b string, n bigint")
            .groupBy("a", "b")
            .agg(F.sum("n").alias("n"))
        )
        for end in ("a", "b"):
            pairs = pairs.join(frequent.withColumnRenamed("word", end), end, "left_semi")
    pairs = _kept(pairs, "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), "n").union(pairs.select("b", "a", "n"))
    sizes = _kept(both.groupBy("word").agg(F.sum("n").alias("size")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0]
    own, its = (send(sizes.select(F.col("word").alias(x), F.col("size").alias(f"{x}_size"))) for x in ("word", "other"))
    chance = F.col("n").cast("double") * float(total) / (F.col("word_size").cast("double") * F.col("other_size"))
    weight = F.floor(F.log(chance) * WEIGHT_UNITS)
    linked = both.where(F.col("n") >= least_pairs).join(own, "word").join(its, "other")
    linked = linked.select("word", "other", weight.alias("weight")).where("weight > 0")
    if not few:
        return linked
    # Places become words only in the links.
    places = spark.createDataFrame(pa.table({"at": pa.array(range(len(listed)), pa.int64()), "name": pa.array(listed, pa.string())}))
    named = {x: F.broadcast(places.select(F.col("at").alias(x), F.col("name").alias(f"{x}_name"))) for x in ("word", "other")}
    return linked.join(named["word"], "word").join(named["other"], "other").select(
        F.col("word_name").alias("word"), F.col("other_name").alias("other"), "weight"
    )


def learn_lexicon(
    df: DataFrame,
    seeds: Mapping[str, float],
    text: str = "text",
    rounds: int = ROUNDS,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    least_pairs: int = LEAST_PAIRS,
) -> DataFrame:
    """(word, polarity) of the seeds, and of all words that polarity reaches within ``rounds`` links.

    Polarities have six decimals, rounded towards zero; words of polarity 0 are left out, seeds are not.
    The table is what :func:`~postgrove.operators.sentiment.with_polarity` takes. Seeds stay as they
    are, also those the texts do not have. NULL texts have no words; every row counts.
    """
    spark: SparkSession = df.sparkSession
    schema = T.StructType([T.StructField("other", T.StringType()), T.StructField("value", T.LongType())])
    given = [(word, round(value * POLARITY_UNITS)) for word, value in seeds.items()]
    fixed = spark.createDataFrame(given, schema)
    links = _kept(neighbours(df, text, window, least_words, least_pairs), "links")
    known = fixed
    few = links.select("word").distinct().count() + len(given) <= MAX_BROADCAST_WORDS
    for _ in range(rounds):
        # Every word has some links, a frequent one very many: what is known goes to the links.
        reached = links.join(F.broadcast(known) if few else known, "other", "left")
        value = F.sum(F.col("weight") * F.coalesce("value", F.lit(0)))
        whole = F.sum("weight")
        mean = F.signum(value).cast("long") * F.call_function("div", F.abs(value), whole)
        spread = reached.groupBy("word").agg(mean.alias("value")).where("value <> 0")
        others = spread.join(F.broadcast(fixed.select(F.col("other").alias("word"))), "word", "left_anti")
        known = _kept(fixed.union(others), "known")
    return known.select(F.col("other").alias("word"), (F.col("value") / POLARITY_UNITS).alias("polarity"))
