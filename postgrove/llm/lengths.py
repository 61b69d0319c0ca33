"""Token counts under every context limit, from one exact histogram of lengths.

Texts are encoded where they are and only (length, number) pairs leave a task.
Suffix sums over the lengths then answer, for every limit at once, how many
texts are cut by it and how many tokens remain.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from postgrove.llm.stored import small_batches, stored

# Lengths that are summed in one task of the suffix sums.
SPAN = 4096

Batches = Iterator[pa.RecordBatch]


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a file of base64 tokens and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _measure(shared) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        import tiktoken

        pattern, ranks = shared.value
        encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found[len(encoding.encode_ordinary(text.as_py() or ""))] += 1
        lengths = sorted(found)
        yield pa.record_batch(
            [pa.array(lengths, pa.int64()), pa.array([found[x] for x in lengths], pa.int64())],
            names=["length", "n_docs"],
        )

    return run


def histogram(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """(length, n_docs): how many texts encode to each number of tokens.

    A NULL or empty text has length 0. Every row counts, repeated rows too; no
    other column is read. An empty table has an empty histogram.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((pattern, ranks))
    return (
        docs.select(text)
        .mapInArrow(_measure(shared), "length bigint, n_docs bigint")
        .groupBy("length")
        .agg(F.sum("n_docs").alias("n_docs"))
    )


def suffix_sums(counts: DataFrame) -> DataFrame:
    """The histogram with what each length, taken as the limit, means.

    ``n_tokens`` and ``n_docs`` are those of the length itself; ``docs_at_least``
    and ``tokens_at_least`` are of texts as long or longer, ``docs_cut`` of longer
    ones; ``total_tokens`` is of all texts, ``truncated_tokens`` what remains of
    them if each is cut at the length, and ``share_within`` the share of texts
    that need no cut. Sums go over spans of lengths first, so a task holds one
    span, and one row per span in the last step.
    """
    # Used twice below: texts are encoded once.
    counts = stored(counts, "lengths")
    rows = counts.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn(
        "span", F.floor(F.col("length") / SPAN)
    )
    within = Window.partitionBy("span").orderBy(F.desc("length"))
    spans = rows.groupBy("span").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    above = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spans = spans.select(
        "span",
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("_docs").over(everything).alias("total_docs"),
        F.sum("_tokens").over(everything).alias("total_tokens"),
    )
    summed = (
        rows.withColumn("docs_here", F.sum("n_docs").over(within))
        .withColumn("tokens_here", F.sum("n_tokens").over(within))
        .join(spans, "span")
        .withColumn("docs_at_least", F.col("docs_here") + F.col("docs_above"))
        .withColumn("tokens_at_least", F.col("tokens_here") + F.col("tokens_above"))
    )
    docs_cut = F.col("docs_at_least") - F.col("n_docs")
    return summed.select(
        "length",
        "n_docs",
        "n_tokens",
        "docs_at_least",
        "tokens_at_least",
        docs_cut.alias("docs_cut"),
        "total_tokens",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias(
            "truncated_tokens"
        ),
        (1 - docs_cut / F.col("total_docs")).alias("share_within"),
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """(limit, docs_cut, truncated_tokens) for any limit, from :func:`suffix_sums`.

    The shortest length beyond the limit tells how many texts are cut.
    """
    total = F.max("total_tokens")
    longer = F.min(F.when(F.col("length") > limit, F.struct("length", "docs_at_least", "tokens_at_least")))
    return sums.agg(longer.alias("x"), total.alias("total")).select(
        F.lit(limit).cast("long").alias("limit"),
        F.coalesce("x.docs_at_least", F.lit(0)).alias("docs_cut"),
        F.coalesce(
            F.col("total") - F.col("x.tokens_at_least") + F.lit(limit) * F.col("x.docs_at_least"),
            F.col("total"),
            F.lit(0),
        ).alias("truncated_tokens"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that covers at least each share of the texts."""
    wanted = F.explode(F.array(*(F.lit(float(x)) for x in shares))).alias("share")
    return (
        sums.select("length", "share_within", wanted)
        .where(F.col("share_within") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("length").alias("length"))
    )
