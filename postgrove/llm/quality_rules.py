"""Quality rules: fixed limits, then the likelihood of a text's words under trusted texts.

Runs of three bytes of a text's words, one space between words, are hashed into
a fixed number of buckets. The bucket counts of trusted texts and of the whole
corpus are two multinomials; a text scores the mean, over its runs, of the
logarithm of their ratio, as in Xie et al., "Data Selection for Language Models
via Importance Resampling" (2023), and is kept if the score reaches a fixed
threshold. Unlike there nothing is drawn: every text is decided by its own runs
and the counts. Runs of bytes and not of words are counted because few of them
fall in one bucket, however large the corpus is; runs of words would fill all
buckets of a large one, and the ratios would tend to 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postgrove.llm.stored import layout, small_batches
from postgrove.llm.words import U64, Words, mixed, slices, windows

BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.5
# About 32 bytes each in an executor.
MAX_BROADCAST_IDS = 5_000_000
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20

Batches = Iterator[pa.RecordBatch]


def _buckets(words: Words, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the three-byte runs of a slice, and the text of each."""
    # Of the bytes between words the one before each word stays, as a space.
    kept = words.inside.copy()
    kept[np.maximum(words.starts - 1, 0)] = True
    stream = np.where(words.inside, words.raw, 0x20)[kept].astype(U64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[kept]
    code = (stream[:-2] << U64(16)) | (stream[1:-1] << U64(8)) | stream[2:]
    whole = text[:-2] == text[2:]
    return (mixed(code[whole]) % U64(buckets)).astype(np.int64), text[:-2][whole]


def _counter(buckets: int) -> Callable[[Batches], Batches]:
    def count(batches: Batches) -> Batches:
        raw, trusted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in slices(batch.column(0)):
                runs, text = _buckets(Words(data, offsets), offsets, buckets)
                raw += np.bincount(runs, minlength=buckets)
                trusted += np.bincount(runs[good[first:last][text]], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.record_batch(
            [used.astype(np.int32), raw[used], trusted[used]], names=["bucket", "raw", "trusted"]
        )

    return count


def weights(
    docs: DataFrame,
    trusted: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
) -> np.ndarray:
    """Log-likelihood ratio of every bucket, from all of ``docs``.

    ``trusted`` holds the ids of the trusted rows. Up to a number their ids go to
    the texts, beyond it the join moves the texts. Tasks send at most ``buckets``
    sums, and the driver gets as many. Without any trusted text all ratios are 0.
    """
    marked = trusted.select(F.col(id).alias("_id")).where("_id is not null").distinct()
    few = marked.count() <= MAX_BROADCAST_IDS
    marked = marked.withColumn("_good", F.lit(True))
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(marked) if few else marked, "_id", "left"
    )
    counts = (
        rows.select("_text", "_good")
        .mapInArrow(_counter(buckets), "bucket int, raw bigint, trusted bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
        .toArrow()
    )
    raw, good = np.zeros(buckets), np.zeros(buckets)
    raw[counts["bucket"].to_numpy()] = counts["raw"].to_numpy()
    good[counts["bucket"].to_numpy()] = counts["trusted"].to_numpy()
    if not good.any():
        return np.zeros(buckets)
    raw, good = raw + smoothing, good + smoothing
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def _scorer(shared, threshold: float) -> Callable[[Batches], Batches]:
    def score(batches: Batches) -> Batches:
        ratio = shared.value
        symbol = np.zeros(256, bool)
        symbol[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for first, last, raw, offsets in slices(batch.column(1)):
                words = Words(raw, offsets)
                hashes = words.hashes()
                begins = words.inside & ((raw & 0xC0) != 0x80)
                chars = np.concatenate(([0], np.cumsum(begins)))[offsets]
                symbols = np.concatenate(([0], np.cumsum(symbol[raw])))[offsets]
                runs, text = _buckets(words, offsets, len(ratio))
                sums = np.bincount(text, ratio[runs], last - first)
                means = sums / np.maximum(np.bincount(text, minlength=last - first), 1)
                for i in range(last - first):
                    own = hashes[words.bounds[i] : words.bounds[i + 1]]
                    lines = raw[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")
                    lines = [line for line in lines if line.strip()]
                    repeated = covered(own)
                    failed = len(own) < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * len(own)
                    values = (
                        len(own), int(chars[i + 1] - chars[i]), int(symbols[i + 1] - symbols[i]),
                        len(lines) - len(set(lines)), repeated, failed, float(means[i]),
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
            failed, mean = np.array(columns[5], bool), np.array(columns[6], float)
            yield pa.record_batch(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in columns[:5])]
                + [pa.array(failed), pa.array(mean), pa.array(~failed & (mean >= threshold))],
                names=[
                    "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "score", "kept",
                ],
            )

    return score


def covered(hashes: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words in windows of ``width`` words that occur twice or more."""
    runs = windows(hashes, width)
    order = np.sort(runs)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    hit = np.isin(runs, twice).astype(np.int64)
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[: len(runs)] += hit
    edge[width : width + len(runs)] -= hit
    return int((np.cumsum(edge) > 0).sum())


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, counts, base_failed, score, kept) of every row.

    The counts are those of words, characters in words, marks ``#*$%&|<>``,
    lines that repeat an earlier line of the text, and words in repeated runs of
    five. Texts of fewer than ten words, or with more than a fifth of repeated
    words, fail; of the others those are kept whose score reaches ``threshold``.
    A NULL or empty text has no words and fails. Repeated rows, rows without an
    id and ids of ``trusted`` that ``docs`` lacks are allowed; other columns are
    not read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    ratio = weights(docs, trusted, id, text, buckets)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    columns = layout(
        docs.schema[id].dataType,
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, score double, kept boolean",
    )
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scorer(shared, threshold), columns).withColumnRenamed("id", id)
