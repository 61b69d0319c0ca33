"""Quality classifier trained on two views that teach each other.

One view is a text's words, hashed; the other is what describes the page: its
source, language and length, and its layout in lines, marks, capitals and
repetitions. Each view has its own logistic classifier. In every round each
labels all unlabelled rows, where they are, and those it is surest of become
training rows of the other (Blum, Mitchell, "Combining Labeled and Unlabeled Data with
Co-Training", 1998). Labelled rows set aside calibrate both at the end, and the
calibrated views are added to score all documents.

Fitting works on at most ``labelled`` labelled rows, chosen by a hash of the id,
and the rows added in the rounds; everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from postgrove.llm.stored import layout, small_batches, stored
from postgrove.llm.words import U64, Words, lowered, mixed, slices

# The bound of the labelled sample, and how it is used.
LABELLED = 8_000
# Ids of labelled rows that are broadcast to be left out, at most.
MOST_SENT = 1_000_000
ROUNDS, SURE, PER_ROUND = 4, 0.95, 400
WORD_BUCKETS, NAME_BUCKETS, LAYOUT = 512, 64, 10
PENALTY = 1.0
THRESHOLD = 0.5

Batches = Iterator[pa.RecordBatch]


def _hash_name(name: str | None, salt: int) -> int:
    if name is None:
        return -1
    total = U64(salt)
    for value in np.frombuffer(name.encode("utf-8"), np.uint8).astype(U64):
        total = mixed(np.array([total ^ value]))[0]
    return int(total % U64(NAME_BUCKETS))


def _features(
    texts: pa.Array, sources: pa.Array, langs: pa.Array, chars: pa.Array
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices as (first, last, word features, page features), a row per text."""
    marks = np.zeros(256, bool)
    marks[np.frombuffer(b"#*$%&|<>!~^_=+@{}[]\\", np.uint8)] = True
    name_of: dict[tuple, int] = {}
    sources, langs, chars = sources.to_pylist(), langs.to_pylist(), chars.to_pylist()
    for first, last, raw, offsets in slices(texts):
        size = last - first
        words = Words(lowered(raw), offsets)
        text = words.texts()
        bucket = (words.hashes() % U64(WORD_BUCKETS)).astype(np.int64)
        counts = np.bincount(text * WORD_BUCKETS + bucket, minlength=size * WORD_BUCKETS)
        content = np.sqrt(counts.reshape(size, WORD_BUCKETS).astype(np.float32))
        content /= np.maximum(np.linalg.norm(content, axis=1, keepdims=True), 1e-6)

        def sums(hit: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(hit)))[offsets])

        length = np.maximum(np.diff(offsets), 1)
        page = np.zeros((size, LAYOUT + 2 * NAME_BUCKETS), np.float32)
        page[:, 0] = np.log1p(sums(raw == 10))
        page[:, 1] = np.log1p(length) / 10
        page[:, 2] = 10 * sums(marks[raw]) / length
        page[:, 3] = 5 * sums((raw >= 65) & (raw <= 90)) / length
        page[:, 4] = 5 * sums((raw >= 48) & (raw <= 57)) / length
        page[:, 5] = sums(words.inside) / np.maximum(words.counts, 1) / 10
        for i in range(size):
            lines = raw[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")
            page[i, 6] = 1 - len(set(lines)) / len(lines)
            own = bucket[words.bounds[i] : words.bounds[i + 1]]
            page[i, 7] = len(np.unique(own)) / max(min(len(own), WORD_BUCKETS), 1)
            n = chars[first + i]
            page[i, 8] = 0.0 if n is None else np.log1p(max(n, 0)) / 10
            page[i, 9] = float(n is None)
            for name, salt in ((sources[first + i], 1), (langs[first + i], 2)):
                if (name, salt) not in name_of:
                    name_of[name, salt] = _hash_name(name, salt)
                at = name_of[name, salt]
                if at >= 0:
                    page[i, LAYOUT + (salt - 1) * NAME_BUCKETS + at] = 1.0
        yield first, last, content, page


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _fit(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights of a logistic classifier, the last one the constant, by Newton steps.

    Rows are widened to double precision a block at a time.
    """
    size = rows.shape[1] + 1
    solution = np.zeros(size)
    ridge = np.full(size, penalty)
    ridge[-1] = 1e-3
    for _ in range(12):
        slope, curve = ridge * solution, np.diag(ridge)
        for start in range(0, len(rows), 1024):
            here = slice(start, start + 1024)
            part = np.hstack((rows[here].astype(float), np.ones((len(rows[here]), 1))))
            p = _probability(part @ solution)
            slope = slope + part.T @ (weight[here] * (p - labels[here]))
            curve = curve + (part * (weight[here] * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ part
        step = np.linalg.solve(curve, slope)
        solution -= step
        if np.abs(step).max() < 1e-6:
            break
    return solution


@dataclass
class Classifier:
    """Weights of both views, and slope and constant that calibrate each."""

    views: list[np.ndarray]
    calibration: list[np.ndarray]
    prior: float

    def logits(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Calibrated logits of each view."""
        return [
            (x @ w[:-1] + w[-1]) * slope + constant
            for x, w, (slope, constant) in zip(rows, self.views, self.calibration)
        ]

    def probability(self, rows: list[np.ndarray]) -> np.ndarray:
        """Both views taken as independent given the class: the prior counts once."""
        one, two = self.logits(rows)
        return _probability(one + two - self.prior)


# For the weights of both views and, for each as teacher, the numbers of good and
# bad rows wanted: the other view's features of those rows, and their classes.
Surest = Callable[[list[np.ndarray], list[tuple[int, int]]], list[tuple[np.ndarray, np.ndarray]]]


def _surest_in_memory(pool: list[np.ndarray], sure: float) -> Surest:
    taken = [np.zeros(len(pool[0]), bool), np.zeros(len(pool[0]), bool)]

    def surest(weights: list[np.ndarray], wanted: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        found = []
        for teacher, (w, (n_good, n_bad)) in enumerate(zip(weights, wanted)):
            pupil = 1 - teacher
            p = _probability(pool[teacher] @ w[:-1] + w[-1])
            p_free = np.where(taken[pupil], 0.5, p)
            good = [i for i in np.argsort(-p_free, kind="stable")[:n_good] if p_free[i] >= sure]
            bad = [i for i in np.argsort(p_free, kind="stable")[:n_bad] if p_free[i] <= 1 - sure]
            rows = np.array(good + bad, int)
            taken[pupil][rows] = True
            found.append((pool[pupil][rows], np.array([1.0] * len(good) + [0.0] * len(bad))))
        return found

    return surest


def _task_surest(shared, sure: float) -> Callable[[Batches], Batches]:
    """Of a task's rows, those each view is surest of, as many as are wanted of all."""

    def run(batches: Batches) -> Batches:
        weights, wanted, taken = shared.value
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for first, last, *views in _features(*batch.columns[1:5]):
                key = keys[first:last]
                for teacher, w in enumerate(weights):
                    logit = views[teacher].astype(float) @ w[:-1] + w[-1]
                    free = ~np.isin(key, taken[teacher])
                    for value, most in zip((1, 0), wanted[teacher]):
                        own = logit if value else -logit
                        at = np.flatnonzero(free & (_probability(own) >= sure))
                        part = own[at], key[at], views[1 - teacher][at]
                        if (teacher, value) in best:
                            part = tuple(np.concatenate(x) for x in zip(best[teacher, value], part))
                        order = np.lexsort((part[1], -part[0]))[:most]
                        best[teacher, value] = tuple(x[order] for x in part)
        for (teacher, value), (own, key, rows) in best.items():
            yield pa.record_batch(
                [
                    pa.array(np.full(len(own), teacher, np.int32)),
                    pa.array(np.full(len(own), value, np.int32)),
                    pa.array(own, pa.float64()),
                    pa.array(key, pa.int64()),
                    pa.array([x.tobytes() for x in rows], pa.binary()),
                ],
                names=["teacher", "value", "own", "key", "row"],
            )

    return run


def _surest_on_spark(rows: DataFrame, sure: float) -> Surest:
    """The same over all rows of (key, text, source, lang, chars), which stay where they are."""
    taken = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
    order = Window.partitionBy("teacher", "value").orderBy(F.col("own").desc(), "key")
    widths = WORD_BUCKETS, LAYOUT + 2 * NAME_BUCKETS

    def surest(weights: list[np.ndarray], wanted: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        shared = rows.sparkSession.sparkContext.broadcast((weights, wanted, taken))
        columns = "teacher int, value int, own double, key bigint, row binary"
        near = rows.mapInArrow(_task_surest(shared, sure), columns)
        top = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(map(max, wanted)))
        table = top.toArrow().sort_by([("teacher", "ascending"), ("value", "descending"), ("rank", "ascending")])
        teachers, values, ranks, keys = (table[x].to_numpy() for x in ("teacher", "value", "rank", "key"))
        blobs = table["row"].to_pylist()
        found = []
        for teacher, (n_good, n_bad) in enumerate(wanted):
            at = np.flatnonzero((teachers == teacher) & (ranks <= np.where(values == 1, n_good, n_bad)))
            taken[teacher] = np.union1d(taken[teacher], keys[at])
            own = np.frombuffer(b"".join([blobs[i] for i in at]), np.float32).reshape(-1, widths[1 - teacher])
            found.append((own, values[at].astype(float)))
        return found

    return surest


def co_train(
    views: list[np.ndarray], labels: np.ndarray, pool: list[np.ndarray] | Surest,
    rounds: int = ROUNDS, sure: float = SURE, per_round: int = PER_ROUND,
) -> Classifier:
    """Fit from labelled rows of both views and the unlabelled pool, in memory or anywhere else."""
    if len(np.unique(labels)) < 2:
        # One class alone: every row belongs to it.
        constant = 5.0 if len(labels) == 0 or labels[0] else -5.0
        flat = [np.zeros(x.shape[1] + 1) for x in views]
        return Classifier(flat, [np.array([1.0, constant])] * 2, 0.0)
    aside = np.arange(len(labels)) % 5 == 0
    if len(np.unique(labels[aside])) < 2 or len(np.unique(labels[~aside])) < 2:
        aside = np.zeros(len(labels), bool)
    learn = [x[~aside] for x in views]
    target = [labels[~aside].astype(float)] * 2
    surest = pool if callable(pool) else _surest_in_memory(pool, sure)

    def fitted() -> list[np.ndarray]:
        return [_fit(x, y, np.ones(len(y))) for x, y in zip(learn, target)]

    weights = fitted()
    for _ in range(rounds):
        # Both classes are added in the proportion in which they occur.
        shares = [target[1 - teacher].mean() for teacher in (0, 1)]
        wanted = [(round(per_round * share), round(per_round * (1 - share))) for share in shares]
        gains = surest(weights, wanted)
        for teacher, (rows, values) in enumerate(gains):
            pupil = 1 - teacher
            learn[pupil] = np.vstack((learn[pupil], rows))
            target[pupil] = np.concatenate((target[pupil], values))
        if not any(len(values) for _, values in gains):
            break
        weights = fitted()
    held = aside if aside.any() else ~aside
    calibration = []
    for x, w in zip(views, weights):
        raw = (x[held] @ w[:-1] + w[-1])[:, None]
        calibration.append(_fit(raw, labels[held].astype(float), np.ones(int(held.sum())), 1e-2))
    share = labels.mean()
    return Classifier(weights, calibration, float(np.log(share / (1 - share))))


def _columns(docs: DataFrame, id: str, text: str, source: str, lang: str, chars: str) -> DataFrame:
    return docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"), F.col(chars).cast("long").alias("chars"),
    )


def _sampled(batches: Batches) -> Batches:
    for batch in batches:
        for first, last, content, page in _features(*batch.columns[1:5]):
            yield pa.record_batch(
                [
                    batch.column(0).slice(first, last - first),
                    batch.column(5).slice(first, last - first),
                    pa.array([x.tobytes() for x in content], pa.binary()),
                    pa.array([x.tobytes() for x in page], pa.binary()),
                ],
                names=["id", "label", "content", "page"],
            )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    label: str = "quality",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    chars: str = "n_chars",
    labelled: int = LABELLED,
    pool: int | None = None,
) -> Classifier:
    """Fit on the bounded labelled sample and all other rows, or ``pool`` of them; ``label`` is 1 for good rows and 0 for bad ones.

    Rows of ``labels`` without id or label are left out, and of several for an id
    the lowest counts. Labels of rows that ``docs`` does not have take no place
    of the sample. The sample is the rows of lowest hash, the same in every run.
    """
    small_batches(docs.sparkSession)
    rows = _columns(docs, id, text, source, lang, chars).where("id is not null")
    known = stored(
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id).alias("id"))
        .agg(F.min(label).cast("int").alias("label"))
        .join(rows.select("id").distinct(), "id", "left_semi"),
        "labels",
    )
    lowest = F.xxhash64("id")
    # At most labelled ids.
    sample = F.broadcast(known.orderBy(lowest, "id").limit(labelled))
    left_out = known.select("id")
    if left_out.count() <= MOST_SENT:
        left_out = F.broadcast(left_out)
    others = rows.join(left_out, "id", "left_anti")
    if pool is not None:
        few = others.select("id").distinct().orderBy(lowest, "id").limit(pool)
        others = others.join(F.broadcast(few), "id", "left_semi")
    others = others.select(lowest.alias("key"), "text", "source", "lang", "chars")
    columns = layout(rows.schema["id"].dataType, "label int, content binary, page binary")
    found = rows.join(sample, "id").mapInArrow(_sampled, columns).toArrow().sort_by("id")
    if not found.num_rows:
        return co_train([np.zeros((0, WORD_BUCKETS)), np.zeros((0, LAYOUT + 2 * NAME_BUCKETS))], np.zeros(0), [np.zeros((0, 1))] * 2)
    value = found["label"].to_numpy()
    # All rows are of one size and none is NULL, so the features stand one behind the other.
    views = []
    for name in ("content", "page"):
        column = found[name].combine_chunks()
        start = column.buffers()[1]
        first = int(np.frombuffer(start, np.int32)[column.offset])
        width = WORD_BUCKETS if name == "content" else LAYOUT + 2 * NAME_BUCKETS
        flat = np.frombuffer(column.buffers()[2], np.float32, len(value) * width, first)
        views.append(flat.reshape(len(value), width))
    # In order of hash, so that no fold follows the order of ids.
    mix = np.argsort(mixed(np.arange(len(value), dtype=U64)))
    return co_train([x[mix] for x in views], (value[mix] > 0).astype(int), _surest_on_spark(others, SURE))


def _scoring(shared, threshold: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        model = Classifier(*shared.value)
        for batch in batches:
            for first, last, content, page in _features(*batch.columns[1:5]):
                one, two = model.logits([content, page])
                p = model.probability([content, page]).astype(float)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(_probability(one).astype(float)),
                        pa.array(_probability(two).astype(float)),
                        pa.array(p),
                        pa.array(p >= threshold),
                    ],
                    names=["id", "content_score", "page_score", "score", "kept"],
                )

    return run


def classify(
    docs: DataFrame,
    model: Classifier,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    chars: str = "n_chars",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, content_score, page_score, score, kept) of every row, where it is.

    Scores are probabilities of being good, of each view and of both; rows of
    ``threshold`` or more are kept. A NULL text is an empty one, and NULL source,
    language or length are values of their own. Without any labelled row all are
    kept. Whole texts are read; repeated rows get equal scores; an empty table
    gives an empty result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.views, model.calibration, model.prior))
    rows = _columns(docs, id, text, source, lang, chars)
    columns = layout(
        rows.schema["id"].dataType, "content_score double, page_score double, score double, kept boolean"
    )
    return rows.mapInArrow(_scoring(shared, threshold), columns).withColumnRenamed("id", id)
