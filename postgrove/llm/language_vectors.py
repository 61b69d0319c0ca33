"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A
trigram binds its letters: the product of the first letter's vector permuted
twice, the second's permuted once, and the third's. A text bundles its trigrams:
the sum of their vectors. A language is the bundle of all its training texts,
and a text belongs to the language whose vector has the greatest cosine with
its own (Joshi, Halseth, Kanerva, "Language Geometry Using Random Indexing",
2016). All sums are of whole numbers, so their order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postgrove.llm.stored import layout, small_batches
from postgrove.llm.words import MIX_C, U64, mixed, slices

DIMENSIONS = 1024
UNKNOWN = "und"
# Different trigrams whose vectors are made at a time.
TRIGRAMS = 2048

Batches = Iterator[pa.RecordBatch]


def _letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """One row of +1 and -1 per code point."""
    blocks = np.arange(1, dimensions // 64 + 1, dtype=U64)
    seeds = mixed((points.astype(U64)[:, None] << U64(20)) + blocks[None, :]) * MIX_C
    bits = np.unpackbits(mixed(seeds).view(np.uint8), axis=1)
    return (2 * bits.astype(np.int8) - 1).astype(np.float32)


def _trigrams(
    texts: pa.Array, dimensions: int
) -> Iterator[tuple[int, int, Iterator[tuple[np.ndarray, np.ndarray]], np.ndarray]]:
    """Slices as (first text, last text, parts, letters).

    A part has some of the trigrams of the slice: counts with a row per text and a column per
    trigram, in the order of the rows of its vectors. ``letters`` counts each text's letters.
    Letters are lower-cased, whatever lies between words is one space, and a text
    begins and ends with one.
    """
    for first, last, raw, offsets in slices(texts):
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.append(np.int32(0), np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32))
        bounds = before[offsets] + np.arange(len(offsets))
        # A space is put before each text, and one more after the last.
        spaced = np.full(len(points) + len(offsets), 32, np.uint32)
        inner = np.ones(len(spaced), bool)
        inner[bounds] = False
        spaced[inner] = points
        present = np.zeros(0x110000, bool)
        present[spaced] = True
        fold = np.full(0x110000, 32, np.uint32)
        for point in np.flatnonzero(present):
            if chr(point).isalpha():
                fold[point] = ord(chr(point).lower()[0])
        stream = fold[spaced]
        text = np.repeat(np.arange(len(offsets), dtype=np.int32), np.diff(np.append(bounds, len(spaced))))
        del raw, points, before, spaced, inner
        is_letter = stream != 32
        letters = np.bincount(text[is_letter], minlength=len(offsets))[: last - first]
        # One space between words, kept with the word before it or the text's start.
        kept = is_letter.copy()
        kept[1:] |= is_letter[:-1]
        kept[bounds] = True
        stream, text = stream[kept], text[kept]
        alphabet, letter = np.unique(stream, return_inverse=True)
        size = len(alphabet)
        del stream, is_letter, kept
        # A trigram may end with the space that begins the next text.
        inside = text[:-2] == text[1:-1]
        code = ((letter[:-2] * size + letter[1:-1]) * size + letter[2:])[inside]
        owner = text[:-2][inside]
        # What is not needed is given back before the vectors are made.
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        del text, letter, inside, order
        yield first, last, _parts(code, owner, last - first, alphabet, dimensions), letters


def _parts(
    code: np.ndarray, owner: np.ndarray, texts: int, alphabet: np.ndarray, dimensions: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts and vectors of the trigrams ``code``, in order, of the texts ``owner``, some trigrams at a time."""
    size = len(alphabet)
    opens = np.append(True, code[1:] != code[:-1])[: len(code)]
    column, used = np.cumsum(opens) - 1, code[opens]
    base = _letter_vectors(alphabet, dimensions)
    twice, once = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    for start in range(0, len(used), TRIGRAMS):
        part = used[start : start + TRIGRAMS]
        here = slice(*np.searchsorted(column, (start, start + len(part))))
        counts = np.bincount(owner[here].astype(np.int64) * len(part) + column[here] - start, minlength=texts * len(part))
        vectors = twice[part // (size * size)]
        vectors *= once[part // size % size]
        vectors *= base[part % size]
        yield counts.reshape(texts, len(part)).astype(np.float32), vectors


def _bundler(dimensions: int) -> Callable[[Batches], Batches]:
    def bundle(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, last, parts, _ in _trigrams(batch.column(0), dimensions):
                own = names[first:last]
                for counts, vectors in parts:
                    for name in set(own):
                        total = counts[own == name].sum(axis=0, dtype=np.float64)
                        sums[name] = sums.get(name, 0.0) + total @ vectors.astype(np.float64)
        for name, total in sums.items():
            yield pa.record_batch(
                [
                    pa.array([name] * dimensions, pa.string()),
                    pa.array(np.arange(dimensions, dtype=np.int32)),
                    pa.array(total.astype(np.int64)),
                ],
                names=["lang", "at", "value"],
            )

    return bundle


@dataclass
class Profiles:
    """A vector of length 1 for every language."""

    names: list[str]
    vectors: np.ndarray


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Bundle the texts of each language; rows without one are left out.

    Tasks and the driver hold ``dimensions`` numbers per language.
    """
    if dimensions % 64:
        raise ValueError("dimensions must be a multiple of 64")
    small_batches(docs.sparkSession)
    sums = (
        docs.where(F.col(lang).isNotNull())
        .select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .mapInArrow(_bundler(dimensions), "lang string, at int, value bigint")
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    names, row = np.unique(np.array(sums["lang"].to_pylist(), dtype=object).astype(str), return_inverse=True)
    vectors = np.zeros((len(names), dimensions))
    vectors[row, sums["at"].to_numpy()] = sums["value"].to_numpy()
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    known = length[:, 0] > 0
    return Profiles(names[known].tolist(), (vectors[known] / length[known]).astype(np.float32))


def _scorer(shared, dimensions: int) -> Callable[[Batches], Batches]:
    def score(batches: Batches) -> Batches:
        known, languages = shared.value
        names = np.array([*known, UNKNOWN], dtype=object)
        for batch in batches:
            best, cosine = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            for first, last, parts, letters in _trigrams(batch.column(1), dimensions):
                if not len(known):
                    continue
                own = np.zeros((last - first, dimensions))
                for counts, vectors in parts:
                    own += counts @ vectors
                length = np.linalg.norm(own, axis=1)
                product = own @ languages.T / np.maximum(length, 1e-9)[:, None]
                top = product.argmax(axis=1)
                some = letters > 0
                best[first:last][some] = top[some]
                cosine[first:last][some] = product[np.arange(len(top)), top][some]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(names[best], pa.string()),
                    pa.array(np.clip(cosine, 0.0, 1.0).astype(np.float64)),
                ],
                names=["id", "lang_pred", "score"],
            )

    return score


def identify(docs: DataFrame, profiles: Profiles, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; the score is the cosine, from 0 to 1.

    A NULL text, one without a letter, and every text if no language was learnt,
    is ``und`` with score 0. Whole texts are read and nothing is shuffled. Ties
    go to the first language in code point order. Repeated rows and rows without
    an id are allowed, other columns are not read, and an empty table gives an
    empty result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((profiles.names, profiles.vectors))
    columns = layout(docs.schema[id].dataType, "lang_pred string, score double")
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    dimensions = profiles.vectors.shape[1]
    return rows.mapInArrow(_scorer(shared, dimensions), columns).withColumnRenamed("id", id)
