"""Words of many texts at once, as numpy arrays.

A word is a longest run of characters other than U+0020 and U+0009 to U+000D.
These are single bytes in UTF-8, so texts are cut and hashed as bytes. Texts are
worked on in slices of about a megabyte: the working memory of a task follows
the slice, or its longest text, and not the batch Spark hands over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

U64 = np.uint64
# Odd 64-bit multipliers of the hashes below.
MIX_A, MIX_B, MIX_C = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers in which every bit depends on every bit."""
    values = values ^ (values >> U64(30))
    values = values * MIX_A
    values ^= values >> U64(27)
    values *= MIX_B
    values ^= values >> U64(31)
    return values


def numbers(count: int, seed: int) -> np.ndarray:
    """Pseudo-random 64-bit numbers, the same on every machine."""
    return mixed((np.arange(1, count + 1, dtype=U64) + U64(seed) * U64(1 << 32)) * MIX_C)


def slices(
    texts: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts as (first, last, bytes, offsets); a NULL text is empty.

    ``offsets`` has one more entry than there are texts and starts at 0.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, where, data = texts.buffers()
    ends = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def lowered(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z made small."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table[raw]


class Words:
    """The words of a slice: byte ranges, and the range of words of each text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: Sequence[int] = SEPARATORS):
        inside = np.ones(256, bool)
        inside[list(separators)] = False
        self.raw = raw
        self.inside = inside = inside[raw]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = np.flatnonzero(np.diff(offsets))
        opens[offsets[filled]] = inside[offsets[filled]]
        closes[offsets[filled + 1] - 1] = inside[offsets[filled + 1] - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.lengths = self.ends - self.starts
        # Words of text i are those from bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def texts(self) -> np.ndarray:
        """The number of the text each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self):
            return np.zeros(0, U64)
        before = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        place = np.arange(int(self.lengths.sum())) - np.repeat(before, self.lengths)
        table = numbers(256, 1)
        term = table[self.raw[self.inside]] + place.astype(U64) * MIX_C
        term ^= term >> U64(32)
        term *= MIX_A
        term ^= term >> U64(29)
        return mixed(np.add.reduceat(term, before) + self.lengths.astype(U64))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` hashes; empty if there are fewer."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, U64)
    factors = numbers(width, 2) | U64(1)
    total = np.full(count, U64(width))
    for i in range(width):
        total += hashes[i : i + count] * factors[i]
    return mixed(total)
