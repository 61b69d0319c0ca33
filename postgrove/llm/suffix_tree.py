"""Scores of texts under a probabilistic suffix tree of words.

The symbols are a text's lower-cased words and one end. The tree predicts the
next symbol from the symbols before it, through contexts of different length as
in Ron, Singer, Tishby, "The Power of Amnesia" (1996). Of a context, what follows
it has to diverge from what follows its longest kept suffix by more than chance
explains. The longest kept suffix of what precedes a token predicts it.

The root is the smoothed frequency of words. What a context does not count has the
shorter context's distribution, in the share that is left, so every distribution sums to 1.

All contexts and all that follows them are counted, however rare. The tree is
therefore never in one place. A token goes, with the symbols before it and its text,
to the bucket of the symbol just before it, where all contexts ending in that symbol
are: a task grows this part of the tree and scores its tokens by it, and the sums of
the texts go back. A symbol with more tokens than a bucket should hold is spread by
the symbol before it: its buckets then hold its longer contexts whole, and are given
what follows it alone from a table. ``contexts`` and ``counts``, if finite, ask for
a smaller tree: contexts seen sqrt(N) / ``contexts`` times and what follows them
sqrt(N) / ``counts`` times, of N tokens.

Words are counted first. Tasks look the most frequent up in a table of at most
``1 / fine`` rows; the counts of rarer words are joined to the buckets they are needed in.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postgrove.llm.stored import layout, small_batches, stored
from postgrove.llm.words import SLICE_BYTES, U64, Words, lowered, mixed, slices

DEPTH = 2
FINE = 1e-6
PRIOR = 10.0
# Standard deviations beyond chance at which a context diverges.
DEVIATIONS = 3.0
# Tokens of a bucket, buckets of a task, buckets a symbol may overfill before it is spread, and
# tokens a task deals to buckets at a time.
BUCKET, TOGETHER, OVERFULL = 500_000, 3, 3
DEALT = 1 << 20
# The end, and what is before a text; words have other hashes.
END, NONE = U64(0), U64(1)
# Row of a text, and what a bucket adds to its known words, base score and gain.
ADDED = "<i8", "<i8", "<f8", "<f8"

Batches = Iterator[pa.RecordBatch]


def _word_counter() -> Callable[[Batches], Batches]:
    """(kind, word, n): 0 for words of the training texts, 1 for these texts, 2 for all tokens."""

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([kind] * len(keys), pa.int32()), pa.array(keys.astype(np.int64)), pa.array(n, pa.int64())],
            names=["kind", "word", "n"],
        )

    def count(batches: Batches) -> Batches:
        texts = tokens = 0
        for batch in batches:
            learn = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, raw, offsets in slices(batch.column(0), 8 * SLICE_BYTES):
                words = Words(lowered(raw), offsets)
                own = learn[first:last]
                texts, tokens = texts + int(own.sum()), tokens + len(words) + last - first
                keys, n = np.unique(words.hashes()[own[words.texts()]], return_counts=True)
                yield rows(0, keys, n)
        yield rows(1, np.zeros(1), np.array([texts]))
        yield rows(2, np.zeros(1), np.array([tokens]))

    return count


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` stand in sorted ``keys``, and whether they do."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _sequence(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, tokens, their places, text of each) of slices of texts."""
    for first, last, raw, offsets in slices(texts):
        words = Words(lowered(raw), offsets)
        sizes = words.counts + 1
        ends = np.cumsum(sizes)
        tokens = np.full(int(ends[-1]), END)
        inner = np.ones(len(tokens), bool)
        inner[ends - 1] = False
        tokens[inner] = words.hashes()
        places = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)
        yield first, last, tokens, places, np.repeat(np.arange(last - first), sizes)


def _before(values: np.ndarray, places: np.ndarray, back: int, none) -> np.ndarray:
    """The value ``back`` tokens before each, ``none`` before the text."""
    found = np.full(len(values), none, values.dtype)
    found[back:] = values[:-back]
    found[places < back] = none
    return found


def _buckets(
    tokens: np.ndarray, places: np.ndarray, depth: int, heavy: np.ndarray, spread: np.ndarray, count: int
) -> np.ndarray:
    """The bucket of each token: of the symbol before it, and of a heavy one's share of the symbols before that."""
    before = _before(tokens, places, 1, NONE)
    key = mixed(before)
    at, found = _found(heavy, before)
    if found.any():
        # At depth 1 there are no longer contexts to keep whole.
        other = _before(tokens, places, 2, NONE) if depth > 1 else tokens
        key[found] = _share(before[found], mixed(other[found]) % spread[at[found]])
    # The first token of a text has no context, so it may be anywhere.
    alone = places == 0
    key[alone] = mixed(tokens[alone] ^ mixed(np.append(tokens[1:], END)[alone]))
    return (key % U64(count)).astype(np.int64)


def _share(words: np.ndarray, share: np.ndarray) -> np.ndarray:
    return mixed(mixed(words) + share.astype(U64))


def _planes(values: np.ndarray, kind: str) -> bytes:
    """First bytes of all values, then second bytes, and so on: these compress better."""
    return values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T.tobytes()


def _narrow(count: int) -> str:
    return "<u2" if count <= 1 << 16 else "<u4"


def _packed(
    symbols: list[np.ndarray], marks: np.ndarray, spots: np.ndarray, hashes: np.ndarray, home: int
) -> bytes:
    """Tokens of a bucket, what is before them, and their texts.

    Symbols are 0 for the end, 1 for what is before a text, and from 2 on frequent words, by their
    place in the table, then others, by their hash.
    """
    used, own = np.unique(np.concatenate([[0, 1], *symbols]), return_inverse=True)
    texts, text = np.unique(marks, return_inverse=True)
    used = used[2:] - 2
    frequent, rare = spots[used[used < len(spots)]], hashes[used[used >= len(spots)] - len(spots)]
    data = b"".join(
        [
            _planes(np.diff(frequent, prepend=0), "<u4"), _planes(np.diff(texts, prepend=0), "<i8"), rare.tobytes(),
            _planes(own[2:], _narrow(len(used) + 2)), _planes(text, _narrow(len(texts))),
        ]
    )
    head = np.array([len(data), len(marks), len(frequent), len(rare), len(texts), home], "<i8")
    return head.tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, depth: int, fine: np.ndarray) -> tuple:
    """(hashes of symbols from 2 on, marks of texts, symbols with a row for each place, text numbers, home)."""
    full, size, frequent, rare, texts, home = np.frombuffer(packed, "<i8", 6).tolist()
    data = np.frombuffer(pa.decompress(packed[48:], full, codec="zstd", asbytes=True), np.uint8)
    at = 0

    def taken(count: int, kind: str, planes: bool = True) -> np.ndarray:
        nonlocal at
        width = np.dtype(kind).itemsize
        own = data[at : at + count * width]
        at += count * width
        return (np.ascontiguousarray(own.reshape(width, count).T) if planes else own.copy()).view(kind).reshape(-1)

    places, marks = np.cumsum(taken(frequent, "<u4"), dtype=np.int64), np.cumsum(taken(texts, "<i8"))
    hashes = np.concatenate((fine[places], taken(rare, "<u8", False)))
    symbols = taken(size * (depth + 1), _narrow(len(hashes) + 2)).reshape(depth + 1, size)
    return hashes, marks, symbols, taken(size, _narrow(texts)), home


def _dealer(shared, depth: int, below: float, texts: int) -> Callable[[Batches], Batches]:
    """From (row, id, text, learn, scored): tokens by bucket, packed, and a row for each scored text.

    That row has the text's score by frequent words and the end; buckets add the others.
    """

    def deal(batches: Batches) -> Batches:
        fine, common, heavy, spread, count = shared.value
        plain = np.log10(common + 0.1) - below
        end = float(np.log10(texts + 0.1) - below)
        held: list[tuple] = []

        def batch_of(ids: pa.Array, buckets, blobs, *others) -> pa.RecordBatch:
            columns = [ids, pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary()), *others]
            return pa.record_batch(
                columns, names=["id", "bucket", "tokens", "row", "n_tokens", "n_known", "base_score"]
            )

        def flush() -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([x[0] for x in held])
            tokens, places, marks = (np.concatenate([x[i] for x in held]) for i in (1, 2, 3))
            held.clear()
            words, number = np.unique(tokens, return_inverse=True)
            at, found = _found(fine, words)
            rare, last = ~found & (words != END), int((words == END).sum())
            starts = np.flatnonzero(places == 0)
            sizes = np.diff(np.append(starts, len(tokens)))
            known = np.add.reduceat(found.astype(np.int64)[number], starts) + int(texts > 0)
            score = np.where(found, plain[at], 0.0) if len(fine) else np.zeros(len(words))
            score = np.add.reduceat(score[number], starts) + end
            text = np.flatnonzero(marks[starts] & 1)
            rows = marks[starts][text] >> 2
            yield batch_of(
                ids.filter(pa.array(marks[starts] & 1 > 0)), rows % count, [None] * len(rows), pa.array(rows),
                pa.array(sizes[text], pa.int64()), pa.array(known[text]), pa.array(score[text]),
            )
            symbol = np.zeros(len(words), np.int64)
            symbol[found], symbol[rare] = np.arange(found.sum()) + 2, np.arange(rare.sum()) + 2 + found.sum()
            spots, hashes, number = at[found], words[rare], symbol[number]
            bucket = _buckets(tokens, places, depth, heavy, spread, count)
            symbols = [number, *(_before(number, places, back, 1) for back in range(1, depth + 1))]
            order = np.argsort((bucket * (len(words) + 2) + symbols[1]) * (len(words) + 2) + number)
            bucket = bucket[order]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(order)]))
            blobs = [
                _packed([x[order[a:b]] for x in symbols], marks[order[a:b]], spots, hashes, int(marks.min() >> 2))
                for a, b in zip(edges, edges[1:])
            ]
            empty, none = pa.nulls(len(blobs), pa.int64()), pa.nulls(len(blobs), pa.float64())
            yield batch_of(pa.nulls(len(blobs), ids.type), bucket[edges[:-1]], blobs, empty, empty, empty, none)

        for batch in batches:
            learn, scored = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            marks = batch.column(0).to_numpy() * 4 + learn * 2 + scored
            for first, last, tokens, places, text in _sequence(batch.column(2)):
                held.append((batch.column(1).slice(first, last - first), tokens, places, marks[first:last][text]))
                if sum(len(x[1]) for x in held) >= DEALT:
                    yield from flush()
        if held:
            yield from flush()

    return deal


def _needed(shared, depth: int) -> Callable[[Batches], Batches]:
    """(word, bucket): the buckets of words that are not in the table of frequent ones."""

    def need(batches: Batches) -> Batches:
        fine, _, heavy, spread, count = shared.value
        for batch in batches:
            for _, _, tokens, places, _ in _sequence(batch.column(0)):
                words, number = np.unique(tokens, return_inverse=True)
                rare = (~_found(fine, words)[1] & (words != END))[number]
                bucket = _buckets(tokens, places, depth, heavy, spread, count)[rare]
                pairs = np.unique(number[rare] * count + bucket)
                yield pa.record_batch(
                    [
                        pa.array(words[pairs // count].astype(np.int64)),
                        pa.array((pairs % count).astype(np.int32)),
                    ],
                    names=["word", "bucket"],
                )

    return need


def _followers(shared) -> Callable[[Batches], Batches]:
    """(context, word, n): what follows heavy words."""

    def count(batches: Batches) -> Batches:
        heavy = shared.value[2]
        for batch in batches:
            for _, _, tokens, places, _ in _sequence(batch.column(0)):
                at, found = _found(heavy, _before(tokens, places, 1, NONE))
                words, number = np.unique(tokens[found], return_inverse=True)
                size = max(len(words), 1)
                pairs, n = np.unique(at[found] * size + number, return_counts=True)
                yield pa.record_batch(
                    [
                        pa.array(heavy[pairs // size].astype(np.int64)),
                        pa.array(words[pairs % size].astype(np.int64)),
                        pa.array(n, pa.int64()),
                    ],
                    names=["context", "word", "n"],
                )

    return count


@dataclass
class Head:
    """Words by hash, in order, with their rank.

    Ranks up to ``contexts`` may stand in a context. The end has the last rank.
    """

    hashes: np.ndarray
    ranks: np.ndarray
    contexts: int

    @property
    def end(self) -> int:
        return len(self.hashes)

    def contexts_of(self, ranks: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
        """A number for the ``length`` symbols before each token; -1 if they are no possible context."""
        base = self.contexts + 1
        code, good = np.zeros(len(ranks), np.int64), places >= length
        for back in range(length, 0, -1):
            before = np.full(len(ranks), -1)
            before[back:] = ranks[:-back]
            good &= (before >= 0) & (before < self.contexts)
            code = code * base + before + 1
        return np.where(good, code, -1)


@dataclass
class Level:
    """Kept contexts of one length: what they count, and the share that is left, as log10."""

    contexts: np.ndarray
    rest: np.ndarray
    # Sorted numbers of (context, next), and the log10 of their probability against the root's.
    pairs: np.ndarray
    gains: np.ndarray


class Tree:
    """Gains of tokens over the root, from the kept contexts of a bucket."""

    def __init__(self, head: Head, root: np.ndarray):
        self.head, self.root, self.levels = head, root, []

    def gains(self, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token after its longest kept suffix, against the root's."""
        gain = np.zeros(len(ranks))
        for length in range(1, len(self.levels) + 1):
            context = self.head.contexts_of(ranks, places, length)
            here = np.flatnonzero(context >= 0)
            gain[here] = self.shorter_gain(context[here], ranks[here], length + 1)
        return gain

    def against(self, level: Level, at: np.ndarray, next: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Of contexts at ``at`` of a level; ``shorter`` is the gain in the shorter context."""
        value = level.rest[at] + shorter
        if len(level.pairs):
            pair = at * (self.head.end + 2) + next + 1
            where = np.minimum(np.searchsorted(level.pairs, pair), len(level.pairs) - 1)
            value = np.where(level.pairs[where] == pair, level.gains[where], value)
        return value

    def shorter_gain(self, context: np.ndarray, next: np.ndarray, length: int) -> np.ndarray:
        """The gain of ``next`` after the longest kept suffix, shorter than ``length``, of contexts."""
        base = self.head.contexts + 1
        gain = np.zeros(len(context))
        for size, level in enumerate(self.levels[: length - 1], 1):
            if len(level.contexts):
                suffix = context % base**size
                at = np.minimum(np.searchsorted(level.contexts, suffix), len(level.contexts) - 1)
                gain = np.where(level.contexts[at] == suffix, self.against(level, at, next, gain), gain)
        return gain

    def grow(self, length: int, context: np.ndarray, next: np.ndarray, n: np.ndarray, total: np.ndarray,
             prior: float, deviations: float) -> None:
        """Add the contexts of one length that diverge, from rows of (context, next, n, total of the context)."""
        if not len(context):
            empty = np.zeros(0, np.int64)
            self.levels.append(Level(empty, np.zeros(0), empty, np.zeros(0)))
            return
        expected = 10 ** (self.root[next] + self.shorter_gain(context, next, length))
        names, first, inverse = np.unique(context, return_index=True, return_inverse=True)
        totals = total[first]
        seen = np.bincount(inverse, n, len(names))
        # Twice the likelihood ratio, what is not counted taken as one symbol more.
        ratio = 2 * np.bincount(inverse, n * np.log(n / (total * expected)), len(names))
        left = np.maximum(totals - seen, 0.0)
        left_expected = np.maximum(1 - np.bincount(inverse, expected, len(names)), 1e-9)
        ratio += 2 * np.where(left > 0, left * np.log(np.maximum(left, 1e-9) / (totals * left_expected)), 0.0)
        freedom = np.bincount(inverse, minlength=len(names))
        kept = ratio > freedom + deviations * np.sqrt(2.0 * freedom)
        # The share that is left goes to the symbols not counted here, in the proportions of the shorter context.
        share = (left + prior) / (totals + prior) if prior else left / totals
        row = kept[inverse]
        position = np.cumsum(kept) - 1
        pairs = position[inverse[row]] * (self.head.end + 2) + next[row] + 1
        probability = (n[row] + prior * expected[row]) / (total[row] + prior)
        uncounted = share - np.bincount(inverse, prior * expected, len(names)) / (totals + prior)
        rest = np.log10(np.maximum(uncounted, 1e-12) / left_expected)[kept]
        order = np.argsort(pairs)
        gains = np.log10(probability) - self.root[next[row]]
        self.levels.append(Level(names[kept], rest, pairs[order], gains[order]))


def _grower(
    shared, depth: int, least: float, head: float, prior: float, deviations: float, texts: int, below: float
) -> Callable[[Batches], Batches]:
    """From all rows of buckets, in order of bucket: the rows of texts, and what each bucket adds to them."""

    def rows_of(*columns: pa.Array) -> pa.RecordBatch:
        names = ["id", "row", "n_tokens", "n_known", "base_score", "home", "added"]
        return pa.record_batch(list(columns), names=names)

    def finish(blobs: list[bytes], rare: list, pairs: list, sent: dict) -> None:
        fine, common, *_ = shared.value
        parts = [_unpacked(x, depth, fine) for x in blobs]
        pairs = [np.concatenate([x[i] for x in pairs]) if pairs else np.zeros(0, np.int64) for i in range(4)]
        after, follower = pairs[0].astype(U64), pairs[1].astype(U64)
        words, number = np.unique(
            np.concatenate([[END, NONE], after, follower, *(x[0] for x in parts)]), return_inverse=True
        )
        # The end has the last rank, what is before a text -1.
        extreme = np.array([len(words) - 2, -1], np.int32)
        ranks, number = np.split((number[2:] - 2).astype(np.int32), [2 * len(after)])
        after, follower = np.split(np.where(ranks < 0, extreme[0], ranks).astype(np.int64), 2)
        starts = np.cumsum([0] + [len(x[0]) for x in parts])
        symbols = np.concatenate(
            [np.append(extreme, number[a : a + len(x[0])])[x[2]] for a, x in zip(starts, parts)], axis=1
        )
        starts, homes = np.cumsum([0] + [len(x[1]) for x in parts]), [x[4] for x in parts]
        marks = np.concatenate([x[1] for x in parts])
        text = np.concatenate([np.int32(a) + x[3].astype(np.int32) for a, x in zip(starts, parts)])
        del parts, ranks, number
        learn, token = (marks & 2 > 0)[text], symbols[0]
        # Counts of the words, from the table of frequent ones or from the joins.
        c = np.zeros(len(words) - 1, np.int64)
        at, found = _found(fine, words[2:])
        c[:-1][found] = common[at[found]]
        uncommon = np.append(~found, False)
        for joined, n in rare:
            at, found = _found(words[2:], joined.astype(U64))
            c[at[found]] = n[found]
        c[follower] = pairs[3]
        c[-1] = texts
        root = np.log10(c + 0.1) - below
        tree = Tree(Head(words[2:], np.arange(len(words) - 2), len(words) - 2), root)
        base, over = len(words) - 1, len(words)
        if base**depth * over >= 1 << 63:
            raise ValueError("too many words in a bucket for this depth: lower BUCKET")
        gain = np.zeros(len(token))
        here, context = np.arange(len(token)), np.zeros(len(token), np.int64)
        for length in range(1, depth + 1):
            # Tokens with that many symbols before them.
            good = symbols[length][here] >= 0
            here, context = here[good], context[good] + (symbols[length][here[good]] + 1) * base ** (length - 1)
            types, type = np.unique(context * over + token[here] + 1, return_inverse=True)
            n = np.bincount(type[learn[here]], minlength=len(types))
            before, next = types // over, types % over - 1
            if length == 1 and len(after):
                # Of a heavy word the bucket has a share; the table has the whole.
                whole = np.isin(before, after + 1)
                rows = [np.append(x[~whole], y) for x, y in ((before, after + 1), (next, follower), (n, pairs[2]))]
            else:
                rows = [before, next, n]
            names, of = np.unique(rows[0], return_inverse=True)
            total = np.bincount(of, rows[2], len(names))[of]
            own = (rows[2] > 0) & (rows[2] >= head) & (total >= least)
            tree.grow(length, *(x[own] for x in rows[:2]), rows[2][own].astype(float), total[own], prior, deviations)
            gain[here] = tree.shorter_gain(before, next, length + 1)[type]
        size = len(marks)
        known = np.bincount(text, (uncommon & (c > 0))[token], size)
        plain = np.bincount(text, np.where(uncommon, root, 0.0)[token], size)
        sums = marks >> 2, known, plain, np.bincount(text, gain, size)
        for home, a, b in zip(homes, starts, starts[1:]):
            scored = marks[a:b] & 1 > 0
            sent.setdefault(home, []).append([x[a:b][scored].astype(y) for x, y in zip(sums, ADDED)])

    def send(sent: dict, kind: pa.DataType) -> pa.RecordBatch:
        """What some buckets add to the texts, in one piece for those dealt together."""
        added = []
        for parts in sent.values():
            data = b"".join(x.astype(y).tobytes() for x, y in zip(_added(parts), ADDED))
            added.append(np.int64(len(data)).tobytes() + pa.compress(data, codec="zstd", asbytes=True))
        homes = pa.array(list(sent), pa.int64())
        empty, none = pa.nulls(len(homes), pa.int64()), pa.nulls(len(homes), pa.float64())
        return rows_of(pa.nulls(len(homes), kind), empty, empty, empty, none, homes, pa.array(added, pa.binary()))

    def grow(batches: Batches) -> Batches:
        bucket, held, kind, sent = None, ([], [], []), None, {}
        for batch in batches:
            kind = batch.schema.field(2).type
            blobs = batch.column(1)
            for i, name in enumerate(batch.column(0).to_pylist()):
                if name != bucket:
                    if held[0]:
                        finish(*held, sent)
                    if sum(len(x[0]) for parts in sent.values() for x in parts) > TOGETHER * BUCKET:
                        yield send(sent, kind)
                        sent = {}
                    bucket, held = name, ([], [], [])
                if blobs[i].is_valid:
                    held[0].append(blobs[i].as_py())
                for spot, own in ((7, held[1]), (8, held[2])):
                    if batch.column(spot)[i].is_valid:
                        fields = batch.column(spot)[i].values.flatten()
                        own.append([x.to_numpy(zero_copy_only=False) for x in fields])
            named = batch.filter(batch.column(3).is_valid())
            size = named.num_rows
            yield rows_of(
                *(named.column(i) for i in range(2, 7)), pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary())
            )
        if held[0]:
            finish(*held, sent)
        if sent:
            yield send(sent, kind)

    return grow


def _added(parts: list) -> list[np.ndarray]:
    """Fields as in ``ADDED`` with one row for each text."""
    fields = [np.concatenate(x) for x in zip(*parts)]
    rows, text = np.unique(fields[0], return_inverse=True)
    return [rows, *(np.bincount(text, x, len(rows)).astype(y) for x, y in zip(fields[1:], ADDED[1:]))]


def _adder() -> Callable[[Batches], Batches]:
    """From (home, added), in order of home: a row for each text."""

    def total(held: list[bytes]) -> pa.RecordBatch:
        parts = []
        for packed in held:
            full = int(np.frombuffer(packed, "<i8", 1)[0])
            data, size = pa.decompress(packed[8:], full, codec="zstd", asbytes=True), full // 32
            parts.append([np.frombuffer(data, kind, size, 8 * i * size) for i, kind in enumerate(ADDED)])
        return pa.record_batch(
            [pa.array(x) for x in _added(parts)],
            names=["row", "more_known", "more_base", "gain"],
        )

    def add(batches: Batches) -> Batches:
        home, held = None, []
        for batch in batches:
            for own, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != home and held:
                    yield total(held)
                    held = []
                home = own
                held.append(packed)
        if held:
            yield total(held)

    return add


def scores(
    docs: DataFrame,
    training: DataFrame | Column,
    id: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    contexts: float = math.inf,
    counts: float = math.inf,
    fine: float = FINE,
    prior: float = PRIOR,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``training`` is a table, or the condition under which rows of ``docs`` are learnt
    from, which reads them once. Tokens are the words and one end. ``base_score`` sums
    the log10 of (c + 0.1) / (N + 0.1 (V + 1)) over them: c is how often ``training`` has the
    token, N how many it has, V how many different ones; ``n_known`` are those
    with c > 0. It is also the score of the tree's root. ``score`` is the log10
    probability of the text under the tree. A NULL or empty text is an end alone.
    Words are told apart by a 64-bit hash. Every row counts once, repeated rows
    and rows without an id too; other columns are not read. Without training rows
    every token is unknown; an empty table gives an empty result.
    """
    if not 1 <= depth <= 3:
        raise ValueError("depth must be from 1 to 3")
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id].dataType
    own = [F.col(id).alias("id"), F.col(text).alias("text")]
    if isinstance(training, Column):
        rows = docs.select(*own, F.coalesce(training, F.lit(False)).alias("learn"), F.lit(True).alias("scored"))
    else:
        rows = docs.select(*own, F.lit(False).alias("learn"), F.lit(True).alias("scored")).union(
            training.select(F.lit(None).cast(kind), F.col(text), F.lit(True), F.lit(False))
        )
    counted = stored(
        rows.select("text", "learn")
        .mapInArrow(_word_counter(), "kind int, word bigint, n bigint")
        .groupBy("kind", "word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    words = counted.where("kind = 0").select("word", F.col("n").alias("c"))
    found = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).head()
    others = {row["kind"]: row["n"] for row in counted.where("kind > 0").collect()}
    texts, tokens = others.get(1, 0), others.get(2, 0)
    distinct, total = found[0] + (texts > 0), found[1] + texts
    below = float(np.log10(total + 0.1 * (distinct + 1)))
    # Words looked up in the task: the most frequent, at most 1 / fine of them.
    sizes = words.where(F.col("c") < max(1.0, fine * total)).groupBy("c").count().orderBy(F.desc("c")).toArrow()
    room = 1 / fine - words.where(F.col("c") >= max(1.0, fine * total)).count()
    fits = int(np.searchsorted(np.cumsum(sizes["count"].to_numpy()), room, side="right"))
    fine = float(sizes["c"][fits - 1].as_py()) if fits else max(1.0, fine * total)
    table = words.where(F.col("c") >= fine).toArrow()
    keys, c = table["word"].to_numpy().astype(U64), table["c"].to_numpy()
    order = np.argsort(keys)
    keys, c = keys[order], c[order]
    # Buckets that a word before others fills, its tokens to be scored included.
    spread = -(-c * max(tokens // max(total, 1), 1) // (OVERFULL * BUCKET))
    heavy, spread = keys[spread > 1], spread[spread > 1].astype(U64)
    count = max(-(-tokens // BUCKET), 1)
    shared = spark.sparkContext.broadcast((keys, c, heavy, spread, count))
    places = "bucket int, tokens binary, row bigint, n_tokens bigint, n_known bigint, base_score double"
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text", "learn", "scored")
    dealt = numbered.mapInArrow(_dealer(shared, depth, below, texts), layout(kind, places))
    rare = (
        rows.select("text")
        .mapInArrow(_needed(shared, depth), "word bigint, bucket int")
        .groupBy("word")
        .agg(F.collect_set("bucket").alias("buckets"))
        .join(words.where(F.col("c") < fine), "word")
        .select("word", "c", F.explode("buckets").alias("bucket"))
    )
    everything = dealt.unionByName(_listed(rare, "words", "word", "c"), allowMissingColumns=True)
    if len(heavy):
        followers = (
            rows.where("learn")
            .select("text")
            .mapInArrow(_followers(shared), "context bigint, word bigint, n bigint")
            .groupBy("context", "word")
            .agg(F.sum("n").alias("n"))
            .join(words, "word", "left")
            .withColumn("c", F.coalesce("c", F.lit(0)))
        )
        shares = {
            (int(word), int(bucket))
            for word, size in zip(heavy, spread)
            for bucket in _share(np.full(int(size), word), np.arange(int(size))) % U64(count)
        }
        homes = [(int(np.uint64(word).astype(np.int64)), bucket) for word, bucket in shares]
        given = followers.join(F.broadcast(spark.createDataFrame(homes, "context bigint, bucket int")), "context")
        pairs = _listed(given, "pairs", "context", "word", "n", "c")
    else:
        pairs = spark.createDataFrame(
            [], "bucket int, pairs array<struct<context: bigint, word: bigint, n: bigint, c: bigint>>"
        )
    least, head = float(np.sqrt(total)) / contexts, float(np.sqrt(total)) / counts
    parts = (
        everything.unionByName(pairs, allowMissingColumns=True)
        .select("bucket", "tokens", "id", "row", "n_tokens", "n_known", "base_score", "words", "pairs")
        .repartition(-(-count // TOGETHER), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(
            _grower(shared, depth, least, head, prior, deviations, texts, below),
            layout(kind, "row bigint, n_tokens bigint, n_known bigint, base_score double, home bigint, added binary"),
        )
    )
    parts = stored(parts, "scores")
    sums = (
        parts.where("added is not null")
        .select("home", "added")
        .repartition(-(-count // TOGETHER), "home")
        .sortWithinPartitions("home")
        .mapInArrow(_adder(), "row bigint, more_known bigint, more_base double, gain double")
    )
    base = F.col("base_score") + F.col("more_base")
    return (
        parts.where("n_tokens is not null")
        .join(sums, "row")
        .select(
            F.col("id").alias(id),
            "n_tokens",
            (F.col("n_known") + F.col("more_known")).alias("n_known"),
            F.lit(int(total)).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            (base + F.col("gain")).alias("score"),
        )
    )


def _listed(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """Rows of each bucket as lists, several of them so that none is long."""
    return (
        rows.groupBy("bucket", F.pmod("word", F.lit(64)).alias("part"))
        .agg(F.collect_list(F.struct(*columns)).alias(name))
        .select("bucket", name)
    )
