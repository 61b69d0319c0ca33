"""Phrases whose words belong together, by counting in HAT-tries.

Word ids form a trie whose nodes are the frequent phrases, one level per length:
a phrase of k + 1 words is a node of level k and one more word. Level by level,
each task reads its share of the corpus, walks the known levels from every
position, and counts the next ones in a HAT-trie (Askitis, Sinha, "HAT-trie: A
Cache-conscious Trie-based Data Structure for Strings", 2007): under a shallow
trie of phrase prefixes stand hash containers, and one that is full bursts
into two at a prefix. When a task's trie is full, its largest containers leave as
sorted runs, whole subtrees each. The runs of all tasks meet by prefix and are
merged, and what is frequent is the next level.

A phrase is no more frequent than any part of it, so phrases that hold an
infrequent word or shorter phrase are never counted, which changes no result.
Everything is per language: the same word of two languages is two words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.llm.stored import numbered, small_batches, stored
from postgrove.llm.words import U64, Words, lowered, mixed, slices

LEAST, LONGEST, BEST = 100, 5, 2000
COVER = 100
NO_LANGUAGE = "und"
# Phrases end at BREAKS, words at GAPS too.
BREAKS = (0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D)
GAPS = (0x20, 0x09)
# Entries at which a container bursts, and at which a task's trie is thinned out.
BURST, FULL = 1 << 16, 1 << 20
# Words, and nodes of all levels, that tasks hold at a time: 16 and 24 bytes each. More
# take as many passes over the corpus as they have parts of this size.
MOST_WORDS, MOST_NODES = 1 << 22, 1 << 22
TOKENS_AT_ONCE = 1 << 19
# Different words a task holds before it hands them on.
WORDS_AT_ONCE = 1 << 18
# Tokens of a stored row; one without a break among them is longer.
ROW = 1 << 13
# The followers of one prefix are merged in so many places.
FOLLOWERS = 16
SALTS = 64

Batches = Iterator[pa.RecordBatch]


class Container:
    """A hash table from numbers to counts, with open addressing over whole arrays."""

    def __init__(self, capacity: int = 256):
        self.keys = np.full(capacity, -1, np.int64)
        self.counts = np.zeros(capacity, np.int64)
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add to the counts of ``keys``, all different."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.items()
            self.__init__(1 << int(2 * (self.size + len(keys))).bit_length())
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slot = (mixed(keys.astype(U64)) & U64(mask)).astype(np.int64)
        while len(keys):
            free = self.keys[slot] < 0
            # Of several keys for one free slot the last is written; the others go on.
            self.keys[slot[free]] = keys[free]
            own = self.keys[slot] == keys
            self.counts[slot[own]] += counts[own]
            self.size += int((own & free).sum())
            keys, counts, slot = keys[~own], counts[~own], (slot[~own] + 1) & mask

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order and their counts."""
        used = np.flatnonzero(self.keys >= 0)
        used = used[np.argsort(self.keys[used])]
        return self.keys[used], self.counts[used]


class HatTrie:
    """Counts of numbers ``prefix * radix + next`` in containers of consecutive prefixes.

    The inner nodes are kept flat, as the lowest number of each container.
    """

    def __init__(self, radix: int, burst: int = BURST, full: int = FULL):
        self.radix, self.burst_at, self.full = radix, burst, full
        self.lowest = np.zeros(1, np.int64)
        self.containers = [Container()]

    def add(self, codes: np.ndarray) -> None:
        codes, counts = np.unique(codes, return_counts=True)
        cuts = [0, *np.searchsorted(codes, self.lowest[1:]), len(codes)]
        for i in reversed(range(len(self.containers))):
            if cuts[i] < cuts[i + 1]:
                self.containers[i].add(codes[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]])
                self._burst(i)

    def _burst(self, i: int) -> None:
        """Split a full container in two, and those again if they are full."""
        if self.containers[i].size <= self.burst_at:
            return
        codes, counts = self.containers[i].items()
        middle = codes[len(codes) // 2]
        # Between two prefixes, or inside the one that fills half of it between two words.
        begin = middle - middle % self.radix
        cut = begin if begin > codes[0] else middle
        at = int(np.searchsorted(codes, cut))
        self.lowest = np.insert(self.lowest, i + 1, cut)
        self.containers[i : i + 1] = [Container(), Container()]
        self.containers[i].add(codes[:at], counts[:at])
        self.containers[i + 1].add(codes[at:], counts[at:])
        self._burst(i + 1)
        self._burst(i)

    def spill(self, everything: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sorted runs of the largest containers, until half the room is free; or of all."""
        total = sum(x.size for x in self.containers)
        most = 0 if everything else self.full if total <= self.full else self.full // 2
        for i in sorted(range(len(self.containers)), key=lambda i: -self.containers[i].size):
            if total <= most:
                return
            total -= self.containers[i].size
            run = self.containers[i].items()
            self.containers[i] = Container()
            yield run


def _salt(lang: str) -> U64:
    return U64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8"), digest_size=8).digest(), "little"))


def _read(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices as (words, a number of each word's language, keys of word and language, first of a phrase)."""
    langs = batch.column(0).to_pylist()
    names = {name: i for i, name in enumerate(dict.fromkeys(langs))}
    salts = np.array([_salt(name) for name in names], U64)
    numbers = np.array([names[x] for x in langs], np.int64)
    breaks = np.zeros(256, bool)
    breaks[list(BREAKS)] = True
    for first, last, raw, offsets in slices(batch.column(1)):
        words = Words(lowered(raw), offsets, BREAKS + GAPS)
        text = words.texts()
        own = numbers[first:last][text]
        piece = np.cumsum(breaks[raw])[words.starts]
        opens = np.ones(len(words), bool)
        opens[1:] = (np.diff(piece) != 0) | (np.diff(text) != 0)
        yield words, own, mixed(words.hashes() ^ salts[own]), opens


def _word_counter(batches: Batches) -> Batches:
    """Counts of a task's words; a NULL word counts all words of its language."""
    held, size = [], 0

    def merged() -> pa.Table:
        rows = pa.concat_tables(held)
        _, first, inverse = np.unique(rows["key"].to_numpy(), return_index=True, return_inverse=True)
        n = np.bincount(inverse, rows["n"].to_numpy(), len(first)).astype(np.int64)
        return rows.take(pa.array(first)).set_column(3, "n", pa.array(n))

    for batch in batches:
        names = list(dict.fromkeys(batch.column(0).to_pylist()))
        # Words of every language in all, under a key of the language alone.
        langs, salts = pa.array(names, pa.string()), np.array([_salt(x) for x in names], U64)
        for words, own, keys, _ in _read(batch):
            _, first, n = np.unique(keys, return_index=True, return_counts=True)
            sizes = words.lengths[first]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            place = np.arange(int(ends[-1])) + np.repeat(words.starts[first] - ends[:-1], sizes)
            written = pa.StringArray.from_buffers(
                len(first), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(words.raw[place].tobytes())
            )
            held.append(
                pa.table(
                    {
                        "lang": langs.take(pa.array(np.append(own[first], np.arange(len(names))))),
                        "word": pa.concat_arrays([written, pa.nulls(len(names), pa.string())]),
                        "key": np.append(keys[first], salts).view(np.int64),
                        "n": np.append(n, np.bincount(own, minlength=len(names))),
                    }
                )
            )
            size += len(held[-1])
            if size >= 2 * WORDS_AT_ONCE:
                held = [merged()]
                size = len(held[0])
                if size >= WORDS_AT_ONCE:
                    yield from held[0].combine_chunks().to_batches(1 << 16)
                    held, size = [], 0
    if held:
        yield from merged().combine_chunks().to_batches(1 << 16)


def _found(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``keys`` stand in the sorted ``values``, and whether they do."""
    if not len(values):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
    return at, values[at] == keys


def _key_sequences(batches: Batches) -> Iterator[np.ndarray]:
    """Keys of a slice's words in their order, without the lowest bit, and 0 before every phrase."""
    for batch in batches:
        for words, _, keys, opens in _read(batch):
            tokens = np.zeros(len(words) + int(opens.sum()), np.int64)
            tokens[np.arange(len(words)) + np.cumsum(opens)] = (keys >> U64(1)).view(np.int64)
            yield tokens


def _stored_sequences(batches: Batches) -> Iterator[np.ndarray]:
    for batch in batches:
        for blob in batch.column(0):
            yield np.frombuffer(blob.as_py(), np.int64)


def _encoder(shared, first: bool, last: bool) -> Callable[[Batches], Batches]:
    """Ids in place of the keys of one part of the words; the ``first`` part reads texts.

    Until the last part ids are written as negative numbers and keys as positive
    ones; the last part leaves 0 for what has no id.
    """

    def run(batches: Batches) -> Batches:
        keys, ids = shared.value
        for tokens in (_key_sequences if first else _stored_sequences)(batches):
            at, known = _found(keys, tokens)
            tokens = np.where(known & (tokens > 0), -ids[at] if len(ids) else 0, tokens)
            if last:
                tokens = np.maximum(-tokens, 0).astype(np.int32)
                # Of several zeros one after the other one is enough.
                tokens = tokens[np.append(True, (tokens[1:] != 0) | (tokens[:-1] != 0))[: len(tokens)]]
            breaks = np.flatnonzero(tokens == 0)
            cuts = breaks[np.searchsorted(breaks, np.arange(ROW, len(tokens) - ROW, ROW)) % max(len(breaks), 1)]
            rows = [x.tobytes() for x in np.split(tokens, np.unique(cuts))]
            yield pa.record_batch([pa.array(rows, pa.binary())], names=["tokens"])

    return run


def _encoded(rows: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """The corpus as rows of ``tokens``, 32-bit ids of ``words``, with 0 for all others and between phrases.

    Tasks hold one of ``parts`` parts of the words at a time.
    """
    spark = rows.sparkSession
    tokens = rows
    short = F.shiftrightunsigned("key", 1)
    for part in range(parts):
        table = words.select(short.alias("key"), "id").where(F.pmod("key", F.lit(parts)) == part).toArrow()
        table = table.sort_by("key")
        shared = spark.sparkContext.broadcast((table["key"].to_numpy(), table["id"].to_numpy()))
        encode = _encoder(shared, part == 0, part == parts - 1)
        tokens = stored(tokens.mapInArrow(encode, "tokens binary"), "tokens")
        shared.destroy()
    return tokens


def _joined(batches: Batches, least: int) -> Iterator[np.ndarray]:
    """The sequences of a task, several at a time, with a 0 between them."""
    held, size = [], 0
    for batch in batches:
        for blob in batch.column(0):
            held += [np.frombuffer(blob.as_py(), np.int32), np.zeros(1, np.int32)]
            size += len(held[-2]) + 1
            if size >= least:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _phrase_counter(shared, radix: int, pairs: bool, whole: bool, burst: int, full: int) -> Callable[[Batches], Batches]:
    """Counts of what follows the nodes of the last level, as (node, word, n).

    With ``whole`` tasks know all nodes, and count only what ends in a node too.
    """

    def rows(run: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        codes, n = run
        return pa.record_batch(
            [pa.array(codes // radix), pa.array((codes % radix).astype(np.int32)), pa.array(n)],
            names=["parent", "word", "n"],
        )

    def count(batches: Batches) -> Batches:
        levels = shared.value
        trie = HatTrie(radix, burst, full)
        for tokens in _joined(batches, TOKENS_AT_ONCE):
            at = np.flatnonzero(tokens > 0)
            node = tokens[at].astype(np.int64)
            for depth, (codes, nodes) in enumerate(levels, 1):
                follower = tokens[np.minimum(at + depth, len(tokens) - 1)]
                where, known = _found(codes, node * radix + follower)
                known &= follower > 0
                at, node = at[known], nodes[where[known]]
            depth = len(levels) + 1
            follower = tokens[np.minimum(at + depth, len(tokens) - 1)]
            good = follower > 0
            if whole and not pairs:
                good[:-1] &= at[1:] == at[:-1] + 1
                good[-1:] = False
            trie.add(node[good] * radix + follower[good])
            yield from map(rows, trie.spill())
        yield from map(rows, trie.spill(everything=True))

    return count


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """(parent, word, n) of at least ``least``, from the runs of all tasks, which meet by prefix.

    A prefix that stands before very many words is merged in several places.
    """
    place = ["parent", "slice"]
    dealt = runs.withColumn("slice", F.pmod("word", F.lit(FOLLOWERS))).repartition(*place)
    merged = dealt.groupBy(*place, "word").agg(F.sum("n").alias("n"))
    return merged.where(F.col("n") >= least).select("parent", "word", "n")


def _level(found: DataFrame, before: DataFrame, size: int) -> DataFrame:
    """Nodes of phrases of ``size`` words, from the level before.

    ``left`` and ``right`` have the counts of the two parts for every cut, and
    ``tail`` is the node of all words but the first.
    """
    head = before.select(
        F.col("node").alias("parent"), "root", F.col("path").alias("_path"),
        F.array_append("left", F.col("n")).alias("left"),
    )
    rest = before.select(
        F.col("path").alias("_rest"), F.col("node").alias("tail"), F.array_prepend("right", F.col("n")).alias("right")
    )
    rows = found.join(head, "parent").withColumn("path", F.array_append("_path", F.col("word")))
    rows = rows.withColumn("_rest", F.slice("path", 2, size - 1)).join(rest, "_rest")
    return rows.select("parent", "word", "n", "root", "path", "left", "right", "tail")


def phrase_levels(
    rows: DataFrame, least: int = LEAST, longest: int = LONGEST, most_words: int = MOST_WORDS,
    most_nodes: int = MOST_NODES, burst: int = BURST, full: int = FULL,
) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The words of each language in all, the frequent words, and a table of nodes for each length from 2 on.

    ``rows`` have lang and text.
    """
    spark = rows.sparkSession
    counted = (
        rows.mapInArrow(_word_counter, "lang string, word string, key bigint, n bigint")
        .groupBy("lang", "word", "key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("word").isNull() | (F.col("n") >= least))
    )
    counted = stored(counted, "words")
    totals = counted.where("word is null").select("lang", F.col("n").alias("total"))
    words, different = numbered(counted.where("word is not null"), "id", "ids", first=1)
    radix = different + 1
    if radix >= 1 << 31:
        raise ValueError(f"{different} frequent words: raise the least count")
    tokens = _encoded(rows, words, different // most_words + 1)
    nothing = F.array().cast("array<bigint>")
    single = words.select(
        F.col("id").alias("node"), "n", F.col("id").alias("root"), F.array(F.col("id").cast("int")).alias("path"),
        nothing.alias("left"), nothing.alias("right"),
    )

    def arrays(level: DataFrame, rounds: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the subtrees of one part of the first words, what leads to each node."""
        code = (F.col("parent") * radix + F.col("word")).alias("code")
        table = level.where(F.pmod("root", F.lit(rounds)) == turn).select(code, "node").toArrow().sort_by("code")
        return table["code"].to_numpy(), table["node"].to_numpy()

    levels, nodes, whole = [single], 0, []
    for size in range(2, longest + 1):
        rounds = nodes // most_nodes + 1
        merged = []
        for turn in range(rounds):
            if rounds == 1:
                whole += [arrays(level, 1, 0) for level in levels[1 + len(whole) :]]
            known = whole if rounds == 1 else [arrays(level, rounds, turn) for level in levels[1:]]
            shared = spark.sparkContext.broadcast(known)
            count = _phrase_counter(shared, radix, size == 2, rounds == 1, burst, full)
            runs = tokens.mapInArrow(count, "parent bigint, word int, n bigint")
            merged.append(stored(_merged(runs, least), "phrases"))
            shared.destroy()
        found = reduce(DataFrame.union, merged)
        level, more = numbered(_level(found, levels[-1], size), "node", "nodes", first=1)
        levels, nodes = [*levels, level], nodes + more
    return totals, words, levels[1:]


def _score(total: Column) -> Column:
    """The lowest-scoring cut as (score, k, l, r), in whole numbers of up to 38 digits."""
    wide = "decimal(18,0)"
    joint = F.col("n").cast(wide) * total.cast(wide) * F.lit(1000).cast("decimal(4,0)")

    def cut(pair: Column, k: Column) -> Column:
        left, right = pair["left"], pair["right"]
        value = F.call_function("div", joint, left.cast(wide) * right.cast(wide))
        return F.struct(value.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.arrays_zip("left", "right"), cut))


def _first(rows: DataFrame, order: list[Column], best: int, exact: bool) -> DataFrame:
    """Rows that are among the first ``best`` of their language: with those equal to the last, unless ``exact``.

    Pieces of a language are cut first, so none has to be sorted as a whole.
    """
    rank = F.row_number() if exact else F.rank()
    for keys in (["lang", "salt"], ["lang"]):
        window = Window.partitionBy(*keys).orderBy(*order)
        rows = rows.withColumn("rank", rank.over(window).cast("long")).where(F.col("rank") <= best)
    return rows


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    best: int = BEST,
    cover: int = COVER,
    **limits: int,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    A phrase is 2 to ``longest`` words that stand together ``least`` times or more,
    with only spaces and tabs between them; A-Z and a-z are the same. Cut after k of its words, its
    score is 1000 a n / (l r), rounded down: a, l and r count the phrase and the two
    parts, n all words of the language; the cut of the lowest score counts, the
    first of equal ones. A phrase is left out if a longer one that holds it is at least
    ``cover`` percent as frequent. Equal scores go to the more frequent, then to the
    first in byte order.

    NULL is a language of the name ``und``; a NULL, empty or wordless text has no
    phrases. Every row counts, repeated ones too, and no other column is read. An
    empty table, or one without frequent phrases, gives an empty result. Words are told
    apart by 63 bits of a hash; counts up to 10**18 are exact. ``limits`` are
    those of :func:`phrase_levels`, and change no result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    totals, words, levels = phrase_levels(rows, least, longest, **limits)
    kept = []
    for level, longer in zip(levels, [*levels[1:], None]):
        if longer is not None:
            # A longer phrase that is frequent enough has one of one word more that is.
            holders = longer.select(F.col("parent").alias("node"), "n").union(longer.select("tail", "n"))
            holders = holders.groupBy("node").agg(F.max("n").alias("longer"))
            level = level.join(holders, "node", "left").where(
                F.coalesce(100 * F.col("longer") < cover * F.col("n"), F.lit(True))
            )
        kept.append(level.select("root", "path", "n", "left", "right"))
    found = reduce(DataFrame.union, kept).join(words.select(F.col("id").alias("root"), "lang"), "root")
    scored = found.join(totals, "lang").withColumn("cut", _score(F.col("total")))
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)))
    order = [F.desc("cut.score"), F.desc("n")]
    near = _first(scored, order, best, exact=False)
    written = (
        near.select("lang", "total", "path", "n", "cut", "salt", F.posexplode("path").alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("lang", "total", "path", "n", "cut", "salt")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        .withColumn("phrase", F.array_join("spelt.word", " "))
    )
    return _first(written, [*order, F.asc("phrase")], best, exact=True).select(
        "lang", "rank", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"
    )
