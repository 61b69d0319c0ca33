"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A text is the set of its word shingles. Its signature has one symbol of 16 bits
per hash function, the low bits of the smallest hash; two signatures differ in
a symbol with probability 1 - similarity. Signatures are split into chunks. Two
signatures that differ in at most T = chunks x (errors + 1) - 1 symbols agree, in
some chunk, in all but ``errors`` symbols: by the pigeonhole principle such a
pair shares one of the keys that leave ``errors`` symbols of a chunk out. So all
pairs within T meet in a bucket of equal keys, and most pairs somewhat beyond.

A bucket may hold a large share of all texts, and its pairs are never listed:

1. texts with the same set are one class, whatever their number;
2. every class is linked with the smallest of each of its buckets, the link is
   confirmed on the full sets, and confirmed links give first groups;
3. in buckets whose classes are still in several groups, those outside the
   largest group are linked in the same way with a random class of that group,
   as long as this settles most of them;
4. buckets that remain are gone through exhaustively for pairs of different
   groups, in pieces of bounded size; pairs within the largest group of a bucket
   are left out, so its size counts once for each part of the other classes.
   All pairs are compared there by the low 16 bits of their shingles, however
   many symbols of their signatures differ. That can only add to what two sets
   share; those that may reach the similarity are confirmed on the full sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postgrove.llm.stored import components, maybe_among, numbered, small_batches, stored
from postgrove.llm.words import U64, Words, lowered, mixed, numbers, slices, windows

WIDTH = 4
PERCENT = 80
# At a similarity of 0.8 a chunk of 5 keeps 4 or 5 equal symbols with
# probability 0.737: 10 chunks miss such a pair once in 600,000.
CHUNKS, CHUNK, ERRORS = 10, 5, 1
# Classes of a bucket that are compared with each other in one piece.
PIECE = 1024
# Rounds of links with a class of the largest group of a bucket, at most.
AGAIN = 4

OF_SET = ["n_shingles", "one", "two"]

Batches = Iterator[pa.RecordBatch]


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for first, last, raw, offsets in slices(texts):
        words = Words(lowered(raw), offsets)
        hashes = words.hashes()
        for i in range(last - first):
            own = hashes[words.bounds[i] : words.bounds[i + 1]]
            # Fewer words than the width are one shingle; none are an empty set.
            yield np.unique(windows(own, min(width, max(len(own), 1))))


def _digests(sets: list[np.ndarray]) -> list[list[int]]:
    """What tells sets apart: their sizes and two sums of hashes."""
    return [
        [len(x) for x in sets],
        [int(x.sum().astype(np.int64)) for x in sets],
        [int(mixed(x).sum().astype(np.int64)) for x in sets],
    ]


def _sketcher(width: int, symbols: int) -> Callable[[Batches], Batches]:
    def sketch(batches: Batches) -> Batches:
        factors, terms = numbers(symbols, 3) | U64(1), numbers(symbols, 4)
        for batch in batches:
            digests, signatures = [[], [], []], []
            for shingles in _sets(batch.column(1), width):
                for all, own in zip(digests, _digests([shingles])):
                    all += own
                least = np.full(symbols, ~U64(0))
                for start in range(0, len(shingles), 4096):
                    part = shingles[None, start : start + 4096] * factors[:, None] + terms[:, None]
                    least = np.minimum(least, part.min(axis=1))
                signatures.append((least & U64(0xFFFF)).astype("<u2").tobytes())
            yield pa.record_batch(
                [
                    batch.column(0),
                    *(pa.array(x, pa.int64()) for x in digests),
                    pa.array(signatures, pa.binary()),
                ],
                names=["id", *OF_SET, "signature"],
            )

    return sketch


def _matrix(signatures: pa.Array, symbols: int) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), "<u2").reshape(-1, symbols)


def _choices(chunks: int, chunk: int, errors: int) -> list[list[int]]:
    """The symbols each key of a signature is made of."""
    return [
        [at * chunk + i for i in kept]
        for at in range(chunks)
        for kept in itertools.combinations(range(chunk), chunk - errors)
    ]


def _keys(signature: Column, choices: list[list[int]]) -> Column:
    """The keys of a signature, an array; the lowest bits of a key are its number."""
    low = (1 << len(choices).bit_length()) - 1
    keys = []
    for at, kept in enumerate(choices):
        parts = [F.substring(signature, 2 * symbol + 1, 2) for symbol in kept]
        key = F.xxhash64(F.lit(at), *parts)
        keys.append(key.bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(at)))
    return F.array(*keys)


def _setter(width: int) -> Callable[[Batches], Batches]:
    def sets(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = list(_sets(part.column(1), width))
                full = pa.array([x.tobytes() for x in found], pa.binary())
                low = pa.array([np.sort(x.astype("<u2")).tobytes() for x in found], pa.binary())
                yield pa.record_batch([*map(pa.array, _digests(found)), full, low], names=[*OF_SET, "shingles", "low"])

    return sets


def _confirmer(percent: int) -> Callable[[Batches], Batches]:
    def confirm(batches: Batches) -> Batches:
        for batch in batches:
            good = []
            for one, two in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(one.as_py(), U64), np.frombuffer(two.as_py(), U64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return confirm


def _comparer(
    chunks: int, chunk: int, errors: int, percent: int
) -> Callable[[pa.Table], pa.Table]:
    """Of some pieces of buckets, the pairs that the full sets must decide."""

    def met_before(equal: np.ndarray, key: int, choices: list[list[int]]) -> np.ndarray:
        """Which pairs share a key of a lower number, from their equal symbols."""
        each = len(choices) // chunks
        at, first = key // each, key // each * each
        alike = equal.reshape(len(equal), chunks, chunk)[:, :at].sum(axis=2)
        met = (alike >= chunk - errors).any(axis=1)
        for kept in choices[first:key]:
            met |= equal[:, kept].all(axis=1)
        return met

    def compare(rows: pa.Table) -> pa.Table:
        choices = _choices(chunks, chunk, errors)
        low = (1 << len(choices).bit_length()) - 1
        rows = rows.combine_chunks()
        rows = rows.sort_by([("key", "ascending"), ("low_part", "ascending"), ("high_part", "ascending")])
        all_keys, low_parts, high_parts, ids, parts, groups = (
            rows[x].to_numpy() for x in ("key", "low_part", "high_part", "id", "part", "component")
        )
        signatures = _matrix(rows["signature"], chunks * chunk)
        lows = [np.frombuffer(x, np.uint16) for x in rows["low"].to_pylist()]
        all_sizes = np.array([len(x) for x in lows])
        turn = (np.diff(all_keys) != 0) | (np.diff(low_parts) != 0) | (np.diff(high_parts) != 0)
        starts = [0, *(np.flatnonzero(turn) + 1)]
        own = np.zeros(1 << 16, bool)
        a, b = [], []
        for start, stop in zip(starts, [*starts[1:], len(ids)]):
            here = slice(start, stop)
            matrix, group, sizes, part = signatures[here], groups[here], all_sizes[here], parts[here]
            number = int(all_keys[start]) & low
            same = low_parts[start] == high_parts[start]
            left = np.flatnonzero(part == low_parts[start])
            right = np.flatnonzero(part == high_parts[start])
            for i in left:
                equal = matrix[right] == matrix[i]
                small, large = np.minimum(sizes[right], sizes[i]), np.maximum(sizes[right], sizes[i])
                near = (group[right] != group[i]) & (100 * small >= percent * large)
                if same:
                    near &= right > i
                near = np.flatnonzero(near)
                # A pair that shares several buckets is compared in the first one.
                near = near[~met_before(equal[near], number, choices)]
                if not len(near):
                    continue
                own[lows[start + i]] = True
                others = start + right[near]
                edges = np.cumsum([0, *all_sizes[others][:-1]])
                both = np.add.reduceat(own[np.concatenate([lows[j] for j in others])].astype(np.int64), edges)
                own[lows[start + i]] = False
                for j in others[100 * both >= percent * (sizes[i] + all_sizes[others] - both)]:
                    a.append(min(ids[start + i], ids[j]))
                    b.append(max(ids[start + i], ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; only sets of pairs of fitting sizes are fetched."""
    size_a, size_b = (sets.select(F.col("id").alias(x), F.col("n_shingles").alias(f"size_{x}")) for x in "ab")
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    fitting = pairs.join(size_a, "a").join(size_b, "b").where(100 * small >= percent * large)
    pairs = stored(fitting.select("a", "b"), "pairs")
    sets = maybe_among(sets, "id", pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    sets = sets.where("wanted")
    one = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    two = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    joined = pairs.join(one, "b").join(two, "a").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(_confirmer(percent), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    chunks: int = CHUNKS,
    chunk: int = CHUNK,
    errors: int = ERRORS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row.

    Texts are linked if ``percent`` of their united shingles are shared;
    ``component_id`` is the smallest id reachable over links and ``kept`` says
    whether it is the row's own. A-Z and a-z are the same. A text of fewer words
    than ``width`` is one shingle. A NULL, empty or wordless text has no shingles,
    is linked with nothing and kept. A row without an id is linked with nothing,
    kept, and has no component. Repeated rows come back as often as they came in, and unlike
    texts of the same id each have their own links. Ids are whole numbers.
    Other columns are not read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    layout = "id bigint, n_shingles bigint, one bigint, two bigint, signature binary"
    sketches = stored(rows.mapInArrow(_sketcher(width, chunks * chunk), layout), "sketches")
    found = sketches.where("id is not null and n_shingles > 0").groupBy(*OF_SET).agg(
        F.min("id").alias("least_id"), F.first("signature").alias("signature")
    )
    # Ids may have several texts, so classes have numbers of their own.
    classes, _ = numbered(found, "id", "classes")
    signatures = classes.select("id", "signature")
    keyed = signatures.select(
        F.explode(_keys(F.col("signature"), _choices(chunks, chunk, errors))).alias("key"), "id"
    )
    buckets = (
        keyed.groupBy("key")
        .agg(F.min("id").alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", "least")
    )
    shared = stored(_unlike_buckets(stored(keyed.join(buckets, "key"), "meetings"), chunks, chunk, errors), "buckets")
    met = stored(
        classes.join(shared.select("id").distinct(), "id", "left_semi").select(*OF_SET, "id", "least_id"), "met"
    )
    # Texts are not moved; of the rows only the sets of those that may be needed are.
    wanted = maybe_among(rows, "id", met.select("least_id"), "wanted").where("wanted").select("id", "text")
    spelt = wanted.mapInArrow(
        _setter(width), "n_shingles bigint, one bigint, two bigint, shingles binary, low binary"
    )
    # A row may have the id of a class and another text, or be there twice. Both steps go by the same columns.
    sets = stored(
        spelt.dropDuplicates(OF_SET)
        .join(met.drop("least_id"), OF_SET)
        .select("id", "n_shingles", "shingles", "low"),
        "sets",
    )
    stars = shared.where("least < id").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(_confirmed(stars, sets, percent), "confirmed")
    left = stored(_open_buckets(shared, _towards_components(links), 0), "open")
    outside = left.where("not major").count()
    for turn in range(1, AGAIN + 1):
        if outside <= PIECE:
            break
        pair = F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")
        found = _confirmed(left.where("not major").select(*pair).distinct(), sets, percent)
        links = stored(links.union(found), "confirmed")
        left = stored(_open_buckets(shared, components(links), turn), "open")
        before, outside = outside, left.where("not major").count()
        if outside > before // 2:
            break
    pieces = _pieces(left, signatures, sets).groupBy(_slot(left))
    compare = _comparer(chunks, chunk, errors, percent)
    pairs = pieces.applyInArrow(compare, "a bigint, b bigint").distinct()
    more = stored(_confirmed(pairs, sets, percent), "confirmed")
    final = stored(components(links.union(more)).withColumnRenamed("node", "id"), "components")
    linked = classes.select(*OF_SET, "id", "least_id").join(final, "id", "left")
    least = linked.where("component is not null").groupBy("component").agg(F.min("least_id").alias("least"))
    named = linked.join(least, "component", "left").select(
        *OF_SET, F.coalesce("least", "least_id").alias("component")
    )
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return (
        sketches.select("id", *OF_SET)
        .join(named, OF_SET, "left")
        .select(
            F.col("id").alias(id),
            "n_shingles",
            own.alias("component_id"),
            F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"),
        )
    )


def _unlike_buckets(shared: DataFrame, chunks: int, chunk: int, errors: int) -> DataFrame:
    """Of buckets with the same classes only the one whose key has the lowest number.

    That is where their pairs are compared. Buckets are told apart as sets are:
    by their size, their least class and two sums of hashes.
    """
    low = (1 << len(_choices(chunks, chunk, errors)).bit_length()) - 1
    sums = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"sum_{i}") for i in range(2)]
    found = shared.groupBy("key", "least").agg(F.count("*").alias("n"), *sums)
    number = F.col("key").bitwiseAND(F.lit(low))
    lowest = found.groupBy("n", "least", "sum_0", "sum_1").agg(F.min_by("key", number).alias("key"))
    return shared.join(lowest.select("key"), "key", "left_semi")


def _towards_components(stars: DataFrame) -> DataFrame:
    """(node, component): classes that are certainly in one component, if not all that are.

    Every class takes the smallest class it is linked to, and then that one's.
    """
    nearest = stars.groupBy("b").agg(F.min("a").alias("near"))
    further = nearest.select(F.col("b").alias("near"), F.col("near").alias("far"))
    return nearest.join(further, "near", "left").select(
        F.col("b").alias("node"), F.coalesce("far", "near").alias("component")
    )


def _open_buckets(shared: DataFrame, known: DataFrame, turn: int) -> DataFrame:
    """The rows of buckets whose classes are in more than one component.

    ``major`` are those of the bucket's largest component, and ``centre`` is one
    of them, another in every turn. ``majors`` and ``minors`` are the numbers of
    parts that those rows and the others are cut into.
    """
    component: Column = F.coalesce("component", "id").alias("component")
    rows = shared.join(known.withColumnRenamed("node", "id"), "id", "left").select("key", "id", component)
    groups = rows.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("centre")
    )
    several = (
        groups.groupBy("key")
        .agg(F.max(F.struct("n", "component", "centre")).alias("top"), F.sum("n").alias("n"))
        .where("top.n < n")
        .select(
            "key",
            F.col("top.component").alias("largest"),
            F.col("top.centre").alias("centre"),
            F.ceil(F.col("top.n") / PIECE).cast("int").alias("majors"),
            F.ceil((F.col("n") - F.col("top.n")) / PIECE).cast("int").alias("minors"),
        )
    )
    major = (F.col("component") == F.col("largest")).alias("major")
    return rows.join(several, "key").select("key", "id", "component", major, "centre", "majors", "minors")


def _slot(left: DataFrame) -> Column:
    """The task group of a piece: so many that each has a few pieces, whatever the size of a bucket."""
    copies = F.when(F.col("major"), F.col("minors")).otherwise(F.col("minors") + F.col("majors"))
    rows = left.agg(F.coalesce(F.sum(copies.cast("long")), F.lit(0))).head()[0]
    return F.pmod(F.xxhash64("key", "low_part", "high_part"), F.lit(rows // PIECE + 1)).alias("slot")


def _pieces(rows: DataFrame, signatures: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows once for every piece (two parts of a bucket, or one with itself) they belong to.

    Parts of the largest component come after the others and meet only those.
    """
    mixed_id = F.xxhash64("id")
    inner = F.pmod(mixed_id, F.col("minors"))
    part = F.when(F.col("major"), F.col("minors") + F.pmod(mixed_id, F.col("majors"))).otherwise(inner).cast("int")
    reach = F.when(F.col("major"), F.col("minors")).otherwise(F.col("minors") + F.col("majors"))
    others = F.transform(
        F.sequence(F.lit(0), reach - 1),
        lambda x: F.struct(F.least("part", x).alias("low_part"), F.greatest("part", x).alias("high_part")),
    )
    return (
        rows.withColumn("part", part)
        .join(signatures.join(sets.select("id", "low"), "id"), "id")
        .withColumn("piece", F.explode(others))
        .select("key", "piece.low_part", "piece.high_part", "part", "id", "component", "signature", "low")
    )
