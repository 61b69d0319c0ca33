"""Exact top-k search by inner product, with MaxScore over postings of signed components.

Components are whole numbers, and a term is a component with a sign: its postings
are the rows whose component has that sign. A query adds up, over its own terms,
products that are all positive; what the opposite signs subtract can only lower a
score, so these sums bound it from above. MaxScore (Turtle, Flood, "Query
Evaluation: Strategies and Optimizations", 1995) orders a query's terms by the most
each can add. The smallest ones that together stay below the k-th best score known
are not essential: a row with none of the others cannot be among the best. So the
postings of essential terms are traversed, and the others are looked up only for
rows that can still reach that score, the largest bound first. Rows that remain are
scored in full.

Rows are packed where they are read into shards, each with its own postings, so
no row is dealt by a key. Queries meet the largest shard first, which gives each a
k-th best score to begin with, and then all others, in blocks of bounded size; the
best of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.llm.stored import numbered, stored

SCALE = 256
BEST = 5
# Rows of a shard, below the 2 ** 16 that positions in postings allow, and queries it meets at a time.
ROWS, QUERIES = 1 << 14, 1 << 12

Batches = Iterator[pa.RecordBatch]


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The numbers in as few bytes as hold them."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


@dataclass
class Shard:
    """Rows by position: ids, and a line of components per dimension, with the postings of every term."""

    ids: np.ndarray
    lines: np.ndarray
    # Terms 2 d and 2 d + 1 are dimension d above and below zero.
    postings: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray) -> Shard:
        lines = _narrow(np.ascontiguousarray(rows.T))
        found = [np.flatnonzero(hit).astype(np.uint16) for line in lines for hit in (line > 0, line < 0)]
        return cls(ids, lines, found)

    def packed(self) -> list[pa.Array]:
        sizes = [len(x) for x in self.postings]
        bounds = [
            abs(int(self.lines[i // 2][rows].max() if i % 2 == 0 else self.lines[i // 2][rows].min())) if len(rows) else 0
            for i, rows in enumerate(self.postings)
        ]
        return [
            pa.array([len(self.ids)], pa.int64()),
            pa.array([len(self.lines)], pa.int32()),
            pa.array([self.ids.tobytes()], pa.binary()),
            pa.array([self.lines.dtype.itemsize], pa.int32()),
            pa.array([self.lines.tobytes()], pa.binary()),
            pa.array([sizes], pa.list_(pa.int64())),
            pa.array([np.concatenate([*self.postings, np.zeros(0, np.uint16)]).tobytes()], pa.binary()),
            pa.array([bounds], pa.list_(pa.int64())),
        ]

    @classmethod
    def open(cls, row: dict) -> tuple[Shard, np.ndarray]:
        """A shard as it was packed, and the bound of every term."""
        ids = np.frombuffer(row["ids"], np.int64)
        lines = np.frombuffer(row["lines"], f"<i{row['bytes']}").reshape(row["size"], len(ids))
        found = np.split(np.frombuffer(row["postings"], np.uint16), np.cumsum(row["sizes"])[:-1])
        return cls(ids, lines, found), np.array(row["bounds"], np.int64)


PACKED = (
    "n_rows bigint, size int, ids binary, bytes int, lines binary, sizes array<bigint>, postings binary, "
    "bounds array<bigint>"
)


def _packer(most: int) -> Callable[[Batches], Batches]:
    """A row per shard, of the rows of a task as they come, by the length of their vectors."""
    names = [field.split()[0] for field in PACKED.split(", ")]

    def shard(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, rows = (np.concatenate(x) for x in zip(*parts))
        return pa.record_batch(Shard.build(ids, rows).packed(), names=names)

    def pack(batches: Batches) -> Batches:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                ids, rows = own.column(0).to_numpy(), _matrix(own.column(1))
                parts = held.setdefault(int(size), [])
                while len(ids):
                    room = most - sum(len(x) for x, _ in parts)
                    parts.append((ids[:room], rows[:room]))
                    ids, rows = ids[room:], rows[room:]
                    if len(parts[-1][0]) == room:
                        yield shard(parts)
                        parts.clear()
        for parts in held.values():
            if parts:
                yield shard(parts)

    return pack


def search(
    shard: Shard, bounds: np.ndarray, query: np.ndarray, own_id: int, k: int, least: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the best ``k`` rows other than ``own_id``, best first, ties to the smaller id.

    Rows below ``least``, a k-th best score known so far, are not needed and may be missing.
    """
    terms = np.flatnonzero(query)
    weight = np.abs(query[terms])
    term = 2 * terms + (query[terms] < 0)
    most = weight * bounds[term]
    order = np.argsort(most, kind="stable")
    below = np.cumsum(most[order])
    # With nothing to beat, or zero, also rows without any term count.
    essential = 0 if least is None or least <= 0 else int(np.searchsorted(below, least, "left"))
    total = np.zeros(len(shard.ids), np.int64)
    for i in order[essential:]:
        rows = shard.postings[term[i]]
        total[rows] += weight[i] * np.abs(shard.lines[terms[i]][rows].astype(np.int64))
    if least is None or least <= 0:
        near = np.arange(len(total))
    else:
        rest = int(below[essential - 1]) if essential else 0
        near = np.flatnonzero((total > 0) & (total + rest >= least))
        for i in order[:essential][::-1]:
            if not len(near):
                break
            value = query[terms[i]] * shard.lines[terms[i]][near].astype(np.int64)
            total[near] += np.maximum(value, 0)
            rest -= int(most[i])
            near = near[total[near] + rest >= least]
    near = near[shard.ids[near] != own_id]
    score = query @ shard.lines[:, near].astype(np.int64)
    if least is not None:
        near, score = near[score >= least], score[score >= least]
    best = np.lexsort((shard.ids[near], -score))[:k]
    return shard.ids[near[best]], score[best]


def _searcher(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(shards: pa.Table, queries: pa.Table) -> pa.Table:
        parts: list[tuple[np.ndarray, ...]] = []
        if shards.num_rows and queries.num_rows:
            shard, bounds = Shard.open(shards.to_pylist()[0])
            vectors = _matrix(queries["vector"].combine_chunks())
            for number, own, least, query in zip(
                queries["number"].to_pylist(), queries["id"].to_pylist(), queries["least"].to_pylist(), vectors
            ):
                ids, scores = search(shard, bounds, query, own, k, least)
                parts.append((np.full(len(ids), number), np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
        return pa.table(
            {name: pa.array(x, pa.int64()) for name, x in zip(("number", "query_id", "id", "score"), columns)}
        )

    return run


def _whole(df: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, vector, size) of rows that have both, in whole numbers."""
    value = F.col(vector).cast("array<double>")
    real = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.where(F.col(id).isNotNull() & F.coalesce(real, F.lit(False)))
    whole = F.transform(value, lambda x: F.floor(scale * x))
    return rows.select(F.col(id).cast("long").alias("id"), whole.alias("vector"), F.size(vector).alias("size"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = BEST,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    rows_at_once: int = ROWS,
    queries_at_once: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of the greatest inner product with each query.

    Every component x counts as floor(``scale`` x) and scores are exact in 64 bits. Ties go to the smaller id. A
    query is not its own result. Rows without an id, and vectors that are NULL or hold
    a NULL or non-finite component, take no part; a vector of zeros does. Vectors
    of different lengths are not compared. Of rows with the same id the best counts.
    A query with fewer than ``k`` candidates gets all of them. Other columns are not read; an
    empty table gives an empty result.
    """
    if not 0 < rows_at_once <= 1 << 16:
        raise ValueError("a shard has at most 65,536 rows")
    packed = _whole(vectors, id, vector, scale).mapInArrow(_packer(rows_at_once), PACKED)
    index, shards = numbered(packed, "shard", "shards")
    asked, count = numbered(_whole(queries, id, vector, scale), "number", "queries")
    blocks = count // queries_at_once + 1
    block = F.pmod(F.xxhash64("number"), F.lit(blocks))
    # The largest shard of each length of vectors.
    first = index.groupBy("size").agg(F.max_by("shard", F.struct("n_rows", "shard")).alias("shard"))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        """Results of queries, each with the shards it goes to, where those are among ``left``."""
        place = ["size", "shard", "block"]
        left = left.withColumn("block", every(blocks))
        return left.groupBy(*place).cogroup(right.withColumn("block", block).groupBy(*place)).applyInArrow(
            _searcher(k), "number bigint, query_id bigint, id bigint, score bigint"
        )

    # One row per length of vectors.
    first = F.broadcast(first)
    nothing = F.lit(None).cast("long").alias("least")
    begun = meet(index.join(first, ["size", "shard"], "left_semi"), asked.select("*", nothing).join(first, "size"))
    found = begun = stored(begun, "begun")
    if shards > 1:
        least = begun.groupBy("number").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
        rest = asked.join(least, "number", "left").withColumn("shard", every(shards))
        found = begun.union(meet(index.join(first, ["size", "shard"], "left_anti"), rest))
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id), "score"
    )
