"""Nearest neighbours by collision counting.

Vectors are projected on random directions, each projection alone a sorted
array. A query's window in an array is centred on its own projection; two
vectors collide in an array if one lies in the other's window. At radius R a
window reaches as far as vectors at distance R project with probability 0.68, so
a vector within R collides in most arrays. Windows grow by virtual rehashing:
the arrays stay as they are and R is multiplied. Vectors whose collisions reach
a threshold are verified by their distance, and a query ends once it has k
verified vectors within R (Gan et al., C2LSH, 2012; Huang et al., QALSH, 2015).

Rows are dealt into blocks of bounded size, each with its own arrays, and meet
the queries in blocks too; the nearest of all blocks are merged. No query set or
table goes through the driver or one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.llm.stored import stored

ARRAYS = 64
# A vector at distance R collides in 0.683 of the arrays on average; one at 2 R in 0.383.
THRESHOLD = 36
GROWTH = 1.3
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 16_384, 4_096
QUERIES_AT_ONCE = 64


def nearest_in_block(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
    arrays: int = ARRAYS, threshold: int = THRESHOLD, growth: float = GROWTH, seed: int = 11,
) -> list[tuple[int, int, float]]:
    """(query, id, distance) of up to ``k`` rows for every query."""
    count, dimensions = rows.shape
    directions = np.random.default_rng(seed).standard_normal((dimensions, arrays))
    projected = rows @ directions
    order = np.argsort(projected, axis=0, kind="stable").T.copy()
    ordered = np.take_along_axis(projected, order.T, axis=0).T.copy()
    found = []
    spread = float(np.abs(ordered[:, -1] - ordered[:, 0]).max())
    # Begin where a window holds about one row in a hundred.
    step = max(1, count // 100)
    gaps = ordered[:, step:] - ordered[:, :-step]
    begin = max(float(np.median(gaps)) / 2 if gaps.size else 0.0, spread * 1e-6, 1e-300)
    for first in range(0, len(queries), QUERIES_AT_ONCE):
        part = queries[first : first + QUERIES_AT_ONCE]
        own = query_ids[first : first + QUERIES_AT_ONCE]
        at = part @ directions
        collisions = np.zeros((len(part), count), np.uint16)
        verified = np.zeros((len(part), count), bool)
        distance = np.full((len(part), count), np.inf)
        low = np.stack([np.searchsorted(ordered[j], at[:, j]) for j in range(arrays)], axis=1)
        high = low.copy()
        active, radius = list(range(len(part))), begin
        candidates = count - (ids[None, :] == own[:, None]).sum(axis=1)
        while active:
            now = np.array(active)
            new_low, new_high = low.copy(), high.copy()
            for j in range(arrays):
                new_low[now, j] = np.searchsorted(ordered[j], at[now, j] - radius, "left")
                new_high[now, j] = np.searchsorted(ordered[j], at[now, j] + radius, "right")
            still = []
            for i in active:
                line = collisions[i]
                for j in range(arrays):
                    a, b, c, d = new_low[i, j], low[i, j], high[i, j], new_high[i, j]
                    if a < b:
                        line[order[j, a:b]] += 1
                    if c < d:
                        line[order[j, c:d]] += 1
                fresh = np.flatnonzero((line >= threshold) & ~verified[i] & (ids != own[i]))
                verified[i, fresh] = True
                if len(fresh):
                    distance[i, fresh] = np.sqrt(((rows[fresh] - part[i]) ** 2).sum(axis=1))
                inside = int((distance[i] <= radius).sum())
                wanted = min(k, int(candidates[i]))
                whole = bool((new_low[i] == 0).all() and (new_high[i] == count).all())
                if inside < wanted and not whole:
                    still.append(i)
            low, high = new_low, new_high
            active, radius = still, radius * growth
        for i in range(len(part)):
            near = np.flatnonzero(verified[i])
            best = near[np.lexsort((ids[near], distance[i, near]))][:k]
            found.extend((int(own[i]), int(ids[x]), float(distance[i, x])) for x in best)
    return found


def _searcher(k: int, arrays: int, threshold: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        column = table["vector"].combine_chunks()
        values = column.flatten().to_numpy(zero_copy_only=False)
        return table["id"].to_numpy(), values.reshape(len(column), -1)

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and queries.num_rows:
            found = nearest_in_block(*matrix(rows), *matrix(queries), k, arrays, threshold)
        columns = list(zip(*found)) or [[], [], []]
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.float64()),
            }
        )

    return search


def usable(vector: Column) -> Column:
    """Whether a vector has a direction and a length: no NULL or non-finite component, not all zero."""
    real = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(real & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id: str = "vec_id",
    vector: str = "embedding",
    arrays: int = ARRAYS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest rows found for each query, by Euclidean distance.

    Distances are in double precision on the given vectors; ties go to the
    smaller id. A query is not its own neighbour. Rows without an id, and vectors
    that are NULL, zero, or hold a NULL or non-finite component take no part, and
    vectors of different lengths are not compared. Of rows with the same id the
    nearest counts. A query with fewer than ``k`` candidates gets all of them.
    Other columns are not read; an empty table gives an empty result.
    """

    def cleaned(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn(
            "size", F.size("vector")
        )

    rows, asked = cleaned(vectors), stored(cleaned(queries), "queries")
    blocks = rows.count() // ROWS_PER_BLOCK + 1
    query_blocks = asked.count() // QUERIES_PER_BLOCK + 1

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(parts))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        )

    place = ["size", "block", "query_block"]
    left = dealt(rows, "block", blocks, "query_block", query_blocks).groupBy(*place)
    right = dealt(asked, "query_block", query_blocks, "block", blocks).groupBy(*place)
    found = left.cogroup(right).applyInArrow(
        _searcher(k, arrays, threshold), "query_id bigint, id bigint, score double"
    )
    best = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id), "score"
    )
