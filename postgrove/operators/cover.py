"""Which box of a large set a point lies in, by a tree of cells cut at the edges of the boxes."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.dimensions import Box
from postgrove.operators.geo import ranked_boxes

# Boxes a point is compared with, at most, and cells of the tree, some 200 bytes each.
LIMIT, MOST_CELLS = 16, 500_000


def _place(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Odd numbers for values that are an edge, even ones for those between two edges."""
    at = np.searchsorted(edges, values)
    on = edges[np.minimum(at, len(edges) - 1)] == values if len(edges) else np.zeros(len(values), bool)
    return 2 * at + on


class Cover:
    """Cells that fill the plane, each with the boxes that matter in it, in order.

    A cell is cut in two at the middle one of the edges inside it, along the axis that has more
    of them: many boxes on top of each other, or long thin ones, so do not make
    many small squares, as a quadtree would. A box after one that covers a cell does not
    matter there, and a cell without edges inside is covered by its first box, so cells can always be cut until
    ``limit`` boxes or fewer matter. Cells with most boxes are cut first; past
    ``most_cells`` cells the rest stay as they are, with longer lists.
    """

    def __init__(self, boxes: Sequence[Box], limit: int = LIMIT, most_cells: int = MOST_CELLS):
        edges = np.array([box[1:] for box in boxes], float).reshape(-1, 4)
        # An empty box, or one with an edge that is no number, holds nothing.
        self.own = np.flatnonzero((edges[:, 0] <= edges[:, 1]) & (edges[:, 2] <= edges[:, 3]))
        self.boxes = edges[self.own]
        self.ys, self.xs = np.unique(self.boxes[:, :2]), np.unique(self.boxes[:, 2:])
        # First and last place of every box on both axes, and the places of the whole plane.
        low = np.stack([_place(self.ys, self.boxes[:, 0]), _place(self.xs, self.boxes[:, 2])])
        high = np.stack([_place(self.ys, self.boxes[:, 1]), _place(self.xs, self.boxes[:, 3])])
        plane = (0, 2 * len(self.ys), 0, 2 * len(self.xs))
        # Of every node the axis and place where its second half begins, and where its halves stand; -1 for a cell.
        axis, cut, child, held_by = [-1], [0], [0], {0: np.arange(len(self.boxes))}
        waiting = [(-len(self.boxes), 0, plane)]
        cells = 1
        while waiting:
            size, node, bounds = heapq.heappop(waiting)
            held = held_by[node]
            if -size <= max(limit, 1) or cells >= most_cells:
                continue
            inside = []
            for i in (0, 1):
                first, last = bounds[2 * i : 2 * i + 2]
                begins, ends = low[i, held], high[i, held] + 1
                inside.append(np.concatenate((begins[begins > first], ends[ends <= last])))
            along = int(len(inside[1]) > len(inside[0]))
            at = int(np.partition(inside[along], len(inside[along]) // 2)[len(inside[along]) // 2])
            axis[node], cut[node], child[node] = along, at, len(axis)
            del held_by[node]
            cells += 1
            for half in (0, 1):
                part = list(bounds)
                part[2 * along + 1 - half] = at if half else at - 1
                (first_y, last_y, first_x, last_x), begin, end = part, low[:, held], high[:, held]
                meets = (begin[0] <= last_y) & (end[0] >= first_y) & (begin[1] <= last_x) & (end[1] >= first_x)
                own = held[meets]
                covers = (
                    (low[0, own] <= first_y) & (high[0, own] >= last_y) & (low[1, own] <= first_x) & (high[1, own] >= last_x)
                )
                if covers.any():
                    own = own[: int(covers.argmax()) + 1]
                heapq.heappush(waiting, (-len(own), len(axis), tuple(part)))
                held_by[len(axis)] = own
                axis.append(-1), cut.append(0), child.append(0)
        self.axis, self.cut, self.child = np.array(axis), np.array(cut), np.array(child)
        self.sizes = np.array([len(held_by.get(i, ())) for i in range(len(axis))])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.lists = np.concatenate([held_by[i] for i in sorted(held_by)])

    @property
    def cells(self) -> int:
        return int((self.axis < 0).sum())

    @property
    def fields(self) -> tuple[np.ndarray, ...]:
        """What tasks need, as arrays."""
        return (
            self.own, self.boxes, self.ys, self.xs, self.axis, self.cut, self.child, self.sizes, self.starts, self.lists
        )


def first_boxes(fields: tuple[np.ndarray, ...], lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """The number of the first box that holds each point, edges included, or -1."""
    own, boxes, ys, xs, axis, cut, child, sizes, starts, lists = fields
    place = np.stack([_place(ys, lat), _place(xs, lon)])
    cell = np.zeros(len(lat), np.int64)
    at = np.flatnonzero(axis[cell] >= 0)
    while len(at):
        node = cell[at]
        cell[at] = child[node] + (place[axis[node], at] >= cut[node])
        at = at[axis[cell[at]] >= 0]
    found = np.full(len(lat), -1)
    at = np.flatnonzero(sizes[cell])
    turn = 0
    while len(at):
        box = lists[starts[cell[at]] + turn]
        low_y, high_y, low_x, high_x = boxes[box].T
        inside = (low_y <= lat[at]) & (lat[at] <= high_y) & (low_x <= lon[at]) & (lon[at] <= high_x)
        found[at[inside]] = own[box[inside]]
        turn += 1
        at = at[~inside]
        at = at[sizes[cell[at]] > turn]
    return found


def _numbered_box(spark: SparkSession, cover: Cover, lat: Column, lon: Column) -> Column:
    shared = spark.sparkContext.broadcast(cover.fields)

    @F.arrow_udf(T.IntegerType())
    def number(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        fields = shared.value
        for y, x in batches:
            found = first_boxes(fields, *(v.fill_null(float("nan")).to_numpy(zero_copy_only=False) for v in (y, x)))
            yield pa.array(found.astype(np.int32), mask=found < 0)

    return number(lat.cast("double"), lon.cast("double"))


def cover_match(
    df: DataFrame,
    boxes: Sequence[Box],
    lat: str = "lat",
    lon: str = "long",
    name: str = "state",
    tie_break: str = "order",
    limit: int = LIMIT,
    most_cells: int = MOST_CELLS,
) -> DataFrame:
    """As :func:`~postgrove.operators.geo.box_match`, for any number of boxes, however they overlap.

    A point goes down the tree where its row stands, and is compared
    with the ``limit`` boxes or fewer that matter there; rows are neither moved nor
    multiplied. The tree is made on the driver, which holds the boxes, and its size is
    bounded by ``most_cells``. A point without both numbers has no box.
    """
    ranked = ranked_boxes(boxes, tie_break)
    spark = df.sparkSession
    numbered = _numbered_box(spark, Cover(ranked, limit, most_cells), F.col(lat), F.col(lon))
    kept = [column for column in df.columns if column != name]
    names = spark.createDataFrame(
        pa.table({"_number": pa.array(range(len(ranked)), pa.int32()), "_name": pa.array([b[0] for b in ranked], pa.string())})
    )
    # As many rows as there are boxes, which the driver holds already.
    return (
        df.withColumn("_number", numbered)
        .join(F.broadcast(names), "_number", "left")
        .select(*kept, F.col("_name").alias(name))
    )
