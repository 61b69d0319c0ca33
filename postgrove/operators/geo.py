"""Which region box a point lies in."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.dimensions import REGION_BOXES, Box

# About 100 bytes a cell: far below what an executor can hold. Past this the
# cells are joined by shuffle instead.
MAX_BROADCAST_CELLS = 200_000


def ranked_boxes(boxes: Sequence[Box], tie_break: str = "order") -> list[Box]:
    """Boxes in the order they are tried: as listed, or the smallest area first."""
    if tie_break == "order":
        return list(boxes)
    if tie_break == "smallest_area":
        return sorted(boxes, key=lambda box: box.area)
    raise ValueError(f"unknown tie_break {tie_break!r}")


def cell_count(boxes: Sequence[Box], cell: float) -> int:
    """Cells touched by the boxes, counted once per box, by arithmetic alone."""

    def steps(low: float, high: float) -> int:
        return max(0, math.floor(high / cell) - math.floor(low / cell) + 1)

    return sum(steps(b.min_lat, b.max_lat) * steps(b.min_lon, b.max_lon) for b in boxes)


def grid_cells(spark: SparkSession, boxes: Sequence[Box], cell: float) -> DataFrame:
    """Grid cells touched by any box, each with its boxes in matching order."""
    schema = T.StructType(
        [T.StructField("rank", T.IntegerType()), T.StructField("name", T.StringType())]
        + [T.StructField(edge, T.DoubleType()) for edge in Box._fields[1:]]
    )
    rows = [(i, box[0], *map(float, box[1:])) for i, box in enumerate(boxes)]

    def lines(low: str, high: str) -> Column:
        first, last = F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)
        return F.when(first <= last, F.sequence(first, last))

    return (
        spark.createDataFrame(rows, schema)
        .select(F.struct(*schema.fieldNames()).alias("box"), lines("min_lat", "max_lat").alias("rows"),
                lines("min_lon", "max_lon").alias("cols"))
        .select("box", F.explode("rows").alias("_row"), "cols")
        .select("box", "_row", F.explode("cols").alias("_col"))
        .groupBy("_row", "_col")
        .agg(F.sort_array(F.collect_list("box")).alias("_boxes"))
    )


def box_match(
    df: DataFrame,
    lat: str = "lat",
    lon: str = "long",
    boxes: Sequence[Box] = REGION_BOXES,
    name: str = "state",
    tie_break: str = "order",
    cell: float = 1.0,
) -> DataFrame:
    """Add the name of the first box holding the point, edges included, or NULL.

    The boxes are laid on a grid and the point's cell is looked up by a hash
    join, so a point is compared with the few boxes of its cell only. The cells
    are broadcast up to a checked number: then points are neither moved nor
    multiplied, however many fall into one cell.
    """
    ranked = ranked_boxes(boxes, tie_break)
    cells = grid_cells(df.sparkSession, ranked, cell)
    if cell_count(ranked, cell) <= MAX_BROADCAST_CELLS:
        cells = F.broadcast(cells)
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    holding = F.filter(
        "_boxes",
        lambda box: y.between(box["min_lat"], box["max_lat"])
        & x.between(box["min_lon"], box["max_lon"]),
    )
    kept = [column for column in df.columns if column != name]
    return (
        df.select(*kept, F.floor(y / cell).alias("_row"), F.floor(x / cell).alias("_col"))
        .join(cells, ["_row", "_col"], "left")
        .select(*kept, F.get(holding, F.lit(0))["name"].alias(name))
    )
