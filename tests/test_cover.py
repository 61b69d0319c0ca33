"""The tree of boxes against trying one box after the other."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgrove.dimensions import REGION_BOXES, Box
from postgrove.operators.cover import Cover, cover_match, first_boxes
from postgrove.operators.geo import box_match


def by_hand(boxes, lat, lon):
    for i, (_, low_y, high_y, low_x, high_x) in enumerate(boxes):
        if low_y <= lat <= high_y and low_x <= lon <= high_x:
            return i
    return -1


def overlapping(kind, count, draw):
    for i in range(count):
        if kind == "nested":
            yield Box(str(i), -i - 1, i + 1, -i - 1, i + 1)
        elif kind == "nested, largest last edge shared":
            yield Box(str(i), 0, i // 2, 0, i // 2)
        elif kind == "strips":
            at = draw.randint(-50, 50)
            yield Box(str(i), at, at + 0.5, -60, 60) if i % 2 else Box(str(i), -60, 60, at, at + 0.5)
        else:
            y, x = draw.randint(-50, 50), draw.randint(-50, 50)
            yield Box(str(i), y, y + draw.randint(-1, 30), x, x + draw.randint(0, 30))


@pytest.mark.parametrize("limit, most", [(1, 10**6), (4, 10**6), (2, 9)])
@pytest.mark.parametrize("kind", ["nested", "nested, largest last edge shared", "strips", "random"])
def test_equals_trying_all_boxes(kind, limit, most):
    draw = random.Random(4)
    boxes = list(overlapping(kind, 60, draw))
    cover = Cover(boxes, limit, most)
    # Points on edges, corners and between.
    points = [(draw.randint(-70, 70) / 2, draw.randint(-70, 70) / 2) for _ in range(800)]
    points += [(box[1], box[3]) for box in boxes] + [(box[2], box[4]) for box in boxes]
    points += [(float("nan"), 0.0), (0.0, float("inf"))]
    lat, lon = np.array(points, float).T
    assert first_boxes(cover.fields, lat, lon).tolist() == [by_hand(boxes, *point) for point in points]
    assert cover.cells <= most
    if most > 9:
        assert cover.sizes.max() <= limit or limit < 1


def test_many_boxes_in_one_place_stay_short_lists():
    boxes = [Box(str(i), 40 - i / 1e4, 40 + i / 1e4, -100 - i / 1e4, -100 + i / 1e4) for i in range(20_000)]
    begin = time.perf_counter()
    cover = Cover(boxes)
    assert cover.sizes.max() <= 16 and time.perf_counter() - begin < 60
    lat, lon = np.random.default_rng(1).uniform((38, -102), (42, -98), (5000, 2)).T
    # The smallest square around a point is known by arithmetic, but for rounding at its edges.
    reach = np.maximum(np.abs(lat - 40), np.abs(lon + 100)) * 1e4
    sure = np.abs(reach - np.round(reach)) > 1e-6
    expected = np.where(np.ceil(reach) < 20_000, np.ceil(reach), -1)
    assert (first_boxes(cover.fields, lat, lon) == expected)[sure].all()


@pytest.mark.parametrize("tie_break", ["order", "smallest_area"])
def test_equals_the_grid_on_the_region_boxes(spark, tie_break):
    draw = random.Random(8)
    rows = [(i, draw.uniform(15, 72), draw.uniform(-170, -60)) for i in range(1500)]
    rows += [(1500 + i, float(box[1]), float(box[4])) for i, box in enumerate(REGION_BOXES)]
    rows += [(2000, None, -100.0), (2001, 40.0, None), (2002, float("nan"), -100.0)]
    points = spark.createDataFrame(rows, "id int, lat float, long float").withColumn("state", F.lit("old"))
    got = cover_match(points, REGION_BOXES, tie_break=tie_break, limit=2)
    assert got.columns == ["id", "lat", "long", "state"]
    key = lambda row: (row.id, row.state)
    assert sorted(map(key, got.collect()), key=str) == sorted(
        map(key, box_match(points, tie_break=tie_break).collect()), key=str
    )
    # Points are not shuffled.
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_without_boxes(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, lat double, long double")
    assert cover_match(points, []).head().state is None
