import random

import pytest
from postgrove.dimensions import CORRECTED_BOXES, REGION_BOXES, Box
from postgrove.operators import geo


def brute_force(lat, lon, boxes):
    for box in boxes:
        if box.min_lat <= lat <= box.max_lat and box.min_lon <= lon <= box.max_lon:
            return box.name
    return None


def points():
    rng = random.Random(5)
    inside = [(rng.uniform(18, 72), rng.uniform(-180, 131)) for _ in range(3000)]
    edges = []
    for box in REGION_BOXES:
        middle = ((box.min_lat + box.max_lat) / 2, (box.min_lon + box.max_lon) / 2)
        edges += [
            (box.min_lat, middle[1]), (box.max_lat, middle[1]),
            (middle[0], box.min_lon), (middle[0], box.max_lon),
            (box.min_lat, box.min_lon), (box.max_lat, box.max_lon),
            (box.min_lat - 1e-9, middle[1]), (box.max_lat + 1e-9, middle[1]), middle,
        ]
    return inside + edges + [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0)]


@pytest.mark.parametrize("boxes", [REGION_BOXES, CORRECTED_BOXES], ids=["listed", "corrected"])
@pytest.mark.parametrize("tie_break", ["order", "smallest_area"])
@pytest.mark.parametrize("cell", [1.0, 2.5])
def test_grid_equals_brute_force(spark, boxes, tie_break, cell):
    df = spark.createDataFrame(points(), "lat double, long double")
    tried = geo.ranked_boxes(boxes, tie_break)
    for row in geo.box_match(df, boxes=boxes, tie_break=tie_break, cell=cell).collect():
        assert row.state == brute_force(row.lat, row.long, tried), row


def test_missing_and_endless_coordinates_match_nothing(spark):
    rows = [(None, -100.0), (40.0, None), (float("nan"), -100.0), (float("inf"), -100.0)]
    df = spark.createDataFrame(rows, "lat double, long double")
    assert [r.state for r in geo.box_match(df).collect()] == [None] * 4


def test_single_precision_points_are_widened(spark):
    df = spark.createDataFrame([(30.2, -88.0)], "lat float, long float")
    assert geo.box_match(df).head().state == "Alabama"


def test_no_shuffle_within_the_bound_and_same_rows_beyond(spark, monkeypatch):
    df = spark.createDataFrame(points(), "lat double, long double")
    plan = geo.box_match(df)._jdf.queryExecution().executedPlan().toString()
    # The points are not moved; only the cells, on the other side, are put together.
    points_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in points_side and "Exchange" not in points_side
    expected = sorted(map(tuple, geo.box_match(df).na.fill("-").collect()))
    monkeypatch.setattr(geo, "MAX_BROADCAST_CELLS", 1)
    assert sorted(map(tuple, geo.box_match(df).na.fill("-").collect())) == expected


def test_fine_cells_are_made_in_spark(spark):
    some = points()[:300]
    df = spark.createDataFrame(some, "lat double, long double")
    assert geo.cell_count(REGION_BOXES, 0.1) > geo.MAX_BROADCAST_CELLS
    for row in geo.box_match(df, cell=0.1).collect():
        assert row.state == brute_force(row.lat, row.long, REGION_BOXES), row


def test_existing_column_is_replaced(spark):
    df = spark.createDataFrame([("x", 36.0, -120.0)], "state string, lat double, long double")
    assert geo.box_match(df, boxes=[Box("Here", 35, 37, -121, -119)]).select("state").head()[0] == "Here"
    with pytest.raises(ValueError):
        geo.box_match(df, tie_break="other")
