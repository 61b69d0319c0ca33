"""Exact shares per label."""

from collections import Counter

import pytest

from postgrove.plans import training


@pytest.mark.parametrize("bits, most", [(16, 100_000), (2, 0)])
@pytest.mark.parametrize("fraction", [0.75, 0.5, 0.0, 1.0])
def test_every_label_has_its_share(spark, monkeypatch, bits, most, fraction):
    monkeypatch.setattr(training, "HIGH_BITS", bits)
    monkeypatch.setattr(training, "MAX_BROADCAST_LABELS", most)
    sizes = {"a": 1, "b": 2, "c": 301, None: 50, "": 7}
    rows = [(f"{label}{i}", label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, label string").repartition(3)
    got = training.with_exact_split(df, ["id"], "label", fraction, seed=5)
    assert got.columns == ["id", "label", "first"]
    taken = Counter(row.label for row in got.collect() if row["first"])
    assert taken == Counter({x: n for x, n in ((x, int(fraction * n + 0.5)) for x, n in sizes.items()) if n})
    again = training.with_exact_split(df.repartition(2), ["id"], "label", fraction, seed=5)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_equal_rows_stay_together_and_nothing_is_well(spark):
    df = spark.createDataFrame([("x", "a")] * 10 + [(None, "a")], "id string, label string")
    sides = {row["first"] for row in training.with_exact_split(df, ["id"], "label").collect() if row.id == "x"}
    assert len(sides) == 1
    assert training.with_exact_split(df.where("false"), ["id"], "label").collect() == []
