"""Tables laid out by ranges and in buckets: same rows, fewer files, no shuffle."""

import pytest
from pyspark.sql import functions as F, types as T

from postgrove.sources import layout

SCHEMA = T.StructType().add("day", T.StringType()).add("k", T.IntegerType()).add("v", T.LongType())


def frame(spark, rows=5000):
    """A third of the rows have one day; every 50th none."""
    i = F.col("id")
    day = F.when(i % 50 == 0, None).when(i % 3 == 0, "d7").otherwise(F.concat(F.lit("d"), (i % 10).cast("string")))
    return spark.range(rows).select(day.alias("day"), (i * 7919 % 100).cast("int").alias("k"), i.alias("v"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("wanted", [{"day": ("d3", "d4")}, {"day": ("d2", "d2"), "k": (0, 9)}, {"k": (5, 5)}, {}])
def test_ranges_skip_files_and_no_row(spark, tmp_path, wanted):
    df = frame(spark)
    layout.write_ranges(df, str(tmp_path), ["day", "k"], 20)
    got = layout.read_ranges(spark, str(tmp_path), SCHEMA, ["day", "k"], **wanted)
    expected = df
    for name, (low, high) in wanted.items():
        expected = expected.where(F.col(name).between(low, high))
    assert rows(got) == rows(expected)
    files = len(list((tmp_path / "rows").glob("*.parquet")))
    assert files >= 15
    if "day" in wanted:
        assert len(got.inputFiles()) <= files // 3
    if wanted:
        assert "PushedFilters: [IsNotNull" in plan(got)


def test_a_day_with_most_rows_is_in_many_files(spark, tmp_path):
    layout.write_ranges(frame(spark), str(tmp_path), ["day"], 20)
    sizes = [row.n for row in spark.read.parquet(f"{tmp_path}/files").collect()]
    assert sum(sizes) == 5000 and max(sizes) < 600
    held = layout.read_ranges(spark, str(tmp_path), SCHEMA, ["day"], day=("d7", "d7"))
    assert len(held.inputFiles()) > 5


def test_ranges_of_nothing(spark, tmp_path):
    df = frame(spark)
    layout.write_ranges(df, str(tmp_path / "a"), ["day"], 4)
    assert layout.read_ranges(spark, str(tmp_path / "a"), SCHEMA, ["day"], day=("x", "z")).collect() == []
    layout.write_ranges(df.where("false"), str(tmp_path / "b"), ["day"], 4)
    assert layout.read_ranges(spark, str(tmp_path / "b"), SCHEMA, ["day"], day=("a", "z")).collect() == []
    with pytest.raises(ValueError):
        layout.read_ranges(spark, str(tmp_path / "a"), SCHEMA, ["day"], v=(1, 2))


def test_buckets_are_joined_and_counted_without_a_shuffle(spark, tmp_path):
    df = frame(spark)
    for name in ("one", "two"):
        layout.write_buckets(df, f"{tmp_path}/{name}", ["k"], 4)
    one, two = (layout.read_buckets(spark, f"{tmp_path}/{name}", SCHEMA, ["k"], 4) for name in ("one", "two"))
    counted = one.groupBy("k").agg(F.count("*").alias("n"))
    joined = counted.join(two.groupBy("k").agg(F.sum("v").alias("s")).hint("merge"), "k")
    assert "Exchange" not in plan(joined)
    assert rows(joined) == rows(df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")))
