"""Reports that follow new posts equal a recount of all posts."""

import random

import pytest
from pyspark.sql import functions as F

from postgrove.plans import reports
from postgrove.plans.increments import ReportCounts
from postgrove.schemas import CLEAN_POST, ENRICHED_POST

DAYS = ["2020-10-14", "2020-10-15", "2020-10-20", "2020-11-08", "2020-11-09", "2020-02-30", None]


def made_posts(count, seed):
    draw = random.Random(seed)
    for _ in range(count):
        day = draw.choice(DAYS)
        hour = None if day is None else draw.randint(0, 23)
        yield (
            day, draw.randint(1, 7), hour, draw.choice(["Trump", "Biden", "Other"]), 1.0,
            draw.choice(["Ohio", "Iowa"]), draw.choice(["some words", None]),
            draw.choice(["Positive", "Neutral", "Negative"]), draw.choice(["English", "German", "French"]),
        )


@pytest.fixture(scope="module")
def parts(spark):
    return [spark.createDataFrame(list(made_posts(40, i)), ENRICHED_POST) for i in range(4)]


def rows(df):
    return sorted(map(str, df.collect()))


def compared(counts, posts):
    clean = posts.select(*CLEAN_POST.names)
    pairs = [
        (counts.hourly_counts(), reports.hourly_counts(clean)),
        (counts.state_counts(), reports.state_counts(clean)),
        (counts.language_counts(), reports.language_counts(posts)),
        (counts.state_sentiment_counts(), reports.state_sentiment_counts(posts)),
        (counts.cumulative_by_language(), reports.cumulative_by_language(posts)),
        (
            counts.cumulative_by_language("2020-10-10", "2020-10-16"),
            reports.cumulative_by_language(posts, "2020-10-10", "2020-10-16"),
        ),
    ]
    for got, expected in pairs:
        assert got.columns == expected.columns and rows(got) == rows(expected)


def test_increments_equal_a_recount(spark, parts, tmp_path):
    counts = ReportCounts(spark, str(tmp_path / "counts"))
    so_far = None
    for i, part in enumerate(parts):
        for _ in range(2 if i == 1 else 1):  # a repeated batch adds nothing
            counts.add_clean(part.select(*CLEAN_POST.names), "w", i)
            counts.add_enriched(part, "w", i)
        so_far = part if so_far is None else so_far.union(part)
        if i == 2:
            counts.compact()
        if i != 1:
            compared(ReportCounts(spark, str(tmp_path / "counts")), so_far)


def test_a_batch_that_failed_half_way_adds_what_is_missing(spark, parts, tmp_path):
    counts = ReportCounts(spark, str(tmp_path / "counts"))
    upsert, counts.tables["days"].upsert = counts.tables["days"].upsert, None
    with pytest.raises(TypeError):
        counts.add_enriched(parts[0], "w", 0)
    counts.tables["days"].upsert = upsert
    counts.add_enriched(parts[0], "w", 0)
    counts.add_clean(parts[0].select(*CLEAN_POST.names), "w", 0)
    compared(counts, parts[0])


def test_new_posts_are_all_that_is_read(spark, parts, tmp_path):
    """An increment of one post writes one row per table, whatever is there."""
    counts = ReportCounts(spark, str(tmp_path / "counts"))
    for part in parts:
        counts.add_enriched(part)
    counts.add_enriched(parts[0].limit(1))
    for name in ("language", "state_analyze", "days"):
        last = counts.tables[name].snapshot().parts[-1][1]
        assert spark.read.parquet(f"{counts.tables[name].path}/{last}").count() == 1


def test_nothing_to_count(spark, parts, tmp_path):
    counts = ReportCounts(spark, str(tmp_path / "counts"))
    assert counts.hourly_counts().collect() == [] and counts.cumulative_by_language().collect() == []
    counts.add_enriched(parts[0].where(F.lit(False)))
    assert counts.language_counts().collect() == [] and counts.cumulative_by_language().collect() == []
