"""Raw posts to clean, typed posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from postgrove.dimensions import REGION_BOXES, Box
from postgrove.functions import timefeat
from postgrove.functions.labels import FILE_RULES, label_by_substring
from postgrove.operators.geo import box_match
from postgrove.schemas import CLEAN_POST
from postgrove.sources.files import read_parquet


def placed_posts(
    raw: DataFrame,
    precision: str,
    boxes: Sequence[Box] = REGION_BOXES,
    rules: Sequence[tuple[str, str]] = FILE_RULES,
    file_column: str = "filename",
    tie_break: str = "order",
) -> DataFrame:
    """Posts with a place, both times and a region; class and time features added.

    ``candidate`` is NULL where the file name names no class. A time of the
    right shape that is no date, such as 30 February, keeps its row with NULL
    features.
    """
    timed = raw.where(
        F.col("lat").isNotNull() & F.col("long").isNotNull() & F.col("created_at").isNotNull()
    ).withColumns(
        {
            "candidate": label_by_substring(F.col(file_column), rules),
            "_time": timefeat.extract_datetime(F.col("created_at"), precision),
            "_join_time": timefeat.extract_datetime(F.col("user_join_date"), precision),
        }
    )
    kept = timed.where(F.col("_time").isNotNull() & F.col("_join_time").isNotNull())
    moment = timefeat.parse_datetime(F.col("_time"))
    placed = box_match(kept, boxes=boxes, tie_break=tie_break).where(F.col("state").isNotNull())
    return placed.withColumn("timestamp", moment).withColumns(
        {
            "date": timefeat.date_text(F.col("timestamp")),
            "dayofweek": F.dayofweek("timestamp"),
            "hour": F.hour("timestamp"),
            "online_age": timefeat.age_months(
                F.col("timestamp"), timefeat.parse_datetime(F.col("_join_time"))
            ),
        }
    )


def clean_posts(raw: DataFrame, **options) -> DataFrame:
    """The clean table: times to the hour, only posts of a known class."""
    placed = placed_posts(raw, "hour", **options)
    return placed.where(F.col("candidate").isNotNull()).select(*CLEAN_POST.fieldNames())


# The columns the word ranking works on.
WORD_POST_COLUMNS = (
    "timestamp",
    "dayofweek",
    "hour",
    "state",
    "candidate",
    "likes",
    "retweet_count",
    "online_age",
    "user_followers_count",
    "lat",
    "long",
    "tweet",
)


def word_posts(raw: DataFrame, **options) -> DataFrame:
    """The input of the word ranking: times to the second."""
    return placed_posts(raw, "second", **options).select(*WORD_POST_COLUMNS)


KEPT = "kept"
# Why a line is not in the clean table, in the order in which it is asked.
REASONS = ("malformed line", "no place", "no time", "no join time", "no region", "no class")


def judged_posts(
    raw: DataFrame,
    boxes: Sequence[Box] = REGION_BOXES,
    rules: Sequence[tuple[str, str]] = FILE_RULES,
    file_column: str = "filename",
    tie_break: str = "order",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Every line of ``raw`` once, as (verdict, raw, *clean columns).

    The lines that :func:`clean_posts` keeps have the verdict ``kept`` and the clean columns, the others the
    first of :data:`REASONS` and the whole line as JSON in ``raw``.
    """
    timed = raw.withColumns(
        {
            "candidate": label_by_substring(F.col(file_column), rules),
            "_raw": F.to_json(F.struct(*raw.columns)),
            "_time": timefeat.extract_datetime(F.col("created_at"), "hour"),
            "_join_time": timefeat.extract_datetime(F.col("user_join_date"), "hour"),
        }
    )
    placed = box_match(timed, boxes=boxes, tie_break=tie_break)
    malformed = F.lit(False) if corrupt_column is None else F.col(corrupt_column).isNotNull()
    fails = (
        malformed,
        F.col("lat").isNull() | F.col("long").isNull(),
        F.col("_time").isNull(),
        F.col("_join_time").isNull(),
        F.col("state").isNull(),
        F.col("candidate").isNull(),
    )
    verdict = F.coalesce(*(F.when(fail, F.lit(reason)) for fail, reason in zip(fails, REASONS)), F.lit(KEPT))
    moment = timefeat.parse_datetime(F.col("_time"))
    made = {
        "date": timefeat.date_text(moment),
        "dayofweek": F.dayofweek(moment),
        "hour": F.hour(moment),
        "online_age": timefeat.age_months(moment, timefeat.parse_datetime(F.col("_join_time"))),
    }
    kept = F.col("verdict") == KEPT
    return placed.withColumn("verdict", verdict).select(
        "verdict",
        F.when(~kept, F.col("_raw")).alias("raw"),
        *(F.when(kept, made.get(name, F.col(name))).alias(name) for name in CLEAN_POST.names),
    )


def write_judged(raw: DataFrame, path: str, **options) -> dict[str, int]:
    """Write clean posts and rejected lines below ``path`` in one pass; returns how many there are of each.

    ``lines`` is how many lines were read. Both tables are folders of one Parquet table by verdict,
    so no line is read twice, and none is lost between the two.
    """
    counts = Observation("ingest")
    verdict = F.col("verdict")
    rows = judged_posts(raw, **options).observe(
        counts,
        F.count("*").alias("lines"),
        *(F.count_if(verdict == name).alias(name) for name in (KEPT, *REASONS)),
    )
    rows.write.mode("overwrite").partitionBy("verdict").parquet(path)
    return counts.get


_JUDGED = T.StructType(
    [T.StructField("raw", T.StringType()), *CLEAN_POST.fields, T.StructField("verdict", T.StringType())]
)


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """The clean posts that :func:`write_judged` wrote."""
    return read_parquet(spark, path, _JUDGED).where(F.col("verdict") == KEPT).select(*CLEAN_POST.names)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """(reason, raw) of the lines it left out."""
    rows = read_parquet(spark, path, _JUDGED).where(F.col("verdict") != KEPT)
    return rows.select(F.col("verdict").alias("reason"), "raw")
