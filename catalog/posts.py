"""Raw posts made from the documents table, row by row, with every kind of flaw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from postgrove.dimensions import Box
from postgrove.schemas import RAW_POST

# Polarity of words that occur in the generated prose of the test tables.
LEXICON = {
    "that": 0.4,
    "this": -0.3,
    "with": 0.2,
    "from": -0.6,
    "are": 0.1,
    "avec": 0.5,
    "que": -0.2,
    "dans": 0.3,
    "nicht": -0.5,
    "auch": 0.6,
    "sch": -0.1,
    "para": 0.3,
    "los": -0.4,
}


def place(key: Column) -> list[Column]:
    """A point between 24 and 50 degrees north and 125 and 67 degrees west."""
    return [
        ((2400 + key * 37 % 2600) / 100).cast("float").alias("lat"),
        ((-12500 + key * 101 % 5800) / 100).cast("float").alias("long"),
    ]


def many_boxes() -> list[Box]:
    """Boxes that overlap: two of three are nested in some degrees, the smallest first."""
    made = []
    for i in range(3000):
        lat, lon = (37.0, -96.0) if i % 3 else (24 + i * 37 % 2600 / 100, -125 + i * 101 % 5800 / 100)
        size = (1 + i // 3) / 128
        made.append(Box(f"box{i}", lat - size, lat + size / 2, lon - size * (1 + i % 5), lon + size))
    return made


def raw_posts(documents: DataFrame) -> DataFrame:
    """One raw post per document, plus the name of the file it would have come from."""
    key = F.col("doc_id")
    lat, lon = place(key)
    created = moment("2020-10-13 00:00:00", key * 7919 % 2_592_000)
    joined = moment("2012-01-01 00:00:00", key * 104_729 % 250_000_000)
    made = {
        "created_at": F.when(key % 19 == 0, None)
        .when(key % 17 == 0, F.lit("no date"))
        .when(key % 13 == 0, F.lit("2020-02-30 10:00:00"))
        .when(key % 11 == 0, F.concat(F.lit("at "), created, F.lit(".5")))
        .otherwise(created),
        "tweet_id": key.cast("string"),
        "tweet": F.col("text"),
        "user_join_date": F.when(key % 23 != 0, joined),
        "lat": F.when(key % 29 != 0, lat),
        "long": lon,
    }
    columns = [
        made.get(field.name, F.lit(None).cast(field.dataType)).alias(field.name)
        for field in RAW_POST
    ]
    filename = (
        F.when(key % 3 == 0, F.lit("archive/hashtag_donaldtrump.csv"))
        .when(key % 3 == 1, F.lit("archive/hashtag_joebiden.csv"))
        .when(key % 2 == 0, F.lit("archive/other.csv"))
        .otherwise(F.lit("archive/hashtag_donaldtrump.csv"))
    )
    return documents.select(*columns, filename.alias("filename"))


def moment(start: str, seconds: Column) -> Column:
    """``start`` plus ``seconds``, as text."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return (F.lit(start).cast(T.TimestampNTZType()) + step).cast("string")
