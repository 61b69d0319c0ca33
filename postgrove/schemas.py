"""Row types of each stage and the contracts of the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names, order and types of a raw post.
RAW_POST = _struct(
    created_at=T.StringType(),
    tweet_id=T.StringType(),
    tweet=T.StringType(),
    likes=T.StringType(),
    retweet_count=T.StringType(),
    source=T.StringType(),
    user_id=T.StringType(),
    user_name=T.StringType(),
    user_screen_name=T.StringType(),
    user_description=T.StringType(),
    user_join_date=T.StringType(),
    user_followers_count=T.StringType(),
    user_location=T.StringType(),
    lat=T.FloatType(),
    long=T.FloatType(),
    city=T.StringType(),
    country=T.StringType(),
    continent=T.StringType(),
    state=T.StringType(),
    state_code=T.StringType(),
    collected_at=T.StringType(),
)

CLEAN_POST = _struct(
    date=T.StringType(),
    dayofweek=T.IntegerType(),
    hour=T.IntegerType(),
    candidate=T.StringType(),
    online_age=T.DoubleType(),
    state=T.StringType(),
    tweet=T.StringType(),
)

ENRICHED_POST = T.StructType(
    CLEAN_POST.fields
    + [
        T.StructField("sentiment", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

# Numbers are read as doubles so that 8 and 8.0 both pass; the model takes
# doubles anyway.
SCORE_REQUEST = _struct(
    uuid=T.StringType(),
    hour=T.DoubleType(),
    dayofweek=T.DoubleType(),
    online_age=T.DoubleType(),
    candidate=T.StringType(),
    language=T.StringType(),
)


@dataclass(frozen=True)
class TableContract:
    """Columns of a result table and the business key its rows are unique by.

    Only key columns in ``null_keys`` may be NULL; NULL is then one key of its own.
    """

    schema: T.StructType
    keys: tuple[str, ...]
    null_keys: tuple[str, ...] = ()


def _counts(key: str, *names: str) -> TableContract:
    columns = {key: T.StringType()} | {name: T.LongType() for name in names}
    return TableContract(_struct(**columns), (key,))


_CROSSED = (
    "trumppositive",
    "trumpneutral",
    "trumpnegative",
    "bidenpositive",
    "bidenneutral",
    "bidennegative",
    "total",
)

# Names, columns and keys of the result tables.
CONTRACTS: dict[str, TableContract] = {
    # Posts of an impossible date have no hour.
    "hour": TableContract(
        _struct(hour=T.IntegerType(), trump=T.LongType(), biden=T.LongType()), ("hour",), ("hour",)
    ),
    "state": TableContract(
        _struct(
            state=T.StringType(),
            trump=T.LongType(),
            biden=T.LongType(),
            total=T.LongType(),
            id=T.StringType(),
        ),
        ("state",),
    ),
    "language": _counts("language", *_CROSSED),
    "state_analyze": _counts("state", *_CROSSED),
    "date_cumulative": TableContract(
        _struct(date=T.StringType(), language=T.StringType(), cumulative=T.LongType()),
        ("language", "date"),
    ),
    "word_list": TableContract(
        _struct(
            candidate=T.StringType(),
            state=T.StringType(),
            word=T.StringType(),
            count=T.LongType(),
            uuid=T.StringType(),
        ),
        ("candidate", "state", "word"),
    ),
}

# Answers to scoring requests.
ANSWERS = TableContract(_struct(uuid=T.StringType(), prediction=T.StringType()), ("uuid",))
