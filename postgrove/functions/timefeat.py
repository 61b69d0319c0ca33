"""Time features of a post."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The shapes a time may be found in, by precision.
TIME_PATTERNS = {
    "hour": r"(\d{4}-\d{2}-\d{2} \d{2})",
    "second": r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})",
}


def extract_datetime(text: Column, precision: str = "hour") -> Column:
    """First date-time inside ``text``, or NULL where there is none."""
    return F.nullif(F.regexp_extract(text, TIME_PATTERNS[precision], 1), F.lit(""))


def parse_datetime(text: Column) -> Column:
    """Text to a zone-free timestamp; an impossible date gives NULL."""
    return text.try_cast(T.TimestampNTZType())


def date_text(moment: Column) -> Column:
    """``yyyy-MM-dd``."""
    return moment.cast("date").cast("string")


def age_months(moment: Column, since: Column) -> Column:
    """Months from ``since`` to ``moment``, fractional to 8 digits."""
    return F.months_between(moment, since)


def day_spine(start: str, end: str) -> Column:
    """Array of every day from ``start`` to ``end``, both included, as text."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return F.transform(days, lambda day: day.cast("string"))
