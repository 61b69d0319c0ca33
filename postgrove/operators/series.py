"""Counts per day, gap filling and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.functions.timefeat import day_spine


def count_nonnull(df: DataFrame, keys: Sequence[str], column: str, name: str = "count") -> DataFrame:
    """Rows per group in which ``column`` is set."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def day_grid(keys: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """Every row of ``keys`` on every day: their cross product with the days.

    The days are made from two literals on each row, so nothing is joined,
    broadcast or shuffled.
    """
    return keys.select(F.explode(day_spine(start, end)).alias(date), *keys.columns)


def fill_missing(grid: DataFrame, counts: DataFrame, on: Sequence[str], measure: str) -> DataFrame:
    """Left join of ``counts`` onto ``grid`` with 0 where nothing was counted."""
    return grid.join(counts, list(on), "left").fillna(0, [measure])


def running_total(df: DataFrame, keys: Sequence[str], order: str, measure: str, name: str) -> DataFrame:
    window = (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.sum(measure).over(window))


def cumulative_by_day(
    df: DataFrame,
    key: str,
    start: str,
    end: str,
    column: str,
    date: str = "date",
    name: str = "cumulative",
) -> DataFrame:
    """Running count of non-null ``column`` per key over every day of a span.

    A key seen anywhere in the data gets all days; days outside the span count
    nowhere. Two shuffles and no join: rows are counted per key and day, a
    window over the days that occur sums them up, and each of these rows is
    then spread over the days until the next. The window sees at most one row
    per day of the span and one more, so no key is too large for it.

    A NULL key gets zeros on every day, as it equals nothing.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    counted = df.groupBy(F.col(key), _day_in_span(date, first, last).alias("_day")).agg(F.count(column).alias("_n"))
    return _summed_over_days(counted, key, first, last, date, name)


def cumulative_of_counts(
    counts: DataFrame,
    key: str,
    start: str,
    end: str,
    measure: str,
    date: str = "date",
    name: str = "cumulative",
) -> DataFrame:
    """:func:`cumulative_by_day` from rows that are counts already: ``measure`` per key and day.

    Its cost follows the days, not the rows that were counted.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    counted = counts.groupBy(F.col(key), _day_in_span(date, first, last).alias("_day")).agg(F.sum(measure).alias("_n"))
    return _summed_over_days(counted, key, first, last, date, name)


def _day_in_span(date: str, first: Column, last: Column) -> Column:
    parsed = F.col(date).try_cast("date")
    return F.when(parsed.between(first, last) & (parsed.cast("string") == F.col(date)), parsed)


def _summed_over_days(
    counted: DataFrame, key: str, first: Column, last: Column, date: str, name: str
) -> DataFrame:
    """Rows of (key, _day, _n) as running totals over every day from ``first`` to ``last``."""
    # The row without a day, if any, comes first: it counts nothing.
    by_day = Window.partitionBy(key).orderBy(F.asc_nulls_first("_day"))
    counts = F.when(F.col("_day").isNotNull() & F.col(key).isNotNull(), F.col("_n")).otherwise(0)
    summed = counted.select(
        key,
        "_day",
        F.sum(counts).over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("_sum"),
        F.date_sub(F.lead("_day").over(by_day), 1).alias("_until"),
        (F.row_number().over(by_day) == 1).alias("_is_first"),
    )

    def days(begin: Column, stop: Column, total: Column) -> Column:
        each = F.when(begin <= stop, F.sequence(begin, stop)).otherwise(F.array().cast("array<date>"))
        return F.transform(each, lambda day: F.struct(day.alias("day"), total.alias("sum")))

    begin, stop = F.coalesce("_day", first), F.coalesce("_until", last)
    zeros_until = F.when(F.col("_is_first"), F.date_sub("_day", 1))
    spread = F.concat(days(first, zeros_until, F.lit(0).cast("bigint")), days(begin, stop, F.col("_sum")))
    return summed.select(key, F.explode(spread).alias("_at")).select(
        F.col("_at.day").cast("string").alias(date), key, F.col("_at.sum").alias(name)
    )
