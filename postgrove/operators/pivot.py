"""Conditional-count pivots with a known set of values."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F


def joined_name(values: Sequence[object]) -> str:
    return "".join(str(value) for value in values).lower()


def conditional_pivot(
    df: DataFrame,
    keys: Sequence[str],
    dims: Mapping[str, Sequence[object]],
    total: str | None = None,
    name: Callable[[Sequence[object]], str] = joined_name,
) -> DataFrame:
    """Rows per group for every combination of the listed values.

    One partial and one final aggregation, whatever the number of cells, so a
    group that holds most of the rows is reduced before the shuffle. ``total``
    names a column with the sum over the cells: rows with other values are not
    in it.
    """
    cells = {
        name(values): reduce(and_, (F.col(dim) == value for dim, value in zip(dims, values)))
        for values in itertools.product(*dims.values())
    }
    counted = df.groupBy(*keys).agg(*(F.count_if(hit).alias(cell) for cell, hit in cells.items()))
    if total is None:
        return counted
    return counted.withColumn(total, row_sum(cells))


def row_sum(columns: Sequence[str]) -> Column:
    return reduce(add, (F.col(column) for column in columns))


def largest_first(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Descending by ``measure``; equal rows by ``ties``, so the order is fixed."""
    return df.orderBy(F.desc(measure), *ties)
