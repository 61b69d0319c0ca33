"""Class labels, ids and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The class a source file belongs to, by a part of its path.
FILE_RULES: tuple[tuple[str, str], ...] = (
    ("donaldtrump", "Trump"),
    ("joebiden", "Biden"),
)


def label_by_substring(text: Column, rules: Sequence[tuple[str, str]] = FILE_RULES,
                       default: str | None = None) -> Column:
    """Label of the first rule whose substring occurs in ``text``."""
    hits = [F.when(F.contains(text, F.lit(part)), F.lit(label)) for part, label in rules]
    return F.coalesce(*hits, F.lit(default))


def sign_label(score: Column) -> Column:
    """Positive, Neutral or Negative by the sign of ``score``; NULL stays NULL."""
    return (
        F.when(score > 0, F.lit("Positive"))
        .when(score == 0, F.lit("Neutral"))
        .when(score < 0, F.lit("Negative"))
    )


def row_digest(*keys: Column) -> Column:
    """SHA-256 of the key values: the same row gets the same id on every run.

    Each value is preceded by its length, so neighbouring values cannot run
    into each other, and NULL differs from empty text.
    """
    texts = [key.cast("string") for key in keys]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_uuid(*keys: Column) -> Column:
    """:func:`row_digest` in the shape of a UUID, for stores with a UUID column."""
    return F.regexp_replace(
        F.substring(row_digest(*keys), 1, 32),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def random_uuid() -> Column:
    """A fresh random UUID per row; differs between runs and task retries."""
    return F.expr("uuid()")
