"""The result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from postgrove.dimensions import STOP_WORDS
from postgrove.functions.labels import row_uuid
from postgrove.functions.text import tokens
from postgrove.operators.heavy import frequent_terms
from postgrove.operators.pivot import conditional_pivot, largest_first
from postgrove.operators.series import cumulative_by_day
from postgrove.operators.terms import explode_terms, term_counts, top_terms

# The classes, sentiments and days the reports cover.
CANDIDATES = ("Trump", "Biden")
SENTIMENTS = ("Positive", "Neutral", "Negative")
FIRST_DAY, LAST_DAY = "2020-10-15", "2020-11-08"


def hourly_counts(clean: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    return conditional_pivot(clean, ["hour"], {"candidate": candidates}).orderBy("hour")


def state_counts(clean: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Posts per region and class. The id depends on the region alone, so a rerun
    replaces rows instead of doubling them."""
    counted = conditional_pivot(clean, ["state"], {"candidate": candidates}, total="total")
    return counted.withColumn("id", row_uuid(F.col("state")))


def sentiment_counts(
    enriched: DataFrame,
    key: str,
    candidates: Sequence[str] = CANDIDATES,
    sentiments: Sequence[str] = SENTIMENTS,
) -> DataFrame:
    """Posts per ``key``, class and sentiment with a total, largest first."""
    dims = {"candidate": candidates, "sentiment": sentiments}
    return largest_first(conditional_pivot(enriched, [key], dims, total="total"), "total", key)


def language_counts(enriched: DataFrame) -> DataFrame:
    return sentiment_counts(enriched, "language")


def state_sentiment_counts(enriched: DataFrame) -> DataFrame:
    return sentiment_counts(enriched, "state")


def cumulative_by_language(
    enriched: DataFrame, start: str = FIRST_DAY, end: str = LAST_DAY
) -> DataFrame:
    return cumulative_by_day(enriched, "language", start, end, "tweet")


def top_words(
    posts: DataFrame,
    batch_id: str,
    k: int = 10,
    candidates: Sequence[str] = CANDIDATES,
    stop_words: Sequence[str] = STOP_WORDS,
    full_mentions: bool = False,
    summaries: bool = False,
) -> DataFrame:
    """The ``k`` most frequent words of each class and region.

    One pass for all classes: the class is part of the group, not a branch. With
    ``summaries`` tasks send what may be among the first words, not all words:
    the same result, for posts so many that the shuffle costs more than reading them again.
    """
    named = posts.where(F.col("candidate").isin(list(candidates))).withColumn(
        "candidate", F.lower("candidate")
    )
    keys = ["candidate", "state"]
    if summaries:
        words = tokens(F.col("tweet"), stop_words, full_mentions)
        return frequent_terms(named, keys, words, k).withColumn("uuid", F.lit(batch_id))
    terms = explode_terms(named, keys, F.col("tweet"), stop_words, full_mentions)
    ranked = top_terms(term_counts(terms, keys), keys, k)
    return ranked.withColumn("uuid", F.lit(batch_id))
