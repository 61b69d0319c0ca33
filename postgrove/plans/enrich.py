"""Clean posts to posts with language and sentiment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from postgrove.dimensions import POLARITY_WORDS, UNKNOWN_LANGUAGE
from postgrove.operators.language import LanguageModel, with_language
from postgrove.operators.sentiment import with_sentiment
from postgrove.schemas import ENRICHED_POST


def enriched_posts(
    clean: DataFrame,
    model: LanguageModel,
    lexicon: Mapping[str, float] | DataFrame = POLARITY_WORDS,
    negation: bool = True,
) -> DataFrame:
    """Add language and sentiment; posts of no known language are dropped.

    Both are computed row by row, without a shuffle, and once, whatever filters
    follow. The language comes first, so dropped posts get no sentiment pass.
    """
    known = with_language(clean, model, once=True).where(F.col("language") != UNKNOWN_LANGUAGE)
    return with_sentiment(known, lexicon=lexicon, negation=negation, once=True).select(
        *ENRICHED_POST.fieldNames()
    )
