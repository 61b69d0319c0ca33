"""Cleaning posts and cutting them into words."""

from __future__ import annotations

import html
import string
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F, types as T

from postgrove.dimensions import STOP_WORDS
from postgrove.functions.batches import batches_by_bytes, by_parts

# The patterns of the cleaning chain, in order, each with its
# replacement. `.` stops at a line end. White space is what Unicode calls so,
# with the control characters \x1c-\x1f. After NON_ASCII all text is ASCII.
SHORT_LINK = (r"https://t.co[^\s\x0b\x1c-\x1f\x85\pZ]+", " ")
MENTION = ("@[A-Za-z0–9]+", "")  # the dash is an en dash: digits 1-8 and _ end a mention
FULL_MENTION = (r"@[\pL\pN_]+", "")
NON_ASCII = (r"[^\x00-\x7F]+", " ")
BRACKETED = (r"\[.*?\]", "")
TAG = (r"<.*?>+", "")
DIGIT_WORD = (r"\w*\d\w*", "")
COM_WORD = (r"\bcom\b", "")
RETWEET = (r"RT[\s\x0b\x1c-\x1f]+", "")
SYMBOL = (r"[^\w ]", " ")
NOISE_WORDS = ("trump", "biden", "donaldtrump", "joebiden", "will", "don")
NOISE = (rf"\b(?:[a-zA-Z]|{'|'.join(NOISE_WORDS)})\b", "")
# Plain texts that are dropped.
COLON, GARBLED_ELLIPSIS, HASH, WWW, LINE_END, HTTPS, HTTP = (
    ":", "‚Ä¶", "#", "www.", "\n", "https", "http",
)


def _batch_cleaner(steps: Sequence[str | tuple[str, str]]) -> Callable[[pa.Array], pa.Array]:
    """Lower-case texts through the steps: plain texts to drop, or pattern and replacement.

    Arrow's regular expressions run over a whole batch and take time linear in
    the text; one core does the chain in a fifth of the time of nested
    regexp_replace calls. A function within a function, as the ones below, so
    that executors need no copy of this package.
    """

    def clean(texts: pa.Array) -> pa.Array:
        suspect = pc.fill_null(pc.match_substring(texts, pattern="&"), False)
        decoded = [html.unescape(text) for text in texts.filter(suspect).to_pylist()]
        if decoded:
            texts = pc.replace_with_mask(texts, suspect, pa.array(decoded, texts.type))
        for step in steps:
            if isinstance(step, str):
                texts = pc.replace_substring(texts, pattern=step, replacement="")
            else:
                texts = pc.replace_substring_regex(texts, pattern=step[0], replacement=step[1])
        return texts

    return clean


def _cleaner(steps: Sequence[str | tuple[str, str]]) -> Callable[[Column], Column]:
    clean = _batch_cleaner(steps)
    batches_by_bytes(SparkSession.getActiveSession())

    @F.arrow_udf(T.StringType())
    def cleaned(texts: pa.Array) -> pa.Array:
        return by_parts(clean, texts)

    return cleaned


def decode_entities(text: Column) -> Column:
    """Resolve HTML entities.

    Only texts with an ampersand are handed over; for all others the batch
    column holds NULL, which costs next to nothing to send.
    """
    suspect = F.when(F.contains(text, F.lit("&")), text)
    return F.coalesce(_cleaner([])(suspect), text)


def _steps(full_mentions: bool) -> list[str | tuple[str, str]]:
    # Later steps see what earlier ones leave behind, so their order matters.
    mention = FULL_MENTION if full_mentions else MENTION
    return [
        SHORT_LINK, COLON, GARBLED_ELLIPSIS, mention, HASH, NON_ASCII, BRACKETED, WWW, TAG,
        LINE_END, DIGIT_WORD, COM_WORD, HTTPS, HTTP, RETWEET, SYMBOL,
    ]


def clean_text(text: Column, full_mentions: bool = False) -> Column:
    """Lower-case words and spaces only: links, mentions, tags, symbols, words with
    digits, single letters and noise words are dropped."""
    return _cleaner([*_steps(full_mentions), NOISE])(F.lower(text))


def tokens(
    text: Column, stop_words: Sequence[str] = STOP_WORDS, full_mentions: bool = False
) -> Column:
    """The words of a raw text in order, as :func:`clean_text` separates them by spaces,
    without stop words.

    Noise words and stop words go in the batch, before they become rows of
    their own.
    """
    clean = _batch_cleaner(_steps(full_mentions))
    noise, stop = ["", *string.ascii_letters, *NOISE_WORDS], list(stop_words)
    batches_by_bytes(SparkSession.getActiveSession())

    def kept_words(texts: pa.Array) -> pa.Array:
        lists = pc.split_pattern(clean(texts).fill_null(""), pattern=" ")
        words, borders = lists.flatten(), lists.offsets.to_numpy()
        dropped = pc.or_(
            pc.is_in(words, value_set=pa.array(noise, words.type)),
            pc.is_in(pc.ascii_lower(words), value_set=pa.array(stop, words.type)),
        )
        kept = pc.invert(dropped)
        before = np.concatenate(([0], np.cumsum(kept.to_numpy(zero_copy_only=False))))
        ends = pa.array(before[borders - borders[0]], pa.int32())
        return pa.ListArray.from_arrays(ends, words.filter(kept), mask=texts.is_null())

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(texts: pa.Array) -> pa.Array:
        return by_parts(kept_words, texts)

    return cut(F.lower(text))
