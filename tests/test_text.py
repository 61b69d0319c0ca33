"""Cleaning against a chain of Python patterns, one per step of the specification."""

import html
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from postgrove.dimensions import STOP_WORDS
from postgrove.functions import text

# The patterns of the specification, a step each.
STEPS = [
    (r"https://t.co\S+", " "),
    (":", ""),
    ("‚Ä¶", ""),
    ("@[A-Za-z0–9]+", ""),
    ("#", ""),
    (r"[^\x00-\x7F]+", " "),
    (r"\[.*?\]", ""),
    (r"www\.", ""),
    (r"<.*?>+", ""),
    ("\n", ""),
    (r"\w*\d\w*", ""),
    (r"\bcom\b", ""),
    ("https", ""),
    ("http", ""),
    ("#", ""),
    (r"RT[\s]+", ""),
    (r"[^\w]", " "),
    (r"\b[a-zA-Z]\b", ""),
] + [(rf"\b{word}\b", "") for word in text.NOISE_WORDS]


def python_clean(value):
    value = html.unescape(value.lower())
    for pattern, by in STEPS:
        value = re.sub(pattern, by, value)
    return value


def python_tokens(value):
    stop = set(STOP_WORDS)
    return [w for w in python_clean(value).split(" ") if w.lower() not in stop and w != ""]


PIECES = st.sampled_from(
    [
        "https://t.co/Ab1", "https://t.co/x y", "https://t\nco/z", "https://t.co　q",
        "https", "http", "hthttpsttp", "www.", "com", ".com", "x1.com", "comx", "@user", "@u_1",
        "@a–9b", "#tag", "##", ":", "‚Ä¶", "‚:Ä¶", "&amp;", "&#82;&#84; a", "&lt;b&gt;", "&copy",
        "&notit;", "&#x41;", "&", "[a]", "[", "]", "[x\ny]", "<p>", "<a\nb>", "<<i>>>", "<", ">",
        "abc1d", "1", "_", "_2", "a", "I", "Trump", "biden", "don't", "will", "trump_", "the",
        "É", "ß", "Σς", "İ", "😀", " ", "　", "\x1c", "\x1f", "\t", "\n", " ", "  ",
        "RT ", "word", "-", "'", "\"", "\\", "$1", "{}", "|", "\r", "\x0b", "\x85", " ",
    ]
)
TEXTS = st.lists(PIECES, max_size=12).map("".join)


@settings(
    max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)
@given(st.lists(TEXTS, min_size=150, max_size=200))
def test_cleaning_equals_the_python_chain(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "tweet string").select(
        "tweet",
        text.clean_text(F.col("tweet")).alias("cleaned"),
        text.tokens(F.col("tweet")).alias("tokens"),
    )
    for row in df.collect():
        assert row.cleaned == python_clean(row.tweet), repr(row.tweet)
        assert row.tokens == python_tokens(row.tweet), repr(row.tweet)


def test_null_text_gives_nothing(spark):
    df = spark.createDataFrame([(None,)], "tweet string")
    assert df.select(text.clean_text(F.col("tweet"))).head()[0] is None
    assert df.select(text.tokens(F.col("tweet"))).head()[0] is None
    assert df.select(F.explode(text.tokens(F.col("tweet")))).count() == 0


def test_full_mentions_take_digits_and_underscores(spark):
    df = spark.createDataFrame([("hi @ann_x bob",)], "tweet string")
    kept = text.tokens(F.col("tweet"))
    whole = text.tokens(F.col("tweet"), full_mentions=True)
    row = df.select(kept.alias("kept"), whole.alias("whole")).head()
    assert row.kept == ["hi", "_x", "bob"] and row.whole == ["hi", "bob"]


@pytest.mark.parametrize("value", ["a &amp; b", "&AMP;", "&nbsp;x", "&#128512;", "&#x1F600", "&bogus;"])
def test_entities(spark, value):
    df = spark.createDataFrame([(value,), ("plain",)], "t string")
    got = [r[0] for r in df.select(text.decode_entities(F.col("t"))).collect()]
    assert got == [html.unescape(value), "plain"]
