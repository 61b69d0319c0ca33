"""Language and sentiment against plain Python on small texts."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postgrove.operators import language, sentiment
from postgrove.operators.language import LanguageModel, with_language

WORDS = {
    "en": "the and that with from this have which would there about people".split(),
    "de": "der und nicht auch schön über wird eine können große wir für".split(),
    "el": "και το να είναι για δεν που με από ΑΘΗΝΑ".split(),
}


def buckets_of(text, buckets):
    letters, space = [], True
    for char in text:
        lower = char.lower()[0] if char.isalpha() else None
        if lower:
            letters.append(ord(lower))
        elif not letters or letters[-1] != 32:
            letters.append(32)
    return [
        sum(c * f for c, f in zip(letters[i : i + 3], language.FACTORS)) % buckets
        for i in range(len(letters) - 2)
    ]


def train_by_hand(rows, buckets):
    counts, docs, letters = defaultdict(Counter), Counter(), defaultdict(set)
    for text, code in rows:
        if code is not None:
            docs[code] += 1
            counts[code].update(buckets_of(text or "", buckets))
            letters[code].update(letters_of(text))
    return counts, docs, letters


def letters_of(text):
    return [char.lower()[0] for char in text or "" if char.isalpha()]


def classify_by_hand(text, counts, docs, letters, buckets):
    found, own = buckets_of(text or "", buckets), letters_of(text)
    written = [
        code
        for code in sorted(docs)
        if own and sum(c in letters[code] for c in own) >= language.LETTER_SHARE * len(own)
    ]
    if not found or not written:
        return None
    def score(code):
        total = sum(counts[code].values()) + buckets
        prior = math.log((docs[code] + 1) / (sum(docs.values()) + len(docs)))
        return prior + sum(math.log((counts[code][b] + 1) / total) for b in found)
    return max(written, key=score)


def sample(seed, n):
    rng = random.Random(seed)
    gaps = [" ", ", ", ".\n", " 😀 ", " 12 ", "  ", "\t–\t"]
    rows = []
    for _ in range(n):
        code = rng.choice(list(WORDS))
        text = "".join(rng.choice(WORDS[code]) + rng.choice(gaps) for _ in range(rng.randint(1, 30)))
        rows.append((rng.choice(["", "!", "É"]) + text, code))
    return rows


EDGES = ["", None, "a", "ab", "the", "😀😀😀", "1 2 3", "漢字漢字", "x" * 50_000, "привет как дела",
         "the and ψψψψψψψψψψ", "𝒜𝒷𝒸 𐐀𐐁 the", "𐐀𐐁𐐂"]


@pytest.mark.parametrize("buckets", [1 << 16, 97])
def test_model_equals_plain_counting(spark, monkeypatch, buckets):
    rows = sample(1, 300) + [("", "en"), (None, "en"), ("unlabelled", None)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    counts, docs, letters = train_by_hand(rows, buckets)
    model = LanguageModel.fit(df, buckets=buckets)
    assert model.codes == sorted(docs)
    for code, row in zip(model.codes, model.counts):
        assert {i: int(n) for i, n in enumerate(row) if n} == dict(counts[code])
    asked = [text for text, _ in sample(2, 200)] + EDGES
    for slice_bytes in (1 << 20, 64):  # many slices give what one gives
        monkeypatch.setattr(language, "SLICE_BYTES", slice_bytes)
        scored = spark.createDataFrame([(t,) for t in asked], "text string").select(
            "text", model.code(F.col("text")).alias("code")
        )
        for row in scored.collect():
            assert row.code == classify_by_hand(row.text, counts, docs, letters, buckets), row.text


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) >= 20")
    model = LanguageModel.fit(docs.where("doc_id % 4 <> 0"))
    rest = docs.where("doc_id % 4 = 0").withColumn("code", model.code(F.col("text")))
    right, total = rest.agg(F.count_if(F.col("code") == F.col("lang")), F.count("*")).head()
    assert total > 200 and right / total > 0.97


def test_saved_model_and_names(spark, tmp_path):
    model = LanguageModel.fit(spark.createDataFrame(sample(3, 100), "text string, lang string"))
    model.save(str(tmp_path / "m"))
    loaded = LanguageModel.load(spark, str(tmp_path / "m"))
    df = spark.createDataFrame([("und nicht über",), ("漢字漢字",), (None,)], "tweet string")
    for made in (model, loaded):
        got = [r.language for r in with_language(df, made).collect()]
        assert got == ["German", "Unknown Language", "Unknown Language"]
    plan = with_language(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_languages_beyond_what_a_task_holds(spark, monkeypatch):
    df = spark.createDataFrame(sample(3, 200), "text string, lang string")
    whole = LanguageModel.fit(df)
    monkeypatch.setattr(language, "HELD_LANGUAGES", 1)
    parts = LanguageModel.fit(df.repartition(5))
    assert parts.codes == whole.codes and (parts.counts == whole.counts).all()
    with pytest.raises(ValueError):
        LanguageModel.fit(df.where("lang is null"))


def test_scripts_never_trained_have_no_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = LanguageModel.fit(docs)
    other = ["Καλημέρα σε όλους τους φίλους", "Доброе утро, как дела", "おはようございます世界", "صباح الخير يا عالم"]
    df = spark.createDataFrame([(x,) for x in other], "tweet string")
    assert {r.language for r in with_language(df, model).collect()} == {"Unknown Language"}


def test_filters_on_other_columns_reach_the_scan(spark, tmp_path):
    rows = [("the and that", "web", "en"), ("und nicht", "app", "de")]
    spark.createDataFrame(rows, "tweet string, source string, lang string").write.parquet(f"{tmp_path}/t")
    posts = spark.read.parquet(f"{tmp_path}/t")
    model = LanguageModel.fit(posts, "tweet")
    for made in (with_language(posts, model), sentiment.with_sentiment(posts)):
        plan = made.where("source = 'web'")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(source,web)" in plan.split("PushedFilters")[1]


def test_enrichment_evaluates_each_model_once(spark):
    from postgrove.plans import enrich
    from postgrove.schemas import CLEAN_POST

    model = LanguageModel.fit(spark.createDataFrame(sample(3, 50), "text string, lang string"))
    posts = enrich.enriched_posts(spark.createDataFrame([], CLEAN_POST), model)
    kept = posts.where("language = 'German' and sentiment = 'Neutral'")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("EvalPython") == 2


def polarity_by_hand(text, lexicon, negation):
    if text is None:
        return None
    import regex

    words = regex.split(r"[^\p{L}']+", text.lower())
    total = hits = 0
    for before, word in zip([""] + words, words):
        if word in lexicon:
            turned = negation and (before in sentiment.NEGATORS or before.endswith("n't"))
            total += round(lexicon[word] * 10**9) * (-1 if turned else 2)
            hits += 1
    return total / (2 * 10**9 * hits) if hits else 0.0


@pytest.mark.parametrize("negation", [True, False])
def test_polarity_equals_plain_python(spark, negation):
    rng = random.Random(7)
    lexicon = {"good": 0.7, "bad": -0.7, "fine": 0.1, "meh": -0.1, "ok": 0.2, "grün": 0.3, "zero": 0.0,
               "faint": 0.0004, "tiny": -0.00001}
    pool = list(lexicon) + ["not", "isn't", "never", "the", "GOOD", "Grün", "don't", "goods"]
    texts = ["", None, "not", "good", "not good", "good bad", "Not. Bad!", "fine ok meh meh meh meh",
             "'good", "no\nfine"]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", ", ", "!", "\n", "1"]) for _ in range(n))
              for n in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    got = df.select("t", sentiment.polarity(F.col("t"), lexicon, negation).alias("p"))
    for row in got.collect():
        assert row.p == polarity_by_hand(row.t, lexicon, negation), row.t
    words = spark.createDataFrame([*lexicon.items(), ("good", 0.1), (None, 1.0)], "word string, polarity double")
    joined = sentiment.joined_polarity(df, "t", words, "p", negation)
    assert joined.columns == ["t", "p"] and joined.count() == len(texts)
    for row in joined.collect():
        assert row.p == polarity_by_hand(row.t, lexicon, negation), row.t


def test_sentiment_labels(spark):
    df = spark.createDataFrame(
        [("what a great day",), ("the worst",), ("a table",), ("good bad",), (None,)], "tweet string"
    )
    got = [r.sentiment for r in sentiment.with_sentiment(df).collect()]
    assert got == ["Positive", "Negative", "Neutral", "Neutral", None]


def test_a_lexicon_table_of_any_size(spark, monkeypatch):
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    words = spark.range(150_000).select(letters.alias("word"), (F.col("id") / 1e6).alias("polarity"))
    df = spark.createDataFrame([("bcd and zzz",), ("not beeeee",), (None,), ("zz",)], "t string")
    expected = [0.000123, -0.5 * 0.144444, None, 0.0]
    for most in (1_000_000, 10):
        monkeypatch.setattr(sentiment, "MAX_BROADCAST_WORDS", most)
        got = {r.t: r.p for r in sentiment.with_polarity(df, "t", "p", words).collect()}
        assert [got[r.t] for r in df.collect()] == expected
    label = sentiment.with_sentiment(df, "t", lexicon={"bcd": 0.0004}).head().sentiment
    assert label == "Positive"
