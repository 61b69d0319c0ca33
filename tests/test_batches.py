"""Work on the texts of a batch is done a bounded piece at a time."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from postgrove.functions import batches, text
from postgrove.operators import heavy, language, lexicon, sentiment

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_pieces_hold_few_bytes_and_all_rows():
    texts = pa.array(["ab", None, "", "x" * 50, "é", "c", None]).slice(1)
    seen = []

    def work(part):
        seen.append(pc.sum(pc.fill_null(pc.binary_length(part), 0)).as_py())
        return pc.utf8_upper(part)

    assert batches.by_parts(work, texts, limit=4).to_pylist() == [None, "", "X" * 50, "É", "C", None]
    assert seen == [0, 50, 3]
    assert batches.by_parts(work, texts.slice(0, 0)).to_pylist() == []


def test_text_columns_ask_for_small_batches(spark):
    docs = spark.createDataFrame([("the word of words", "en")], "text string, lang string")
    words = text.tokens(F.col("text"))
    uses = {
        "tokens": lambda: text.tokens(F.col("text")),
        "clean": lambda: text.clean_text(F.col("text")),
        "polarity": lambda: sentiment.polarity(F.col("text")),
        "language": lambda: language.bucket_counts(docs, "text", "lang"),
        "heavy": lambda: heavy.frequent_terms(docs, ["lang"], words),
        "lexicon": lambda: lexicon.neighbours(docs),
    }
    kept = spark.conf.get(NAME)
    for name, use in uses.items():
        spark.conf.set(NAME, str(1 << 30))
        use()
        assert spark.conf.get(NAME) == str(batches.BATCH_BYTES), name
    spark.conf.set(NAME, kept)


def test_rows_of_several_pieces_are_those_of_one(spark):
    rows = [(i, None if i % 7 == 0 else f"the good Word{i % 5} is not good & bad; " * (i % 9 * 2000)) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    made = df.select(
        "i", "t", text.clean_text(F.col("t")).alias("c"), text.tokens(F.col("t")).alias("w"),
        sentiment.polarity(F.col("t"), {"good": 0.5, "bad": -1.0}).alias("p"),
    )
    for row in made.collect():
        if row.t is None:
            assert (row.c, row.w, row.p) == (None, None, None)
        else:
            n = row.i % 9 * 2000
            assert row.w == ["good", "good", "bad"] * n and row.c.split() == "the good is not good bad".split() * n
            assert abs(row.p - (-0.25 if n else 0.0)) < 1e-9
