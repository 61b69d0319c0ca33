"""Rows with missing, repeated and clashing ids: each text counts for itself."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from postgrove.llm import language_vectors, minhash, mixing, stored

WORDS = "some words of a text that stand here one after the other to be twenty shingles and a few more of them at last"


def test_unlike_texts_of_one_id_each_have_their_links(spark):
    near = WORDS.rsplit(" ", 1)[0] + " end"
    rows = [(5, "an unlike text with words of its own and nothing else"), (5, WORDS), (6, near), (7, WORDS), (None, WORDS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(str, minhash.near_duplicates(docs).drop("n_shingles").collect()))
    assert got == sorted(
        str(row) for row in minhash.near_duplicates(docs).drop("n_shingles").collect()
    )
    found = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert found == Counter([(5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (None, None, True)])


def test_a_group_that_only_a_second_text_of_an_id_links(spark):
    near = WORDS.rsplit(" ", 1)[0] + " end"
    rows = [(5, WORDS), (5, "an unlike text with words of its own and nothing else"), (9, near), (3, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).where("doc_id <> 5").collect()} == {9: 5, 3: 3}


def test_the_pipeline_keeps_every_unlike_text(spark):
    near = WORDS.rsplit(" ", 1)[0] + " end"
    texts = [
        (5, "first text under the id five that is like no other text here"), (5, WORDS), (6, near), (None, WORDS),
        (None, "a text without an id that nothing is like"), (7, None), (7, None), (8, ""), (5, WORDS),
    ]
    docs = spark.createDataFrame([(*row, "en") for row in texts], "doc_id bigint, text string, row string").repartition(3)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(
        (*row, "en") for row in (texts[0], texts[2], texts[4], texts[5], texts[6], texts[7])
    )


@pytest.mark.parametrize("text", ["concat('ten words in a text a b c d ', id)", "'ten equal words in a text a b c d'"])
def test_rows_without_an_id_come_near_their_target(spark, text):
    docs = spark.range(3000).selectExpr(
        "cast(null as bigint) as doc_id", f"{text} as text", "case when id < 1000 then 'a' else 'b' end as source"
    ).repartition(5)
    plan = mixing.mix_plan(docs).groupBy("source_size", "target").sum("taken").collect()
    for row in plan:
        assert abs(row["sum(taken)"] - row.target) < 0.07 * row.target
    again = mixing.mix_plan(docs.repartition(3))
    assert sorted(map(str, again.collect())) == sorted(map(str, mixing.mix_plan(docs).collect()))
    mixed = mixing.mixed_documents(docs)
    assert mixed.count() * 10 == sum(row["sum(taken)"] for row in plan) and mixed.columns == docs.columns


def test_language_of_a_text_of_many_letters_needs_little_memory(spark):
    """Five megabytes of 5,000 different letters, whose trigrams are nearly all different."""
    import resource

    draw = np.random.default_rng(2)
    text = "".join(map(chr, 0x4E00 + draw.integers(0, 5000, 1_700_000)))
    profiles = language_vectors.Profiles(["x"], np.ones((1, 1024), np.float32) / 32)
    import pyarrow as pa

    class Shared:
        value = (profiles.names, profiles.vectors)

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    batch = pa.record_batch([pa.array([1]), pa.array([text])], names=["id", "text"])
    (found,) = language_vectors._scorer(Shared, 1024)(iter([batch]))
    assert found["lang_pred"].to_pylist() == ["x"]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000


@pytest.mark.parametrize("most", [1 << 28, 40_000, 64])
def test_a_filter_of_bits_never_misses_a_key(spark, monkeypatch, most):
    monkeypatch.setattr(stored, "MOST_BITS", most)
    keys = spark.sql("select explode(sequence(0, 30000, 7)) as k union all select null union all select -5")
    rows = spark.sql("select explode(sequence(-10, 30000)) as v, 'x' as k, 1 as _at union all select null, 'y', 2")
    marked = stored.maybe_among(rows, "v", keys, "found")
    assert marked.columns == ["v", "k", "_at", "found"]
    got = Counter(map(tuple, marked.select("v", "found").collect()))
    assert sum(got.values()) == rows.count() and got[(None, False)] == 1
    wanted = {-5, *range(0, 30001, 7)}
    assert all(found for v, found in got if v in wanted)
    if most == 1 << 28:
        assert sum(found for v, found in got if v not in wanted) < 1200
    assert not stored.maybe_among(rows, "v", keys.where("false"), "found").where("found").count()


def test_rows_are_parted_by_a_table_of_keys(spark):
    rows = spark.sql("select cast(v as int) as v, 'x' as _key from (select explode(sequence(1, 3000)) as v union all select null)")
    keys = spark.sql("select explode(sequence(0L, 3000L, 3L)) as k union all select null")
    inside, others = (sorted(map(str, part.collect())) for part in stored.parted(rows, "v", keys))
    assert inside == sorted(map(str, rows.where("v % 3 = 0").collect()))
    assert others == sorted(map(str, rows.where("v is null or v % 3 <> 0").collect()))
    assert [part.count() for part in stored.parted(rows, "v", keys.where("false"))] == [0, 3001]


def test_of_buckets_with_the_same_classes_the_lowest_number_stays(spark):
    """Ten keys of one class, so four bits hold a key's number; keys 17 and 35 hold the same classes."""
    rows = [(35, 1), (35, 2), (17, 1), (17, 2), (51, 1), (51, 2), (51, 3), (66, 4), (66, 5)]
    shared = spark.createDataFrame([(key, id, 1 if id < 4 else 4) for key, id in rows], "key bigint, id bigint, least bigint")
    left = minhash._unlike_buckets(shared, 2, 5, 1)
    assert sorted((r.key, r.id) for r in left.collect()) == [(17, 1), (17, 2), (51, 1), (51, 2), (51, 3), (66, 4), (66, 5)]
