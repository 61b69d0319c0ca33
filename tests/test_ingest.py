"""Raw CSV with every known flaw, through cleaning and the result tables."""

import pytest
from pyspark.sql import functions as F, types as T

from postgrove.plans import ingest, reports
from postgrove.schemas import CLEAN_POST, CONTRACTS, RAW_POST, TableContract
from postgrove.sources import files
from postgrove.sources.keyed import KeyedTable

HEADER = ",".join(RAW_POST.fieldNames())


def line(created="2020-10-15 08:30:00", tweet="hello", joined="2012-03-04 05:06:07",
         lat="36.0", lon="-120.0"):
    cells = [""] * 21
    cells[0], cells[2], cells[10], cells[13], cells[14] = created, tweet, joined, lat, lon
    return ",".join(cells)


@pytest.fixture
def archive(tmp_path):
    trump = [
        HEADER,
        line(tweet='"two\nlines, and a ""quote"" \\"'),
        line(lat=""),
        line(created=""),
        line(joined=""),
        line(created="no date"),
        line(created="2020-02-30 10:00:00"),
        line(lat="0.0"),
    ]
    (tmp_path / "hashtag_donaldtrump.csv").write_text("\n".join(trump) + "\n")
    biden = [HEADER, line(created="2020-11-01 23:59:59", lat="41.0", lon="-73.0")]
    (tmp_path / "hashtag_joebiden.csv").write_text("\n".join(biden) + "\n")
    (tmp_path / "other.csv").write_text("\n".join([HEADER, line(tweet="none")]) + "\n")
    return str(tmp_path)


def test_cleaning_raw_files(spark, archive):
    raw = files.read_csv(spark, archive, file_column="filename")
    rows = sorted(map(tuple, ingest.clean_posts(raw).collect()), key=str)
    assert ingest.clean_posts(raw).schema.simpleString() == CLEAN_POST.simpleString()
    two_lines = 'two\nlines, and a "quote" \\'
    assert rows == sorted(
        [
            ("2020-10-15", 5, 8, "Trump", 103.35887097, "California", two_lines),
            (None, None, None, "Trump", None, "California", "hello"),
            ("2020-11-01", 1, 23, "Biden", 103.92741935, "Connecticut", "hello"),
        ],
        key=str,
    )


def test_word_posts_keep_seconds_and_every_class(spark, archive):
    raw = files.read_csv(spark, archive, file_column="filename")
    rows = {r.tweet: r for r in ingest.word_posts(raw).where("timestamp is not null").collect()}
    assert rows["none"].candidate is None
    assert str(rows["none"].timestamp) == "2020-10-15 08:30:00"
    top = reports.top_words(ingest.word_posts(raw), "run").where("candidate = 'trump'")
    assert {r.word for r in top.collect()} == {"twolines", "quote", "hello"}


def test_csv_round_trip(spark, archive, tmp_path):
    clean = ingest.clean_posts(files.read_csv(spark, archive, file_column="filename"))
    files.write_csv(clean, str(tmp_path / "out"), cluster_by="state")
    back = files.read_csv(spark, str(tmp_path / "out"), CLEAN_POST)
    assert sorted(map(str, back.collect())) == sorted(map(str, clean.collect()))


def test_partitioned_parquet_prunes(spark, archive, tmp_path):
    clean = ingest.clean_posts(files.read_csv(spark, archive, file_column="filename"))
    files.write_parquet(clean, str(tmp_path / "p"), partition_by=("candidate",))
    back = files.read_parquet(spark, str(tmp_path / "p")).where("candidate = 'Biden'")
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(candidate" in back._jdf.queryExecution().toString()


def test_reports_total_is_the_sum_of_their_cells(spark):
    rows = [("2020-10-15", 1, 8, c, 1.0, s, "t", m, "English")
            for c in ("Trump", "Biden", "Other") for s in ("Ohio", "Iowa")
            for m in ("Positive", "Neutral", "Negative", None)]
    df = spark.createDataFrame(
        rows, "date string, dayofweek int, hour int, candidate string, online_age double, "
        "state string, tweet string, sentiment string, language string")
    for r in reports.state_sentiment_counts(df).collect():
        cells = r.asDict()
        assert cells["total"] == 6 == sum(v for k, v in cells.items() if k not in ("state", "total"))
    assert [tuple(r)[:4] for r in reports.state_counts(df).orderBy("state").collect()] == [
        ("Iowa", 4, 4, 8), ("Ohio", 4, 4, 8)]
    assert [tuple(r) for r in reports.hourly_counts(df).collect()] == [(8, 8, 8)]


CONTRACT = TableContract(
    T.StructType().add("k", T.StringType()).add("n", T.LongType()).add("note", T.StringType()), ("k",)
)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "note string, k string, n int")


def test_upsert_replaces_by_key_and_repeats_safely(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), CONTRACT)
    assert stored.read().collect() == [] and stored.read().schema == CONTRACT.schema
    stored.upsert(frame(spark, ("x", "a", 1), ("x", "b", 1)), 0)
    for _ in range(2):
        stored.upsert(frame(spark, (None, "b", 2), ("y", "c", 2)), 1)
    expected = [("a", 1, "x"), ("b", 2, None), ("c", 2, "y")]
    assert sorted(map(tuple, stored.read().collect())) == expected
    stored.upsert(frame(spark, ("old", "c", 9)), 0)  # an older version does not win
    assert ("c", 2, "y") in set(map(tuple, stored.read().collect()))


def test_upsert_refuses_a_null_key(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), CONTRACT)
    with pytest.raises(Exception, match="NULL in key column k"):
        stored.upsert(frame(spark, ("x", None, 1)), 0)
    with pytest.raises(ValueError):
        stored.upsert(frame(spark, ("x", "a", 1)), -1)


def test_contracts_accept_the_reports(spark, tmp_path):
    clean = spark.createDataFrame(
        [("2020-10-15", 5, 8, "Trump", 1.0, "Ohio", "good")], CLEAN_POST)
    enriched = clean.withColumns({"sentiment": F.lit("Positive"), "language": F.lit("English")})
    made = {
        "hour": reports.hourly_counts(clean),
        "state": reports.state_counts(clean),
        "language": reports.language_counts(enriched),
        "state_analyze": reports.state_sentiment_counts(enriched),
        "date_cumulative": reports.cumulative_by_language(enriched),
        "word_list": reports.top_words(clean, "b"),
    }
    assert set(made) == set(CONTRACTS)
    for name, df in made.items():
        assert set(df.columns) == set(CONTRACTS[name].schema.fieldNames()), name
        stored = KeyedTable(spark, str(tmp_path / name), CONTRACTS[name])
        stored.upsert(df, 0)
        stored.upsert(df, 1)
        assert stored.read().count() == df.count()


def test_versions_count_up_and_fold(spark, tmp_path):
    contract = TableContract(CONTRACT.schema, ("k",), ("k",))
    stored = KeyedTable(spark, str(tmp_path / "t"), contract)
    assert stored.upsert(frame(spark, ("x", "a", 1), ("x", None, 1))) == 0
    assert stored.upsert(frame(spark, ("y", "b", 2), ("y", None, 2))) == 1
    before = sorted(map(str, stored.read().collect()))
    stored.compact()
    stored.compact()
    assert sorted(map(str, stored.read().collect())) == before and len(before) == 3
    with pytest.raises(ValueError, match="already folded"):
        stored.upsert(frame(spark, ("z", "c", 3)), 1)
    assert stored.upsert(frame(spark, ("z", "b", 3))) == 2
    rows = {r.k: r.n for r in stored.read().collect()}
    assert rows == {"a": 1, "b": 3, None: 2}
    # Folded versions are not read again.
    read = {path for path in stored.read().inputFiles()}
    assert read and all("/base-1/" in path or "/version=2/" in path for path in read)
    # A base that was not finished is not used.
    (tmp_path / "t" / "base-2").mkdir()
    assert {r.k: r.n for r in stored.read().collect()} == rows


RAW_LINES = [
    ["2020-10-20 10:11:12", "1", "a, \"b\"", "1", "2", "web", "7", "n", "s", "d", "2010-01-01 00:00:00", "3", "l", "40", "-83"],
    ["2020-10-20 10:11:12", "2", "no place", "1", "2", "web", "7", "n", "s", "d", "2010-01-01 00:00:00", "3", "l", "", "-83"],
    ["soon", "3", "no time", "1", "2", "web", "7", "n", "s", "d", "2010-01-01 00:00:00", "3", "l", "40", "-83"],
    ["2020-10-20 10:11:12", "4", "no join time", "1", "2", "web", "7", "n", "s", "d", "", "3", "l", "40", "-83"],
    ["2020-10-20 10:11:12", "5", "at sea", "1", "2", "web", "7", "n", "s", "d", "2010-01-01 00:00:00", "3", "l", "0", "0"],
    ["2020-10-20 10:11:12", "6", "bad number", "1", "2", "web", "7", "n", "s", "d", "2010-01-01 00:00:00", "3", "l", "forty", "-83"],
]


def test_no_line_is_lost_between_kept_and_rejected(spark, tmp_path):
    import csv

    for label in ("donaldtrump", "unnamed"):
        with open(tmp_path / f"hashtag_{label}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\n")
            for line in RAW_LINES:
                writer.writerow(line + [""] * 6)
            file.write("too,few,cells\n" + ",".join(["x"] * 25) + "\n")
    raw = files.read_csv(
        spark, f"{tmp_path}/hashtag_*.csv", RAW_POST, header=False, file_column="filename", corrupt_column="bad"
    )
    counts = ingest.write_judged(raw, f"{tmp_path}/out", corrupt_column="bad")
    assert counts == {
        "lines": 16, "kept": 1, "malformed line": 6, "no place": 2, "no time": 2, "no join time": 2, "no region": 2,
        "no class": 1,
    }
    kept = ingest.read_kept(spark, f"{tmp_path}/out")
    plain = files.read_csv(spark, f"{tmp_path}/hashtag_*.csv", RAW_POST, header=False, file_column="filename")
    assert kept.columns == CLEAN_POST.names
    assert kept.collect() == [r for r in ingest.clean_posts(plain).collect() if r.tweet == 'a, "b"']
    rejected = ingest.read_rejected(spark, f"{tmp_path}/out").collect()
    assert len(rejected) == 15 and all(r.raw for r in rejected)
    texts = {r.reason: [x.raw for x in rejected if x.reason == r.reason] for r in rejected}
    assert any('"bad":"too,few,cells"' in x for x in texts["malformed line"])
    assert all('"tweet_id":"4"' in x for x in texts["no join time"])


def test_judged_posts_keep_what_the_filter_keeps(spark):
    from catalog import posts

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    raw = posts.raw_posts(docs)
    judged = ingest.judged_posts(raw)
    kept = judged.where("verdict = 'kept'").select(*CLEAN_POST.names)
    assert sorted(map(str, kept.collect())) == sorted(map(str, ingest.clean_posts(raw).collect()))
    assert judged.count() == docs.count()
