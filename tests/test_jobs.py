"""The jobs from raw files to reports, model and answers, as a user runs them."""

import json

import pytest

from postgrove import __main__ as jobs
from postgrove.schemas import CONTRACTS, RAW_POST
from postgrove.sources.keyed import KeyedTable

TEXTS = {
    "en": ["what a great day, the best people are here", "the worst debate and that is so sad"],
    "de": ["das ist nicht gut und auch schön für alle", "wir können eine große wahl haben"],
}


@pytest.fixture
def archive(tmp_path):
    (tmp_path / "archive").mkdir()
    for name, shift in (("donaldtrump", 0), ("joebiden", 1)):
        lines = [",".join(RAW_POST.fieldNames())]
        for i in range(120):
            cells = [""] * 21
            cells[0] = f"2020-10-{15 + i % 15} {(i * 7 + shift) % 24:02}:10:00"
            cells[2] = '"' + TEXTS["en" if i % 3 else "de"][i % 2] + '\n""quoted"""'
            cells[10] = "2012-01-01 00:00:00"
            cells[13], cells[14] = str(26 + i % 20), str(-120 + i % 40)
            lines.append(",".join(cells))
        (tmp_path / "archive" / f"hashtag_{name}.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


def test_raw_files_to_answers(spark, archive, capsys):
    def run(*argv):
        jobs.main([str(part) for part in argv])

    labelled = [(text, code) for code, texts in TEXTS.items() for text in texts]
    spark.createDataFrame(labelled, "text string, lang string").write.parquet(f"{archive}/labelled")
    run("ingest", "--input", archive / "archive", "--output", archive / "clean")
    run("train-language", "--input", archive / "labelled", "--output", archive / "languages")
    run("enrich", "--input", archive / "clean", "--model", archive / "languages",
        "--output", archive / "enriched")
    clean = spark.read.parquet(f"{archive}/clean")
    enriched = spark.read.parquet(f"{archive}/enriched")
    assert clean.count() == enriched.count() > 50
    assert {r.language for r in enriched.select("language").distinct().collect()} == {"English", "German"}

    for table, (read, _) in jobs.REPORTS.items():
        source = {jobs.raw_posts: "archive", jobs.clean: "clean", jobs.enriched: "enriched"}[read]
        for _ in range(2):
            run("report", table, "--input", archive / source, "--output", archive / table)
        run("compact", table, "--output", archive / table)
        stored = KeyedTable(spark, f"{archive}/{table}", CONTRACTS[table]).read()
        assert stored.count() > 0 and stored.count() == stored.dropDuplicates(CONTRACTS[table].keys).count()
    hour = KeyedTable(spark, f"{archive}/hour", CONTRACTS["hour"]).read()
    assert sum(r.trump + r.biden for r in hour.collect()) == clean.count()
    run("report", "hour", "--input", archive / "clean", "--format", "json",
        "--option", f"path={archive}/hour_json")
    assert spark.read.json(f"{archive}/hour_json").count() == hour.count()

    run("train", "--input", archive / "enriched", "--output", archive / "model", "--seed", 1)
    assert "rows skipped for a missing number: 0" in capsys.readouterr().out
    run("score", "--input", archive / "enriched", "--model", archive / "model",
        "--output", archive / "scored")
    assert spark.read.parquet(f"{archive}/scored").count() == enriched.count()

    (archive / "in").mkdir()
    request = {"uuid": "u", "hour": 3, "dayofweek": 1, "online_age": 100.5, "candidate": "Trump",
               "language": "English"}
    (archive / "in" / "1.txt").write_text(json.dumps(request) + "\nbroken\n")
    run("serve", "--model", archive / "model", "--checkpoint", archive / "checkpoint",
        "--dead-letters", archive / "dead", "--source", "text",
        "--source-option", f"path={archive}/in", "--sink", "text", "--answers", archive / "out", "--once")
    (answer,) = spark.read.text(f"{archive}/out").collect()
    assert json.loads(answer.value)["uuid"] == "u"
    assert spark.read.text(f"{archive}/dead").count() == 1


def test_runs_add_up_and_an_impossible_date_is_kept(spark, archive):
    def run(*argv):
        jobs.main([str(part) for part in argv])

    def report(clean):
        run("report", "hour", "--input", clean, "--output", archive / "hour")
        return {r.hour: r for r in KeyedTable(spark, f"{archive}/hour", CONTRACTS["hour"]).read().collect()}

    file = archive / "archive" / "hashtag_donaldtrump.csv"
    rows = [""] * 21
    rows[0], rows[10], rows[13], rows[14] = "2020-02-30 10:00:00", "2012-01-01 00:00:00", "40", "-100"
    rows[2], rows[7] = "text", 'a 5" pipe'
    file.write_text(file.read_text() + ",".join(rows) + "\n")
    run("ingest", "--input", archive / "archive", "--output", archive / "clean")
    clean = spark.read.parquet(f"{archive}/clean")
    hours = [r.hour for r in clean.select("hour").distinct().collect()]
    assert clean.where("hour is null").count() == 1
    clean.where("hour < 12").write.parquet(f"{archive}/am")
    clean.where("hour >= 12 or hour is null").write.parquet(f"{archive}/pm")
    report(archive / "am")
    found = report(archive / "pm")
    # Two runs with different keys: both remain, and the hour of no date is one of them.
    assert set(found) == set(hours) and found[None].trump == 1
    assert sum(r.trump + r.biden for r in found.values()) == clean.count()


def test_flags_of_jobs(spark, archive):
    def run(*argv):
        jobs.main([str(part) for part in argv])

    words = [("great", 0.5), ("worst", -0.00001)]
    spark.createDataFrame(words, "word string, polarity double").write.option("header", True).csv(f"{archive}/lexicon")
    labelled = [(text, code) for code, texts in TEXTS.items() for text in texts]
    spark.createDataFrame(labelled, "text string, lang string").write.parquet(f"{archive}/labelled")
    run("ingest", "--input", archive / "archive", "--output", archive / "clean", "--boxes", "corrected",
        "--tie-break", "smallest_area")
    run("train-language", "--input", archive / "labelled", "--output", archive / "languages")
    run("enrich", "--input", archive / "clean", "--model", archive / "languages", "--output",
        archive / "enriched", "--lexicon", archive / "lexicon", "--lexicon-format", "csv")
    rows = spark.read.parquet(f"{archive}/enriched").select("tweet", "sentiment").distinct().collect()
    label = {"great": "Positive", "worst": "Negative"}
    for row in rows:
        assert row.sentiment == next((v for k, v in label.items() if k in row.tweet), "Neutral")
    run("report", "date_cumulative", "--input", archive / "enriched", "--output", archive / "days",
        "--start", "2020-10-20", "--end", "2020-10-21")
    days = KeyedTable(spark, f"{archive}/days", CONTRACTS["date_cumulative"]).read()
    assert {r.date for r in days.collect()} == {"2020-10-20", "2020-10-21"}
    (archive / "stop.txt").write_text("great\nday\n")
    run("report", "word_list", "--input", archive / "archive", "--output", archive / "words", "--k", 2,
        "--stop-words", archive / "stop.txt", "--full-mentions")
    words = KeyedTable(spark, f"{archive}/words", CONTRACTS["word_list"]).read().collect()
    assert words and not {"great", "day"} & {r.word for r in words}
    per_group = {}
    for row in words:
        per_group[row.candidate, row.state] = per_group.get((row.candidate, row.state), 0) + 1
    assert max(per_group.values()) == 2
