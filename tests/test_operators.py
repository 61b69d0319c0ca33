import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from postgrove.dimensions import LANGUAGE_NAMES
from postgrove.functions import labels, timefeat
from postgrove.operators import lookup, pivot, series, terms


def test_pivot_counts_listed_values_only_and_keeps_null_groups(spark):
    rows = [("a", "x", 1), ("a", "y", 1), ("a", None, 1), ("a", "z", 2), (None, "x", 2), ("b", "z", 1)]
    df = spark.createDataFrame(rows, "k string, c string, s int")
    got = {
        r.k: r.asDict()
        for r in pivot.conditional_pivot(df, ["k"], {"c": ["x", "y"], "s": [1, 2]}, "total").collect()
    }
    assert got["a"] == {"k": "a", "x1": 1, "x2": 0, "y1": 1, "y2": 0, "total": 2}
    assert got[None]["x2"] == 1 and got["b"]["total"] == 0


def test_largest_first_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, n int")
    assert [r.k for r in pivot.largest_first(df, "n", "k").collect()] == ["c", "a", "b"]


def test_cumulative_counts_every_day_of_the_span(spark):
    rng = random.Random(3)
    rows = [
        (f"2020-10-{rng.randint(10, 31)}", rng.choice("ab"), rng.choice(["t", None]))
        for _ in range(500)
    ] + [("2020-10-01", "late", "t"), ("2020-10-16", None, "t")]
    df = spark.createDataFrame(rows, "date string, language string, tweet string")
    got = {
        (r.language, r.date): r.cumulative
        for r in series.cumulative_by_day(df, "language", "2020-10-15", "2020-11-08", "tweet").collect()
    }
    days = [f"2020-10-{d}" for d in range(15, 32)] + [f"2020-11-{d:02}" for d in range(1, 9)]
    assert len(days) == 25 and len(got) == 25 * 4
    for key in ("a", "b", "late", None):
        running = 0
        for day in days:
            if key is not None:
                running += sum(r[0] == day and r[1] == key and r[2] is not None for r in rows)
            assert got[key, day] == running


def test_cumulative_equals_grid_join_and_window(spark):
    rng = random.Random(4)
    rows = [(f"2020-10-{rng.randint(10, 31)}", rng.randint(0, 40), 1) for _ in range(2000)]
    df = spark.createDataFrame(rows, "date string, key int, one int")
    one_pass = series.cumulative_by_day(df, "key", "2020-10-12", "2020-10-20", "one")
    grid = series.day_grid(series.distinct_keys(df, "key"), "2020-10-12", "2020-10-20")
    filled = series.fill_missing(
        grid, series.count_nonnull(df, ["date", "key"], "one"), ["date", "key"], "count"
    )
    joined = series.running_total(filled, ["key"], "date", "count", "cumulative").select(*one_pass.columns)
    assert sorted(one_pass.collect()) == sorted(joined.collect())


def test_cumulative_needs_no_join_and_two_shuffles(spark):
    df = spark.createDataFrame([("2020-10-15", "a", "t")], "date string, language string, tweet string")
    plan = series.cumulative_by_day(df, "language", "2020-10-15", "2020-10-20", "tweet")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 2


def top_by_hand(counts, k):
    groups = defaultdict(list)
    for key, word, n in counts:
        groups[key].append((-n, word))
    return {(key, word, -n) for key, rows in groups.items() for n, word in sorted(rows)[:k]}


def test_top_terms_with_ties_and_a_hot_group(spark, monkeypatch):
    rng = random.Random(9)
    counts = [("hot", f"w{i}", rng.randint(1, 5)) for i in range(800)]
    counts += [("cold", f"w{i}", 1) for i in range(7)]
    df = spark.createDataFrame(counts, "state string, word string, count bigint")
    for k in (3, 50):
        expected = top_by_hand(counts, k)
        assert set(map(tuple, terms.top_terms(df, ["state"], k).collect())) == expected
        with monkeypatch.context() as patched:  # the way for large k
            patched.setattr(terms, "SPARK_GROUP_LIMIT", 2)
            assert set(map(tuple, terms.top_terms(df, ["state"], k).collect())) == expected


def test_top_terms_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "w", 1)], "state string, word string, count bigint")
    plan = terms.top_terms(df, ["state"], 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_union_tagged(spark):
    parts = {name: spark.createDataFrame([(i,)], "n int") for i, name in enumerate("ab")}
    assert Counter(map(tuple, terms.union_tagged(parts, "tag").collect())) == Counter([(0, "a"), (1, "b")])


def test_code_lookup_defaults(spark, monkeypatch):
    df = spark.createDataFrame([("en",), ("xx",), (None,)], "code string")
    expected = [("en", "English"), ("xx", "?"), (None, "?")]
    assert list(map(tuple, lookup.code_lookup(df, "code", LANGUAGE_NAMES, "name", "?").collect())) == expected
    monkeypatch.setattr(lookup, "MAX_BROADCAST_CODES", 1)
    got = lookup.code_lookup(df, "code", LANGUAGE_NAMES, "name", "?").collect()
    assert set(map(tuple, got)) == set(expected)


def test_datetime_extraction(spark):
    texts = [
        "2020-10-15 08:30:59", "on 2020-10-15 08:30:59.000+00", "2020-10-15", "none", None,
        "2020-02-30 10:00:00", "x 2020-10-15 08", "2020-10-15 25:00:00",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hour = timefeat.extract_datetime(F.col("t"), "hour")
    second = timefeat.extract_datetime(F.col("t"), "second")
    rows = df.select(hour, second, timefeat.parse_datetime(hour).cast("string")).collect()
    assert [r[0] for r in rows] == [
        "2020-10-15 08", "2020-10-15 08", None, None, None, "2020-02-30 10", "2020-10-15 08", "2020-10-15 25",
    ]
    assert [r[1] for r in rows][:2] == ["2020-10-15 08:30:59"] * 2 and rows[6][1] is None
    assert [r[2] for r in rows] == [
        "2020-10-15 08:00:00", "2020-10-15 08:00:00", None, None, None, None, "2020-10-15 08:00:00", None,
    ]


def test_file_rules_first_match_wins(spark):
    names = ["x/hashtag_donaldtrump.csv", "joebiden", "donaldtrump_joebiden", "other", None]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r[0] for r in df.select(labels.label_by_substring(F.col("f"))).collect()]
    assert got == ["Trump", "Biden", "Trump", None, None]


def test_row_ids_tell_rows_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), ("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    ids = df.select(labels.row_uuid(F.col("x"), F.col("y")).alias("id"))
    first, second = ids.collect(), ids.collect()
    assert first == second and len({r.id for r in first}) == len(rows)


def test_sign_labels(spark):
    df = spark.createDataFrame([(0.1,), (0.0,), (-0.2,), (None,)], "s double")
    got = [r[0] for r in df.select(labels.sign_label(F.col("s"))).collect()]
    assert got == ["Positive", "Neutral", "Negative", None]
