"""One query per operator, on the tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from catalog import posts
from postgrove.dimensions import LANGUAGE_NAMES, UNKNOWN_LANGUAGE
from postgrove.functions import codec, labels, text, timefeat
from postgrove.operators import cover, geo, heavy, language, lexicon, lookup, pivot, sentiment, series, terms
from postgrove.plans import enrich, increments, ingest, reports, training
from postgrove.schemas import ANSWERS, CLEAN_POST, CONTRACTS, ENRICHED_POST, RAW_POST, TableContract
from postgrove.session import shared_folder
from postgrove.sources import files, layout
from postgrove.sources.keyed import KeyedTable
from postgrove.sources.messages import KeyedSink, Sink, read_messages
from postgrove.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_WEIGHTS = {"click": 2, "error": 0, "purchase": 10, "signup": 5}
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-31"
AGE_DATE = "2001-03-31 12:30:15"
# Letters of the test tables, and Greek and Cyrillic ones in their place.
OTHER_SCRIPT = (
    "abcdefghijklmnopqrstuvwxyzàáâäçèéêëíîïñóôöùúûüß",
    "αβγδεζηθικλμνξοπρστυφχψωабвгдежзийклмнопрстуфхцчшщ",
)
FILE_RULES = (("documents.parquet", "text"), ("labels.parquet", "label"))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work that is heavy per row."""
    return files.spread(table(spark, sf_dir, name).select(*columns))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        timefeat.date_text(F.col("ts")).alias("date"), "event_type", "user_id"
    )


# --- aggregations and pivots -------------------------------------------------


@query
def pivot_1d(spark, sf_dir):
    hours = table(spark, sf_dir, "events").select(F.hour("ts").alias("hour"), "event_type")
    return pivot.conditional_pivot(hours, ["hour"], {"event_type": EVENT_TYPES}).orderBy("hour")


@query
def pivot_2d(spark, sf_dir):
    rated = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    counted = pivot.conditional_pivot(
        rated,
        ["lang"],
        {"quality": (0, 1), "toxic": (0, 1)},
        total="total",
        name=lambda values: "quality{}_toxic{}".format(*values),
    )
    return pivot.largest_first(counted, "total", "lang")


@query
def pivot_total(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return pivot.conditional_pivot(
        orders,
        ["c_mktsegment"],
        {"o_orderstatus": ("F", "O", "P")},
        total="total",
        name=lambda values: f"status_{values[0].lower()}",
    )


@query
def group_count_nonnull(spark, sf_dir):
    rated = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return series.count_nonnull(rated, ["lang", "source"], "quality", "rated")


@query
def distinct_keys(spark, sf_dir):
    return series.distinct_keys(table(spark, sf_dir, "events"), "event_type", "user_id")


# --- series ------------------------------------------------------------------


@query
def spine_running_sum(spark, sf_dir):
    return series.cumulative_by_day(
        daily_events(spark, sf_dir), "event_type", FIRST_DAY, LAST_DAY, "user_id"
    )


@query
def date_key_grid(spark, sf_dir):
    users = series.distinct_keys(table(spark, sf_dir, "events"), "user_id")
    return series.day_grid(users, FIRST_DAY, LAST_DAY)


@query
def left_fill(spark, sf_dir):
    counts = series.count_nonnull(daily_events(spark, sf_dir), ["date", "user_id"], "event_type")
    return series.fill_missing(
        date_key_grid(spark, sf_dir), counts, ["date", "user_id"], "count"
    )


@query
def running_total(spark, sf_dir):
    filled = left_fill(spark, sf_dir)
    return series.running_total(filled, ["user_id"], "date", "count", "cumulative")


# --- scalar functions --------------------------------------------------------


@query
def time_features(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        timefeat.date_text(F.col("ts")).alias("date"),
        F.dayofweek("ts").alias("dayofweek"),
        F.hour("ts").alias("hour"),
    )


@query
def extract_datetime(spark, sf_dir):
    # Every seventh text has no time of day, every eleventh is an impossible date.
    key = F.col("o_orderkey")
    moment = F.col("o_orderdate").cast("string")
    written = (
        F.when(key % 7 == 0, F.substring(moment, 1, 10))
        .when(key % 11 == 0, F.lit("ordered 1995-02-30 10:00:00"))
        .otherwise(F.concat(F.lit("ordered "), moment, F.lit(" UTC")))
    )
    found = {p: timefeat.extract_datetime(written, p) for p in ("hour", "second")}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        found["hour"].alias("hour_text"),
        found["second"].alias("second_text"),
        timefeat.parse_datetime(found["hour"]).alias("hour_time"),
        timefeat.parse_datetime(found["second"]).alias("second_time"),
    )


@query
def age_months(spark, sf_dir):
    since = F.lit(AGE_DATE).cast(T.TimestampNTZType())
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", timefeat.age_months(F.col("o_orderdate"), since).alias("online_age")
    )


@query
def safe_cast(spark, sf_dir):
    # Values like "12x" are no numbers.
    written = F.concat(
        F.col("user_id").cast("string"), F.when(F.col("event_id") % 7 == 0, "x").otherwise("")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", (written.try_cast("int") + 1).alias("next_user")
    )


@query
def json_codec(spark, sf_dir):
    props = codec.decode_json(F.col("props"), T.StructType().add("k", T.IntegerType()))
    return (
        table(spark, sf_dir, "events")
        .select("event_id", props["k"].alias("k"))
        .select("event_id", "k", codec.encode_json("event_id", "k").alias("message"))
    )


@query
def row_id(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        labels.row_digest(F.col("event_id"), F.col("event_type"), F.col("props")).alias("digest"),
        labels.row_uuid(F.col("event_id"), F.col("event_type")).alias("id"),
    )


@query
def random_id(spark, sf_dir):
    """Random ids differ between runs; what can be checked is shape and uniqueness."""
    ids = table(spark, sf_dir, "events").select(labels.random_uuid().alias("id"))
    shaped = F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return ids.groupBy("id").agg(F.count("*").alias("n"), F.max(shaped).alias("ok")).agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") == 1).alias("unique_ids"),
        F.count_if(F.col("ok")).alias("shaped_ids"),
    )


# --- lookups -----------------------------------------------------------------


@query
def box_match(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select(
        "c_custkey", *posts.place(F.col("c_custkey"))
    )
    return geo.box_match(points).select("c_custkey", "state")


@query
def box_match_smallest(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select(
        "c_custkey", *posts.place(F.col("c_custkey"))
    )
    return geo.box_match(points, tie_break="smallest_area").select("c_custkey", "state")


@query
def box_cover(spark, sf_dir):
    """Points among 3,000 overlapping boxes, many nested around one place and some with equal edges."""
    points = table(spark, sf_dir, "customer").select("c_custkey", *posts.place(F.col("c_custkey")))
    return cover.cover_match(points, posts.many_boxes()).select("c_custkey", "state")


@query
def code_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit("xx")).otherwise(F.col("lang")).alias("code")
    )
    return lookup.code_lookup(docs, "code", LANGUAGE_NAMES, "language", UNKNOWN_LANGUAGE)


@query
def file_label(spark, sf_dir):
    paths = [f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet"]
    rows = spark.read.schema("doc_id bigint").parquet(*paths)
    named = files.with_file_path(rows, "filename")
    return named.select(
        "doc_id", labels.label_by_substring(F.col("filename"), FILE_RULES, "other").alias("label")
    )


@query
def inline_relation(spark, sf_dir):
    weights = spark.createDataFrame(list(EVENT_WEIGHTS.items()), "event_type string, weight int")
    return (
        table(spark, sf_dir, "events")
        .join(F.broadcast(weights), "event_type")
        .groupBy("user_id")
        .agg(F.sum("weight").alias("score"))
    )


# --- text --------------------------------------------------------------------


@query
def text_clean(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", text.clean_text(F.col("text")).alias("cleaned")
    )


@query
def entity_decode(spark, sf_dir):
    return texts(spark, sf_dir, "pages", "page_id", "html").select(
        "page_id", text.decode_entities(F.lower("html")).alias("decoded")
    )


@query
def tokens(spark, sf_dir):
    return texts(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        "conv_id",
        "turn",
        F.array_join(text.tokens(F.col("text")), "|").alias("tokens"),
    )


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents", "lang", "source", "text")
    return terms.explode_terms(docs, ["lang", "source"], F.col("text"))


@query
def explode_terms(spark, sf_dir):
    """Rows per document after the explode, rather than the rows themselves."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    words = terms.explode_terms(docs, ["doc_id"], F.col("text"))
    return words.groupBy("doc_id").agg(
        F.count("*").alias("words"), F.sum(F.length("word")).alias("letters")
    )


@query
def term_count(spark, sf_dir):
    return terms.term_counts(document_terms(spark, sf_dir), ["lang"])


@query
def topk_terms(spark, sf_dir):
    counts = terms.term_counts(document_terms(spark, sf_dir), ["lang", "source"])
    return terms.top_terms(counts, ["lang", "source"])


@query
def union_tagged(spark, sf_dir):
    counted = {}
    for origin, name in (("document", "documents"), ("conversation", "conversations")):
        words = terms.explode_terms(texts(spark, sf_dir, name, "text"), [], F.col("text"))
        counted[origin] = terms.term_counts(words, [])
    return terms.union_tagged(counted, "origin")


# --- enrichment --------------------------------------------------------------


@query
def sentiment_label(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    scored = docs.select("doc_id", sentiment.polarity(F.col("text"), posts.LEXICON).alias("score"))
    return scored.select(
        "doc_id",
        F.round("score", 9).alias("polarity"),
        labels.sign_label(F.col("score")).alias("sentiment"),
    )


@query
def language_id(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language.with_language(docs, language.LanguageModel.fit(docs), text="text")
    return found.where(F.col("language") != UNKNOWN_LANGUAGE).select("doc_id", "language")


@query
def language_unknown(spark, sf_dir):
    """Every fifth text is moved to letters no language was trained on."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.LanguageModel.fit(docs)
    other = F.translate(F.lower("text"), *OTHER_SCRIPT)
    moved = docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, other).otherwise(F.col("text")))
    return language.with_language(moved, model, text="text").select("doc_id", "language")


@query
def language_profile(spark, sf_dir):
    """What training counts: trigram buckets per language."""
    docs = texts(spark, sf_dir, "documents", "text", "lang")
    return language.bucket_counts(docs, "text", "lang")


# --- whole jobs on posts made from the tables --------------------------------


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return ingest.clean_posts(posts.raw_posts(docs))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.LanguageModel.fit(texts(spark, sf_dir, "documents", "text", "lang"))
    return enrich.enriched_posts(clean(spark, sf_dir), model, posts.LEXICON)


@query
def sentiment_lexicon(spark, sf_dir):
    """Polarity by a lexicon table: the words of the conversations, to five decimals."""
    spoken = table(spark, sf_dir, "conversations").select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}']+")).alias("word")
    )
    made = (F.ascii("word") * 7919 + F.length("word") * 104_729) % 200_001
    lexicon = (
        spoken.where("word <> ''").distinct().withColumn("polarity", (made - 100_000) / 100_000.0)
    )
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return sentiment.with_polarity(docs, "text", "score", lexicon).select(
        "doc_id", F.round("score", 9).alias("polarity")
    )


@query
def learnt_lexicon(spark, sf_dir):
    """Polarity spread from a few words to those that stand near them."""
    docs = texts(spark, sf_dir, "documents", "text")
    return lexicon.learn_lexicon(docs, posts.LEXICON, rounds=3, least_pairs=20)


@query
def ingest_clean(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def ingest_words(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return ingest.word_posts(posts.raw_posts(docs)).select(
        "timestamp", "dayofweek", "hour", "state", "candidate", "online_age", "tweet"
    )


@query
def enrich_posts(spark, sf_dir):
    return enriched(spark, sf_dir)


@query
def hourly_counts(spark, sf_dir):
    return reports.hourly_counts(clean(spark, sf_dir))


@query
def state_counts(spark, sf_dir):
    return reports.state_counts(clean(spark, sf_dir))


@query
def language_counts(spark, sf_dir):
    return reports.language_counts(enriched(spark, sf_dir))


@query
def state_sentiment_counts(spark, sf_dir):
    return reports.state_sentiment_counts(enriched(spark, sf_dir))


@query
def cumulative_by_language(spark, sf_dir):
    return reports.cumulative_by_language(enriched(spark, sf_dir))


@query
def top_words(spark, sf_dir):
    raw = posts.raw_posts(texts(spark, sf_dir, "documents", "doc_id", "text"))
    return reports.top_words(ingest.word_posts(raw), batch_id="run-1")


@query
def top_words_summaries(spark, sf_dir):
    """The same from summaries of the tasks."""
    raw = posts.raw_posts(texts(spark, sf_dir, "documents", "doc_id", "text"))
    return reports.top_words(ingest.word_posts(raw), batch_id="run-1", summaries=True)


@query
def frequent_terms(spark, sf_dir):
    """Top words of languages and sources from summaries so small that all ways of counting are taken."""
    docs = texts(spark, sf_dir, "documents", "lang", "source", "text")
    return heavy.frequent_terms(docs, ["lang", "source"], text.tokens(F.col("text")), remembered=4000, sent=2)


# --- sources and sinks -------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "csv")
    files.write_csv(clean(spark, sf_dir), folder, cluster_by="state")
    return files.read_csv(spark, folder, CLEAN_POST)


@query
def csv_records(spark, sf_dir):
    """The same rows from files that are not clustered."""
    folder = shared_folder(spark, "records")
    files.write_csv(clean(spark, sf_dir), folder)
    return files.read_csv(spark, folder, CLEAN_POST)


@query
def raw_csv_ingest(spark, sf_dir):
    """Raw posts as CSV files of 21 columns, read with line ends in quoted text, and cleaned.

    The name of every post has a quotation mark of its own, and is written unquoted.
    """
    folder = shared_folder(spark, "raw_csv")
    write_raw_csv(spark, sf_dir, folder, F.lit(False))
    back = files.read_csv(
        spark, f"{folder}/hashtag_*", RAW_POST, header=False, file_column="filename"
    )
    return ingest.clean_posts(back)


def write_raw_csv(spark: SparkSession, sf_dir: str, folder: str, cut: Column) -> None:
    """Raw posts as CSV files; of those in ``cut`` only the beginning of the line."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    raw = posts.raw_posts(docs).withColumn("user_name", F.lit('the 5" pipe'))
    cells = [
        F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))
        if name == "tweet"
        else F.col(name).cast("string")
        for name in RAW_POST.fieldNames()
    ]
    line = F.concat_ws(",", *(F.coalesce(cell, F.lit("")) for cell in cells))
    line = F.when(cut, F.concat_ws(",", "tweet_id", F.lit("cut"))).otherwise(line)
    for label in ("donaldtrump", "joebiden", "other"):
        named = F.col("filename").contains(label)
        if label == "other":
            named = ~F.col("filename").rlike("donaldtrump|joebiden")
        raw.where(named).select(line).write.text(f"{folder}/hashtag_{label}")


@query
def ingest_quarantine(spark, sf_dir):
    """Every line of raw CSV files with its verdict; every 31st line is cut short."""
    folder = shared_folder(spark, "judged")
    write_raw_csv(spark, sf_dir, f"{folder}/raw", F.col("tweet_id").cast("bigint") % 31 == 0)
    raw = files.read_csv(
        spark, f"{folder}/raw/hashtag_*", RAW_POST, header=False, file_column="filename", corrupt_column="corrupt"
    )
    ingest.write_judged(raw, f"{folder}/posts", corrupt_column="corrupt")
    kept, rejected = ingest.read_kept(spark, f"{folder}/posts"), ingest.read_rejected(spark, f"{folder}/posts")
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in CLEAN_POST]
    return kept.select(F.lit(ingest.KEPT).alias("verdict"), "*").union(rejected.select("reason", *nothing))


@query
def parquet_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "parquet")
    files.write_parquet(clean(spark, sf_dir), folder, partition_by=("candidate",))
    back = files.read_parquet(spark, folder, CLEAN_POST)
    return back.where(F.col("candidate") == "Biden")


@query
def table_append(spark, sf_dir):
    folder = shared_folder(spark, "append")
    counts = reports.hourly_counts(clean(spark, sf_dir))
    for _ in range(2):
        files.append_table(counts, "parquet", path=folder)
    return files.read_table(spark, "parquet", path=folder)


@query
def keyed_upsert(spark, sf_dir):
    """Customers, then the balance of those with orders replaced by their order total."""
    contract = TableContract(
        T.StructType()
        .add("c_custkey", T.LongType())
        .add("c_name", T.StringType())
        .add("orders", T.LongType()),
        ("c_custkey",),
    )
    stored = KeyedTable(spark, shared_folder(spark, "keyed"), contract)
    customers = table(spark, sf_dir, "customer")
    stored.upsert(customers.withColumn("orders", F.lit(0)), version=0)
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    changed = customers.join(counts, F.col("c_custkey") == F.col("o_custkey"))
    for _ in range(2):  # a repeated version replaces itself
        stored.upsert(changed, version=1)
    return stored.read()


@query
def keyed_compaction(spark, sf_dir):
    """Five upserts of ever fewer customers, folded in between."""
    contract = TableContract(
        T.StructType().add("c_nationkey", T.IntegerType()).add("c_custkey", T.LongType())
        .add("turn", T.IntegerType()),
        ("c_nationkey", "c_custkey"), ("c_nationkey",),
    )
    stored = KeyedTable(spark, shared_folder(spark, "compacted"), contract)
    # Every ninth nation is unknown.
    nation = F.when(F.col("c_nationkey") % 9 != 0, F.col("c_nationkey"))
    customers = table(spark, sf_dir, "customer").withColumn("c_nationkey", nation)
    for turn in range(5):
        chosen = customers.where(F.col("c_custkey") % (turn + 1) == 0)
        stored.upsert(chosen.withColumn("turn", F.lit(turn)))
        if turn == 2:
            stored.compact()
    return stored.read()


@query
def result_tables(spark, sf_dir):
    """The date and language report through its table contract, written twice."""
    stored = KeyedTable(spark, shared_folder(spark, "tables"), CONTRACTS["date_cumulative"])
    report = reports.cumulative_by_language(enriched(spark, sf_dir))
    for version in (0, 1):
        stored.upsert(report, version)
    return stored.read()


@query
def all_result_tables(spark, sf_dir):
    """All six reports through their contracts, from posts with impossible dates: rows as text."""
    posts_in, rich = clean(spark, sf_dir), stored_posts(spark, sf_dir)
    raw = posts.raw_posts(texts(spark, sf_dir, "documents", "doc_id", "text"))
    made = {
        "hour": reports.hourly_counts(posts_in),
        "state": reports.state_counts(posts_in),
        "language": reports.language_counts(rich),
        "state_analyze": reports.state_sentiment_counts(rich),
        "date_cumulative": reports.cumulative_by_language(rich),
        "word_list": reports.top_words(ingest.word_posts(raw), batch_id="run-1"),
    }
    folder, shown = shared_folder(spark, "all_tables"), []
    for name, report in made.items():
        stored = KeyedTable(spark, f"{folder}/{name}", CONTRACTS[name])
        stored.upsert(report)
        stored.upsert(report)
        shown.append(as_rows(name, stored.read()))
    return reduce(DataFrame.unionByName, shown)


def as_rows(name: str, report: DataFrame) -> DataFrame:
    """A result table as text, a row each."""
    columns = [F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in CONTRACTS[name].schema.names]
    return report.select(F.lit(name).alias("table_name"), F.concat_ws("|", *columns).alias("row"))


# --- models ------------------------------------------------------------------


@query
def train_split(spark, sf_dir):
    first = training.in_first_part(["doc_id"], 0.75, seed=7)
    return table(spark, sf_dir, "documents").select("doc_id", first.alias("train"))


@query
def train_split_exact(spark, sf_dir):
    """Three quarters of the documents of every language, to the row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return training.with_exact_split(docs, ["doc_id"], "lang", 0.75, seed=7, name="train")


@query
def feature_index(spark, sf_dir):
    """Category indexes, and the vector opened up: its width and what is set."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    features = (("n_chars", training.NUMBER), ("lang", training.INDEX), ("source", training.ONE_HOT))
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    made = Pipeline(stages=training.feature_stages(features)).fit(docs).transform(docs)
    vector = vector_to_array("features")
    return made.select(
        "doc_id",
        F.col("lang_indexed").cast("int").alias("lang_index"),
        F.col("source_indexed").cast("int").alias("source_index"),
        F.size(vector).alias("width"),
        vector[0].cast("bigint").alias("first_feature"),
        (F.array_position(F.slice(vector, F.lit(3), F.size(vector)), F.lit(1.0)) - 1).cast("int").alias("hot"),
    )


_STORED: dict[tuple[str, str], str] = {}


def stored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched posts, written once for all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        folder = shared_folder(spark, "enriched")
        files.write_parquet(enriched(spark, sf_dir), folder)
        _STORED[key] = folder
    return files.read_parquet(spark, _STORED[key], ENRICHED_POST)


def trained(spark: SparkSession, sf_dir: str, features=training.POST_FEATURES):
    """A forest on a sentiment that class and weekday decide, so right predictions are known."""
    early = F.col("dayofweek") < 4
    known = (
        F.when((F.col("candidate") == "Trump") & early, "Positive")
        .when((F.col("candidate") == "Biden") & ~early, "Negative")
        .otherwise("Neutral")
    )
    rows = stored_posts(spark, sf_dir).withColumn("sentiment", known)
    first, rest = training.split_rows(rows, ["date", "tweet"], 0.75, seed=7)
    return training.train(first, features, seed=7, features_per_split="all"), first, rest


@query
def model_accuracy(spark, sf_dir):
    model, first, rest = trained(spark, sf_dir)
    return training.evaluate(model.model, {"train": first, "validation": rest})


@query
def batch_score(spark, sf_dir):
    model, _, _ = trained(spark, sf_dir, training.REQUEST_FEATURES)
    return training.score(model.model, requests(spark, sf_dir))


@query
def model_roundtrip(spark, sf_dir):
    """Saved and loaded, a model must predict the same: rows by agreement."""
    model, _, _ = trained(spark, sf_dir, training.REQUEST_FEATURES)
    folder = shared_folder(spark, "model")
    training.save_model(model.model, folder)
    asked = requests(spark, sf_dir)
    before = training.score(model.model, asked).select("uuid", F.col("predicted").alias("before"))
    after = training.score(training.load_model(folder), asked).select("uuid", "predicted")
    return before.join(after, "uuid").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("before") == F.col("predicted")).alias("same"),
    )


@query
def score_keeps_rows(spark, sf_dir):
    """Requests with a number missing in every way: all come back, some without a prediction."""
    model, _, _ = trained(spark, sf_dir, training.REQUEST_FEATURES)
    number = F.substring("uuid", 2, 20).cast("bigint")
    age = (
        F.when(number % 5 == 0, F.lit(float("nan")))
        .when(number % 7 == 0, F.lit(float("inf")))
        .when(number % 11 != 0, F.col("online_age"))
    )
    return training.score(model.model, requests(spark, sf_dir).withColumn("online_age", age)).select(
        "uuid", "predicted"
    )


# --- streaming ---------------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per event."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("uuid"),
        F.hour("ts").cast("double").alias("hour"),
        F.dayofweek("ts").cast("double").alias("dayofweek"),
        F.col("value").alias("online_age"),
        F.when(F.col("user_id") % 2 == 0, "Trump").otherwise("Biden").alias("candidate"),
        F.when(F.col("event_type") == "view", "Klingon").otherwise("English").alias("language"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests as messages; every seventh is cut short, every eleventh lacks its hour."""
    number = F.substring("uuid", 2, 20).cast("bigint")
    whole = codec.encode_json(*(F.col(name) for name in requests(spark, sf_dir).columns))
    without_hour = codec.encode_json("uuid", "dayofweek", "online_age", "candidate", "language")
    return requests(spark, sf_dir).select(
        F.when(number % 7 == 0, F.lit('{"uuid": "cut'))
        .when(number % 11 == 0, without_hour)
        .otherwise(whole)
        .alias("value")
    )


def streamed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Answers and dead letters of a stream over all messages, run to its end."""
    folder = shared_folder(spark, "stream")
    messages(spark, sf_dir).write.text(f"{folder}/in")
    model, _, _ = trained(spark, sf_dir, training.REQUEST_FEATURES)
    scoring.start_scoring(
        read_messages(spark, "text", path=f"{folder}/in"),
        model.model,
        Sink("text", f"{folder}/out"),
        Sink("text", f"{folder}/dead"),
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    # Each batch has a folder of its own, whose name would be a column.
    return tuple(spark.read.text(f"{folder}/{end}").select("value") for end in ("out", "dead"))


def fields(lines: DataFrame, *names: str) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return lines.select(codec.decode_json(F.col("value"), schema).alias("m")).select("m.*")


@query
def stream_score(spark, sf_dir):
    return fields(streamed(spark, sf_dir)[0], "uuid", "prediction")


@query
def stream_equals_batch(spark, sf_dir):
    """A streamed answer must be the one the batch gives: requests by agreement."""
    answers = stream_score(spark, sf_dir)
    batch = batch_score(spark, sf_dir).select("uuid", "predicted")
    return answers.join(batch, "uuid").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("prediction") == F.col("predicted")).alias("same"),
    )


@query
def stream_conservation(spark, sf_dir):
    """Messages with every kind of flaw: each gives one answer or one dead letter."""
    folder = shared_folder(spark, "conserved")
    number = F.substring("uuid", 2, 20).cast("bigint")
    whole = codec.encode_json(*(F.col(name) for name in requests(spark, sf_dir).columns))
    age = F.regexp_replace(whole, '"online_age":[^,]+', '"online_age":NaN')
    flawed = (
        F.when(number % 5 == 0, age)
        .when(number % 7 == 0, F.replace(age, F.lit("NaN"), F.lit('"Infinity"')))
        .when(number % 11 == 0, F.concat(F.lit("["), whole, F.lit("]")))
        .when(number % 13 == 0, F.concat(whole, F.lit(" and more")))
        .when(number % 17 == 0, F.concat(whole, whole))
        .otherwise(whole)
    )
    requests(spark, sf_dir).select(flawed.alias("value")).write.text(f"{folder}/in")
    model, _, _ = trained(spark, sf_dir, training.REQUEST_FEATURES)
    scoring.start_scoring(
        read_messages(spark, "text", path=f"{folder}/in"),
        model.model,
        Sink("text", f"{folder}/out"),
        Sink("text", f"{folder}/dead"),
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    ends = {"messages": "in", "answers": "out", "dead_letters": "dead"}
    lines = terms.union_tagged(
        {name: spark.read.text(f"{folder}/{end}").select("value") for name, end in ends.items()}, "end"
    )
    return lines.agg(*(F.count_if(F.col("end") == name).alias(name) for name in ends))


@query
def stream_dead_letter(spark, sf_dir):
    return fields(streamed(spark, sf_dir)[1], "message", "reason")


@query
def stream_upsert(spark, sf_dir):
    """Answers by ``uuid`` where every third request is sent twice and all are streamed twice.

    The second stream has a new checkpoint, so it repeats every batch of the first.
    """
    folder = shared_folder(spark, "upserted")
    sent = messages(spark, sf_dir)
    number = F.xxhash64("value")
    sent.union(sent.where(F.pmod(number, F.lit(3)) == 0)).write.text(f"{folder}/in")
    model, _, _ = trained(spark, sf_dir, training.REQUEST_FEATURES)
    answers = KeyedTable(spark, f"{folder}/answers", ANSWERS)
    for turn in ("first", "second"):
        arriving = read_messages(spark, "text", "arrived", path=f"{folder}/in")
        scoring.start_scoring(
            scoring.each_once(arriving, "arrived"),
            model.model,
            KeyedSink(answers),
            Sink("text", f"{folder}/dead-{turn}"),
            f"{folder}/checkpoint-{turn}",
            trigger={"availableNow": True},
        ).awaitTermination()
    return answers.read()


@query
def keyed_writers(spark, sf_dir):
    """Orders of each customer, by as many writers at once as there are order states, then folded beside another."""
    contract = TableContract(
        T.StructType().add("o_orderkey", T.LongType()).add("o_orderstatus", T.StringType())
        .add("turn", T.IntegerType()),
        ("o_orderkey",),
    )
    path = shared_folder(spark, "writers")
    orders = table(spark, sf_dir, "orders")

    def write(turn: int) -> None:
        # Each writer opens the table itself, as jobs of their own would.
        own = orders.where(F.pmod("o_orderkey", F.lit(turn + 1)) == 0).withColumn("turn", F.lit(turn))
        KeyedTable(spark, path, contract).upsert(own, version=turn)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
        stored = KeyedTable(spark, path, contract)
        before = stored.snapshot()
        list(pool.map(lambda job: job(), (stored.compact, lambda: write(4), KeyedTable(spark, path, contract).compact)))
    stored.vacuum()
    return terms.union_tagged({"before": stored.read(before), "after": stored.read()}, "seen")


# --- reports that follow new posts ---------------------------------------------


@query
def report_increments(spark, sf_dir):
    """The reports as text, from posts that come in five parts by two streams, the last part in two writings."""
    folder = shared_folder(spark, "increments")
    counts = increments.ReportCounts(spark, f"{folder}/counts")
    part = F.pmod(F.xxhash64("tweet", "date"), F.lit(5))
    arriving = {"clean": clean(spark, sf_dir), "enriched": stored_posts(spark, sf_dir)}
    schemas = {"clean": CLEAN_POST, "enriched": ENRICHED_POST}
    follow = {"clean": counts.follow_clean, "enriched": counts.follow_enriched}
    for kind, rows in arriving.items():
        files.write_parquet(rows.withColumn("part", part), f"{folder}/all-{kind}", partition_by=("part",))
        # Every part is a batch of its own; the stream starts again after the third.
        whole = files.read_parquet(spark, f"{folder}/all-{kind}")
        for own in ((0, 1, 2), (3, 4)):
            for number in own:
                mine = whole.where(F.col("part") == number).select(*schemas[kind].names)
                mine.coalesce(1).write.mode("append").parquet(f"{folder}/{kind}")
            stream = spark.readStream.schema(schemas[kind]).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{kind}")
            follow[kind](stream, f"{folder}/checkpoint-{kind}", {"availableNow": True}).awaitTermination()
        if kind == "clean":
            counts.compact()
    made = {
        "hour": counts.hourly_counts(),
        "state": counts.state_counts(),
        "language": counts.language_counts(),
        "state_analyze": counts.state_sentiment_counts(),
        "date_cumulative": counts.cumulative_by_language(),
    }
    return reduce(DataFrame.unionByName, (as_rows(name, report) for name, report in made.items()))


# --- layout on disk --------------------------------------------------------------


@query
def range_layout(spark, sf_dir):
    """Posts of three days in the larger part of the states, from a table laid out by day and state."""
    folder = shared_folder(spark, "ranges")
    layout.write_ranges(clean(spark, sf_dir), folder, ["date", "state"], files=16)
    return layout.read_ranges(
        spark, folder, CLEAN_POST, ["date", "state"], date=("2020-10-20", "2020-10-22"), state=("Georgia", "Ohio")
    )


@query
def bucketed_join(spark, sf_dir):
    """Orders and prices of each customer from two tables in equal buckets."""
    folder = shared_folder(spark, "buckets")
    read = {}
    for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        rows = table(spark, sf_dir, name)
        layout.write_buckets(rows, f"{folder}/{name}", [key], 8)
        read[name] = layout.read_buckets(spark, f"{folder}/{name}", rows.schema, [key], 8)
    # Merged, as tables too large to send would be.
    joined = read["orders"].join(read["customer"].hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("o_custkey", "c_name").agg(
        F.count("*").alias("orders"), F.max("o_totalprice").alias("dearest")
    )
