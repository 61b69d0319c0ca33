"""A cleaning pipeline for a text corpus, in stages that each write their result.

Every stage works on all rows the one before it kept. The first four return the
columns they are given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from postgrove.llm import cotraining, language_vectors, minhash, mixing, pieces
from postgrove.llm.stored import numbered, parted, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text is in none of the learnt languages if its cosine with all of them is below
# this quantile of what texts of its length have with their own language.
OWN_COSINES = 0.005
# Lengths are told apart by powers of two, up to this one.
SIZES = 32
# Words of a shingle.
WIDTH = 5


def _least_cosines(own: DataFrame) -> list[float]:
    """The limit for each size, from (size, score) of texts that are in their own language.

    A size without such texts has the limit of the next smaller one, or of the smallest.
    """
    least = F.percentile_approx("score", OWN_COSINES, 100_000).alias("least")
    seen = {row["size"]: row["least"] for row in own.groupBy("size").agg(least).collect()}
    limits, last = [], seen[min(seen)] if seen else 0.0
    for size in range(SIZES + 1):
        last = seen.get(size, last)
        limits.append(last)
    return limits


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a language of the labelled rows; texts without letters go."""
    profiles = language_vectors.learn(docs)
    size = F.coalesce(F.least(F.floor(F.log2(F.length("text") + 1)), F.lit(SIZES)), F.lit(0)).cast("int")
    named = docs.where("lang is not null").select(F.struct("lang", size.alias("size")).alias("row"), "text")
    own = language_vectors.identify(named, profiles, id="row").where("row.lang = lang_pred")
    limits = _least_cosines(own.select("row.size", "score"))
    rows = docs.select(F.struct(F.struct("*").alias("row"), size.alias("size")).alias("sized"), "text")
    found = language_vectors.identify(rows, profiles, id="sized")
    # Sums of another batch may differ in their last bits.
    least = F.element_at(F.array(*map(F.lit, limits)), F.col("sized.size") + 1) - 1e-6
    good = (F.col("lang_pred") != language_vectors.UNKNOWN) & (F.col("score") >= least)
    return found.where(good).select("sized.row.*")


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the co-trained classifier keeps, fitted on those rows that have labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = cotraining.train(docs, labels)
    rows = docs.select(F.struct("*").alias("row"), "text", "source", "lang", "n_chars")
    return cotraining.classify(rows, model, id="row").where("kept").select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one of the smallest id.

    Rows without an id, or with one that other rows have too, come after all others. They are told
    apart by a number of their own, so unlike texts of one id all stay, and so do rows without words.
    """
    shared = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    shared = stored(shared, "shared_ids")
    rows = docs.select(F.col("doc_id").alias("_at"), F.struct("*").alias("row"))
    repeated, single = parted(rows, "_at", shared)
    alone = single.where("_at is not null")
    last = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long")).head()[0]
    others = repeated.union(single.where("_at is null")).select("row")
    others, _ = numbered(others, "_at", "others", first=last + 1)
    rows = alone.union(others.select("_at", "row"))
    found = minhash.near_duplicates(rows.select("_at", "row.text"), id="_at", width=WIDTH)
    # Fewer rows go than stay, and only those that may go are moved.
    copies = stored(found.where("not kept").select("_at"), "copies")
    return parted(rows, "_at", copies)[1].select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the target weights of their sources ask for."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row's pieces, and whether decoding them gives the text again."""
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    rows = pieces.encode_and_check(docs, vocabulary, keep=("doc_id", "source"))
    return rows.select(
        "doc_id",
        "source",
        "ids",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        "restored",
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", in_known_language),
    ("quality", of_good_quality),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("pieces", encoded),
]

# Random letter vectors and fitted weights are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
