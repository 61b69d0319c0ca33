"""One query per operator, over whole tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postgrove.llm import (
    collocations,
    cotraining,
    huffman,
    language_vectors,
    lengths,
    maxscore,
    minhash,
    mixing,
    neighbours,
    pieces,
    quality_rules,
    suffix_tree,
    vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id: str, folds: int) -> Column:
    """The fold of a row; 0 is held out. NULL for a row without an id."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % folds


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed limits and the likelihood ratio against texts labelled as good."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken for half as many words again."""
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates on four-word shingles at 80 percent."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learnt from four of five documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_vectors.learn(docs.where(fold("doc_id", 5) != 0))
    # The prediction sees the text; the fold is carried beside it.
    rows = docs.select(F.struct("doc_id", (fold("doc_id", 5) == 0).alias("held_out")).alias("row"), "text")
    found = language_vectors.identify(rows, profiles, id="row")
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every text, learnt from nine of ten documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select(F.struct("doc_id", (fold("doc_id", 10) == 0).alias("held_out")).alias("row"), "text")
    # A row without an id is in no fold, and not learnt from.
    found = suffix_tree.scores(rows, ~F.col("row.held_out"), id="row")
    return found.select(
        "row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every context limit means for the corpus, in tokens of a byte-level vocabulary."""
    ranks = lengths.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return lengths.suffix_sums(
        lengths.histogram(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    )


def op8_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all token ids as Huffman code and read them back."""
    folder = huffman.new_folder(spark)
    huffman.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return huffman.read(spark, folder, digest=True)


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, from labels of some and two views of all."""
    docs = table(spark, sf_dir, "documents")
    return cotraining.classify(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text into pieces and decode it: sizes, a digest and whether the text came back."""
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_and_check(docs, vocabulary).select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "restored",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest inner products of every fiftieth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of eight bytes of all vectors, with what they lose."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_neighbours": op2_neighbours,
    "op3_mixing": op3_mixing,
    "op4_minhash": op4_minhash,
    "op5_language": op5_language,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_lengths": op7_lengths,
    "op8_huffman": op8_huffman,
    "op9_cotraining": op9_cotraining,
    "op10_pieces": op10_pieces,
    "op11_collocations": op11_collocations,
    "op12_maxscore": op12_maxscore,
    "op13_vector_codes": op13_vector_codes,
}
