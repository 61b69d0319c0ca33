"""Training and applying the sentiment classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    OneHotEncoderModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.operators.terms import union_tagged

PREDICTED = "predicted"
NUMBER, INDEX, ONE_HOT = "number", "index", "one_hot"

# The features and their order in the vector.
POST_FEATURES: tuple[tuple[str, str], ...] = (
    ("hour", NUMBER),
    ("dayofweek", NUMBER),
    ("online_age", NUMBER),
    ("state", ONE_HOT),
    ("candidate", INDEX),
    ("language", ONE_HOT),
)
# Requests carry no region.
REQUEST_FEATURES = tuple(feature for feature in POST_FEATURES if feature[0] != "state")


@dataclass(frozen=True)
class Trained:
    """``model`` scores rows without a label and names the class in ``predicted``."""

    model: PipelineModel
    labels: list[str]


def in_first_part(keys: list[str], fraction: float, seed: int) -> Column:
    """Whether a row falls into the first ``fraction``, by a hash of its values.

    The same row falls on the same side on every run, retry and cluster size.
    """
    texts = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000
    return bucket < round(fraction * 10_000)


def split_rows(
    df: DataFrame, keys: list[str], fraction: float = 0.75, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    first = in_first_part(keys, fraction, seed)
    return df.where(first), df.where(~first)


def _hash_of(keys: list[str], seed: int) -> Column:
    """52 bits that follow from the values alone."""
    texts = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *texts)), 1, 13), 16, 10).cast("bigint")


# The first pass counts hashes by their highest bits.
HIGH_BITS = 16
MAX_BROADCAST_LABELS = 100_000


def with_exact_split(
    df: DataFrame, keys: list[str], label: str, fraction: float = 0.75, seed: int = 0, name: str = "first"
) -> DataFrame:
    """Add whether a row falls into the first part, which has its exact share of every label.

    Rows go by a hash of their ``keys``, as with :func:`in_first_part`, but up to a threshold of
    each label, found in two passes and without a sort: the first counts hashes by their highest bits, which tells
    the range that holds the threshold, the second only what is in that range. The share is right to one
    row; rows that are equal in all keys fall on the same side, together. NULL is a label of its own.
    """
    rows = df.select(F.col(label).alias("_label"), _hash_of(keys, seed).alias("_hash"))
    shift = 52 - HIGH_BITS

    high = F.shiftright("_hash", shift).alias("high")
    ranges = rows.groupBy("_label", high).agg(F.count("*").alias("n"))
    sizes = ranges.withColumn("all", F.sum("n").over(Window.partitionBy("_label")))
    want = F.floor(F.lit(fraction) * F.col("all") + 0.5)
    # At most 2 ** HIGH_BITS rows of a label.
    first = sizes.withColumn("want", want).where("want > 0")
    window = Window.partitionBy("_label").orderBy("high").rowsBetween(Window.unboundedPreceding, 0)
    crossed = (
        first.withColumn("to", F.sum("n").over(window))
        .where("to >= want and to - n < want")
        .select(F.col("_label").alias("_own"), "high", "want", (F.col("to") - F.col("n")).alias("before"))
    )
    labels = crossed.count()
    send = F.broadcast if labels <= MAX_BROADCAST_LABELS else (lambda x: x)
    near = rows.join(
        send(crossed), rows["_label"].eqNullSafe(crossed["_own"]) & (F.shiftright("_hash", shift) == F.col("high"))
    )
    hashes = near.groupBy("_label", "_hash", "want", "before").agg(F.count("*").alias("n"))
    window = Window.partitionBy("_label").orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    limits = (
        hashes.withColumn("to", F.col("before") + F.sum("n").over(window))
        .where("to >= want and to - n < want")
        .select(F.col("_label").alias("_own"), F.col("_hash").alias("_limit"))
    )
    joined = df.withColumn("_hash", _hash_of(keys, seed)).join(send(limits), F.col(label).eqNullSafe(F.col("_own")), "left")
    inside = F.coalesce(F.col("_hash") <= F.col("_limit"), F.lit(False))
    return joined.select(*df.columns, inside.alias(name))


def feature_stages(features: tuple[tuple[str, str], ...]) -> list[Transformer]:
    """Indexer, encoder and assembler. Unseen categories are kept as one more.

    One indexer for all categories counts them in one pass over the rows.
    """
    categories = [name for name, kind in features if kind in (INDEX, ONE_HOT)]
    encoded = [name for name, kind in features if kind == ONE_HOT]
    stages: list[Transformer] = []
    if categories:
        indexed = [f"{name}_indexed" for name in categories]
        stages.append(
            StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep")
        )
    if encoded:
        stages.append(
            OneHotEncoder(
                inputCols=[f"{name}_indexed" for name in encoded],
                outputCols=[f"{name}_encoded" for name in encoded],
            )
        )
    column = {NUMBER: "{}", INDEX: "{}_indexed", ONE_HOT: "{}_encoded"}
    inputs = [column[kind].format(name) for name, kind in features]
    return [
        *stages,
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
    ]


def incomplete(features: tuple[tuple[str, str], ...]) -> Column:
    """Whether a row lacks a number: it is not trained on and has no prediction."""
    return _lacking([name for name, kind in features if kind == NUMBER])


def _lacking(numbers: list[str]) -> Column:
    missing = F.lit(False)
    for name in numbers:
        value = F.col(name).cast("double")
        missing = missing | value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return missing


def train(
    rows: DataFrame,
    features: tuple[tuple[str, str], ...] = POST_FEATURES,
    label: str = "sentiment",
    seed: int = 0,
    trees: int = 20,
    depth: int = 5,
    features_per_split: str = "auto",
) -> Trained:
    """Fit a random forest on the ``rows`` that have a label and all numbers.

    The label is indexed outside the pipeline, so the model needs no label
    column to score, and has one class per label of the training rows. ``rows``
    are read three times (labels, categories, vectors) and should come from a
    stored table; the forest keeps its own compact copy for the tree levels.
    """
    columns = [name for name, _ in features]
    rows = rows.select(*columns, label).where(F.col(label).isNotNull() & ~incomplete(features))
    index = StringIndexer(inputCol=label, outputCol="_label").fit(rows)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="_label", numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy=features_per_split,
    )
    fitted = Pipeline(stages=[*feature_stages(features), forest]).fit(index.transform(rows))
    decoder = IndexToString(inputCol="prediction", outputCol=PREDICTED, labels=index.labels)
    return Trained(PipelineModel([*fitted.stages, decoder]), list(index.labels))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Every one of ``rows`` with the predicted class, NULL for a row that lacks a number."""
    (assembler,) = [stage for stage in model.stages if isinstance(stage, VectorAssembler)]
    made = {name for stage in model.stages if isinstance(stage, (StringIndexerModel, OneHotEncoderModel))
            for name in stage.getOutputCols()}
    numbers = [name for name in assembler.getInputCols() if name not in made]
    known = F.when(~_lacking(numbers), F.col(PREDICTED)).alias(PREDICTED)
    return model.transform(rows).select(*rows.columns, known)


def accuracy(label: str = "sentiment") -> Column:
    """Share of rows whose prediction is the label; a label never seen counts as wrong."""
    right = F.coalesce(F.col(PREDICTED) == F.col(label), F.lit(False))
    return F.avg(right.cast("int"))


def evaluate(model: PipelineModel, parts: dict[str, DataFrame], label: str = "sentiment") -> DataFrame:
    """Of each part, the rows that can be scored and the accuracy on them."""
    scored = union_tagged({name: score(model, part) for name, part in parts.items()}, "part").where(
        F.col(PREDICTED).isNotNull()
    )
    return scored.groupBy("part").agg(
        F.count("*").alias("rows"), accuracy(label).alias("accuracy")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
