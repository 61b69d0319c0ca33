"""A model that changes while a stream runs, and a source that fails and comes back."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postgrove.plans import training
from postgrove.plans.models import ModelFolder
from postgrove.sources.messages import Sink, read_messages
from postgrove.streaming import scoring


def model_saying(spark, label):
    rows = spark.range(40).select(
        F.col("id").cast("int").alias("hour"), F.lit(1).alias("dayofweek"), F.lit(1.0).alias("online_age"),
        F.lit("x").alias("candidate"), F.lit("y").alias("language"), F.lit(label).alias("sentiment"),
    )
    other = rows.limit(1).withColumn("sentiment", F.lit("Other")).withColumn("hour", F.lit(99))
    return training.train(rows.union(other), training.REQUEST_FEATURES, seed=1, trees=2).model


@pytest.fixture(scope="module")
def models(spark):
    return {label: model_saying(spark, label) for label in ("Positive", "Negative")}


def request(i):
    return json.dumps(
        {"uuid": i, "hour": 3, "dayofweek": 1, "online_age": 1.0, "candidate": "x", "language": "y"}
    ) + "\n"


def answers(spark, folder):
    read = [json.loads(r.value) for r in spark.read.text(f"{folder}/out").collect()]
    return {a["uuid"]: a["prediction"] for a in read}


def test_a_batch_is_scored_by_the_model_then_in_use(spark, models, tmp_path):
    folder = ModelFolder(spark, str(tmp_path / "models"))
    with pytest.raises(ValueError):
        folder.newest()
    assert folder.add(models["Positive"]) == 0
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text(request(str(i)))

    class Swapping(Sink):
        """Another job adds a model after the first batch, and takes it back after the second."""

        def write(self, rows, batch_id):
            super().write(rows, batch_id)
            other = ModelFolder(spark, str(tmp_path / "models"))
            if batch_id == 0:
                assert other.add(models["Negative"]) == 1
            elif batch_id == 1:
                assert other.use(0) == 2

    progress = scoring.Progress()
    spark.streams.addListener(progress)
    try:
        scoring.start_scoring(
            read_messages(spark, "text", path=f"{tmp_path}/in", maxFilesPerTrigger="1"), folder,
            Swapping("text", f"{tmp_path}/out"), Sink("text", f"{tmp_path}/dead"),
            f"{tmp_path}/checkpoint", trigger={"availableNow": True},
        ).awaitTermination()
    finally:
        spark.streams.removeListener(progress)
    assert sorted(answers(spark, tmp_path).values()) == ["Negative", "Positive", "Positive"]
    assert folder.newest()[0] == 2 and folder.newest()[1] is folder.newest()[1]
    with pytest.raises(ValueError):
        folder.use(7)


def test_a_source_that_fails_once_loses_nothing(spark, models, tmp_path):
    """A file that is gone when its batch is read, and is there again after the restart."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text(request("a"))
    broken = tmp_path / "in" / "2.txt"
    waits, starts = [], []

    def start():
        starts.append(1)
        query = scoring.start_scoring(
            read_messages(spark, "text", path=f"{tmp_path}/in", maxFilesPerTrigger="1").where(fails()),
            models["Positive"], Sink("text", f"{tmp_path}/out"), Sink("text", f"{tmp_path}/dead"),
            f"{tmp_path}/checkpoint", trigger={"availableNow": True},
        )
        return query

    def fails():
        # The source's rows cannot be read in the second batch of the first two starts.
        bad = F.col("value").contains('"b"') & F.lit(len(starts) < 3)
        return F.when(bad, F.raise_error(F.lit("the source is gone")).cast("boolean")).otherwise(True)

    broken.write_text(request("b"))
    (tmp_path / "in" / "3.txt").write_text(request("c"))
    assert scoring.keep_running(start, restarts=3, wait=0.5, sleep=waits.append) == 2
    assert set(answers(spark, tmp_path)) == {"a", "b", "c"}
    assert len(starts) == 3 and waits == [0.5, 1.0] or waits == [0.5, 0.5]


def test_a_source_that_stays_away_is_given_up(spark, models, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text(request("a"))
    waits = []

    def start():
        away = F.raise_error(F.lit("never there")).cast("boolean")
        return scoring.start_scoring(
            read_messages(spark, "text", path=f"{tmp_path}/in").where(away), models["Positive"],
            Sink("text", f"{tmp_path}/out"), Sink("text", f"{tmp_path}/dead"), f"{tmp_path}/checkpoint",
            trigger={"availableNow": True},
        )

    with pytest.raises(StreamingQueryException, match="never there"):
        scoring.keep_running(start, restarts=2, wait=1, longest=1.5, sleep=waits.append)
    assert waits == [1, 1.5]
