"""Training, scoring and the request stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from postgrove.plans import training
from postgrove.sources.messages import Sink, read_messages
from postgrove.streaming import scoring


def post_rows(n=400):
    rng = random.Random(11)
    rows = []
    for _ in range(n):
        candidate = rng.choice(["Trump", "Biden"])
        hour = rng.randint(0, 23)
        label = "Positive" if hour < 8 else "Neutral" if hour < 16 else "Negative"
        rows.append((hour, rng.randint(1, 7), rng.uniform(0, 150), rng.choice(["Ohio", "Iowa"]),
                     candidate, rng.choice(["English", "German"]), label))
    return rows + [(5, 1, None, "Ohio", "Trump", "English", "Positive"), (5, 1, 2.0, None, "Trump", None, None)]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(
        post_rows(),
        "hour int, dayofweek int, online_age double, state string, candidate string, "
        "language string, sentiment string",
    ).persist()


@pytest.fixture(scope="module")
def trained(posts):
    return training.train(posts, training.REQUEST_FEATURES, seed=1)


def test_split_is_stable_and_complete(spark):
    df = spark.range(2000).withColumn("t", F.lit(None).cast("string"))
    first, rest = training.split_rows(df, ["id", "t"], 0.75, seed=3)
    ids = {r.id for r in first.collect()}
    assert ids == {r.id for r in training.split_rows(df.repartition(5), ["id", "t"], 0.75, 3)[0].collect()}
    assert first.count() + rest.count() == 2000 and 1400 < len(ids) < 1600


def test_forest_layout_and_accuracy(posts):
    made = training.train(posts, seed=1)
    forest = made.model.stages[-2]
    assert forest.numClasses == 3 and forest.getNumTrees == 20
    assert forest.numFeatures == 3 + 1 + 2 + 2
    assert sorted(made.labels) == ["Negative", "Neutral", "Positive"]
    scored = training.score(made.model, posts)
    assert scored.count() == posts.count() == 402
    assert [r.online_age for r in scored.where("predicted is null").collect()] == [None]
    result = {r.part: r for r in training.evaluate(made.model, {"all": posts}).collect()}
    assert result["all"].rows == 401 and result["all"].accuracy > 0.9
    assert posts.where(training.incomplete(training.POST_FEATURES)).count() == 1


def test_scoring_needs_no_label_and_takes_unseen_values(spark, trained, tmp_path):
    asked = spark.createDataFrame(
        [(3.0, 1.0, 5.0, "Nobody", "Klingon"), (20.0, 1.0, 5.0, None, None)],
        "hour double, dayofweek double, online_age double, candidate string, language string",
    )
    before = [r.predicted for r in training.score(trained.model, asked).collect()]
    assert before == ["Positive", "Negative"]
    training.save_model(trained.model, str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    assert [r.predicted for r in training.score(loaded, asked).collect()] == before


def request(uuid, **changes):
    body = {"uuid": uuid, "hour": 3, "dayofweek": 2, "online_age": 13, "candidate": "Trump",
            "language": "English"} | changes
    return json.dumps({k: v for k, v in body.items() if v != "absent"})


GOOD = [request("a"), request("b", hour=20.0), request("c", language="Klingon"), request("a")]
BAD = [
    "not json", "{", request("d", hour="absent"), request("e", online_age=None),
    request("absent"), request("f", hour="eight"), "[]", '"text"', request("g", hour="NaN"),
    request("h").replace("13", "NaN"), request("i").replace("13", "-Infinity"), request("j") + " more",
    request("k") + request("k"), "[" + request("l") + "]", request("m") + "]", request("n") + "}",
]


def run(spark, model, folder):
    scoring.start_scoring(
        read_messages(spark, "text", path=f"{folder}/in"),
        model,
        Sink("text", f"{folder}/out"),
        Sink("text", f"{folder}/dead"),
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    answers = [json.loads(r.value) for r in spark.read.text(f"{folder}/out").collect()]
    dead = [json.loads(r.value) for r in spark.read.text(f"{folder}/dead").collect()]
    return answers, dead


def test_stream_answers_rejects_and_restarts(spark, trained, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join(GOOD + BAD) + "\n")
    answers, dead = run(spark, trained.model, tmp_path)
    predictions = {"a": "Positive", "b": "Negative", "c": "Positive"}
    assert sorted(a["uuid"] for a in answers) == ["a", "a", "b", "c"]
    assert all(set(a) == {"uuid", "prediction"} and a["prediction"] == predictions[a["uuid"]] for a in answers)
    assert sorted(d["message"] for d in dead) == sorted(BAD)
    assert {d["message"]: d["reason"] for d in dead}[BAD[2]] == "missing or malformed: hour"
    # Nothing new: nothing is answered again. Something new: only that is.
    assert len(run(spark, trained.model, tmp_path)[0]) == 4
    (tmp_path / "in" / "2.txt").write_text(request("z") + "\n")
    answers, dead = run(spark, trained.model, tmp_path)
    assert len(answers) == 5 and len(dead) == len(BAD)


def test_stream_gives_what_the_batch_gives(spark, trained, tmp_path):
    rng = random.Random(2)
    bodies = [request(str(i), hour=rng.randint(0, 23), online_age=rng.uniform(0, 99)) for i in range(200)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join(bodies) + "\n")
    answers, _ = run(spark, trained.model, tmp_path)
    parsed = scoring.parse_requests(spark.createDataFrame([(b,) for b in bodies], "value string"))
    batch = training.score(trained.model, parsed).collect()
    assert {a["uuid"]: a["prediction"] for a in answers} == {r.uuid: r.predicted for r in batch}


def test_a_failing_batch_stops_the_query_and_is_repeated_once(spark, trained, tmp_path):
    """A sink that fails in the second batch: the restart answers that batch, and no other again."""
    class Failing(Sink):
        def write(self, rows, batch_id):
            if batch_id == 1 and not (tmp_path / "mended").exists():
                raise OSError("sink is gone")
            super().write(rows, batch_id)

    (tmp_path / "in").mkdir()

    def serve():
        scoring.start_scoring(
            read_messages(spark, "text", path=f"{tmp_path}/in"), trained.model,
            Failing("text", f"{tmp_path}/out"), Sink("text", f"{tmp_path}/dead"),
            f"{tmp_path}/checkpoint", trigger={"availableNow": True},
        ).awaitTermination()
        return sorted(json.loads(r.value)["uuid"] for r in spark.read.text(f"{tmp_path}/out").collect())

    (tmp_path / "in" / "1.txt").write_text(request("a") + "\n")
    assert serve() == ["a"]
    (tmp_path / "in" / "2.txt").write_text(request("b") + "\n")
    with pytest.raises(Exception, match="sink is gone"):
        serve()
    assert [json.loads(r.value)["uuid"] for r in spark.read.text(f"{tmp_path}/out").collect()] == ["a"]
    (tmp_path / "mended").write_text("")
    assert serve() == ["a", "b"] and serve() == ["a", "b"]
