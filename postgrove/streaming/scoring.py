"""Endless scoring of request messages."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from postgrove.functions.codec import decode_one_object, encode_json
from postgrove.plans.models import ModelFolder
from postgrove.plans.training import PREDICTED, score
from postgrove.schemas import SCORE_REQUEST
from postgrove.sources.messages import KeyedSink, Sink, once


def parse_requests(messages: DataFrame) -> DataFrame:
    """Request fields of each message, and why it cannot be scored, if so.

    A message is one JSON object and nothing besides. NaN and infinite numbers
    count as missing, so every message has an answer or a reason.
    """
    request = decode_one_object(F.col("value"), SCORE_REQUEST)
    parsed = messages.select("value", request.alias("_request"))

    def missing_field(field: T.StructField) -> Column:
        value = F.col(f"_request.{field.name}")
        gone = value.isNull()
        if isinstance(field.dataType, T.DoubleType):
            gone = gone | F.isnan(value) | (F.abs(value) == float("inf"))
        return F.when(gone, F.lit(field.name))

    missing = F.array_compact(F.array(*(missing_field(field) for field in SCORE_REQUEST)))
    reason = F.when(
        F.size(missing) > 0, F.concat(F.lit("missing or malformed: "), F.array_join(missing, ", "))
    )
    return parsed.select("value", reason.alias("reason"), "_request.*")


def answered(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """(uuid, prediction) for every request that can be scored."""
    scored = score(model, requests.where(F.col("reason").isNull()).drop("value", "reason"))
    return scored.select("uuid", F.col(PREDICTED).alias("prediction"))


def responses(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """``{"uuid", "prediction"}`` for every request that can be scored."""
    return answered(requests, model).select(encode_json("uuid", "prediction").alias("value"))


def each_once(messages: DataFrame, arrived: str, within: str = "1 hour") -> DataFrame:
    """Messages without those whose ``uuid`` came before, within that time; see :func:`once`."""
    key = decode_one_object(F.col("value"), SCORE_REQUEST)["uuid"]
    return once(messages, key, arrived, within).select("value")


def rejects(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("reason").isNotNull()).select(
        encode_json(F.col("value").alias("message"), "reason").alias("value")
    )


def start_scoring(
    messages: DataFrame,
    model: PipelineModel | ModelFolder,
    answers: Sink | KeyedSink,
    dead_letters: Sink,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a stream of messages; those that cannot be scored go to a sink of their own.

    All pending messages of a micro-batch are scored in parallel by the model
    loaded once; of a folder of models, by the version in use when the batch begins. A restart goes on from the checkpoint. A keyed sink has one answer for
    each ``uuid``, however often a request is sent or a batch repeated.
    """
    made = answered if isinstance(answers, KeyedSink) else responses

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = model.newest()[1] if isinstance(model, ModelFolder) else model
        requests = parse_requests(batch).persist()
        try:
            answers.write(made(requests, now), batch_id)
            dead_letters.write(rejects(requests), batch_id)
        finally:
            requests.unpersist()

    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


class Progress(StreamingQueryListener):
    """Counts of what streams have done, by the id their checkpoint keeps; ``failures`` by its error.

    Add it with ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self.batches: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self.failures: list[str] = []

    def onQueryStarted(self, event) -> None:
        self.batches.setdefault(str(event.id), 0)
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        stream = str(event.progress.id)
        if event.progress.numInputRows:
            self.batches[stream] = self.batches.get(stream, 0) + 1
            self.rows[stream] = self.rows.get(stream, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)


def keep_running(
    start: Callable[[], StreamingQuery], restarts: int = 5, wait: float = 1.0, longest: float = 60.0,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run a stream to its end, starting it again from its checkpoint after a failure of source, task or sink.

    It is started again at most ``restarts`` times in a row without a finished batch in between, after a wait that
    doubles from ``wait`` to ``longest`` seconds; then the failure is raised. Returns how often it was.
    """
    in_row = times = 0
    while True:
        query = None
        try:
            query = start()
            query.awaitTermination()
            return times
        except StreamingQueryException:
            # A source that cannot be reached fails before the first batch, or in any later one.
            done = query is not None and any(x.numInputRows for x in query.recentProgress)
            in_row = 1 if done else in_row + 1
            if in_row > restarts:
                raise
            times += 1
            sleep(min(wait * 2 ** (in_row - 1), longest))
