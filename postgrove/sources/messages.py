"""Message topics as streaming sources and per-batch sinks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postgrove.sources.keyed import KeyedTable


def read_messages(spark: SparkSession, source: str, arrived: str | None = None, **options: str) -> DataFrame:
    """A stream of message texts in one column ``value``.

    ``source`` is "kafka" for a topic, read from its start on the first run and
    from the checkpoint afterwards, or "text" for a folder of JSON lines. ``arrived``
    names a column for the time a message came: the topic's, or that of its file.
    """
    if source == "kafka":
        options = {"startingOffsets": "earliest"} | options
    stream = spark.readStream.format(source).options(**options).load()
    value = F.col("value").cast("string").alias("value")
    if arrived is None:
        return stream.select(value)
    moment = F.col("timestamp" if source == "kafka" else "_metadata.file_modification_time")
    return stream.select(value, moment.alias(arrived))


def once(messages: DataFrame, key: Column, arrived: str, within: str) -> DataFrame:
    """Of messages with the same ``key`` that come ``within`` that time of each other, the first.

    Keys are remembered for that time only, by Spark's state store. Messages without
    a key are told apart by their whole text.
    """
    named = messages.withColumn("_key", F.coalesce(key, F.concat(F.lit("-"), F.col("value"))))
    return named.withWatermark(arrived, within).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


@dataclass(frozen=True)
class Sink:
    """Where each micro-batch goes.

    With a ``path`` every batch has its own folder, so a batch that is repeated
    after a failure overwrites itself. Without one, rows are appended: at least
    once.
    """

    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.format(self.format).options(**self.options)
        if self.path is None:
            writer.mode("append").save()
        else:
            writer.mode("overwrite").save(f"{self.path.rstrip('/')}/batch={batch_id}")


@dataclass(frozen=True)
class KeyedSink:
    """A keyed table each micro-batch is upserted into, so that every key has one row.

    A batch that is repeated after a failure is found in the table's log and not
    written again. The stream's id, which its checkpoint keeps, tells its batches from those of
    other streams, so several may fill one table, and a stream that starts anew upserts
    the same keys again.
    """

    table: KeyedTable

    def write(self, batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        self.table.upsert(batch, writer=stream, batch=None if stream is None else batch_id)
