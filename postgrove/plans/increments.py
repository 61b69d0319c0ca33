"""Result tables that follow new posts, without counting old ones again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from postgrove.functions.labels import row_uuid
from postgrove.operators.series import count_nonnull, cumulative_of_counts
from postgrove.operators.pivot import conditional_pivot, largest_first
from postgrove.plans import reports
from postgrove.schemas import CONTRACTS, TableContract
from postgrove.sources.keyed import SummedTable

_STATE = T.StructType([field for field in CONTRACTS["state"].schema if field.name != "id"])
_DAYS = (
    T.StructType().add("language", T.StringType()).add("date", T.StringType()).add("posts", T.LongType())
)


def _null_allowed(schema: T.StructType, *keys: str) -> TableContract:
    """Posts without a region, language or day are counted like any others."""
    return TableContract(schema, keys, keys)


# What is added up for each report, and the counts that new posts bring.
CLEAN_COUNTS: dict[str, tuple[TableContract, Callable[[DataFrame], DataFrame]]] = {
    "hour": (_null_allowed(CONTRACTS["hour"].schema, "hour"), reports.hourly_counts),
    "state": (
        _null_allowed(_STATE, "state"),
        lambda posts: conditional_pivot(posts, ["state"], {"candidate": reports.CANDIDATES}, total="total"),
    ),
}
ENRICHED_COUNTS: dict[str, tuple[TableContract, Callable[[DataFrame], DataFrame]]] = {
    "language": (_null_allowed(CONTRACTS["language"].schema, "language"), reports.language_counts),
    "state_analyze": (_null_allowed(CONTRACTS["state_analyze"].schema, "state"), reports.state_sentiment_counts),
    "days": (
        _null_allowed(_DAYS, "language", "date"),
        lambda posts: count_nonnull(posts, ["language", "date"], "tweet", "posts"),
    ),
}


class ReportCounts:
    """Counts of all posts so far, for the reports on clean and on enriched posts.

    New posts are counted once and their counts added to tables of one row per
    cell; a report reads those tables. Days are kept as counts per day, so a running
    total may cover any span, and a late post for an early day raises all
    days after it. A batch of a writer that is added again after a failure adds
    only what is still missing, table by table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.tables = {
            name: SummedTable(spark, f"{path.rstrip('/')}/{name}", contract)
            for name, (contract, _) in (CLEAN_COUNTS | ENRICHED_COUNTS).items()
        }

    def add_clean(self, posts: DataFrame, writer: str | None = None, batch: int | None = None) -> None:
        """Count new clean posts."""
        self._add(CLEAN_COUNTS, posts, writer, batch)

    def add_enriched(self, posts: DataFrame, writer: str | None = None, batch: int | None = None) -> None:
        """Count new posts with language and sentiment."""
        self._add(ENRICHED_COUNTS, posts, writer, batch)

    def _add(self, counts, posts: DataFrame, writer: str | None, batch: int | None) -> None:
        # All counts of one batch come from one reading of it.
        posts = posts.persist()
        try:
            for name, (_, counted) in counts.items():
                self.tables[name].upsert(counted(posts), writer=writer, batch=batch)
        finally:
            posts.unpersist()

    def follow_clean(self, posts: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Count a stream of clean posts as they come."""
        return self._follow(self.add_clean, posts, checkpoint, trigger)

    def follow_enriched(self, posts: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Count a stream of posts with language and sentiment as they come."""
        return self._follow(self.add_enriched, posts, checkpoint, trigger)

    def _follow(self, add, posts: DataFrame, checkpoint: str, trigger: dict | None) -> StreamingQuery:
        def handle(batch: DataFrame, number: int) -> None:
            add(batch, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), number)

        return (
            posts.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start()
        )

    def hourly_counts(self) -> DataFrame:
        return self.tables["hour"].read().orderBy("hour")

    def state_counts(self) -> DataFrame:
        return self.tables["state"].read().withColumn("id", row_uuid(F.col("state")))

    def language_counts(self) -> DataFrame:
        return largest_first(self.tables["language"].read(), "total", "language")

    def state_sentiment_counts(self) -> DataFrame:
        return largest_first(self.tables["state_analyze"].read(), "total", "state")

    def cumulative_by_language(
        self, start: str = reports.FIRST_DAY, end: str = reports.LAST_DAY
    ) -> DataFrame:
        return cumulative_of_counts(self.tables["days"].read(), "language", start, end, "posts")

    def compact(self) -> None:
        """Fold the counts of all increments into one row per cell."""
        for table in self.tables.values():
            table.compact()
