"""Result tables with upsert by business key, on plain Parquet."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.schemas import TableContract
from postgrove.sources.commits import CommitLog, Entry, Store


@dataclass(frozen=True)
class Snapshot:
    """The folders that make up a table after one entry of its log."""

    number: int
    base: str | None
    base_version: int
    # Folders of versions after the base, the winner of each.
    parts: tuple[tuple[int, str], ...]
    # The last batch of every writer that numbers its batches.
    batches: dict[str, int]

    @property
    def newest(self) -> int:
        """-1 for a table without any version."""
        return max([self.base_version, *(version for version, _ in self.parts)])

    @property
    def folders(self) -> set[str]:
        return {folder for _, folder in self.parts} | ({self.base} if self.base else set())


class KeyedTable:
    """A table in which a later row replaces an earlier one with the same key.

    Every upsert writes a folder of its own that never changes, and then adds an
    entry to the table's log; reading takes the newest row of each key from the
    folders the log names. So an upsert costs what it brings, not what the table
    holds; any number of writers may work at once, as each waits only for its entry;
    and what a reader has begun to read stays as it was. An upsert that
    fails leaves no entry. ``compact`` folds all versions so far into one base, after
    which readers read only that and newer versions. ``vacuum`` removes folders that no
    recent reader can be using.
    """

    def __init__(self, spark: SparkSession, path: str, contract: TableContract):
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.store = Store(spark, self.path)
        self.log = CommitLog(self.store)

    def upsert(
        self, df: DataFrame, version: int | None = None, writer: str | None = None, batch: int | None = None
    ) -> int:
        """Write ``df`` as ``version``, by default the next one; higher versions win over lower ones.

        A version that is given and repeated replaces what it had brought. A ``writer``
        that numbers its batches upwards has each of them once: a batch that is
        in the log is not written again. Returns the version, -1 for such a batch.
        """
        if version is not None and version < 0:
            raise ValueError("version must not be negative")
        if (writer is None) != (batch is None):
            raise ValueError("a writer numbers its batches")
        now = self.snapshot()
        self._check(now, version)
        if writer is not None and now.batches.get(writer, -1) >= batch:
            return -1
        columns = [self._checked(field) for field in self.contract.schema]
        shown = now.newest + 1 if version is None else version
        folder = f"version={shown}/{uuid.uuid4().hex}"
        df.select(*columns).write.parquet(f"{self.path}/{folder}")

        def entry(seen: list[Entry]) -> Entry | None:
            # As others may have been first, all is looked at again.
            now = self._after(seen)
            self._check(now, version)
            if writer is not None and now.batches.get(writer, -1) >= batch:
                return None
            made = {"kind": "rows", "folder": folder, "version": now.newest + 1 if version is None else version}
            return made if writer is None else made | {"writer": writer, "batch": batch}

        done = self.log.append(entry)
        return -1 if done is None else done["version"]

    def _check(self, now: Snapshot, version: int | None) -> None:
        if version is not None and now.base is not None and version <= now.base_version:
            raise ValueError(f"version {version} is already folded into base {now.base_version}")

    def _checked(self, field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if field.name in self.contract.keys and field.name not in self.contract.null_keys:
            message = F.lit(f"NULL in key column {field.name}")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        return value.alias(field.name)

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The table as it is, or as it was after the log's entry of that number."""
        seen = self.log.entries()
        return self._after([entry for entry in seen if number is None or entry["number"] <= number])

    def _after(self, seen: list[Entry]) -> Snapshot:
        bases = [entry for entry in seen if entry["kind"] == "base"]
        # Of two that folded at the same time the one that folded more counts.
        base = max(bases, key=lambda entry: (entry["upto"], entry["number"]), default=None)
        upto = -1 if base is None else base["upto"]
        parts: dict[int, str] = {}
        batches = {} if base is None else dict(base["batches"])
        for entry in seen:
            if entry["kind"] == "rows" and entry["number"] > upto:
                parts[entry["version"]] = entry["folder"]
                if "writer" in entry:
                    batches[entry["writer"]] = max(entry["batch"], batches.get(entry["writer"], -1))
        return Snapshot(
            seen[-1]["number"] if seen else -1,
            None if base is None else base["folder"],
            -1 if base is None else base["version"],
            tuple(sorted(parts.items())),
            batches,
        )

    def compact(self) -> None:
        """Fold everything into a new base; does nothing if there is nothing to fold."""
        now = self.snapshot()
        if not now.parts:
            return
        folder = f"base-{now.newest}/{uuid.uuid4().hex}"
        self.read(now).write.parquet(f"{self.path}/{folder}")
        made = {"kind": "base", "folder": folder, "version": now.newest, "upto": now.number, "batches": now.batches}
        self.log.append(lambda seen: made)

    def vacuum(self, older_than: float = 7 * 24 * 3600) -> list[str]:
        """Remove folders that have not been part of the table for ``older_than`` seconds, and their entries.

        Readers that began before that may lose their files. So may an upsert that takes
        longer than that to write. Returns the folders.
        """
        limit = time.time() - older_than
        seen = self.log.entries()
        now = self._after(seen)
        needed = set(now.folders)
        left: list[Entry] = []
        for i, entry in enumerate(seen):
            # What was part of the table after this entry was so until the next one.
            ended = seen[i + 1].get("time", time.time()) if i + 1 < len(seen) else time.time()
            if ended >= limit:
                needed |= self._after(seen[: i + 1]).folders
            elif entry.get("folder") not in needed and i + 1 < len(seen):
                left.append(entry)
        removed = []
        for above in self.store.names():
            if above.startswith(("version=", "base-")):
                for name, changed in self.store.names(above).items():
                    if f"{above}/{name}" not in needed and changed < limit:
                        self.store.remove(f"{above}/{name}")
                        removed.append(f"{above}/{name}")
        for entry in left:
            if entry.get("folder") not in needed:
                self.log.remove(entry)
        return removed

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The newest row of every key; NULL is a key like any other where the contract allows it."""
        now = self.snapshot() if snapshot is None else snapshot
        names = self.contract.schema.fieldNames()
        reader = self.spark.read.schema(self.contract.schema)
        parts = []
        if now.base is not None:
            base = reader.parquet(f"{self.path}/{now.base}")
            parts.append(base.withColumn("version", F.lit(now.base_version).cast("long")))
        if now.parts:
            rows = reader.parquet(*(f"{self.path}/{folder}" for _, folder in now.parts))
            own = [(folder.split("/")[1], version) for version, folder in now.parts]
            versions = self.spark.createDataFrame(own, "_folder string, version bigint")
            folder = F.regexp_extract("_metadata.file_path", "/([0-9a-f]{32})/[^/]*$", 1)
            placed = rows.select("*", folder.alias("_folder")).join(F.broadcast(versions), "_folder")
            parts.append(placed.select(*names, "version"))
        if not parts:
            return self.spark.createDataFrame([], self.contract.schema)
        rows = reduce(DataFrame.unionByName, parts)
        if not now.parts:
            return rows.select(*names)
        keys = list(self.contract.keys)
        return self._joined(rows, keys, [name for name in names if name not in keys]).select(*names)

    def _joined(self, rows: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
        """One row per key from those of all versions."""
        newest = rows.groupBy(*keys).agg(F.max(F.struct("version", *rest)).alias("_row"))
        return newest.select(*keys, *(F.col(f"_row.{name}").alias(name) for name in rest))


class SummedTable(KeyedTable):
    """A table in which the numbers of rows with the same key add up.

    An upsert brings what is to be added, so counts follow new rows at the cost of
    those rows. Sums do not depend on the order of versions; what must not
    be added twice is written as a numbered batch of a writer.
    """

    def _joined(self, rows: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in rest))
