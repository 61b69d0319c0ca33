"""The log of keyed tables: races, snapshots, removal, and batches that are repeated."""

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import types as T

from postgrove.schemas import TableContract
from postgrove.sources.commits import CommitLog, Store
from postgrove.sources.keyed import KeyedTable
from postgrove.sources.messages import KeyedSink, Sink, read_messages
from postgrove.streaming import scoring

CONTRACT = TableContract(T.StructType().add("k", T.LongType()).add("n", T.LongType()), ("k",))


def rows(table, snapshot=None):
    return sorted(map(tuple, table.read(snapshot).collect()))


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k bigint, n bigint")


def test_racing_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(i):
        return KeyedTable(spark, path, CONTRACT).upsert(frame(spark, (i, i), (-1, i)))

    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(write, range(12)))
    assert sorted(versions) == list(range(12))
    # The shared key has the row of the writer whose entry came last.
    last = versions.index(11)
    table = KeyedTable(spark, path, CONTRACT)
    assert rows(table) == sorted([(-1, last)] + [(i, i) for i in range(12)])


@pytest.mark.parametrize("local", [True, False])
def test_an_entry_is_created_only_if_absent(spark, tmp_path, local):
    store = Store(spark, str(tmp_path))
    if not local:
        store._local = None  # as on a store that only Hadoop reaches
    (tmp_path / "log").mkdir()
    assert store.create("log/a.json", "1") and not store.create("log/a.json", "2")
    assert store.read("log/a.json") == "1" and set(store.names("log")) - {".a.json.crc"} == {"a.json"}
    log, turns = CommitLog(Store(spark, str(tmp_path / "x"))), []

    def make(seen):
        if not turns:  # another writer is first
            CommitLog(log.store).append(lambda _: {"kind": "rows", "who": "other"})
        turns.append([entry.get("who") for entry in seen])
        return {"kind": "rows", "who": "me"}

    assert log.append(make)["number"] == 1
    assert turns == [[], ["other"]]


def test_an_unfinished_entry_counts_as_empty(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), CONTRACT)
    table.upsert(frame(spark, (1, 1)))
    (tmp_path / "t" / "log" / f"{1:020d}.json").write_text('{"kind": "ro')
    assert rows(table) == [(1, 1)]
    assert table.upsert(frame(spark, (1, 2))) == 1
    assert rows(KeyedTable(spark, str(tmp_path / "t"), CONTRACT)) == [(1, 2)]


def test_readers_keep_their_snapshot_until_folders_are_removed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), CONTRACT)
    table.upsert(frame(spark, (1, 1), (2, 1)))
    table.upsert(frame(spark, (2, 2)))
    before = table.snapshot()
    reading = table.read()
    table.compact()
    table.upsert(frame(spark, (1, 3)))
    assert rows(table, before) == [(1, 1), (2, 2)] == sorted(map(tuple, reading.collect()))
    assert rows(table) == [(1, 3), (2, 2)]
    assert rows(table, table.snapshot(0)) == [(1, 1), (2, 1)]
    # Nothing is old enough; then what the base covers goes, with an upsert that never ended.
    assert table.vacuum() == []
    os.makedirs(tmp_path / "t" / "version=9" / "0" / "_temporary")
    time.sleep(1.1)
    removed = table.vacuum(older_than=1)
    assert {name.split("/")[0] for name in removed} == {"version=0", "version=1", "version=9"}
    assert rows(table) == [(1, 3), (2, 2)] == rows(KeyedTable(spark, str(tmp_path / "t"), CONTRACT))
    assert len(list((tmp_path / "t" / "log").glob("[0-9]*.json"))) == 2
    assert table.upsert(frame(spark, (5, 5))) == 3


def test_an_upsert_beside_a_fold_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    table, other = KeyedTable(spark, path, CONTRACT), KeyedTable(spark, path, CONTRACT)
    table.upsert(frame(spark, (1, 1), (2, 1)))
    append = table.log.append

    def late(make):
        # While the base is written, another writer upserts and a second fold is done.
        other.upsert(frame(spark, (2, 2)))
        other.compact()
        return append(make)

    table.log.append = late
    table.compact()
    assert rows(KeyedTable(spark, path, CONTRACT)) == [(1, 1), (2, 2)]


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), CONTRACT)
    table.upsert(frame(spark, (1, 1)))
    with pytest.raises(Exception, match="NULL in key column k"):
        table.upsert(frame(spark, (1, 9), (None, 2)))
    assert rows(table) == [(1, 1)] and table.snapshot().number == 0


def test_a_writers_batch_is_written_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), CONTRACT)
    assert table.upsert(frame(spark, (1, 1)), writer="a", batch=0) == 0
    assert table.upsert(frame(spark, (1, 7)), writer="a", batch=0) == -1
    assert table.upsert(frame(spark, (2, 2)), writer="b", batch=0) == 1
    table.compact()
    assert table.upsert(frame(spark, (1, 7)), writer="a", batch=0) == -1
    assert table.upsert(frame(spark, (1, 3)), writer="a", batch=1) == 2
    assert rows(table) == [(1, 3), (2, 2)]
    with pytest.raises(ValueError):
        table.upsert(frame(spark, (1, 1)), writer="a")


TEXTS = TableContract(T.StructType().add("value", T.StringType()).add("n", T.LongType()), ("value",))


def test_a_repeated_batch_of_a_stream_is_found_in_the_log(spark, tmp_path):
    """The stream dies after its table has the batch; after the restart the batch is not written again."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("x\ny\n")
    sink = KeyedSink(KeyedTable(spark, str(tmp_path / "t"), TEXTS))
    fails = [True]

    def handle(batch, number):
        sink.write(batch.selectExpr("value", "1 as n"), number)
        if fails.pop() if fails else False:
            raise OSError("gone after the commit")

    def stream():
        read_messages(spark, "text", path=f"{tmp_path}/in").writeStream.foreachBatch(handle).option(
            "checkpointLocation", f"{tmp_path}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="gone after the commit"):
        stream()
    stream()
    assert sink.table.snapshot().number == 0 and list(sink.table.snapshot().batches.values()) == [0]
    assert sorted(r.value for r in sink.table.read().collect()) == ["x", "y"]


def test_a_request_sent_twice_is_scored_once(spark, tmp_path):
    """In one batch, in a later one, and after a restart; what has no uuid is told apart by its text."""
    def request(i, **more):
        body = {"uuid": i, "hour": 3, "dayofweek": 2, "online_age": 13, "candidate": "x", "language": "y"}
        return json.dumps(body | more)

    (tmp_path / "in").mkdir()
    seen = []

    def stream():
        arriving = read_messages(spark, "text", "arrived", path=f"{tmp_path}/in")
        scoring.each_once(arriving, "arrived", "2 hours").writeStream.foreachBatch(
            lambda batch, _: seen.extend(row.value for row in batch.collect())
        ).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    (tmp_path / "in" / "1.txt").write_text("\n".join([request("a"), request("a"), request("b"), "no json", "{"]) + "\n")
    stream()
    assert sorted(seen) == sorted([request("a"), request("b"), "no json", "{"])
    (tmp_path / "in" / "2.txt").write_text("\n".join([request("b", hour=5), request("c"), "[]"]) + "\n")
    stream()
    assert sorted(seen[4:]) == sorted([request("c"), "[]"])
