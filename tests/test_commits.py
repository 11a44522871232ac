import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from millrace.schemas import CELL
from millrace.session import Folder, fresh_dir
from millrace.sinks import commits
from millrace.sinks.cells import CellTable
from millrace.sinks.commits import CommitLog, Entry


def cells(spark, value, keys=3, first=0):
    return spark.range(first, keys).select(
        F.col("id").cast("string").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit(1).cast("bigint").alias("ts_micros"), F.lit(value).cast("binary").alias("value"),
    )


def values(frame):
    return {r["row_key"]: bytes(r["value"]).decode() for r in frame.collect()}


def test_a_merge_beside_a_batch_that_is_being_written_loses_nothing(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    table.write(cells(spark, "a"), 0)
    half_done = table.stage(cells(spark, "b", 2), 1)
    os.makedirs(f"{table.path}/cells/00000000-{2:020d}-x/_temporary")  # another one, begun and never ended
    table.merge()
    assert values(table.read()) == {"0": "a", "1": "a", "2": "a"}
    table.commit(half_done, 1)
    assert values(table.read()) == {"0": "b", "1": "b", "2": "a"}
    table.merge()
    table.write(cells(spark, "a", 5), 0)  # a replay of a batch that was merged: batch 1 still wins where it wrote
    assert values(table.read()) == {"0": "b", "1": "b", "2": "a", "3": "a", "4": "a"}
    assert values(table.read(1)) == {"0": "a", "1": "a", "2": "a"}


def test_readers_outlive_merges_until_vacuum(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    for number in range(3):
        table.write(cells(spark, str(number), 3 - number), number)
    pinned, version = table.read(), table.version()
    table.merge()
    table.write(cells(spark, "new", 4), 3)
    table.merge()
    assert values(pinned) == values(table.read(version)) == {"0": "2", "1": "1", "2": "0"}
    assert values(table.read()) == {k: "new" for k in "0123"}
    assert table.vacuum() == []
    time.sleep(0.05)
    assert len(table.vacuum(0)) == 5 and len(os.listdir(f"{table.path}/merged")) == 1 and os.listdir(f"{table.path}/cells") == []
    assert values(table.read()) == {k: "new" for k in "0123"}
    with pytest.raises(ValueError):
        table.read(99)


def test_of_two_merges_of_the_same_batches_one_is_given_up(spark, monkeypatch):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    table.write(cells(spark, "a"), 0)
    table.write(cells(spark, "b", 1), 1)
    plain, inner = CellTable._current, []

    def slow(self, state):
        frame = plain(self, state)
        if not inner:
            inner.append(1)
            CellTable(spark, table.path).merge()
            CellTable(spark, table.path).write(cells(spark, "c", 1), 2)
        return frame

    monkeypatch.setattr(CellTable, "_current", slow)
    table.merge()
    monkeypatch.undo()
    assert table.snapshots() == [0] and table.batches() == [("00000000", 2)]
    assert values(table.read()) == {"0": "c", "1": "a", "2": "a"}


def test_a_failed_write_leaves_no_trace_in_the_table(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    table.write(cells(spark, "a"), 0)
    broken = cells(spark, "b").withColumn("value", F.when(F.col("row_key") == "1", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        table.write(broken, 1)
    assert values(table.read()) == {"0": "a", "1": "a", "2": "a"} and table.batches() == [("00000000", 0)]
    table.write(cells(spark, "b"), 1)
    assert set(values(table.read()).values()) == {"b"} and table.read().columns == CELL.fieldNames()


def test_every_commit_of_several_writers_gets_a_number_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(commits, "STATE_EVERY", 7)
    path = fresh_dir(spark, "log")

    def writer(name):
        log = CommitLog(spark, path)
        for number in range(12):
            log.commit(lambda now, n=number: {"add": [Entry(f"{name}-{n}", {"n": n})], "remove": [f"{name}-{n - 1}"] if n else [], "names": [name]})

    threads = [threading.Thread(target=writer, args=(name,)) for name in "abc"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    log = CommitLog(spark, path)
    assert log.versions() == list(range(36))
    assert log.state().live == {f"{name}-11": {"n": 11} for name in "abc"} and sorted(log.state().names) == ["a", "b", "c"]
    assert any(name.endswith(".state") for name in Folder(spark, f"{path}/log").names())
    whole = [log.state(v) for v in log.versions()]
    monkeypatch.setattr(commits.Folder, "names", lambda self: [f"{v:020d}.json" for v in range(36)])
    assert whole == [log.state(v) for v in range(36)]  # replayed from the first commit on
    assert log.commit(lambda now: None).version == 35


def test_a_taken_number_is_never_overwritten(spark):
    path = fresh_dir(spark, "taken")
    log = CommitLog(spark, path)
    log.commit(lambda now: {"add": [Entry("a")]})
    assert not log._put(f"{0:020d}.json", "{}") and log.state().live == {"a": {}}
    assert [n for n in os.listdir(f"{path}/log") if n.startswith(".") and not n.endswith(".crc")] == []
