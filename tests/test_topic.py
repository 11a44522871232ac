import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from millrace.plans import flows
from millrace.session import Folder, fresh_dir
from millrace.sources import topic
from millrace.sources.events import SourceOptions, read_events
from millrace.streaming.running import append_to_files, run_to_end

TRANSPORT = "event_id string, attributes map<string,string>, payload binary, event_ts timestamp"
AT = dt.datetime(2024, 1, 1)


def arrivals(spark, folder, rows):
    """Add a file of transports (id, payload) to a folder that a stream reads."""
    made = [(k, {"n": str(k)}, v, AT) for k, v in rows]
    spark.createDataFrame(made, TRANSPORT).coalesce(1).write.mode("append").parquet(folder)
    return read_events(spark, SourceOptions(path=folder, schema=spark.read.parquet(folder).schema))


def records(spark, path, **options):
    return topic.read_topic_log(spark, path, **options).orderBy("partition", "offset").collect()


def test_records_come_back_with_offsets_and_headers(spark):
    inbox, path = fresh_dir(spark, "inbox"), fresh_dir(spark, "t") + "/orders"
    rows = [("a", b"1"), ("b", None), (None, b"3"), ("a", b"4"), ("é", b"\x00\xff")]
    run_to_end(flows.write_topic(arrivals(spark, inbox, rows), path, fresh_dir(spark, "c"), 3), spark)
    got = records(spark, path)
    assert sorted((r.key and r.key.decode(), r.value) for r in got if r.key) == sorted(((k, v) for k, v in rows if k), key=str)
    assert {r.topic for r in got} == {"orders"} and all(r.timestamp == AT and r.timestampType == 0 for r in got)
    assert all(r.headers == [("n", str(r.key.decode() if r.key else None).encode())] for r in got)
    assert [r.value for r in got if r.key == b"a"] == [b"1", b"4"]
    for p in {r.partition for r in got}:
        assert [r.offset for r in got if r.partition == p] == list(range(sum(r.partition == p for r in got)))


def test_readers_go_on_where_they_stopped(spark):
    inbox, path = fresh_dir(spark, "inbox"), fresh_dir(spark, "t") + "/orders"
    checkpoint, reading, out = fresh_dir(spark, "c"), fresh_dir(spark, "c"), fresh_dir(spark, "out")
    for turn in range(3):
        stream = arrivals(spark, inbox, [(f"{turn}-{n}", b"x") for n in range(20)])
        run_to_end(flows.write_topic(stream, path, checkpoint, 4), spark)
        read = read_events(spark, SourceOptions("topic", path))
        append_to_files(read, spark, "seen", path=out, checkpoint=reading)
        assert spark.read.parquet(out).count() == 20 * (turn + 1)
    assert spark.read.parquet(out).select("event_id").distinct().count() == 60
    times = [r.timestamp for r in topic.read_topic_log(spark, path, timestampType="LOG_APPEND_TIME").orderBy("partition", "offset").filter("partition = 0").collect()]
    assert times == sorted(times) and len(set(times)) == 3


def test_a_batch_that_is_replayed_adds_nothing(spark):
    inbox, path, checkpoint = fresh_dir(spark, "inbox"), fresh_dir(spark, "t") + "/orders", fresh_dir(spark, "c")
    run_to_end(flows.write_topic(arrivals(spark, inbox, [("a", b"1"), ("b", b"2")]), path, checkpoint, 2), spark)
    before = records(spark, path)
    for name in ("0", ".0.crc"):  # the query died after the topic's commit and before its own
        Folder(spark, f"{checkpoint}/commits/{name}").remove()
    stream = arrivals(spark, inbox, [("c", b"3")])
    run_to_end(flows.write_topic(stream, path, checkpoint, 2), spark)
    after = records(spark, path)
    assert sorted(r.key for r in after) == [b"a", b"b", b"c"]
    assert [r for r in after if r.key != b"c"] == before
    orphans = len([n for n in Folder(spark, f"{path}/segments").names() if n.endswith(".parquet")])
    assert orphans > len(list(topic.TopicLog(Folder(spark, path).qualified()).segments({}, {"0": 99, "1": 99})))


def test_failed_tasks_leave_no_records(spark):
    inbox, path = fresh_dir(spark, "inbox"), fresh_dir(spark, "t") + "/orders"
    stream = arrivals(spark, inbox, [("a", b"1"), ("bad", b"2")])
    broken = stream.withColumn("payload", F.when(F.col("event_id") == "bad", F.raise_error(F.lit("no"))).otherwise(F.col("payload")).cast("binary"))
    checkpoint = fresh_dir(spark, "c")
    with pytest.raises(Exception, match="no"):
        run_to_end(flows.write_topic(broken, path, checkpoint, 1), spark)
    assert records(spark, path) == []
    run_to_end(flows.write_topic(stream, path, checkpoint, 1), spark)
    assert [(r.key, r.offset) for r in records(spark, path)] == [(b"a", 0), (b"bad", 1)]


def test_ranges_start_where_asked_and_split(spark):
    inbox, path = fresh_dir(spark, "inbox"), fresh_dir(spark, "t") + "/orders"
    for turn in range(3):
        folder = f"{inbox}/{turn}"
        run_to_end(flows.write_topic(arrivals(spark, folder, [(str(n), b"x") for n in range(50)]), path, fresh_dir(spark, "c"), 1), spark)
    got = records(spark, path, startingOffsets=json.dumps({"0": 70}), rowsPerTask="30")
    assert [r.offset for r in got] == list(range(70, 150))
    read = topic.read_topic_log(spark, path, startingOffsets='{"0": 70}', rowsPerTask="30")
    assert read.rdd.getNumPartitions() == 3  # 70-100, 100-130, 130-150
    assert records(spark, path, startingOffsets="latest") == []
    with pytest.raises(Exception, match="time type"):
        records(spark, path, timestampType="never")


def test_writers_that_race_get_offsets_of_their_own(tmp_path):
    log = topic.TopicLog(f"file:{tmp_path}/t")
    writers = [threading.Thread(target=lambda w=w: [log.append([(f"s{w}-{b}", 0, 5)], f"w{w}", b) for b in range(10)]) for w in range(4)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    found = sorted(s.base for s in log.segments({}, {"0": 10_000}))
    assert found == list(range(0, 200, 5)) and log.ends() == {"0": 200}
    assert not log.append([("again", 0, 5)], "w1", 9)


def test_empty_topic(spark):
    path = fresh_dir(spark, "t") + "/none"
    assert records(spark, path) == []
    assert topic.stream_topic_log(spark, path).isStreaming
