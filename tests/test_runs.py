"""Sinks over several queries, rows without event time, lateness of one's own, and strict payloads."""

import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cells import cells_or_failed, group_cells
from millrace.operators.decode import decode, decode_or_fail
from millrace.operators.outcome import with_event_time
from millrace.operators.windows import count_windows, typed_results
from millrace.plans import flows
from millrace.plans.config import Aggregation, TableOptions, distinct_names, duration, parse_aggregations
from millrace.schemas import ERROR, TRANSPORT
from millrace.session import fresh_dir
from millrace.sinks.cells import CellTable
from millrace.sinks.files import WindowedFiles
from millrace.sources.events import first_headers, topic_transports
from millrace.sources.generator import GeneratorOptions, generate
from millrace.streaming.panes import count_panes
from millrace.streaming.running import finish, read_arrivals, run_batches, stage_arrivals, start_batches

K = T.StructType([T.StructField("k", T.LongType())])


def topic(spark, rows):
    """Rows (id, payload, seconds or None) as a stream."""
    path = fresh_dir(spark, "topic")
    made = [(str(i), {}, bytearray(p.encode()), None if s is None else datetime.fromtimestamp(s)) for i, p, s in rows]
    spark.createDataFrame(made, TRANSPORT).repartition(1).write.parquet(path)
    return spark.readStream.schema(TRANSPORT).parquet(path)


def stored(table, spark):
    return sorted(r["k"] for r in table.read(K).collect())


def test_second_ingest_adds_to_the_first(spark):
    options = TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once")
    for first in (1, 100):
        table = flows.ingest(spark, topic(spark, [(n, f'{{"k": {n}}}' if n % 5 else "bad", None) for n in range(first, first + 9)]), options, K)
    assert stored(table, spark) == [n for first in (1, 100) for n in range(first, first + 9) if n % 5]
    assert table.read_errors(ERROR).count() == 3


def test_the_function_sees_each_event_once(spark):
    seen = tempfile.mkdtemp(prefix="calls-")

    def noted(event):
        with open(f"{seen}/{os.getpid()}", "a") as out:
            out.write(event["event_id"] + "\n")
        if event["event_id"] == "3":
            raise ValueError("three")
        return event

    options = TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once")
    table = flows.ingest(spark, topic(spark, [(n, f'{{"k": {n}}}', None) for n in range(20)]), options, K, event_transform=noted)
    calls = [line for name in os.listdir(seen) for line in open(f"{seen}/{name}").read().split()]
    assert sorted(map(int, calls)) == list(range(20))
    assert stored(table, spark) == [n for n in range(20) if n != 3]
    assert [(r["event_id"], r["stage"]) for r in table.read_errors(ERROR).collect()] == [("3", "transform")]


def test_frame_transform_passes_dead_letters_by(spark):
    options = TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once")
    body = F.concat(F.lit('{"k": 7'), F.col("event_id"), F.lit("}")).cast("binary")
    table = flows.ingest(
        spark, topic(spark, [(n, "x", None) for n in range(3)]), options, K, frame_transform=lambda df: df.withColumn("payload", body)
    )
    assert stored(table, spark) == [70, 71, 72]


def cell(spark, key, value, ts=1):
    return spark.range(1).select(
        F.lit(key).alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit(ts).cast("bigint").alias("ts_micros"), F.lit(value).cast("binary").alias("value"),
    )


def test_later_runs_win_and_snapshots_hold_all_runs(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    counts = {}
    for run in range(3):
        def handle(batch, number, run=run):
            table.write(cell(spark, "same", f"run {2 - run}").unionByName(cell(spark, f"own {run}", "x")), number)

        run_batches(topic(spark, [(1, "x", None)]), spark, "cells", handle)
        if run == 1:
            table.merge()
        counts[run] = {r["row_key"]: bytes(r["value"]).decode() for r in table.read().collect()}
    assert counts[0]["same"] == "run 2" and counts[2] == {"same": "run 0", "own 0": "x", "own 1": "x", "own 2": "x"}


def test_cell_table_stays_small_and_capped(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"), versions=2, merge_every=4, keep_seconds=0)
    for number in range(9):
        table.write(cell(spark, "a", f"v{number}", number), number)
        assert len(table.batches()) < 4 and len(table.snapshots()) <= 1
        assert len(os.listdir(f"{table.path}/merged")) <= 1 if os.path.exists(f"{table.path}/merged") else True
    assert sorted(r["ts_micros"] for r in table.read().collect()) == [7, 8]
    table.write(cell(spark, "a", "replayed", 8), 7)  # a replay of what a snapshot holds changes nothing
    assert sorted(bytes(r["value"]).decode() for r in table.read().collect()) == ["v7", "v8"]


def test_write_order_beats_value_order(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    both = cell(spark, "a", "zz").withColumn("write_order", F.lit(1)).unionByName(cell(spark, "a", "aa").withColumn("write_order", F.lit(2)))
    table.write(both, 0)
    assert bytes(table.read().first()["value"]) == b"aa"
    listed = group_cells(both.withColumns({c: F.lit(None).cast("timestamp") for c in ("window_start", "window_end")})).first()["cells"]
    assert [bytes(c["value"]) for c in listed] == [b"aa"]


def hours(spark, numbers):
    return spark.createDataFrame([(str(n), datetime.fromtimestamp(3600 * n) if n is not None else None) for n in numbers], "value string, event_ts timestamp")


def test_marker_state_rolls_and_passes_to_the_next_query(spark):
    files = WindowedFiles(spark, fresh_dir(spark, "files"), "json", length="1 hour")
    for number in range(8):
        files.write(hours(spark, [number]), number)
        assert len(os.listdir(f"{files.path}/state/query=direct")) <= 2
    assert {r["hour_start"].hour for r in files.markers().collect()} == set(range(7))
    run_batches(topic(spark, [(1, "x", None)]), spark, "files", lambda batch, number: files.write(hours(spark, [8, None]), number))
    assert {r["hour_start"].hour for r in files.markers().collect()} == set(range(8))  # hour 7 was the first query's
    rows = files.read().collect()
    assert len(rows) == 10 and [r["window"] for r in rows if r["value"] == "None"] == ["none"]


def test_rows_without_event_time_are_reported(spark):
    df = spark.createDataFrame([("a", 1, datetime(2024, 1, 1)), ("b", 1, None)], "event_id string, k long, event_ts timestamp")
    both = with_event_time(df)
    assert [r["event_id"] for r in both.ok.collect()] == ["a"]
    row = both.failed.first()
    assert (row["event_id"], row["stage"], row["payload"]) == ("b", "event_time", None)
    assert sum(r["result_long"] for r in count_windows(df, [Aggregation(("k",), 60_000)]).collect()) == 1


def test_names_are_told_apart_by_length(spark):
    entry = lambda length: {"type": "COUNT", "window": {"length": length}, "fields": {"key": "k"}}
    assert [a.name for a in parse_aggregations({"aggregations": [entry("15m"), entry("1h"), entry("90s")]})] == ["count_k_15m", "count_k_1h", "count_k_90s"]
    with pytest.raises(ValueError):
        parse_aggregations({"aggregations": [entry("60m"), entry("1h")]})
    assert [a.name for a in distinct_names([Aggregation(("k",), 1)])] == ["count_k"]
    assert [duration(ms) for ms in (1, 1500, 60_000, 86_400_000)] == ["1ms", "1500ms", "1m", "1d"]


def test_each_aggregation_keeps_its_own_lateness(spark):
    """Minutes 0-2, then 30, then a late row of minute 1: late for a lateness of 10 minutes, not for one of an hour."""
    base = 1_700_000_400
    rows = [(batch, base + 60 * m) for batch, m in ((0, 0), (0, 1), (0, 2), (1, 30), (2, 1), (3, 200))]
    df = spark.createDataFrame(rows, "batch int, second long").withColumn("event_ts", F.timestamp_seconds("second")).withColumn("k", F.lit("a"))
    path = stage_arrivals(df, F.col("batch"))
    wanted = [Aggregation(("k",), 300_000, 600_000), Aggregation(("k",), 600_000, 3_600_000)]
    finals = []
    panes = count_panes(read_arrivals(spark, path, df.schema), wanted)
    query = start_batches(panes, spark, "late", lambda batch, _: finals.extend(batch.filter("is_final").collect()), "update")
    finish(query)
    first = {r["agg_name"]: r["result_long"] for r in finals if r["window_start"].timestamp() == base}
    assert first == {"count_k_5m": 3, "count_k_10m": 4}
    with pytest.raises(ValueError):
        count_windows(read_arrivals(spark, path, df.schema), wanted)


def test_results_without_a_cell_are_dead_letters(spark):
    base = spark.createDataFrame([("a", 1.5)], "k string, v double")
    results = typed_results(base, "n", ["k"], "DOUBLE", F.col("v")).unionByName(typed_results(base, "n", ["k"], "LONG", F.lit(None)))
    both = cells_or_failed(results)
    assert both.ok.count() == 1 and [r["error_class"] for r in both.failed.collect()] == ["MissingValue"]
    narrow = cells_or_failed(results, types=("LONG",))
    assert narrow.ok.count() == 0 and sorted(r["error_class"] for r in narrow.failed.collect()) == ["MissingValue", "UnknownResultType"]


STRICT = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("m", T.MapType(T.StringType(), T.LongType(), False))])


@pytest.mark.parametrize("text,good", [
    ('{"k": 1}', True), (' {"k": 1} ', True), ('{"k": 1}{"k": 2}', False), ('{"k": 1} junk', False), ("{}", False), ("", False), (None, False),
    ('{"k": null}', False), ('{"k": 1, "m": {"a": 1}}', True), ('{"k": 1, "m": {"a": null}}', False), ('{"k": "x"}', False), ('{"k": 1', False),
])
def test_strict_payloads(spark, text, good):
    df = spark.createDataFrame([("e", {}, None if text is None else bytearray(text.encode()), None)], TRANSPORT)
    assert (decode(df, STRICT).ok.count(), decode(df, STRICT).failed.count()) == ((1, 0) if good else (0, 1))
    if good:
        assert decode_or_fail(df, STRICT).first()["k"] == 1
    else:
        with pytest.raises(Exception, match="MalformedPayload"):
            decode_or_fail(df, STRICT).collect()


def test_large_nested_collections_do_not_repeat(spark):
    schema = T.StructType([T.StructField("xs", T.ArrayType(T.ArrayType(T.LongType())))])
    made = generate(spark.range(2), "id", schema, GeneratorOptions(min_chars=5, max_chars=6, max_collection=1500))
    flat = made.select(F.explode(F.flatten("xs")).alias("x")).agg(F.count("x").alias("n"), F.countDistinct("x").alias("d")).first()
    assert flat["n"] > 100_000 and flat["d"] > 0.9999 * flat["n"]


def test_topic_records_become_transports(spark):
    raw = spark.createDataFrame(
        [(b"k", b"v", [("a", b"1"), ("b", b"2"), ("a", b"3")], datetime(2024, 1, 1), "t", 0, 5), (None, b"v", None, datetime(2024, 1, 2), "t", 1, 6)],
        "key binary, value binary, headers array<struct<key:string,value:binary>>, timestamp timestamp, topic string, partition int, offset long",
    )
    rows = topic_transports(raw).collect()
    assert rows[0]["attributes"] == {"a": "1", "b": "2"} and rows[0]["event_ts"] == datetime(2024, 1, 1)
    assert rows[1]["event_id"] == "t-1-6" and rows[1]["attributes"] == {}
    assert raw.select(first_headers(F.col("headers")).alias("h")).first()["h"] == {"a": "1", "b": "2"}
