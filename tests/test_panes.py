"""Pane sequences against a brute-force simulation of the firing rules."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.windows import count_windows
from millrace.plans.config import Aggregation, EarlyFirings
from millrace.session import fresh_dir
from millrace.streaming.panes import count_panes
from millrace.streaming.running import (
    append_to_files,
    finish,
    read_arrivals,
    stage_arrivals,
    start_batches,
    update_to_files,
)

LENGTH, LATENESS = 600, 300  # seconds


def arrivals(spark):
    """Seven batches; one key has a third of the events; some events are late, some too late."""
    rows = []
    for n in range(700):
        key = "hot" if n % 3 == 0 else f"k{n % 5}"
        batch = n // 100
        second = n * 4
        if n % 23 == 0:
            second = max(0, second - 700)  # late within or beyond the lateness
        rows.append((n, key, second, batch))
    return rows


@pytest.fixture(scope="module")
def staged(spark):
    df = spark.createDataFrame(arrivals(spark), "n bigint, user string, second bigint, batch int")
    df = df.withColumn("event_ts", F.timestamp_seconds("second"))
    path = stage_arrivals(df, F.col("batch"), files_per_batch=2)
    return path, df.schema


def simulate(rows, early, closing):
    """(key, start, pane, total, delta) of every pane."""
    batches = defaultdict(list)
    for _, key, second, batch in rows:
        batches[batch].append((key, second))
    state, panes, seen = {}, [], None
    for batch in range(max(batches) + 2):
        # the engine's watermark starts at the epoch and never goes back
        watermark = max(0, seen - LATENESS) if seen is not None else 0
        added = defaultdict(int)
        for key, second in batches.get(batch, []):
            start = second // LENGTH * LENGTH
            if watermark < start + LENGTH:
                added[key, start] += 1
        for (key, start), n in added.items():
            total, emitted, on_time = state.get((key, start), (0, 0, False))
            total += n
            if not on_time and watermark < start + LENGTH - LATENESS and early and total - emitted >= early:
                panes.append((key, start, "early", total, total - emitted))
                emitted = total
            state[key, start] = (total, emitted, on_time)
        for (key, start), (total, emitted, on_time) in list(state.items()):
            end = start + LENGTH
            if watermark >= end:
                if closing == "always" or total != emitted:
                    panes.append((key, start, "final", total, total - emitted))
                del state[key, start]
            elif watermark >= end - LATENESS and not on_time:
                panes.append((key, start, "on_time", total, total - emitted))
                state[key, start] = (total, total, True)
        for _, second in batches.get(batch, []):
            seen = second if seen is None else max(seen, second)
    return sorted(panes)


@pytest.mark.parametrize("early,accumulating,closing", [(25, True, "always"), (25, False, "if_changed"), (None, True, "always")])
def test_pane_sequences(spark, staged, early, accumulating, closing):
    path, schema = staged
    firing = EarlyFirings(early is not None, early, None, accumulating)
    aggregation = Aggregation(("user",), LENGTH * 1000, LATENESS * 1000, firing)
    panes = count_panes(read_arrivals(spark, path, schema, 2), [aggregation], closing=closing)
    rows = spark.read.schema(panes.schema).parquet(update_to_files(panes, spark, "test-panes")).collect()
    expected = simulate(arrivals(spark), early, closing)
    got = sorted((r["agg_key"], r["window_start"], r["pane"], r["result_long"]) for r in rows)
    wanted = sorted(
        (k, datetime(1970, 1, 1) + timedelta(seconds=s), p, t if accumulating or early is None else d)
        for k, s, p, t, d in expected
    )
    assert got == wanted
    assert {p for _, _, p, _ in got} >= {"on_time"}
    assert all(r["is_final"] == (r["pane"] == "final") for r in rows)


def test_state_of_closed_windows_is_dropped(spark):
    rows = [(n, f"k{n % 40}", n * 4, n // 100) for n in range(300)] + [(300, "last", 10**6, 3)]
    df = spark.createDataFrame(rows, "n bigint, user string, second bigint, batch int")
    df = df.withColumn("event_ts", F.timestamp_seconds("second"))
    path = stage_arrivals(df, F.col("batch"))
    aggregation = Aggregation(("user",), LENGTH * 1000, LATENESS * 1000, EarlyFirings(True, 3))
    panes = count_panes(read_arrivals(spark, path, df.schema), [aggregation])
    finals = []
    query = start_batches(panes, spark, "state", lambda batch, _: finals.append(batch.filter("is_final").count()), "update")
    finish(query)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sum(finals) == 80  # forty keys in two windows; the last one is still open
    assert max(kept) == 80 and kept[-1] == 1  # only the open window


def test_hot_keys_collapse_before_the_shuffle(spark):
    from millrace.streaming import panes

    hot = spark.range(0, 60_000, 1, 2).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("user"),
        F.lit("2024-01-01").cast("timestamp").alias("event_ts"),
    )
    keyed = panes.pane_keys(hot, [Aggregation(("user",), LENGTH * 1000)], "event_ts")
    counted = panes.partial_counts(keyed).groupBy("agg_key").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    row = counted.filter("agg_key = 'hot'").first()
    assert row["n"] == 20_000 and row["rows"] == 2  # one row per task
    assert counted.agg(F.sum("n")).first()[0] == 60_000
    flushed = panes.partial_counts(keyed, held_groups=100)
    assert flushed.agg(F.sum("n")).first()[0] == 60_000
    assert 2 < flushed.filter("agg_key = 'hot'").count() < 20


def test_bounded_input_closes_every_window(spark, staged):
    path, schema = staged
    aggregation = Aggregation(("user",), LENGTH * 1000, LATENESS * 1000, EarlyFirings(True, 5))
    df = spark.read.schema(schema).parquet(path)
    assert sorted(count_panes(df, [aggregation]).collect()) == sorted(count_windows(df, [aggregation]).collect())
    assert sum(r["result_long"] for r in count_panes(df, [aggregation]).collect()) == 700


def test_unknown_closing_is_refused(spark, staged):
    path, schema = staged
    with pytest.raises(ValueError):
        count_panes(read_arrivals(spark, path, schema), [Aggregation(("user",), 1000)], closing="never")


def test_update_mode_gives_running_counts(spark, staged):
    path, schema = staged
    aggregation = Aggregation(("user",), LENGTH * 1000, 10**9)
    counts = count_windows(read_arrivals(spark, path, schema, 2), [aggregation])
    rows = spark.read.schema(counts.schema).parquet(update_to_files(counts, spark, "test-updates"))
    last = rows.groupBy("agg_key", "window_start").agg(F.max("result_long").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == 700
    assert rows.count() > last.count()


def test_append_mode_drops_late_rows(spark, staged):
    path, schema = staged
    counts = count_windows(read_arrivals(spark, path, schema, 2), [Aggregation(("user",), LENGTH * 1000, LATENESS * 1000)])
    out = append_to_files(counts, spark, "test-append")
    rows = spark.read.schema(counts.schema).parquet(out).collect()
    assert len({(r["agg_key"], r["window_start"]) for r in rows}) == len(rows)
    assert sum(r["result_long"] for r in rows) < 700


def test_a_quiet_key_shows_its_early_pane_after_a_real_delay(spark):
    """Nothing arrives after the first batch but time; later events of the key start another wait, the close cancels one."""
    import time

    from millrace.streaming.running import start_batches
    from tests.conftest import wait_until

    source = fresh_dir(spark, "quiet")

    def arrive(rows):
        frame = spark.createDataFrame([(k, datetime.fromtimestamp(t)) for k, t in rows], "k string, event_ts timestamp")
        frame.coalesce(1).write.mode("append").parquet(source)

    arrive([("a", 10), ("a", 20), ("b", 30)])
    stream = spark.readStream.schema("k string, event_ts timestamp").parquet(source)
    both = [
        Aggregation(("k",), 60_000, 0, EarlyFirings(True, time_ms=2_000, accumulating=False)),
        Aggregation(("k",), 3_600_000, 0, EarlyFirings(True, count=3, time_ms=2_000)),
    ]
    seen, began = [], time.monotonic()

    def handle(batch, number):
        seen.extend((round(time.monotonic() - began, 1), r["agg_name"], r["agg_key"], r["pane"], r["result_long"]) for r in batch.collect())

    query = start_batches(count_panes(stream, both, waiting=True), spark, "quiet", handle, "update", trigger={"processingTime": "200 milliseconds"})

    def panes(pane):
        return sorted((name[-2:], key, n) for _, name, key, kind, n in seen if kind == pane)

    try:
        first = [("1h", "a", 2), ("1h", "b", 1), ("1m", "a", 2), ("1m", "b", 1)]
        wait_until(lambda: len(panes("early")) >= 4)
        assert panes("early") == first and all(at >= 2 for at, *_ in seen) and not panes("final")
        arrive([("a", 40)])  # the third element of the hour fires by number; the minute's waits again
        wait_until(lambda: len(panes("early")) >= 6)
        assert panes("early") == sorted([*first, ("1h", "a", 3), ("1m", "a", 1)])
        arrive([("b", 50), ("c", 130)])
        wait_until(lambda: len(panes("final")) >= 2)
        assert panes("final") == [("1m", "a", 0), ("1m", "b", 1)]
        wait_until(lambda: len(panes("early")) >= 9)
        assert panes("early") == sorted([*first, ("1h", "a", 3), ("1m", "a", 1), ("1h", "b", 2), ("1h", "c", 1), ("1m", "c", 1)])
    finally:
        query.stop()


def test_keys_share_their_state_by_window_and_bucket(spark):
    """5000 keys leave far fewer rows of state; a key that comes after the on-time panes of the others has its own."""
    day = 86_400
    rows = spark.range(5000).select(F.col("id").alias("user_id"), (F.col("id") * 0 + 10).alias("s"), F.lit(0).alias("b"))
    rows = rows.union(spark.createDataFrame([(0, day + 10, 1), (0, 20, 2), (9999, 30, 2), (1, 4 * day, 3)], "user_id long, s long, b int"))
    events = rows.select("user_id", F.timestamp_seconds("s").alias("event_ts"), "b")
    stream = read_arrivals(spark, stage_arrivals(events, F.col("b")), events.drop("b").schema)
    panes = count_panes(stream, [Aggregation(("user_id",), day * 1000, day * 1000, EarlyFirings(True, 1, None, True))])
    path, states = fresh_dir(spark, "shared-state"), []
    query = start_batches(panes, spark, "shared-state", lambda batch, n: batch.write.parquet(f"{path}/batch_id={n}"), "update")
    finish(query)
    states = [p.stateOperators[0].numRowsTotal for p in query.recentProgress]
    assert 0 < max(states) < 5000
    found = spark.read.parquet(path).filter("agg_key IN ('0', '7', '9999') AND window_start = timestamp '1970-01-01'")
    got = sorted((r.agg_key, r.pane, r.result_long) for r in found.collect())
    # The first window's on-time point is the watermark that a query begins with, so it has no early panes.
    assert got == [("0", "final", 2), ("0", "on_time", 1), ("7", "final", 1), ("7", "on_time", 1), ("9999", "final", 1), ("9999", "on_time", 1)]


@pytest.mark.parametrize("fault", [None, "fails", "shows nothing"])
def test_delayed_panes_are_whole_or_an_error(spark, monkeypatch, tmp_path, fault):
    """Neither a query that failed nor one that never shows its panes ends as a shorter result."""
    import pyarrow as pa
    from pyarrow import parquet
    from pyspark.errors import StreamingQueryException

    from catalog import streams

    rows = {"event_id": range(24), "ts": [datetime(2024, 1, 1 + n % 3, 5) for n in range(24)], "user_id": [n % 4 or None for n in range(24)]}
    parquet.write_table(pa.table({name: list(values) for name, values in rows.items()}), f"{tmp_path}/events.parquet")
    begin = streams.start_batches

    def faulty(panes, spark, label, handle, *args, **kwargs):
        def broken(batch, number):
            if fault == "fails" and number == 1:
                raise ValueError("no disk")
            handle(batch.filter("agg_key = 'nobody'") if fault == "shows nothing" else batch, number)

        return begin(panes, spark, label, broken, *args, **kwargs)

    monkeypatch.setattr(streams, "start_batches", faulty)
    monkeypatch.setattr(streams, "EARLY_BATCHES", 12 if fault else 50, raising=False)
    if fault:
        with pytest.raises(StreamingQueryException if fault == "fails" else TimeoutError):
            streams.panes_early_delay(spark, str(tmp_path))
    else:
        found = streams.panes_early_delay(spark, str(tmp_path)).collect()
        assert sorted((r["agg_key"], r["window_start"], r["total"]) for r in found) == [(k, datetime(2024, 1, 3), 2) for k in ("1", "2", "3", "\\N")]
