"""Early, on-time and final panes of windowed counts.

Spark's built-in windowed aggregation emits either every change or only the closed window. This
stateful operator adds count- or time-triggered early panes, the on-time pane, and a final marker.

A streaming query has one watermark, so all aggregations share one operator and one read of the
source. The watermark trails the largest event time by M, the largest allowed lateness of any aggregation.
With window end E and an aggregation's own lateness L, its on-time pane is a timer at E - M and the close of its
window a timer at E + L - M; events that arrive when the watermark has reached that are dropped.

One stateful operator has one clock, event time here. Alone it fires a time-triggered early pane in the first micro-batch that
brings events for its key once the delay has passed. In a query that keeps running (``waiting``) a second operator stands behind
it, on processing time: fed with the running counts, it holds a timer for every pane that waits, so a key that goes quiet shows
its early pane when the delay is over, whether or not anything else arrives.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.encoding import key_text
from millrace.operators.windows import as_results, count_windows
from millrace.plans.config import Aggregation, distinct_names, interval

PANES = "agg_name string, agg_key string, start_us bigint, end_us bigint, pane string, is_final boolean, total bigint, delta bigint"
STATE = "panes binary"
HELD = pa.schema([("agg_key", pa.string()), ("total", pa.int64()), ("emitted", pa.int64()), ("since_ms", pa.int64()), ("on_time", pa.bool_())])
BUCKETS = 4096  # of the keys of a window; fixed for the life of a checkpoint
WAITING = "total bigint, emitted bigint, due_ms bigint"
CHANGED = "changed"
ORDER = (CHANGED, "early", "on_time", "final")


@dataclass(frozen=True)
class Rule:
    """When the panes of one aggregation fire, relative to the shared watermark."""

    on_time_ms: int  # after the window's end, in watermark time: 0 or less
    close_ms: int
    early_count: int | None
    early_ms: int | None

    @classmethod
    def of(cls, aggregation: Aggregation, most_late_ms: int) -> Rule:
        early = aggregation.early
        return cls(
            -most_late_ms,
            aggregation.lateness_ms - most_late_ms,
            early.count if early.enabled else None,
            early.time_ms if early.enabled else None,
        )


def packed(panes: dict) -> bytes:
    columns = zip(*((key, *values) for key, values in panes.items()), strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, HELD, strict=True)], schema=HELD)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, HELD) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> dict:
    columns = [c.to_pylist() for c in pa.ipc.open_stream(data).read_all().columns]
    return dict(zip(columns[0], zip(*columns[1:], strict=True), strict=True))


class PaneProcessor(StatefulProcessor):
    """State of the keys of one (aggregation, window, bucket): of each the count, what was emitted, which panes fired.

    Reading, writing and timers cost a call to the JVM each, so they are paid once a bucket and not once a key. All keys of a
    window share its two times.
    """

    def __init__(self, rules: dict[str, Rule], closing: str, waiting: bool = False):
        self.rules = rules
        self.closing = closing
        self.waiting = waiting  # a WaitingProcessor decides on the panes of rules with a delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added: dict[str, int] = {}
        for row in rows:
            added[row["agg_key"]] = added.get(row["agg_key"], 0) + row["n"]
        now = timerValues.getCurrentProcessingTimeInMs()
        watermark = timerValues.getCurrentWatermarkInMs()
        rule = self.rules[key[0]]
        on_time_at, close_at = key[2] // 1000 + rule.on_time_ms, key[2] // 1000 + rule.close_ms
        if watermark >= close_at:
            return  # the window is closed: these events are too late
        stored = self.state.get()
        panes = unpacked(stored[0]) if stored else {}
        if not stored:
            self.handle.registerTimer(close_at)
        if not stored or watermark >= on_time_at and not added.keys() <= panes.keys():
            self.handle.registerTimer(on_time_at)  # a key may come after the on-time pane of the others
        for agg_key, n in added.items():
            total, emitted, since, on_time = panes.get(agg_key) or (0, 0, now, False)
            if total == emitted:
                since = now  # first element of a new pane
            total += n
            fire = False
            if self.waiting and rule.early_ms is not None:
                if not on_time and watermark < on_time_at:
                    yield self._pane(key, agg_key, CHANGED, False, total, n)
            elif not on_time and watermark < on_time_at:
                fire = rule.early_count is not None and total - emitted >= rule.early_count
                fire = fire or (rule.early_ms is not None and now - since >= rule.early_ms)
            if fire:
                yield self._pane(key, agg_key, "early", False, total, total - emitted)
                emitted = total
            panes[agg_key] = (total, emitted, since, on_time)
        self.state.update((packed(panes),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.state.get()
        if not stored:
            return
        panes = unpacked(stored[0])
        close_at = key[2] // 1000 + self.rules[key[0]].close_ms
        if expiredTimerInfo.getExpiryTimeInMs() >= close_at:
            delayed = self.waiting and self.rules[key[0]].early_ms is not None
            for agg_key, (total, emitted, _, _) in panes.items():
                if delayed or self.closing == "always" or total != emitted:
                    yield self._pane(key, agg_key, "final", True, total, total - emitted)
            self.state.clear()
        elif timerValues.getCurrentWatermarkInMs() < close_at:
            # When time jumps past both timers, the final pane alone is emitted.
            for agg_key, (total, emitted, since, on_time) in panes.items():
                if not on_time:
                    yield self._pane(key, agg_key, "on_time", False, total, total - emitted)
                    panes[agg_key] = (total, total, since, True)
            self.state.update((packed(panes),))

    def close(self) -> None:
        pass

    @staticmethod
    def _pane(key, agg_key: str, pane: str, is_final: bool, total: int, delta: int) -> Row:
        return pane_row(key[0], agg_key, key[1], key[2], pane, is_final, total, delta)


def pane_row(agg_name: str, agg_key: str, start_us: int, end_us: int, pane: str, is_final: bool, total: int, delta: int) -> Row:
    return Row(
        agg_name=agg_name,
        agg_key=agg_key,
        start_us=start_us,
        end_us=end_us,
        pane=pane,
        is_final=is_final,
        total=total,
        delta=delta,
    )


class WaitingProcessor(StatefulProcessor):
    """Panes of rules with a delay, in processing time: the first element of a pane starts a timer.

    Gets every change of a count, and on-time and final counts. State: the count, what was emitted, when the waiting pane
    is due (0: none waits).
    """

    def __init__(self, rules: dict[str, Rule], closing: str):
        self.rules = rules
        self.closing = closing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", WAITING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rule, arrived = self.rules[key[0]], sorted(rows, key=lambda r: (ORDER.index(r["pane"]), r["total"]))
        if rule.early_ms is None:
            for row in arrived:
                yield pane_row(*key, row["pane"], row["is_final"], row["total"], row["delta"])
            return
        total, emitted, due = self.state.get() or (0, 0, 0)
        for row in arrived:
            total = row["total"]
            if row["pane"] == CHANGED:
                if not due:
                    due = timerValues.getCurrentProcessingTimeInMs() + rule.early_ms
                    self.handle.registerTimer(due)
                fire = "early" if rule.early_count is not None and total - emitted >= rule.early_count else None
            else:
                fire = row["pane"] if row["pane"] != "final" or self.closing == "always" or total != emitted else None
            if due and row["pane"] != CHANGED or fire and due:
                self.handle.deleteTimer(due)
                due = 0
            if fire:
                yield pane_row(*key, fire, row["is_final"], total, total - emitted)
                emitted = total
        if arrived[-1]["is_final"]:
            self.state.clear()
        else:
            self.state.update((total, emitted, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.state.get()
        if known is not None and known[2]:
            yield pane_row(*key, "early", False, known[0], known[0] - known[1])
            self.state.update((known[0], known[0], 0))

    def close(self) -> None:
        pass


HELD_GROUPS = 50_000


def partial_counts(keyed: DataFrame, held_groups: int = HELD_GROUPS) -> DataFrame:
    """Count per key and window inside each task, before the shuffle.

    Without this, every event of a hot key would travel to one task and through its Python
    worker. With it, a hot key sends about one row per task; a task holds at most twice
    ``held_groups`` groups and passes them on when keys are many.
    """
    columns = ["agg_name", "agg_key", "start_us", "end_us"]

    def grouped(table: pa.Table, how: tuple) -> pa.Table:
        counted = table.group_by(columns, use_threads=False).aggregate([how])
        return counted.select([*columns, counted.column_names[-1]]).rename_columns([*columns, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            counted = grouped(pa.Table.from_batches([batch]), ([], "count_all"))
            held = counted if held is None else pa.concat_tables([held, counted])
            if held.num_rows > 2 * held_groups:
                held = grouped(held, ("n", "sum"))
                if held.num_rows > held_groups:
                    yield from held.to_batches()
                    held = None
        if held is not None:
            yield from grouped(held, ("n", "sum")).to_batches()

    return keyed.mapInArrow(run, "agg_name string, agg_key string, start_us bigint, end_us bigint, n bigint")


def pane_keys(df: DataFrame, aggregations: Sequence[Aggregation], ts: str) -> DataFrame:
    """One row per event and aggregation: agg_name, agg_key, start_us, end_us."""
    most_late = max(a.lateness_ms for a in aggregations)
    micros = F.unix_micros("_ts")

    def row(a: Aggregation):
        start = micros - F.pmod(micros, F.lit(a.length_ms * 1000))
        return F.struct(
            F.lit(a.name).alias("agg_name"),
            key_text(a.key_fields).alias("agg_key"),
            start.alias("start_us"),
            (start + a.length_ms * 1000).alias("end_us"),
        )

    fields = list(dict.fromkeys(f for a in aggregations for f in a.key_fields))
    timed = df.filter(F.col(ts).isNotNull()).withWatermark(ts, interval(most_late)).select(F.col(ts).alias("_ts"), *fields)
    return timed.select(F.inline(F.array(*map(row, aggregations))))


def count_panes(df: DataFrame, aggregations: Sequence[Aggregation], ts: str = "event_ts", closing: str = "always", waiting: bool = False) -> DataFrame:
    """Panes of every aggregation, in result shape; ``result_long`` is the running count when
    panes accumulate and the increment when they discard.

    ``closing`` is ``always`` (each key and window gets exactly one final pane) or ``if_changed``
    (no final pane when nothing arrived since the pane before). Bounded input has no early panes:
    every window simply closes. ``waiting`` adds the operator that fires after real delays; it is for queries that keep
    running, as one that drains its source waits for nobody.
    """
    if not df.isStreaming:
        return count_windows(df, aggregations, ts)
    if closing not in ("always", "if_changed"):
        raise ValueError(f"unknown closing behaviour: {closing}")

    aggregations = distinct_names(aggregations)
    most_late = max(a.lateness_ms for a in aggregations)
    rules = {a.name: Rule.of(a, most_late) for a in aggregations}
    waiting = waiting and any(rule.early_ms for rule in rules.values())
    group = ["agg_name", "agg_key", "start_us", "end_us"]
    bucketed = partial_counts(pane_keys(df, aggregations, ts)).withColumn("bucket", F.pmod(F.xxhash64("agg_key"), F.lit(BUCKETS)))
    panes = bucketed.groupBy("agg_name", "start_us", "end_us", "bucket").transformWithState(
        statefulProcessor=PaneProcessor(rules, closing, waiting), outputStructType=PANES, outputMode="Update", timeMode="EventTime"
    )
    if waiting:
        panes = panes.groupBy(*group).transformWithState(
            statefulProcessor=WaitingProcessor(rules, closing), outputStructType=PANES, outputMode="Update", timeMode="ProcessingTime"
        )
    window = F.struct(F.timestamp_micros("start_us").alias("start"), F.timestamp_micros("end_us").alias("end"))
    discarding = [a.name for a in aggregations if not a.early.accumulating]
    value = F.when(F.col("agg_name").isin(discarding), F.col("delta")).otherwise(F.col("total")) if discarding else F.col("total")
    return as_results(panes.withColumn("window", window), value, F.col("pane"), F.col("is_final"))
