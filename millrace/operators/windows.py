"""Keyed counts over fixed event-time windows, in the result shape the cell sink consumes.

One row per (aggregation, key, window): agg_name, agg_key, window_start, window_end, pane,
is_final, result_type, result_long, result_double, result_string.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.encoding import key_text
from millrace.plans.config import Aggregation, distinct_names, interval

RESULT = [
    "agg_name",
    "agg_key",
    "window_start",
    "window_end",
    "pane",
    "is_final",
    "result_type",
    "result_long",
    "result_double",
    "result_string",
]


def keyed_windows(df: DataFrame, aggregations: Sequence[Aggregation], ts: str) -> DataFrame:
    """One row per event and aggregation: window, agg_name, agg_key.

    Aggregations that share a window specification read their input once. The window column is
    computed before the fan-out so that it keeps the watermark.
    """
    first = aggregations[0]
    if df.isStreaming:
        df = df.withWatermark(ts, interval(first.lateness_ms))
    window = F.window(F.col(ts), interval(first.length_ms)).alias("window")
    keys = [
        F.struct(F.lit(a.name).alias("agg_name"), key_text(a.key_fields).alias("agg_key"))
        for a in aggregations
    ]
    if len(keys) == 1:
        return df.select(window, F.lit(first.name).alias("agg_name"), key_text(first.key_fields).alias("agg_key"))
    fields = list(dict.fromkeys(f for a in aggregations for f in a.key_fields))
    return df.select(window, *fields).select("window", F.inline(F.array(*keys)))


def count_windows(df: DataFrame, aggregations: Sequence[Aggregation], ts: str = "event_ts") -> DataFrame:
    """Count per key and window. Batch input: every window closes, and all aggregations share one
    scan and one shuffle. Streaming input: use append mode for one row per closed window, update
    mode for running counts; aggregations with the same window and lateness share the input.

    The count is a partial aggregation followed by one shuffle, so a hot key travels as one row
    per map task. Rows without event time belong to no window; :func:`with_event_time` sets them aside.

    A streaming query has one watermark, so streamed aggregations need one lateness here;
    :func:`count_closed` gives each its own.
    """
    aggregations = distinct_names(aggregations)
    if df.isStreaming and len({a.lateness_ms for a in aggregations}) > 1:
        raise ValueError("streamed aggregations of different lateness go through count_closed")
    if len(aggregations) > 1 and not df.isStreaming:
        return _count_together(df, aggregations, ts)

    def spec(a: Aggregation):
        return (a.length_ms, a.lateness_ms)

    parts = []
    for _, group in groupby(sorted(aggregations, key=spec), key=spec):
        members = list(group)
        if len(members) == 1:
            counted = _count_one(df, members[0], ts)
        else:
            counted = keyed_windows(df, members, ts).groupBy("window", "agg_name", "agg_key").count()
        parts.append(as_results(counted, F.col("count")))
    return reduce(DataFrame.unionByName, parts)


def count_closed(df: DataFrame, aggregations: Sequence[Aggregation], ts: str = "event_ts") -> DataFrame:
    """Streamed counts for append mode: one row per key and window, when the aggregation's own lateness has passed.

    Any number of aggregations, each with its window length and lateness, share one read, one watermark and one native
    stateful aggregation. The watermark trails by the greatest lateness M. An aggregation of lateness L counts in time
    moved back by M - L: a window then ends M - L early, so the watermark passes its end exactly when L is over.
    Partial counts are combined before the shuffle, so a hot key travels as one row per task.
    """
    aggregations = distinct_names(aggregations)
    most = max(a.lateness_ms for a in aggregations)
    early = [most - a.lateness_ms for a in aggregations]
    shapes = [(a.length_ms, -back % a.length_ms) for a, back in zip(aggregations, early, strict=True)]

    def row(slot: int, a: Aggregation):
        moved = F.timestamp_micros(F.unix_micros("_ts") - early[slot] * 1000)
        return F.struct(F.lit(slot).alias("_slot"), key_text(a.key_fields).alias("agg_key"), moved.alias("_t"))

    fields = list(dict.fromkeys(f for a in aggregations for f in a.key_fields))
    timed = df.filter(F.col(ts).isNotNull()).select(F.col(ts).alias("_ts"), *fields)
    fanned = timed.select(F.inline(F.array(*[row(slot, a) for slot, a in enumerate(aggregations)])))
    fanned = fanned.withWatermark("_t", interval(most))
    columns = {shape: f"_window{number}" for number, shape in enumerate(dict.fromkeys(shapes))}
    for (length, offset), column in columns.items():  # one window expression per select
        fanned = fanned.withColumn(column, F.window("_t", interval(length), interval(length), interval(offset)))
    # A field keeps the watermark of its column, which a conditional expression would lose.
    windows = F.array(*[F.struct(F.lit(slot).alias("_at"), F.col(columns[shape]).alias("window")) for slot, shape in enumerate(shapes)])
    own = fanned.select("_slot", "agg_key", F.inline(F.filter(windows, lambda w: w["_at"] == F.col("_slot"))))
    counted = own.groupBy("window", "_slot", "agg_key").count()
    names, back = F.array(*[F.lit(a.name) for a in aggregations]), F.array(*[F.lit(ms * 1000) for ms in early])
    bounds = [F.timestamp_micros(F.unix_micros(F.col("window")[side]) + back[F.col("_slot")]).alias(side) for side in ("start", "end")]
    return as_results(counted.select(names[F.col("_slot")].alias("agg_name"), "agg_key", F.struct(*bounds).alias("window"), "count"), F.col("count"))


def _count_together(df: DataFrame, aggregations: Sequence[Aggregation], ts: str) -> DataFrame:
    """Bounded input, several aggregations: each event fans out to one row per aggregation."""
    fields = list(dict.fromkeys(f for a in aggregations for f in a.key_fields))
    lengths = list(dict.fromkeys(a.length_ms for a in aggregations))
    timed = df.select(F.col(ts).alias("_ts"), *fields)
    for length in lengths:  # one window expression per select
        timed = timed.withColumn(f"_w{length}", F.window("_ts", interval(length)))
    rows = [
        F.struct(
            F.col(f"_w{a.length_ms}").alias("window"),
            F.lit(a.name).alias("agg_name"),
            key_text(a.key_fields).alias("agg_key"),
        )
        for a in aggregations
    ]
    fanned = timed.select(F.inline(F.array(*rows)))
    return as_results(fanned.groupBy("window", "agg_name", "agg_key").count(), F.col("count"))


def _count_one(df: DataFrame, aggregation: Aggregation, ts: str) -> DataFrame:
    """One aggregation groups by the key columns themselves: the key text is built once per
    result instead of once per event, and the shuffle carries the native types."""
    if df.isStreaming:
        df = df.withWatermark(ts, interval(aggregation.lateness_ms))
    window = F.window(F.col(ts), interval(aggregation.length_ms)).alias("window")
    keys = [F.col(f).alias(f"_k{i}") for i, f in enumerate(aggregation.key_fields)]
    names = [f"_k{i}" for i in range(len(keys))]
    counted = df.select(window, *keys).groupBy("window", *names).count()
    return counted.select("window", F.lit(aggregation.name).alias("agg_name"), key_text(names).alias("agg_key"), "count")


def as_results(counted: DataFrame, count: Column, pane: Column | None = None, is_final: Column | None = None) -> DataFrame:
    """Shape counts as LONG results."""
    return counted.select(
        "agg_name",
        "agg_key",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        (pane if pane is not None else F.lit("final")).alias("pane"),
        (is_final if is_final is not None else F.lit(True)).alias("is_final"),
        F.lit("LONG").alias("result_type"),
        count.cast("bigint").alias("result_long"),
        F.lit(None).cast("double").alias("result_double"),
        F.lit(None).cast("string").alias("result_string"),
    )


def typed_results(df: DataFrame, name: str, key_fields: Sequence[str], kind: str, value: Column, window: Column | None = None, is_final: bool = True) -> DataFrame:
    """Results of one of the five types: DOUBLE, FLOAT, INT, LONG or STRING.

    INT and LONG fill ``result_long``, DOUBLE and FLOAT ``result_double``, STRING
    ``result_string``. ``window`` is a struct of start and end, or absent for unwindowed results.
    """
    return all_typed_results(df, name, key_fields, {kind: value}, window, is_final)


def all_typed_results(df: DataFrame, name: str, key_fields: Sequence[str], values: dict[str, Column], window: Column | None = None, is_final: bool = True) -> DataFrame:
    """As :func:`typed_results` for several types at once: each row of ``df`` is read once and fans out."""
    width = F.array(*[_typed(name, key_fields, kind, value, window, is_final) for kind, value in values.items()])
    return df.select(F.inline(width))


def _typed(name: str, key_fields: Sequence[str], kind: str, value: Column, window: Column | None, is_final: bool) -> Column:
    casts = {"DOUBLE": "double", "FLOAT": "float", "INT": "int", "LONG": "bigint", "STRING": "string"}
    if kind not in casts:
        raise ValueError(f"unknown result type: {kind}")
    typed = value.cast(casts[kind])
    return F.struct(
        F.lit(name).alias("agg_name"),
        key_text(key_fields).alias("agg_key"),
        (window["start"] if window is not None else F.lit(None).cast("timestamp")).alias("window_start"),
        (window["end"] if window is not None else F.lit(None).cast("timestamp")).alias("window_end"),
        F.lit("final" if is_final else "on_time").alias("pane"),
        F.lit(is_final).alias("is_final"),
        F.lit(kind).alias("result_type"),
        (typed if kind in ("INT", "LONG") else F.lit(None)).cast("bigint").alias("result_long"),
        (typed if kind in ("DOUBLE", "FLOAT") else F.lit(None)).cast("double").alias("result_double"),
        (typed if kind == "STRING" else F.lit(None)).cast("string").alias("result_string"),
    )
