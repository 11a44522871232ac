"""Aggregation results as wide-column cells (row key, family, qualifier, timestamp, value bytes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.encoding import double_bytes, float_bytes, iso_millis, long_bytes
from millrace.operators.outcome import Outcome
from millrace.schemas import CELL

FAMILY = "aggregation_results"  # fixed value: default column family
MAX_VERSIONS = 5  # fixed value: versions kept per cell
RESULT_TYPES = ("DOUBLE", "FLOAT", "INT", "LONG", "STRING")


def window_stamp() -> Column:
    """Last instant of the window (end - 1 ms), or null for unwindowed results."""
    return iso_millis(F.col("window_end").cast("timestamp") - F.expr("INTERVAL '0.001' SECOND"))


def value_bytes(types: Sequence[str]) -> Column:
    """Bytes of the result. Only the encoders of ``types`` enter the plan, so counts stay on the JVM."""
    kind = F.col("result_type")
    branches = {
        "INT": lambda: long_bytes(F.col("result_long")),
        "LONG": lambda: long_bytes(F.col("result_long")),
        "DOUBLE": lambda: double_bytes(F.col("result_double")),
        "FLOAT": lambda: float_bytes(F.col("result_double").cast("float")),
        "STRING": lambda: F.encode(F.col("result_string"), "UTF-8"),
    }
    chosen = None
    for name in types:
        test = kind == name
        chosen = F.when(test, branches[name]()) if chosen is None else chosen.when(test, branches[name]())
    return chosen


def to_cells(results: DataFrame, family: str = FAMILY, types: Sequence[str] = ("LONG",), epoch_millis: Column | None = None) -> DataFrame:
    """Cells plus the window bounds of the result they came from.

    Row key: key, ``#`` and window stamp when windowed. Qualifier: name, ``_final`` on final
    values, type, window stamp or ``NA``. The cell timestamp is ``epoch_millis`` (default: the
    window stamp; now for unwindowed results) in microseconds.
    """
    stamp = window_stamp()
    default_millis = F.unix_millis(F.coalesce(F.col("window_end").cast("timestamp") - F.expr("INTERVAL '0.001' SECOND"), F.current_timestamp()))
    name = F.concat(F.col("agg_name"), F.when(F.col("is_final"), F.lit("_final")).otherwise(F.lit("")))
    return results.select(
        F.concat(F.col("agg_key"), F.coalesce(F.concat(F.lit("#"), stamp), F.lit(""))).alias("row_key"),
        F.lit(family).alias("family"),
        F.concat_ws(":", name, F.col("result_type"), F.coalesce(stamp, F.lit("NA"))).alias("qualifier"),
        ((epoch_millis if epoch_millis is not None else default_millis) * 1000).alias("ts_micros"),
        value_bytes(types).alias("value"),
        "window_start",
        "window_end",
    )


def cells_or_failed(results: DataFrame, types: Sequence[str] = RESULT_TYPES, family: str = FAMILY, epoch_millis: Column | None = None) -> Outcome:
    """Cells, and as dead letters the results that have no cell: no encoder for their type, or no value."""
    kinds = F.col("result_type").isin(list(types))
    value = F.when(F.col("result_type").isin("INT", "LONG"), F.col("result_long").isNotNull()).when(
        F.col("result_type").isin("DOUBLE", "FLOAT"), F.col("result_double").isNotNull()
    ).otherwise(F.col("result_string").isNotNull())
    good = F.coalesce(kinds & value, F.lit(False))
    failed = results.filter(~good).select(
        F.col("agg_key").alias("event_id"),
        F.lit("cells").alias("stage"),
        F.when(F.coalesce(kinds, F.lit(False)), "MissingValue").otherwise("UnknownResultType").alias("error_class"),
        F.concat(F.lit("no cell for a result of type "), F.coalesce("result_type", F.lit("null"))).alias("error_message"),
        F.create_map(F.lit("aggregation"), F.col("agg_name"), F.lit("window_end"), F.col("window_end").cast("string")).alias("attributes"),
        F.to_json(F.struct(*results.columns)).cast("binary").alias("payload"),
    )
    return Outcome(to_cells(results.filter(good), family, types, epoch_millis), failed)


def latest_cells(cells: DataFrame, order: Sequence[str]) -> DataFrame:
    """One value per (row key, family, qualifier, timestamp): the last write by ``order`` wins.

    ``max_by`` is combined map-side, so repeated writes of one hot cell collapse before the shuffle.
    """
    rank = F.struct(*[F.col(c) for c in order])
    return cells.groupBy("row_key", "family", "qualifier", "ts_micros").agg(
        F.max_by("value", rank).alias("value")
    )


def group_cells(cells: DataFrame) -> DataFrame:
    """All cells of one row key, timestamp and window as one mutation list.

    Repeated writes of a cell are collapsed first, so a list holds at most one cell per qualifier: its size is
    bounded by the number of configured aggregations, whatever the number of input rows. The greatest
    ``write_order`` wins where the frame has that column; without it, writes of one cell are expected to be equal.
    Rows are dealt by the list's own key, which both aggregations share.
    """
    outer = ["row_key", "ts_micros", "window_start", "window_end"]
    last = F.max_by("value", "write_order") if "write_order" in cells.columns else F.max("value")
    dealt = cells.repartition(*[F.col(c) for c in outer])
    distinct = dealt.groupBy(*outer, "family", "qualifier").agg(last.alias("value"))
    cell = F.struct("family", "qualifier", "ts_micros", "value")
    return distinct.groupBy(*outer).agg(
        F.array_sort(F.collect_list(cell)).alias("cells")
    )


def keep_versions(cells: DataFrame, versions: int = MAX_VERSIONS, columns: Sequence[str] = ()) -> DataFrame:
    """The newest ``versions`` timestamps of each cell, with the cell's columns or those named.

    Spark limits each group on the map side first (window group limit), so a hot cell ships at
    most ``versions`` rows per map task.
    """
    newest = Window.partitionBy("row_key", "family", "qualifier").orderBy(F.col("ts_micros").desc())
    ranked = cells.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= versions).select(*(columns or CELL.fieldNames()))
