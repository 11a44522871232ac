"""Windowed counts and cells over bounded input."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import ntz, query, table, text_hex
from millrace.functions.encoding import long_bytes
from millrace.operators import cells as cell_ops
from millrace.operators.outcome import with_event_time
from millrace.operators.windows import all_typed_results, count_windows
from millrace.plans.config import Aggregation, millis
from millrace.session import fresh_dir
from millrace.sinks.cells import CellTable
from millrace.sinks.files import WindowedFiles


def count_by(*fields: str, length: str = "15m") -> Aggregation:
    return Aggregation(fields, millis(length), millis("1m"))


def timed_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("event_ts", F.col("ts").cast("timestamp"))


def shown(results):
    return results.select(
        "agg_name", "agg_key", ntz("window_start", "window_start"), ntz("window_end", "window_end"), "result_long"
    )


def count_sql(name: str, key: str, length: str, source: str = "events") -> str:
    return f"""SELECT '{name}' AS agg_name, {key} AS agg_key, w AS window_start,
      w + INTERVAL '{length}' AS window_end, count(*) AS result_long
    FROM (SELECT *, time_bucket(INTERVAL '{length}', ts) AS w FROM {source}) GROUP BY w, {key}"""


USER = "user_id::VARCHAR"
PAIR = "event_type || '|' || user_id::VARCHAR"
COUNT_15M = count_sql("count_user_id", USER, "15 minutes")


@query("agg_count_15m", COUNT_15M)
def agg_count_15m(spark, sf_dir):
    return shown(count_windows(timed_events(spark, sf_dir), [count_by("user_id")]))


@query("agg_count_composite_key", count_sql("count_event_type_user_id", PAIR, "1 hour"))
def agg_count_composite_key(spark, sf_dir):
    return shown(count_windows(timed_events(spark, sf_dir), [count_by("event_type", "user_id", length="1h")]))


@query(
    "agg_multi",
    " UNION ALL ".join(
        [
            COUNT_15M,
            count_sql("count_event_type", "event_type", "15 minutes"),
            count_sql("count_event_type_user_id", PAIR, "1 hour"),
        ]
    ),
)
def agg_multi(spark, sf_dir):
    """Three aggregations; the two with the same window read the events once."""
    wanted = [count_by("user_id"), count_by("event_type"), count_by("event_type", "user_id", length="1h")]
    return shown(count_windows(timed_events(spark, sf_dir), wanted))


@query(
    "agg_result_types",
    """SELECT event_id::VARCHAR AS agg_key, t.result_type,
      CASE t.result_type WHEN 'INT' THEN length(props) WHEN 'LONG' THEN event_id END::VARCHAR AS result_long,
      CASE t.result_type WHEN 'DOUBLE' THEN value WHEN 'FLOAT' THEN value::FLOAT::DOUBLE END AS result_double,
      CASE t.result_type WHEN 'STRING' THEN event_type END AS result_string
    FROM events, (VALUES ('INT'), ('LONG'), ('DOUBLE'), ('FLOAT'), ('STRING')) t(result_type)""",
)
def agg_result_types(spark, sf_dir):
    events = timed_events(spark, sf_dir)
    values = {
        "INT": F.length("props"),
        "LONG": F.col("event_id"),
        "DOUBLE": F.col("value"),
        "FLOAT": F.col("value"),
        "STRING": F.col("event_type"),
    }
    made = all_typed_results(events, "latest", ["event_id"], values)
    # Nullable integers as text: the same on every client.
    return made.select(
        "agg_key", "result_type", F.col("result_long").cast("string").alias("result_long"), "result_double", "result_string"
    )


STAMP = "strftime(window_end - INTERVAL '1 millisecond', '%Y-%m-%dT%H:%M:%S.') || '999Z'"
MICROS = "epoch_ms(window_end - INTERVAL '1 millisecond') * 1000"


def cells_sql(counts: str) -> str:
    return f"""SELECT agg_key || '#' || {STAMP} AS row_key, 'aggregation_results' AS family,
      agg_name || '_final:LONG:' || {STAMP} AS qualifier, {MICROS} AS ts_micros,
      lpad(hex(result_long), 16, '0') AS value_hex FROM ({counts})"""


def shown_cells(cells):
    return cells.select("row_key", "family", "qualifier", "ts_micros", text_hex("value", "value_hex"))


@query("cells_from_counts", cells_sql(COUNT_15M))
def cells_from_counts(spark, sf_dir):
    counts = count_windows(timed_events(spark, sf_dir), [count_by("user_id")])
    return shown_cells(cell_ops.to_cells(counts))


@query(
    "cells_grouped",
    f"""SELECT agg_key || '#' || {STAMP} AS row_key, {MICROS} AS ts_micros, 3 AS n_cells,
      'events_final:INT:' || {STAMP} || '|events_final:LONG:' || {STAMP} || '|events_final:STRING:' || {STAMP} AS qualifiers,
      lpad(hex(result_long), 16, '0') || '|' || lpad(hex(result_long), 16, '0') || '|' ||
        hex(encode(result_long::VARCHAR)) AS values_hex
    FROM ({count_sql("events", USER, "1 hour")})""",
)
def cells_grouped(spark, sf_dir):
    """Three typed results of one key and hour become one mutation list."""
    counts = count_windows(timed_events(spark, sf_dir), [count_by("user_id", length="1h")])
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    same = {kind: F.col("result_long") for kind in ("INT", "LONG", "STRING")}
    made = all_typed_results(counts, "events", ["agg_key"], same, window)
    grouped = cell_ops.group_cells(cell_ops.to_cells(made, types=("INT", "LONG", "STRING")))
    return grouped.select(
        "row_key",
        "ts_micros",
        F.size("cells").alias("n_cells"),
        F.array_join(F.transform("cells", lambda c: c["qualifier"]), "|").alias("qualifiers"),
        F.array_join(F.transform("cells", lambda c: F.hex(c["value"])), "|").alias("values_hex"),
    )


def price_cells(spark, sf_dir):
    """One cell per customer and order time; the value is the price in cents."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").cast("string").alias("row_key"),
        F.lit("prices").alias("family"),
        F.col("o_orderpriority").alias("qualifier"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ts_micros"),
        long_bytes(F.round(F.col("o_totalprice") * 100)).alias("value"),
        "o_orderkey",
    )


PRICE_CELLS = """SELECT o_custkey::VARCHAR AS row_key, 'prices' AS family, o_orderpriority AS qualifier,
  epoch_us(o_orderdate) AS ts_micros, lpad(hex(round(o_totalprice * 100)::BIGINT), 16, '0') AS value_hex, o_orderkey
  FROM orders"""


@query(
    "cells_upsert",
    f"""SELECT row_key, family, 'price' AS qualifier, 0::BIGINT AS ts_micros,
      arg_max(value_hex, o_orderkey) AS value_hex FROM ({PRICE_CELLS}) GROUP BY row_key, family""",
)
def cells_upsert(spark, sf_dir):
    """Two batches write the same cells, one of them twice; the later batch wins, also across a
    snapshot."""
    cells = price_cells(spark, sf_dir).withColumn("qualifier", F.lit("price")).withColumn("ts_micros", F.lit(0).cast("bigint"))
    target = CellTable(spark, fresh_dir(spark, "cells"))
    half = cells.agg(F.expr("max(o_orderkey) div 2")).first()[0]

    def part(rows):
        return cell_ops.latest_cells(rows, ["o_orderkey"])

    target.write(part(cells.filter(F.col("o_orderkey") <= half)), 0)
    target.merge()
    target.write(part(cells.filter(F.col("o_orderkey") > half)), 1)
    target.write(part(cells.filter(F.col("o_orderkey") > half)), 1)
    return shown_cells(target.read())


@query(
    "cells_merge_while_writing",
    f"""WITH c AS (SELECT *, o_orderkey % 4 AS b FROM ({PRICE_CELLS}))
    SELECT 'all' AS reader, row_key, family, 0::BIGINT AS ts_micros, arg_max(value_hex, (b, o_orderkey)) AS value_hex FROM c GROUP BY row_key, family
    UNION ALL SELECT 'pinned', row_key, family, 0, arg_max(value_hex, (b, o_orderkey)) FROM c WHERE b < 2 GROUP BY row_key, family""",
)
def cells_merge_while_writing(spark, sf_dir):
    """Two merges run while batches are being written; a reader from before keeps its rows, and no batch is lost."""
    cells = price_cells(spark, sf_dir).withColumn("qualifier", F.lit("price")).withColumn("ts_micros", F.lit(0).cast("bigint"))
    target = CellTable(spark, fresh_dir(spark, "cells"))

    def part(number):
        return cell_ops.latest_cells(cells.filter(F.col("o_orderkey") % 4 == number), ["o_orderkey"])

    target.write(part(1), 1)
    target.write(part(0), 0)
    pinned = target.read()
    third = target.stage(part(2), 2)
    target.merge()
    target.write(part(3), 3)
    target.merge()
    target.commit(third, 2)
    target.write(part(1), 1)
    target.merge()
    every = [df.withColumn("reader", F.lit(name)) for name, df in (("all", target.read()), ("pinned", pinned))]
    return every[0].unionByName(every[1]).select("reader", "row_key", "family", "ts_micros", text_hex("value", "value_hex"))


@query(
    "cells_max_versions",
    f"""SELECT row_key, family, qualifier, ts_micros, value_hex FROM (
      SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts_micros DESC) AS version
      FROM (SELECT row_key, family, 'price' AS qualifier, ts_micros, arg_max(value_hex, o_orderkey) AS value_hex
            FROM ({PRICE_CELLS}) GROUP BY row_key, family, ts_micros)) WHERE version <= 5""",
)
def cells_max_versions(spark, sf_dir):
    cells = price_cells(spark, sf_dir).withColumn("qualifier", F.lit("price"))
    return shown_cells(cell_ops.keep_versions(cell_ops.latest_cells(cells, ["o_orderkey"])))


@query(
    "cells_two_lengths",
    " UNION ALL ".join(
        cells_sql(count_sql(name, USER, length))
        for name, length in (("count_user_id_15m", "15 minutes"), ("count_user_id_1h", "1 hour"))
    ),
)
def cells_two_lengths(spark, sf_dir):
    """Two window lengths on one key: where both windows end together, each keeps its cell."""
    counts = count_windows(timed_events(spark, sf_dir), [count_by("user_id"), count_by("user_id", length="1h")])
    target = CellTable(spark, fresh_dir(spark, "cells"))
    target.write(cell_ops.to_cells(counts), 0)
    return shown_cells(target.read())


@query(
    "missing_event_time",
    f"""SELECT agg_key AS id, result_long::BIGINT AS n, 'counted' AS outcome FROM ({count_sql("count_user_id", USER, "15 minutes", "(SELECT * FROM events WHERE event_id % 13 <> 0)")})
    UNION ALL SELECT event_id::VARCHAR, 1, 'event_time' FROM events WHERE event_id % 13 = 0
    UNION ALL SELECT event_id::VARCHAR, 1, CASE WHEN event_id % 13 = 0 THEN 'none' ELSE strftime(time_bucket(INTERVAL '6 hours', ts), '%H%M') END FROM events""",
)
def missing_event_time(spark, sf_dir):
    """Every 13th event has no event time: it is not counted but reported, and files keep it in a folder of its own."""
    events = timed_events(spark, sf_dir)
    holed = events.withColumn("event_ts", F.when(F.col("event_id") % 13 != 0, F.col("event_ts")))
    timed = with_event_time(holed)
    counted = count_windows(timed.ok, [count_by("user_id")])
    files = WindowedFiles(spark, fresh_dir(spark, "holes"), "parquet", "6 hours")
    files.write(holed.select("event_id", "event_ts"), 0)
    kept = files.read(T.StructType([T.StructField("event_id", T.LongType())]))
    return (
        counted.select(F.col("agg_key").alias("id"), F.col("result_long").alias("n"), F.lit("counted").alias("outcome"))
        .unionByName(timed.failed.select(F.col("event_id").alias("id"), F.lit(1).cast("bigint").alias("n"), F.col("stage").alias("outcome")))
        .unionByName(kept.select(F.col("event_id").cast("string").alias("id"), F.lit(1).cast("bigint").alias("n"), F.col("window").alias("outcome")))
    )
