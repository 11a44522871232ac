"""Streaming windows, late rows and panes, run to the end over staged arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.counts import COUNT_15M, USER, count_by, count_sql, shown
from catalog.registry import ntz, query, table
from millrace.operators.windows import count_closed, count_windows
from millrace.plans.config import Aggregation, EarlyFirings, millis
from millrace.session import Folder, fresh_dir
from millrace.sinks.files import with_window_folders
from millrace.sources.events import SourceOptions, read_events
from millrace.sources.topic import read_topic_log, topic_records, write_topic_log
from millrace.streaming.panes import count_panes
from millrace.streaming.running import append_to_files, read_arrivals, run_to_end, stage_arrivals, start_batches, stop_when, update_to_files

BATCHES = 12
ROWS_PER_FILE = 1_000_000


def event_stream(spark, sf_dir, event_time="ts") -> DataFrame:
    """The events file as a stream."""
    schema = table(spark, sf_dir, "events").schema
    return read_events(
        spark, SourceOptions(path=sf_dir, schema=schema, glob="events.parquet", event_time=event_time)
    )


def staged(df: DataFrame, number: str = "event_id") -> tuple[str, int]:
    """Write rows as arriving files: twelve batches by number, every 17th row three batches late."""
    size, rows = df.agg(F.expr(f"(max({number}) + {BATCHES}) div {BATCHES}"), F.count("*")).first()
    arrival = F.expr(f"({number} + IF({number} % 17 = 0, 3 * {size}, 0)) div {size}")
    files = max(1, -(-rows // (BATCHES * ROWS_PER_FILE)))
    return stage_arrivals(df, arrival, files), files


def late_events(spark, sf_dir) -> DataFrame:
    """Events as a stream in arrival order, one batch per trigger."""
    events = table(spark, sf_dir, "events").withColumn("event_ts", F.col("ts").cast("timestamp")).drop("ts")
    path, files = staged(events)
    return read_arrivals(spark, path, events.schema, files)


ARRIVALS = f"""p AS (SELECT (max(event_id) + {BATCHES}) // {BATCHES} AS size FROM events),
e AS (SELECT *, (event_id + CASE WHEN event_id % 17 = 0 THEN 3 * size ELSE 0 END) // size AS b FROM events, p),
m AS (SELECT b, max(ts) AS latest FROM e GROUP BY b),
x AS (SELECT DISTINCT b FROM e UNION SELECT max(b) + 1 FROM e),
w AS (SELECT x.b, max(m.latest) AS seen FROM x LEFT JOIN m ON m.b < x.b GROUP BY x.b)"""


@query("src_file_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def src_file_stream(spark, sf_dir):
    stream = event_stream(spark, sf_dir, None)
    return spark.read.schema(stream.schema).parquet(append_to_files(stream, spark, "file-stream"))


@query("src_event_time", "SELECT o_orderkey, o_orderdate AS event_ts FROM orders")
def src_event_time(spark, sf_dir):
    """Event time taken from a chosen column instead of the payload."""
    schema = table(spark, sf_dir, "orders").schema
    stream = read_events(spark, SourceOptions(path=sf_dir, schema=schema, glob="orders.parquet", event_time="o_orderdate"))
    chosen = stream.select("o_orderkey", "event_ts")
    path = append_to_files(chosen, spark, "event-time")
    return spark.read.schema(chosen.schema).parquet(path).select("o_orderkey", ntz("event_ts", "event_ts"))


@query(
    "agg_count_15m_append",
    f"SELECT * FROM ({COUNT_15M}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'",
)
def agg_count_15m_append(spark, sf_dir):
    """Append mode: one row per window that the watermark has closed."""
    counts = count_windows(event_stream(spark, sf_dir), [count_by("user_id")])
    return shown(spark.read.schema(counts.schema).parquet(append_to_files(counts, spark, "append")))


@query(
    "late_rows",
    f"""WITH {ARRIVALS},
    late AS (SELECT w.b, max(prior.seen) AS bound FROM w LEFT JOIN w prior ON prior.b < w.b GROUP BY w.b),
    c AS (SELECT user_id::VARCHAR AS agg_key, time_bucket(INTERVAL '15 minutes', ts) AS window_start, e.b FROM e)
    SELECT 'count_user_id' AS agg_name, agg_key, window_start, window_start + INTERVAL '15 minutes' AS window_end,
      count(*) AS result_long
    FROM c JOIN late USING (b)
    WHERE (bound IS NULL OR window_start + INTERVAL '15 minutes' > bound - INTERVAL '1 minute')
      AND window_start + INTERVAL '15 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'
    GROUP BY agg_key, window_start""",
)
def late_rows(spark, sf_dir):
    """Rows that arrive after their window closed are dropped; the rest are counted."""
    counts = count_windows(late_events(spark, sf_dir), [count_by("user_id")])
    return shown(spark.read.schema(counts.schema).parquet(append_to_files(counts, spark, "late")))


@query(
    "window_5m_files",
    """SELECT event_id, strftime(w, '%Y-%m-%d') AS date, strftime(w, '%H') AS hour, strftime(w, '%H%M') AS "window"
      FROM (SELECT *, time_bucket(INTERVAL '5 minutes', ts) AS w FROM events)""",
)
def window_5m_files(spark, sf_dir):
    """Five-minute windows as folders, written by the streaming file sink."""
    shaped = with_window_folders(event_stream(spark, sf_dir).select("event_id", "event_ts"))
    path = append_to_files(shaped, spark, "windows", partition_by=("date", "hour"))
    return spark.read.schema(shaped.schema).parquet(path).select("event_id", "date", "hour", "window")


LENGTH, LATENESS, EARLY = "5d", "3d", 4


def pane_config(accumulating: bool = True, count: int | None = EARLY, time: str | None = None) -> Aggregation:
    early = EarlyFirings(True, count, millis(time) if time else None, accumulating)
    return Aggregation(("user_id",), millis(LENGTH), millis(LATENESS), early)


def panes_sql(early: int = EARLY) -> str:
    """All panes: agg_key, ws, we, pane, is_final, total, delta."""
    return f"""WITH RECURSIVE {ARRIVALS},
    g AS (SELECT user_id::VARCHAR AS agg_key, time_bucket(INTERVAL '5 days', ts, TIMESTAMP '1970-01-01') AS ws, b FROM e),
    c AS (SELECT agg_key, ws, ws + INTERVAL '5 days' AS we, b, any_value(seen) AS seen, count(*) AS n
      FROM g JOIN w USING (b)
      WHERE seen IS NULL OR ws + INTERVAL '5 days' > seen - INTERVAL '3 days' GROUP BY agg_key, ws, b),
    s AS (SELECT *, row_number() OVER (PARTITION BY agg_key, ws ORDER BY b) AS rn,
      sum(n) OVER (PARTITION BY agg_key, ws ORDER BY b) AS total FROM c),
    r AS (SELECT s.*, n AS pending, (seen IS NULL OR seen < we) AND n >= {early} AS fire FROM s WHERE rn = 1
      UNION ALL
      SELECT s.*, CASE WHEN r.fire THEN 0 ELSE r.pending END + s.n AS pending,
        (s.seen IS NULL OR s.seen < s.we) AND CASE WHEN r.fire THEN 0 ELSE r.pending END + s.n >= {early} AS fire
      FROM r JOIN s ON s.agg_key = r.agg_key AND s.ws = r.ws AND s.rn = r.rn + 1),
    k AS (SELECT agg_key, ws, we, min(b) AS first_b, sum(n) AS whole, coalesce(max(total) FILTER (WHERE fire), 0) AS early_total,
        (SELECT min(w.b) FROM w WHERE w.seen >= r.we) AS passed,
        (SELECT min(w.b) FROM w WHERE w.seen - INTERVAL '3 days' >= r.we) AS closed
      FROM r GROUP BY agg_key, ws, we),
    o AS (SELECT k.*, greatest(passed, first_b) AS ontime_b,
        passed IS NOT NULL AND (closed IS NULL OR greatest(passed, first_b) < closed) AS has_ontime FROM k),
    t AS (SELECT o.*, CASE WHEN has_ontime THEN (SELECT sum(n) FROM c WHERE c.agg_key = o.agg_key AND c.ws = o.ws AND c.b <= o.ontime_b) END AS ontime_total FROM o),
    panes AS (
      SELECT agg_key, ws, we, 'early' AS pane, false AS is_final, total, pending AS delta FROM r WHERE fire
      UNION ALL SELECT agg_key, ws, we, 'on_time', false, ontime_total, ontime_total - early_total FROM t WHERE has_ontime
      UNION ALL SELECT agg_key, ws, we, 'final', true, whole, whole - coalesce(ontime_total, early_total) FROM t WHERE closed IS NOT NULL)"""


def selected_panes(value: str, where: str = "true", early: int = EARLY) -> str:
    return f"""{panes_sql(early)} SELECT agg_key, ws AS window_start, we AS window_end, pane, is_final,
      {value}::BIGINT AS result_long FROM panes WHERE {where}"""


def run_panes(spark, sf_dir, config: Aggregation, closing: str = "always") -> DataFrame:
    panes = count_panes(late_events(spark, sf_dir), [config], closing=closing)
    found = spark.read.schema(panes.schema).parquet(update_to_files(panes, spark, "panes"))
    return found.select(
        "agg_key", ntz("window_start", "window_start"), ntz("window_end", "window_end"), "pane", "is_final", "result_long"
    )


@query("panes_early_count", selected_panes("total", "pane = 'early'"))
def panes_early_count(spark, sf_dir):
    """Early panes whenever four more elements have arrived."""
    return run_panes(spark, sf_dir, pane_config()).filter("pane = 'early'")


@query("panes_accumulating", selected_panes("total"))
def panes_accumulating(spark, sf_dir):
    return run_panes(spark, sf_dir, pane_config(accumulating=True))


@query("panes_discarding", selected_panes("delta"))
def panes_discarding(spark, sf_dir):
    return run_panes(spark, sf_dir, pane_config(accumulating=False))


@query("panes_final", selected_panes("total", "is_final AND delta > 0"))
def panes_final(spark, sf_dir):
    """Final panes of the windows that changed after their last pane."""
    return run_panes(spark, sf_dir, pane_config(), closing="if_changed").filter("is_final")


@query("panes_early_time", selected_panes("total", early=1))
def panes_early_time(spark, sf_dir):
    """Processing-time firings with no delay: a pane in every micro-batch that brings elements."""
    return run_panes(spark, sf_dir, pane_config(count=None, time="0s"))


@query(
    "agg_multi_stream",
    f"""SELECT * FROM ({count_sql("count_user_id_15m", USER, "15 minutes")}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'
    UNION ALL SELECT * FROM ({count_sql("count_user_id_1h", USER, "1 hour")}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'
    UNION ALL SELECT * FROM ({count_sql("count_event_type", "event_type", "1 day")}) WHERE window_end <= (SELECT max(ts) FROM events)""",
)
def agg_multi_stream(spark, sf_dir):
    """Three aggregations, two of them on one key, each with its own window and lateness, in one streamed read."""
    wanted = [
        Aggregation(("user_id",), millis("15m"), millis("1m")),
        Aggregation(("user_id",), millis("1h"), millis("1h")),
        Aggregation(("event_type",), millis("1d")),
    ]
    closed = count_closed(event_stream(spark, sf_dir), wanted)
    return shown(spark.read.schema(closed.schema).parquet(append_to_files(closed, spark, "multi")))


LATENESSES = [("count_user_id_15m", USER, "15 minutes", "10 minutes"), ("count_user_id_1h", USER, "1 hour", "0 minutes"),
              ("count_event_type", "event_type", "7 minutes", "2 hours")]


@query(
    "agg_latenesses",
    f"""WITH {ARRIVALS}, f AS (SELECT e.*, w.seen FROM e JOIN w USING (b)), t AS (SELECT max(ts) AS latest FROM events)
    """
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS agg_name, agg_key, window_start, window_end, total FROM (
        SELECT {key} AS agg_key, time_bucket(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01') AS window_start,
          time_bucket(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{length}' AS window_end, count(*) AS total
        FROM f WHERE seen IS NULL OR time_bucket(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{length}' + INTERVAL '{late}' > seen GROUP BY ALL
        ), t WHERE window_end + INTERVAL '{late}' <= latest"""
        for name, key, length, late in LATENESSES
    ),
)
def agg_latenesses(spark, sf_dir):
    """Late arrivals in twelve batches: each aggregation drops by its own lateness what the others still count."""
    wanted = [
        Aggregation(("user_id",), millis("15m"), millis("10m")),
        Aggregation(("user_id",), millis("1h"), 0),
        Aggregation(("event_type",), millis("7m"), millis("2h")),
    ]
    closed = count_closed(late_events(spark, sf_dir), wanted)
    rows = spark.read.schema(closed.schema).parquet(append_to_files(closed, spark, "latenesses"))
    return rows.select("agg_name", "agg_key", ntz("window_start", "window_start"), ntz("window_end", "window_end"), F.col("result_long").alias("total"))


EARLY_BATCHES = 50  # far more than the triggers that fit in the delay: the first one after it fires all panes that wait


@query(
    "panes_early_delay",
    f"""SELECT agg_key, window_start, window_end, pane, total FROM (
      SELECT agg_key, window_start, window_end, 'early' AS pane, result_long AS total, max(window_end) OVER () AS last
      FROM ({count_sql("count_user_id", USER, "1 day")}))
    WHERE window_end > (SELECT max(ts) FROM events)""",
)
def panes_early_delay(spark, sf_dir):
    """All events arrive at once and nothing after them: the windows still open show their early pane when the delay is over."""
    wanted = [Aggregation(("user_id",), millis("1d"), 0, EarlyFirings(True, time_ms=1500))]
    stream = event_stream(spark, sf_dir)
    newest = F.date_trunc("day", F.max(F.col("ts").cast("timestamp")))
    last = table(spark, sf_dir, "events").agg(newest).first()[0]
    open_keys = table(spark, sf_dir, "events").filter(F.col("ts").cast("timestamp") >= F.lit(last)).select("user_id").distinct().count()
    path = fresh_dir(spark, "early-delay")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.filter("pane = 'early'").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    panes = count_panes(stream, wanted, waiting=True)
    running = start_batches(panes, spark, "early-delay", handle, "update", trigger={"processingTime": "300 milliseconds"})
    schema = panes.schema

    def shown_all() -> bool:
        return Folder(spark, path).exists() and spark.read.schema(schema).parquet(path).count() >= open_keys

    stop_when(running, shown_all, most_batches=EARLY_BATCHES)
    found = spark.read.schema(schema).parquet(path)
    return found.select("agg_key", ntz("window_start", "window_start"), ntz("window_end", "window_end"), "pane", F.col("result_long").alias("total"))


def events_topic(spark, sf_dir) -> str:
    """All events, in twelve batches, as a topic of four partitions by number."""
    path = fresh_dir(spark, "topic") + "/events"
    events = late_events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"), F.create_map(F.lit("type"), "event_type").alias("attributes"),
        F.col("props").cast("binary").alias("payload"), "event_ts",
    )
    records = topic_records(events, 4, F.pmod(F.col("event_id").cast("long"), F.lit(4)))
    run_to_end(write_topic_log(records, path, fresh_dir(spark, "topic-writer")), spark)
    return path


@query("topic_roundtrip", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props, ts AS event_ts FROM events")
def topic_roundtrip(spark, sf_dir):
    """Written to a topic by one query, read from it as transports by another."""
    stream = read_events(spark, SourceOptions("topic", events_topic(spark, sf_dir)))
    path = append_to_files(stream, spark, "topic-read")
    read = spark.read.schema(stream.schema).parquet(path)
    return read.select("event_id", F.col("attributes")["type"].alias("event_type"), F.col("payload").cast("string").alias("props"), ntz("event_ts", "event_ts"))


@query(
    "topic_offsets",
    """SELECT CAST(event_id % 4 AS INTEGER) AS "partition", CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset, count(*) AS records,
      count(DISTINCT event_id) AS keys, CAST(0 AS BIGINT) AS backward FROM events GROUP BY 1""",
)
def topic_offsets(spark, sf_dir):
    """Offsets are gapless in each partition, and append times never go back along them."""
    topic = read_topic_log(spark, events_topic(spark, sf_dir), timestampType="LOG_APPEND_TIME")
    commits = topic.groupBy("partition", "timestamp").agg(F.min("offset").alias("low"), F.max("offset").alias("high"), F.count("*").alias("n"), F.countDistinct("offset").alias("o"), F.countDistinct("key").alias("k"))
    later = commits.alias("a").join(commits.alias("b"), (F.col("a.partition") == F.col("b.partition")) & (F.col("a.timestamp") < F.col("b.timestamp")))
    backward = later.filter("a.high >= b.low").groupBy(F.col("a.partition").alias("partition")).agg(F.count("*").alias("backward"))
    ends = commits.groupBy("partition").agg(F.min("low").alias("first_offset"), F.max("high").alias("last_offset"), F.sum("o").alias("records"), F.sum("k").alias("keys"))
    return ends.join(backward, "partition", "left").select("partition", "first_offset", "last_offset", "records", "keys", F.coalesce("backward", F.lit(0)).alias("backward"))
