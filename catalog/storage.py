"""Table, file and cell sinks, and the composed flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import duck
from catalog.counts import COUNT_15M, cells_sql, count_by, shown_cells, timed_events
from catalog.registry import ntz, query, table, text_hex
from catalog.streams import LATENESS, LENGTH, event_stream, panes_sql, staged
from catalog.transports import EVENT, PROPS, TURN, avro_transports, event_transports, record_transports, text_transports
from millrace.operators.decode import decode, payload_text
from millrace.operators.envelope import maybe_decompress, pack
from millrace.operators.transforms import load_transform
from millrace.plans import flows
from millrace.plans.config import TableOptions, load_aggregations
from millrace.schemas import ERROR, TRANSPORT
from millrace.session import fresh_dir
from millrace.sources import avro_files
from millrace.sinks.tables import SKEW_DEGREE, AppendTable, destination
from millrace.sources.generator import GeneratorOptions
from millrace.sources.sequence import spread
from millrace.streaming.running import append_to_files, read_arrivals, run_batches, run_to_end

STORED = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("event_ts", T.TimestampType())] + EVENT.fields)
EVENT_COLUMNS = "event_id::VARCHAR AS event_id, user_id, event_type, value, props, ts AS event_ts"


def stored(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", *EVENT.fieldNames(), ntz("event_ts", "event_ts"))


def as_stream(transports: DataFrame, files_per_trigger: int = 1000) -> DataFrame:
    """Write transports to a folder and read it as a stream."""
    spark = transports.sparkSession
    path = fresh_dir(spark, "topic")
    transports.write.parquet(path)
    return read_arrivals(spark, path, TRANSPORT, files_per_trigger)


@query("sink_table_append", f"SELECT {EVENT_COLUMNS} FROM events")
def sink_table_append(spark, sf_dir):
    """Appended over several micro-batches, at least once."""
    target = AppendTable(spark, TableOptions(fresh_dir(spark, "table"), record_shape="TABLE_ROW", streams=2))
    rows = decode(as_stream(record_transports(spark, sf_dir).repartition(4, "event_id"), 2), EVENT).ok.drop("attributes")
    run_batches(rows, spark, "append-table", lambda batch, number: target.write(batch, number))
    return stored(target.read(STORED))


@query("sink_replay_idempotent", f"SELECT {EVENT_COLUMNS} FROM events")
def sink_replay_idempotent(spark, sf_dir):
    """Every micro-batch is written twice; exactly-once tables keep one copy."""
    target = AppendTable(spark, TableOptions(fresh_dir(spark, "table"), guarantee="exactly_once"))
    rows = decode(as_stream(record_transports(spark, sf_dir).repartition(4, "event_id"), 2), EVENT).ok.drop("attributes")

    def handle(batch, number):
        target.write(batch, number)
        target.write(batch, number)

    run_batches(rows, spark, "replay", handle)
    return stored(target.read(STORED))


def routed_sql(number: str) -> str:
    return f"SELECT event_id, 'events-' || CAST({number} AS VARCHAR) AS destination FROM {duck.lanes('events', 'event_id')}"


@query("route_uniform", routed_sql(duck.DRAWS.below(4, "destination")))
def route_uniform(spark, sf_dir):
    """Fan-out to four tables."""
    options = TableOptions(fresh_dir(spark, "fan-out") + "/events", destinations=4, guarantee="exactly_once")
    target = AppendTable(spark, options)
    target.write(timed_events(spark, sf_dir).select("event_id"), 0)
    return target.read(T.StructType([T.StructField("event_id", T.LongType()), T.StructField("destination", T.StringType())]))


@query("route_skewed", routed_sql(duck.DRAWS.skewed(16, SKEW_DEGREE, "destination")))
def route_skewed(spark, sf_dir):
    """Skewed fan-out to sixteen tables."""
    return destination(table(spark, sf_dir, "events").select("event_id"), "events", 16, "event_id", skewed=True)


@query("sink_time_partition", "SELECT o_orderkey, date_trunc('month', o_orderdate) AS time_partition FROM orders")
def sink_time_partition(spark, sf_dir):
    options = TableOptions(
        fresh_dir(spark, "monthly"), time_column="o_orderdate", time_unit="MONTH", guarantee="exactly_once", streams=4
    )
    target = AppendTable(spark, options)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    target.write(orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")), 0)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("time_partition", T.TimestampType())])
    return target.read(schema).select("o_orderkey", ntz("time_partition", "time_partition"))


@query(
    "sink_errors",
    """SELECT 'conversations-' || conv_id || '-' || turn AS event_id, 'decode' AS stage, md5(text) AS payload FROM conversations
      WHERE NOT json_valid(text) OR json_type(text) <> 'OBJECT'""",
)
def sink_errors(spark, sf_dir):
    """Dead letters of an ingestion land in the table's own error table."""
    mixed = event_transports(spark, sf_dir).unionByName(text_transports(spark, sf_dir, "conversations", TURN))
    options = TableOptions(fresh_dir(spark, "with-errors"), guarantee="exactly_once")
    target = flows.ingest(spark, as_stream(mixed), options, PROPS)
    return target.read_errors(ERROR).select("event_id", "stage", F.md5("payload").alias("payload"))


WINDOWED = f"""SELECT {EVENT_COLUMNS}, strftime(w, '%Y-%m-%d') AS date, strftime(w, '%H') AS hour, strftime(w, '%H%M') AS "window"
  FROM (SELECT *, time_bucket(INTERVAL '6 hours', ts) AS w FROM events)"""


def windowed(spark, sf_dir, fmt):
    files = flows.write_window_files(
        spark, as_stream(record_transports(spark, sf_dir)), fmt=fmt, schema=EVENT, length="6 hours", shards=4
    )
    rows = files.read(STORED)
    return rows.select(*stored(rows).columns[:-1], ntz("event_ts", "event_ts"), "date", "hour", "window")


@query("sink_files_parquet", WINDOWED)
def sink_files_parquet(spark, sf_dir):
    return windowed(spark, sf_dir, "parquet")


@query("sink_files_orc", WINDOWED)
def sink_files_orc(spark, sf_dir):
    return windowed(spark, sf_dir, "orc")


@query("sink_files_avro", WINDOWED)
def sink_files_avro(spark, sf_dir):
    """Container files by window, from Avro payloads."""
    transports = as_stream(avro_transports(spark, sf_dir))
    files = flows.write_window_files(spark, transports, fmt="avro", schema=EVENT, length="6 hours", payloads="AVRO")
    rows = files.read(STORED)
    return rows.select(*stored(rows).columns[:-1], ntz("event_ts", "event_ts"), "date", "hour", "window")


@query("avro_splits", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 0::BIGINT AS broken FROM orders")
def avro_splits(spark, sf_dir):
    """Container files read back in ranges that cut their blocks anywhere."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    orders, path = table(spark, sf_dir, "orders").select(*columns), fresh_dir(spark, "avro")
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    avro_files.write_avro(orders, path)
    out = avro_files.read_avro_or_errors(spark, path, orders.schema, splitBytes=100_003, tasks=2 * spark.sparkContext.defaultParallelism)
    broken = out.failed.agg(F.count("*").alias("broken"))
    return out.ok.withColumn("o_orderdate", ntz("o_orderdate", "o_orderdate")).crossJoin(F.broadcast(broken))


@query(
    "sink_files_json",
    """SELECT props AS payload, strftime(w, '%Y-%m-%d') AS date, strftime(w, '%H') AS hour, strftime(w, '%H%M') AS "window"
      FROM (SELECT *, time_bucket(INTERVAL '6 hours', ts) AS w FROM events)""",
)
def sink_files_json(spark, sf_dir):
    """Payload text, one JSON document per line, not parsed."""
    files = flows.write_window_files(spark, as_stream(event_transports(spark, sf_dir)), fmt="json", length="6 hours", shards=4)
    return files.read().select(F.col("value").alias("payload"), "date", "hour", "window")


@query(
    "hourly_markers",
    """SELECT DISTINCT date_trunc('hour', ts) AS hour_start FROM events
      WHERE date_trunc('hour', ts) + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'""",
)
def hourly_markers(spark, sf_dir):
    """One marker per hour that the watermark (an hour behind) has passed."""
    files = flows.write_window_files(
        spark, as_stream(event_transports(spark, sf_dir), 1), fmt="json", length="1 day", lateness_seconds=3600, shards=2
    )
    return files.markers().select(ntz("hour_start", "hour_start"))


@query("sink_topic_files", "SELECT event_id::VARCHAR AS event_id, props AS payload, ts AS event_ts FROM events")
def sink_topic_files(spark, sf_dir):
    path = fresh_dir(spark, "topic-out")
    stream = as_stream(event_transports(spark, sf_dir))
    run_to_end(flows.write_topic_files(stream, path, fresh_dir(spark, "topic-checkpoint")), spark)
    found = spark.read.schema(TRANSPORT).parquet(path)
    return found.select("event_id", payload_text().alias("payload"), ntz("event_ts", "event_ts"))


@query(
    "flow_ingest",
    """SELECT event_id::VARCHAR AS event_id, 'stored' AS stage, ((props ->> '$.k')::BIGINT * 2)::VARCHAR AS detail
      FROM events WHERE (props ->> '$.k')::BIGINT <= 90
    UNION ALL SELECT event_id::VARCHAR, 'transform', md5(props) FROM events WHERE (props ->> '$.k')::BIGINT > 90
    UNION ALL SELECT 'documents-' || doc_id, 'decompress', md5(text) FROM documents""",
)
def flow_ingest(spark, sf_dir):
    """Envelopes, plain events and texts that claim to be compressed: decompressed, transformed by
    a user function, decoded and stored, with the dead letters of every stage."""
    events = event_transports(spark, sf_dir)
    packed = pack(events.filter("event_ts < timestamp '2024-01-15'"), max_records=500)
    plain = events.filter("event_ts >= timestamp '2024-01-15'")
    bad = text_transports(spark, sf_dir, "documents", "doc_id", compressed=True)
    options = TableOptions(fresh_dir(spark, "ingest"), guarantee="exactly_once")
    target = flows.ingest(
        spark,
        as_stream(packed.unionByName(plain).unionByName(bad)),
        options,
        PROPS,
        event_transform=load_transform("catalog.transforms:reject_large"),
    )
    schema = T.StructType([T.StructField("event_id", T.StringType())] + PROPS.fields)
    good = target.read(schema).select("event_id", F.lit("stored").alias("stage"), F.col("k").cast("string").alias("detail"))
    failed = target.read_errors(ERROR).select("event_id", "stage", F.md5("payload").alias("detail"))
    return good.unionByName(failed)


CONFIG = f"""
aggregations:
  - type: COUNT
    window:
      length: {LENGTH}
      lateness: {LATENESS}
      earlyFirings:
        enabled: true
        count: 4
        accumulating: true
    input:
      format: JSON
    fields:
      key:
        - user_id
"""

@query("flow_aggregate_bounded", cells_sql(COUNT_15M))
def flow_aggregate_bounded(spark, sf_dir):
    """Decompress, decode, count per user and 15 minutes, shape as cells; bounded input."""
    return shown_cells(flows.aggregate_bounded(record_transports(spark, sf_dir), EVENT, [count_by("user_id")]).ok)


PANE_STAMP = "strftime(we - INTERVAL '1 millisecond', '%Y-%m-%dT%H:%M:%S.') || '999Z'"


@query(
    "flow_aggregate",
    f"""{panes_sql()} SELECT agg_key || '#' || {PANE_STAMP} AS row_key,
      'count_user_id' || CASE WHEN is_final THEN '_final' ELSE '' END || ':LONG:' || {PANE_STAMP} AS qualifier,
      epoch_ms(we - INTERVAL '1 millisecond') * 1000 AS ts_micros, lpad(hex(max(total)::BIGINT), 16, '0') AS value_hex
    FROM panes GROUP BY agg_key, we, is_final""",
)
def flow_aggregate(spark, sf_dir):
    """Late-arriving JSON events to panes to cells; each pane overwrites the one before."""
    transports = record_transports(spark, sf_dir).withColumn("number", F.col("event_id").cast("bigint"))
    path, files = staged(transports, "number")
    stream = read_arrivals(spark, path, TRANSPORT, files)
    cells = flows.aggregate(
        spark, stream, EVENT, load_aggregations(CONFIG), "project.instance.counts", fresh_dir(spark, "cells")
    )
    return cells.read().select("row_key", "qualifier", "ts_micros", text_hex("value", "value_hex"))


GENERATED = GeneratorOptions(min_chars=10, max_chars=20, max_collection=5, skewed_fields=("uuid",), skew_degree=10)


def generated_uuid() -> str:
    from catalog.generation import D
    from millrace.functions.draws import fixed_number

    bucket = D.skewed(1000, 10, "uuid^")
    length = f"((({bucket}) * 7919 + {fixed_number(42, 'uuid', 1 << 20)}) % 10 + 10)"
    return duck.letters_from(f"'42|uuid|bucket|' || CAST({bucket} AS VARCHAR)", length)


@query(
    "flow_generate",
    f"""SELECT sha256(event_id::VARCHAR) AS event_id, {generated_uuid()} AS uuid,
      {duck.DRAWS.long('externalId')} AS external_id, ts AS event_ts FROM {duck.lanes('events', 'event_id')}""",
)
def flow_generate(spark, sf_dir):
    """Generate compound events with a skewed key from a stream of numbers, pack them into
    envelopes, publish to a topic folder, read the topic back and decode."""
    options = flows.GenerateOptions("compound", "THRIFT", GENERATED, compressed=True, records_per_envelope=450)
    numbers = spread(event_stream(spark, sf_dir).select("event_id", "event_ts"))
    path = append_to_files(flows.generate_events(numbers, "event_id", options, "event_ts"), spark, "generated")
    topic = spark.read.schema(TRANSPORT).parquet(path)
    found = decode(maybe_decompress(topic).ok, "compound").ok
    return found.select("event_id", "uuid", F.col("externalId").alias("external_id"), ntz("event_ts", "event_ts"))


@query(
    "sink_two_runs",
    f"""SELECT event_id::VARCHAR AS id, 'event' AS kind, 1::BIGINT AS n FROM events
    UNION ALL SELECT 'conversations-' || conv_id || '-' || turn, 'error', 1 FROM conversations
      WHERE NOT json_valid(text) OR json_type(text) <> 'OBJECT'
    UNION ALL SELECT event_id::VARCHAR, 'file', 1 FROM events
    UNION ALL SELECT row_key, 'cell', ('0x' || value_hex)::BIGINT FROM ({cells_sql(COUNT_15M)})
      WHERE ts_micros < epoch_us((SELECT max(ts) FROM events) - INTERVAL '1 minute')""",
)
def sink_two_runs(spark, sf_dir):
    """Each sink is fed by two queries without a common checkpoint, the second after the first has ended;
    nothing that the first wrote is lost, also where a snapshot lies between the two."""
    records = record_transports(spark, sf_dir)
    noise = text_transports(spark, sf_dir, "conversations", TURN)
    first = F.crc32(F.col("event_id").cast("binary")) % 2 == 0
    options = TableOptions(fresh_dir(spark, "two-runs"), guarantee="exactly_once")
    files_path, cells_path = fresh_dir(spark, "two-runs-files"), fresh_dir(spark, "two-runs-cells")
    newest = records.agg(F.max("event_ts")).first()[0]
    half = records.agg(F.expr("timestamp_micros(unix_micros(min(event_ts)) + (unix_micros(max(event_ts)) - unix_micros(min(event_ts))) div 2)").alias("t")).select(F.date_trunc("DAY", "t")).first()[0]
    for part in (first, ~first):
        table_ = flows.ingest(spark, as_stream(records.unionByName(noise).filter(part)), options, EVENT)
        files = flows.write_window_files(spark, as_stream(records.filter(part)), files_path, "parquet", EVENT, length="6 hours")
    # Windows close when time has passed them, so the runs of the counts are two spans of time; the end of
    # all times closes the first span.
    mark = records.filter(F.col("event_ts") == F.lit(newest)).limit(1)
    early = records.filter(F.col("event_ts") < F.lit(half))
    for part in (early.unionByName(mark), records.filter(F.col("event_ts") >= F.lit(half))):
        cells = flows.aggregate(spark, as_stream(part), EVENT, [count_by("user_id")], "p.i.counts", cells_path)
        cells.merge()
    one = F.lit(1).cast("bigint").alias("n")
    stored_rows = table_.read(STORED).select(F.col("event_id").alias("id"), F.lit("event").alias("kind"), one)
    failed = table_.read_errors(ERROR).select(F.col("event_id").alias("id"), F.lit("error").alias("kind"), one)
    kept = files.read(STORED).select(F.col("event_id").alias("id"), F.lit("file").alias("kind"), one)
    counted = cells.read().select(F.col("row_key").alias("id"), F.lit("cell").alias("kind"), F.conv(F.hex("value"), 16, 10).cast("bigint").alias("n"))
    return stored_rows.unionByName(failed).unionByName(kept).unionByName(counted)


@query(
    "flow_aggregate_errors",
    """SELECT event_id::VARCHAR AS event_id, 'event_time' AS stage FROM events WHERE event_id % 13 = 0
    UNION ALL SELECT 'documents-' || doc_id, 'decompress' FROM documents
    UNION ALL SELECT 'conversations-' || conv_id || '-' || turn, 'decode' FROM conversations
      WHERE NOT json_valid(text) OR json_type(text) <> 'OBJECT'""",
)
def flow_aggregate_errors(spark, sf_dir):
    """The aggregation stores its own dead letters: bad envelopes, bad payloads, missing event times."""
    events = record_transports(spark, sf_dir)
    holed = events.withColumn("event_ts", F.when(F.expr("CAST(event_id AS BIGINT) % 13") != 0, F.col("event_ts")))
    bad = text_transports(spark, sf_dir, "documents", "doc_id", compressed=True)
    noise = text_transports(spark, sf_dir, "conversations", TURN)
    options = TableOptions(fresh_dir(spark, "aggregate-errors"), guarantee="exactly_once")
    flows.aggregate(
        spark, as_stream(holed.unionByName(bad).unionByName(noise)), EVENT, [count_by("user_id")], "p.i.counts", fresh_dir(spark, "cells"), errors=options
    )
    return AppendTable(spark, options).read_errors(ERROR).select("event_id", "stage")
