import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.decode import decode
from millrace.plans import flows
from millrace.plans.config import Aggregation, EarlyFirings, TableOptions
from millrace.schemas import CELL, ERROR, TRANSPORT
from millrace.session import fresh_dir, scoped_conf
from millrace.sinks.cells import CellTable
from millrace.sinks.files import WindowedFiles
from millrace.sinks.tables import AppendTable, destination, spread_for_write
from millrace.streaming.running import read_arrivals, stage_arrivals
from tests.conftest import wait_until

ROW = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())])
K = T.StructType([T.StructField("k", T.LongType())])


def rows(spark, start=0, stop=100):
    return spark.range(start, stop, 1, 3).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 86_400).alias("ts"))


def test_exactly_once_and_at_least_once(spark):
    for guarantee, expected in (("exactly_once", 100), ("at_least_once", 200), ("row_inserts", 200)):
        table = AppendTable(spark, TableOptions(fresh_dir(spark, "t"), guarantee=guarantee))
        table.write(rows(spark), 3)
        table.write(rows(spark), 3)
        assert table.read(ROW).count() == expected


def test_missing_table_is_not_created_when_forbidden(spark):
    path = fresh_dir(spark, "t")
    with pytest.raises(FileNotFoundError):
        AppendTable(spark, TableOptions(path, create_if_needed=False))
    AppendTable(spark, TableOptions(path)).write(rows(spark), 0)
    assert AppendTable(spark, TableOptions(path, create_if_needed=False)).read(ROW).count() == 100


@pytest.mark.parametrize("unit,parts", [("HOUR", 100), ("DAY", 100), ("MONTH", 4), ("YEAR", 1)])
def test_time_partitions(spark, unit, parts):
    path = fresh_dir(spark, "t")
    table = AppendTable(spark, TableOptions(path, time_column="ts", time_unit=unit, guarantee="exactly_once"))
    table.write(rows(spark), 0)
    assert len([n for n in os.listdir(f"{path}/query=direct/batch_id=0") if n.startswith("time_partition=")]) == parts
    assert table.read(ROW).count() == 100


@pytest.mark.parametrize("extra", [dict(autoshard=True), dict(streams=2), dict(streams=3, destinations=2), dict(autoshard=True, destinations=2)])
def test_sharding_keeps_every_row(spark, extra):
    table = AppendTable(spark, TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once", **extra))
    table.write(rows(spark), 0)
    assert table.read(ROW).distinct().count() == 100


def test_destinations(spark):
    even = destination(spark.range(4000), "t", 4, "id").groupBy("destination").count().collect()
    assert {r["destination"] for r in even} == {f"t-{i}" for i in range(4)} and all(900 < r["count"] < 1100 for r in even)
    skew = destination(spark.range(4000), "t", 16, "id", skewed=True).groupBy("destination").count().collect()
    assert {r["destination"] for r in skew} == {"t-7", "t-8"}  # degree 80: the middle of the range


def test_hot_partition_is_spread(spark):
    hot = spark.range(0, 4000, 1, 8).withColumn("dest", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50))
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):  # a few rows would be coalesced
        spread = spread_for_write(hot, ("dest",), 4).withColumn("task", F.spark_partition_id())
        found = spread.groupBy("task", "dest").count().collect()
    assert sum(r["count"] for r in found) == 4000
    assert sum(r["dest"] == 0 for r in found) > 1


def cells(spark, value, keys=3):
    return spark.range(keys).select(
        F.col("id").cast("string").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit(1).cast("bigint").alias("ts_micros"), F.lit(value).cast("binary").alias("value"),
    )


def values(table):
    return {r["row_key"]: bytes(r["value"]).decode() for r in table.read().collect()}


def test_cell_table_replay_and_snapshots(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    assert table.read().count() == 0 and table.read().columns == CELL.fieldNames()
    table.write(cells(spark, "a"), 0)
    table.write(cells(spark, "b", 2), 1)
    table.write(cells(spark, "b", 2), 1)
    assert values(table) == {"0": "b", "1": "b", "2": "a"}
    table.merge()
    table.merge()
    assert table.snapshots() == [0] and values(table) == {"0": "b", "1": "b", "2": "a"}
    table.write(cells(spark, "c", 1), 2)
    assert values(table) == {"0": "c", "1": "b", "2": "a"}
    os.makedirs(f"{table.path}/merged/snapshot=9")  # a snapshot that was never finished
    assert table.snapshots() == [0] and values(table) == {"0": "c", "1": "b", "2": "a"}


def test_snapshot_drops_old_versions(spark):
    table = CellTable(spark, fresh_dir(spark, "cells"))
    many = spark.range(20).select(
        F.lit("r").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.col("id").alias("ts_micros"), F.lit("v").cast("binary").alias("value"),
    )
    table.write(many, 0)
    table.merge()
    assert sorted(r["ts_micros"] for r in table.read().collect()) == [15, 16, 17, 18, 19]


def hours(spark, first, last):
    ids = spark.range(first, last, 1, 2)
    return ids.select(F.col("id").cast("string").alias("value"), F.timestamp_seconds(F.col("id") * 600).alias("event_ts"))


def test_hours_are_marked_once_they_are_complete(spark):
    files = WindowedFiles(spark, fresh_dir(spark, "files"), "json")
    files.write(hours(spark, 0, 9), 0)  # until 01:20
    assert [r["batch_id"] for r in files.markers().collect()] == [0]
    files.write(hours(spark, 9, 14), 1)  # until 02:10
    files.write(hours(spark, 9, 14), 1)
    assert sorted((r["hour_start"].hour, r["batch_id"]) for r in files.markers().collect()) == [(0, 0), (1, 1)]
    assert files.read().count() == 14
    assert {r["window"] for r in files.read().collect()} >= {"0000", "0010", "0210"}


def test_files_with_no_rows_and_unknown_formats(spark):
    files = WindowedFiles(spark, fresh_dir(spark, "files"), "json")
    files.write(hours(spark, 0, 0), 0)
    assert files.markers().count() == 0
    with pytest.raises(ValueError):
        WindowedFiles(spark, "p", "xml")


def test_missing_checkpoint_folder_on_a_cluster(spark, monkeypatch):
    from millrace import session

    class Context:
        master = "spark://host:7077"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Fake:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.scratch_root(Fake())


def test_ingest_in_the_background_and_restart(spark):
    source = fresh_dir(spark, "topic")
    checkpoint = fresh_dir(spark, "checkpoint")

    def publish(ids):
        bodies = [(str(i), {}, bytearray((f'{{"k": {i}}}' if i % 4 else "broken").encode()), None) for i in ids]
        spark.createDataFrame(bodies, TRANSPORT).write.mode("append").parquet(source)

    publish(range(0, 20))
    options = TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once", flush_seconds=1)
    stream = spark.readStream.schema(TRANSPORT).parquet(source)
    table, query = flows.start_ingest(spark, stream, options, K, checkpoint=checkpoint)
    query.processAllAvailable()
    query.stop()
    publish(range(20, 40))
    table = flows.ingest(spark, stream, options, K, checkpoint=checkpoint)
    schema = T.StructType([T.StructField("event_id", T.StringType())] + K.fields)
    assert sorted(r["k"] for r in table.read(schema).collect()) == [i for i in range(40) if i % 4]
    assert sorted(int(r["event_id"]) for r in table.read_errors(ERROR).collect()) == list(range(0, 40, 4))


def test_aggregate_without_early_firings_and_its_errors(spark):
    bodies = spark.range(0, 200, 1, 2).select(
        F.col("id").alias("n"),
        F.col("id").cast("string").alias("event_id"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        F.when(F.col("id") % 10 == 0, F.lit("broken")).otherwise(F.concat(F.lit('{"k": '), F.col("id") % 3, F.lit("}"))).cast("binary").alias("payload"),
        F.timestamp_seconds(F.col("id") * 60).alias("event_ts"),
    )
    path = stage_arrivals(bodies, F.expr("n div 50"))
    stream = read_arrivals(spark, path, TRANSPORT)
    wanted = [Aggregation(("k",), 3_600_000, 0, EarlyFirings())]
    table = flows.aggregate(spark, stream, K, wanted, "p.i.t", fresh_dir(spark, "root"))
    counted = sum(int.from_bytes(r["value"], "big") for r in table.read().collect())
    good = [i for i in range(180) if i % 10]  # the hour that starts at 180 is still open
    assert counted == len(good)
    errors = flows.aggregate_errors(spark, stream, K, TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once"))
    assert errors.read_errors(ERROR).count() == 20


def test_results_and_dead_letters_come_from_one_pass(spark):
    """Every payload is inflated once, good or bad, and bad ones do not wait for a window to close."""
    from millrace.operators.envelope import pack
    from millrace.streaming.running import finish

    plain = spark.range(0, 240, 1, 4).select(
        F.col("id").cast("string").alias("event_id"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        F.when(F.col("id") % 8 == 0, F.lit('{"k": 1} x')).otherwise(F.concat(F.lit('{"k": '), F.col("id") % 3, F.lit("}"))).cast("binary").alias("payload"),
        F.when(F.col("id") % 9 != 1, F.timestamp_seconds(F.col("id"))).alias("event_ts"),
    )
    path = fresh_dir(spark, "one-pass")
    pack(plain, 30, 1).write.parquet(path)
    stream = spark.readStream.schema(TRANSPORT).parquet(path)
    for early in (EarlyFirings(), EarlyFirings(True, count=3)):
        wanted = [Aggregation(("k",), 60_000, 0, early), Aggregation(("k",), 120_000, 30_000)]
        options = TableOptions(fresh_dir(spark, "t"), guarantee="exactly_once")
        table, query = flows.start_aggregate(spark, stream, K, wanted, "p.i.t", fresh_dir(spark, "root"), errors=options)
        finish(query)
        plan = query._jsq.explainInternal(False)
        assert plan.count("ReusedExchange") == 1 and plan.count("explode(array(from_json") == 1, plan
        failed = AppendTable(spark, options).read_errors(ERROR)
        bad, untimed = {str(i) for i in range(0, 240, 8)}, {str(i) for i in range(240) if i % 9 == 1 and i % 8}
        assert {(r["event_id"], r["stage"]) for r in failed.collect()} == {(i, "decode") for i in bad} | {(i, "event_time") for i in untimed}
        assert failed.count() == len(bad | untimed)
        final = [r for r in table.read().collect() if "_final:" in r["qualifier"] and "_1m_" in r["qualifier"]]
        good = [i for i in range(180) if i % 8 and i % 9 != 1]  # the minute that starts at 180 is still open
        assert sum(int.from_bytes(r["value"], "big") for r in final) == len(good)


def test_generated_transports_carry_their_schema(spark):
    from millrace.operators.transport import expand_schema, schema_text

    options = flows.GenerateOptions("log", "JSON")
    made = flows.generate_events(spark.range(5), "id", options)
    row = made.withColumn("schema", schema_text(F.col("attributes"))).first()
    assert T.StructType.fromJson(__import__("json").loads(expand_schema(row["schema"]))).fieldNames()[0] == "category"
    thrift = flows.generate_events(spark.range(5), "id", flows.GenerateOptions("simple", "THRIFT"))
    assert thrift.first()["attributes"] == {} and decode(thrift, "simple").ok.count() == 5


def test_generation_at_a_rate_fills_envelopes(spark):
    from millrace.operators.envelope import maybe_decompress
    from millrace.sources.generator import GeneratorOptions

    path = fresh_dir(spark, "topic")
    options = flows.GenerateOptions("simple", "THRIFT", GeneratorOptions(min_chars=5, max_chars=9), compressed=True, records_per_envelope=25)
    query = flows.start_generate(spark, options, 100, path, fresh_dir(spark, "checkpoint"), partitions=2)
    try:
        wait_until(lambda: any(p["numInputRows"] for p in query.recentProgress))
    finally:
        query.stop()
    topic = spark.read.schema(TRANSPORT).parquet(path)
    sizes = [int(r["attributes"]["records"]) for r in topic.collect()]
    assert sizes and set(sizes) == {25}
    names = [r["event_id"] for r in topic.collect()]
    assert len(set(names)) == len(names)
    opened = decode(maybe_decompress(topic).ok, "simple").ok
    assert opened.select("event_id").distinct().count() == sum(sizes)


def test_streaming_autoshard_and_streaming_sizes(spark):
    from millrace.operators.stats import observe_payloads
    from millrace.streaming.running import finish, start_batches

    source = fresh_dir(spark, "topic")
    bodies = [(str(i), {}, bytearray(b"abc"), None) for i in range(50)]
    spark.createDataFrame(bodies, TRANSPORT).write.parquet(source)
    table = AppendTable(spark, TableOptions(fresh_dir(spark, "t"), destinations=2, autoshard=True, guarantee="exactly_once"))
    stream, _ = observe_payloads(spark.readStream.schema(TRANSPORT).parquet(source), "sizes")
    query = start_batches(stream.select("event_id"), spark, "auto", table.write)
    finish(query)
    assert table.read(T.StructType([T.StructField("event_id", T.StringType())])).count() == 50
    seen = [p["observedMetrics"]["sizes"]["total"] for p in query.recentProgress if "sizes" in p["observedMetrics"]]
    assert sum(v or 0 for v in seen) == 150


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_an_empty_batch_marks_nothing_and_keeps_the_state(spark, fmt):
    hours = spark.range(10).select(F.timestamp_seconds(F.col("id") * 3600).alias("event_ts"), F.col("id").cast("string").alias("value"))
    path = fresh_dir(spark, "empty")
    hours.limit(0).write.parquet(path)
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "true"}):
        files = WindowedFiles(spark, fresh_dir(spark, "w"), fmt, "1 day", 3600, 2)
        files.write(spark.read.schema(hours.schema).parquet(path), 0)
        files.write(hours.filter("value < 5"), 1)
        files.write(spark.read.schema(hours.schema).parquet(path), 2)
        assert files.markers().count() == 3
        files.write(hours.filter("value >= 5"), 3)
    assert files.markers().count() == 8 and files.read(hours.schema).count() == 10
