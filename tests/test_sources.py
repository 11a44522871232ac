import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fresh_dir
from millrace.sources.events import SourceOptions, read_events, transport_from_table
from millrace.sources.sequence import spread
from millrace.streaming.running import drain

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType())])


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_files_in_both_modes(spark, kind):
    path = fresh_dir(spark, "source")
    rows = spark.range(30).withColumn("at", F.timestamp_seconds("id"))
    rows.write.format(kind).save(path)
    batch = read_events(spark, SourceOptions(kind, path, ROW, streaming=False, event_time="at"))
    assert not batch.isStreaming and batch.filter("event_ts = at").count() == 30
    stream = read_events(spark, SourceOptions(kind, path, ROW, max_files_per_trigger=1))
    assert stream.isStreaming
    name = f"seen_{kind}"
    query = stream.writeStream.format("memory").queryName(name).start()
    drain(query)
    assert spark.table(name).count() == 30 and not query.isActive


def test_file_sources_need_a_schema(spark):
    with pytest.raises(ValueError):
        read_events(spark, SourceOptions("parquet", "somewhere"))


def test_rate_source(spark):
    stream = read_events(spark, SourceOptions("rate", per_second=5, event_time="timestamp"))
    assert stream.isStreaming and stream.columns == ["timestamp", "value", "event_ts"]


def test_broker_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_events(spark, SourceOptions("kafka", servers="host:9092", topic="t"))


def test_table_as_transports(spark):
    df = spark.range(3).withColumn("body", F.lit("x"))
    made = transport_from_table(df, "id", "body")
    assert [(r["event_id"], bytes(r["payload"]), r["attributes"], r["event_ts"]) for r in made.orderBy("event_id").collect()] == [
        (str(i), b"x", {}, None) for i in range(3)
    ]


def test_spread_follows_the_number_of_rows(spark):
    def tasks(df):
        return df.select(F.spark_partition_id().alias("p")).distinct().count()

    narrow = spark.range(0, 1000, 1, 1)
    assert tasks(spread(narrow)) == spark.sparkContext.defaultParallelism
    assert tasks(spread(narrow, rows_per_task=50)) == 20
