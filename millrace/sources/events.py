"""One entry point for event input: files and topic folders everywhere, the Kafka connector where installed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.topic import read_topic_log, stream_topic_log


@dataclass(frozen=True)
class SourceOptions:
    """``kind`` is a file format (parquet, orc, json), ``topic`` (a topic folder), ``kafka`` or ``rate``."""

    kind: str = "parquet"
    path: str = ""
    schema: T.StructType | None = None
    streaming: bool = True
    event_time: str | None = None
    max_files_per_trigger: int | None = None
    glob: str | None = None
    servers: str = ""
    topic: str = ""
    group: str = ""
    per_second: int = 1000
    options: dict = field(default_factory=dict)


def read_events(spark: SparkSession, options: SourceOptions) -> DataFrame:
    """Read events. With ``event_time`` set, an ``event_ts`` column takes that column's value:
    a time inside the event, or the log's append time (``timestamp`` of a topic record)."""
    if options.kind == "rate":
        df = spark.readStream.format("rate").option("rowsPerSecond", options.per_second).load()
    elif options.kind == "topic":
        read = stream_topic_log if options.streaming else read_topic_log
        df = topic_transports(read(spark, options.path, **options.options))
    elif options.kind == "kafka":
        df = _read_topic(spark, options)
    else:
        df = _read_files(spark, options)
    if options.event_time:
        df = df.withColumn("event_ts", F.col(options.event_time).cast("timestamp"))
    return df


def _read_files(spark: SparkSession, options: SourceOptions) -> DataFrame:
    if options.schema is None:
        raise ValueError("file sources need an explicit schema")
    reader = spark.readStream if options.streaming else spark.read
    reader = reader.format(options.kind).schema(options.schema).options(**options.options)
    if options.glob:
        reader = reader.option("pathGlobFilter", options.glob)
    if options.streaming and options.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", options.max_files_per_trigger)
    return reader.load(options.path)


def _read_topic(spark: SparkSession, options: SourceOptions) -> DataFrame:
    reader = spark.readStream if options.streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", options.servers)
    reader = reader.option("subscribe", options.topic).option("includeHeaders", "true")
    if options.group:
        reader = reader.option("kafka.group.id", options.group)
    raw = reader.options(**options.options).load()
    return topic_transports(raw)


def first_headers(headers: Column) -> Column:
    """Record headers as a map. A topic may repeat a header's key; the first one counts."""
    known = F.coalesce(headers, F.array().cast("array<struct<key:string,value:binary>>"))
    names = F.transform(known, lambda h: h["key"])
    firsts = F.filter(known, lambda h, at: F.array_position(names, h["key"]) == at + 1)
    return F.map_from_entries(F.transform(firsts, lambda h: F.struct(h["key"], h["value"].cast("string"))))


def topic_transports(raw: DataFrame) -> DataFrame:
    """Records of a topic as transports; event time is the log's append time unless another is chosen."""
    return raw.select(
        F.coalesce(F.col("key").cast("string"), F.concat_ws("-", "topic", "partition", "offset")).alias("event_id"),
        first_headers(F.col("headers")).alias("attributes"),
        F.col("value").alias("payload"),
        F.col("timestamp").alias("event_ts"),
        F.col("timestamp"),
    )


def transport_from_table(df: DataFrame, event_id: str, payload: Column | str, event_ts: str | None = None, attributes: Column | None = None) -> DataFrame:
    """Shape any table as transports: id, attributes, payload bytes, event time."""
    body = F.col(payload) if isinstance(payload, str) else payload
    empty = F.create_map().cast("map<string,string>")
    time = F.col(event_ts).cast("timestamp") if event_ts else F.lit(None).cast("timestamp")
    return df.select(
        F.col(event_id).cast("string").alias("event_id"),
        (attributes if attributes is not None else empty).alias("attributes"),
        body.cast("binary").alias("payload"),
        time.alias("event_ts"),
    )
