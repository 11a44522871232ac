"""The composed flows: generate, ingest, aggregate, and window files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.operators import cells as cell_ops
from millrace.operators.decode import decode, decode_or_fail, parse, payload_text
from millrace.operators.envelope import MAX_RECORDS, maybe_decompress, pack, unpack_all
from millrace.operators.outcome import Outcome, union_errors, with_event_time
from millrace.operators.stats import observe_payloads
from millrace.operators.transforms import apply_frame, map_events
from millrace.operators.transport import compress_schema, encode, schema_attributes, wrap
from millrace.operators.windows import count_closed, count_windows
from millrace.plans.config import Aggregation, TableOptions, cell_destination, distinct_names
from millrace.schemas import ERROR, TRANSPORT
from millrace.session import fresh_dir
from millrace.sinks.cells import CellTable
from millrace.sinks.files import WindowedFiles
from millrace.sinks.tables import AppendTable
from millrace.sources.generator import GeneratorOptions, generate_records
from millrace.sources.sequence import expand_impulses, impulses_per_second, unbounded_sequence
from millrace.sources.topic import topic_records, write_topic_log
from millrace.streaming.panes import count_panes
from millrace.streaming.running import finish, run_batches, start_batches


GENERATED = "generated"  # name of the generator's metrics in streaming progress


# -- generate ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class GenerateOptions:
    schema: str | T.StructType = "compound"
    fmt: str = "THRIFT"
    record: GeneratorOptions = field(default_factory=GeneratorOptions)
    compressed: bool = False
    level: int = 1
    records_per_envelope: int = MAX_RECORDS


def generate_events(sequence: DataFrame, number: str, options: GenerateOptions, event_ts: str | None = None) -> DataFrame:
    """Sequence to transports; batch or streaming.

    Plain transports carry their schema in attributes (empty for Thrift, which has none);
    compressed ones are packed into envelopes by the task that generated them.
    """
    keep = (number,) + ((event_ts,) if event_ts else ())
    records = generate_records(sequence, number, options.schema, options.record, keep)
    if options.fmt.upper() == "AVRO":  # a wide record as an argument of a Python function is not planned, a column is
        records = records.select(*keep, F.explode(F.array("record")).alias("record"))
    attributes = None
    if not options.compressed and options.fmt.upper() != "THRIFT":
        text = compress_schema(schemas.resolve(options.schema).json())
        attributes = schema_attributes(F.lit(text))
    plain = wrap(records, encode(F.col("record"), options.fmt, options.schema), (number,), attributes, event_ts)
    return pack(plain, options.records_per_envelope, options.level) if options.compressed else plain


def start_generate(spark: SparkSession, options: GenerateOptions, events_per_second: int, path: str, checkpoint: str, ramp_up: str | None = None, partitions: int | None = None):
    """Generate at a rate into a topic folder; returns the running query.

    With compression, a sequence element stands for one envelope, so the sequence runs at the
    event rate divided by the envelope size. Each micro-batch reports its time, and under ``generated`` the number
    and size of the payloads made (compressed, where they are), in the query's progress.
    """
    per_impulse = options.records_per_envelope if options.compressed else 1
    numbers = unbounded_sequence(spark, impulses_per_second(events_per_second, per_impulse), ramp_up, partitions)
    if options.compressed:
        numbers = expand_impulses(numbers, "value", per_impulse, ("timestamp",))
    events, _ = observe_payloads(generate_events(numbers, "value", options, "timestamp"), GENERATED)
    return write_topic_files(events, path, checkpoint).start()


def write_topic_files(transports: DataFrame, path: str, checkpoint: str):
    """Streaming writer of transports to a folder of files, where no broker is at hand."""
    return (
        transports.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def write_topic(transports: DataFrame, path: str, checkpoint: str, partitions: int = 8):
    """Streaming writer of transports to a topic folder with partitions, offsets and append times."""
    return write_topic_log(topic_records(transports, partitions), path, checkpoint)


def write_topic_broker(transports: DataFrame, servers: str, topic: str, checkpoint: str):
    """Streaming writer of transports to a Kafka topic, where the connector is installed."""
    headers = F.transform(
        F.map_entries("attributes"),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )
    return (
        transports.select(F.col("event_id").alias("key"), F.col("payload").alias("value"), headers.alias("headers"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .option("checkpointLocation", checkpoint)
    )


# -- ingest ------------------------------------------------------------------------------------


def ingest_batch(batch: DataFrame, batch_id: int, table: AppendTable, schema, frame_transform: Callable | None = None, event_transform: Callable | None = None) -> None:
    """Decompress, transform, decode and append one micro-batch; dead letters go to the error table.

    Every step keeps its failures in the rows themselves, so one frame that carries all of them is persisted and
    split when it is written: the user's function is called once per event, and each payload is
    parsed once. A lost executor recomputes the frame from the batch's source.
    """
    whole = in_one_frame(unpack_all(batch), schema, frame_transform, event_transform).persist()
    try:
        good = whole.filter(F.col("error_class").isNull())
        table.write(good.select("event_id", "event_ts", "record.*"), batch_id)
        table.write_errors(whole.filter(F.col("error_class").isNotNull()).select(*ERROR.fieldNames()), batch_id)
    finally:
        whole.unpersist()


def in_one_frame(unpacked: DataFrame, schema, frame_transform: Callable | None, event_transform: Callable | None) -> DataFrame:
    """Transports with ``record`` and, on rows that failed, ``stage`` and the error columns."""
    names = TRANSPORT.fieldNames()
    nothing = [F.lit(None).cast("string").alias(c) for c in ("error_class", "error_message")]
    frame = unpacked
    if frame_transform is not None:
        # A transform sees good rows only; the dead letters pass beside it.
        frame = apply_frame(unpacked.filter(F.col("error_class").isNull()).select(*names), frame_transform).select(*names, *nothing)
        frame = frame.unionByName(unpacked.filter(F.col("error_class").isNotNull()).select(*names, "error_class", "error_message"))
    stage = F.when(F.col("error_class").isNotNull(), F.lit("decompress"))
    frame = frame.select(*names, "error_class", "error_message", stage.alias("stage"))
    if event_transform is not None:
        frame = map_events(frame, event_transform, ("error_class", "error_message", "stage"))
    parsed = parse(frame, schema, ("error_class", "error_message", "stage"))
    return parsed.withColumn("stage", F.coalesce("stage", F.when(F.col("error_class").isNotNull(), F.lit("decode"))))


def start_ingest(spark: SparkSession, transports: DataFrame, options: TableOptions, schema, frame_transform: Callable | None = None, event_transform: Callable | None = None, checkpoint: str | None = None, trigger: dict | None = None):
    """Start ingestion into an append-only table; returns (table, running query). The trigger
    defaults to the table's flush cadence, or to draining the source."""
    table = AppendTable(spark, options)

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, table, schema, frame_transform, event_transform)

    return table, start_batches(transports, spark, "ingest", handle, checkpoint=checkpoint, trigger=trigger or options.trigger)


def ingest(spark: SparkSession, transports: DataFrame, options: TableOptions, schema, frame_transform: Callable | None = None, event_transform: Callable | None = None, checkpoint: str | None = None) -> AppendTable:
    """Ingest what the source holds now, then stop."""
    table, query = start_ingest(
        spark, transports, options, schema, frame_transform, event_transform, checkpoint, {"availableNow": True}
    )
    finish(query)
    return table


# -- aggregate ---------------------------------------------------------------------------------


def aggregate_bounded(transports: DataFrame, schema, aggregations: Sequence[Aggregation], ts: str = "event_ts") -> Outcome:
    """Bounded form: decompress, decode, count per window, shape as cells; the dead letters of all stages."""
    inflated = maybe_decompress(transports)
    decoded = decode(inflated.ok, schema)
    timed = with_event_time(decoded.ok, ts)
    cells = cell_ops.to_cells(count_windows(timed.ok, aggregations, ts))
    return Outcome(cells, union_errors([inflated.failed, decoded.failed, timed.failed]))


def closed_or_panes(decoded: DataFrame, aggregations: Sequence[Aggregation], closing: str, waiting: bool) -> DataFrame:
    """Panes where early firings are configured, otherwise one row per closed window, counted on the JVM."""
    if not any(a.early.enabled for a in aggregations):
        return count_closed(decoded, aggregations)
    results = count_panes(decoded, aggregations, closing=closing, waiting=waiting)
    quiet = [a.name for a in aggregations if not a.early.enabled]  # these write their final pane only
    return results.filter(F.col("is_final") | ~F.col("agg_name").isin(quiet)) if quiet else results


def results_and_errors(transports: DataFrame, schema, aggregations: Sequence[Aggregation], closing: str, waiting: bool) -> DataFrame:
    """``result`` of the aggregations, or ``error`` (with its ``event_ts``): dead letters of the same read.

    Rows are inflated and parsed once, then dealt once in turn, good ones with their time and the key fields only. The
    counts and the dead letters are two readers of that one shuffle, and a dead letter leaves in the micro-batch that
    brought it, whatever the windows do.
    """
    whole = in_one_frame(unpack_all(transports), schema, None, None)
    fields = list(dict.fromkeys(f for a in aggregations for f in a.key_fields))
    untimed = F.col("error_class").isNull() & F.col("event_ts").isNull()
    error = F.struct(
        "event_id",
        F.when(untimed, F.lit("event_time")).otherwise(F.col("stage")).alias("stage"),
        F.when(untimed, F.lit("MissingEventTime")).otherwise(F.col("error_class")).alias("error_class"),
        F.when(untimed, F.lit("the event has no event time")).otherwise(F.col("error_message")).alias("error_message"),
        "attributes",
        "payload",
    )
    failed = F.when(F.col("error_class").isNotNull() | F.col("event_ts").isNull(), error).alias("error")
    tagged = whole.select("event_ts", *[F.col("record").getField(f).alias(f) for f in fields], failed)
    dealt = tagged.repartition(int(transports.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The rows pass a generator, so that neither side's filter sinks below the shuffle and makes two of it.
    rows = dealt.select(F.inline(F.array(F.struct(*tagged.columns))))
    results = closed_or_panes(rows.filter(F.col("error").isNull()), aggregations, closing, waiting)
    kinds = [F.struct(*results.columns), F.lit(None).cast("timestamp"), F.lit(None).cast(tagged.schema["error"].dataType)]
    left = results.select(*[kind.alias(name) for kind, name in zip(kinds, ("result", "event_ts", "error"), strict=True)])
    nothing = F.lit(None).cast(left.schema["result"].dataType).alias("result")
    return left.unionByName(rows.filter(F.col("error").isNotNull()).select(nothing, "event_ts", "error"))


def start_aggregate(spark: SparkSession, transports: DataFrame, schema, aggregations: Sequence[Aggregation], destination: str, root: str, checkpoint: str | None = None, closing: str = "always", trigger: dict | None = None, errors: TableOptions | None = None, merge_every: int | None = 50, state_partitions: int | None = None):
    """Start windowed counts into a cell table; returns (table, running query).

    ``destination`` names the cell table in three parts; it becomes a folder below ``root``.
    Configured early firings bring panes; otherwise each window is written once, when it closes.
    With ``errors``, the dead letters of the same read are stored in that table's error table, batch by batch.
    """
    aggregations = distinct_names(aggregations)
    table = CellTable(spark, "/".join([root.rstrip("/"), *cell_destination(destination)]), merge_every=merge_every)
    mode = "update" if any(a.early.enabled for a in aggregations) else "append"
    waiting = trigger is not None and "processingTime" in trigger  # the query keeps running
    if errors is None:
        decoded = decode(maybe_decompress(transports).ok, schema).ok

        def handle(batch: DataFrame, batch_id: int) -> None:
            table.write(cell_ops.to_cells(batch), batch_id)

        return table, start_batches(closed_or_panes(decoded, aggregations, closing, waiting), spark, "aggregate", handle, mode, checkpoint, trigger, state_partitions)

    beside = AppendTable(spark, errors)

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # closed windows and dead letters, written one after the other
        try:
            table.write(cell_ops.to_cells(batch.filter(F.col("result").isNotNull()).select("result.*")), batch_id)
            beside.write_errors(batch.filter(F.col("error").isNotNull()).select("error.*"), batch_id)
        finally:
            batch.unpersist()

    frame = results_and_errors(transports, schema, aggregations, closing, waiting)
    return table, start_batches(frame, spark, "aggregate", split, mode, checkpoint, trigger, state_partitions)


def aggregate(spark: SparkSession, transports: DataFrame, schema, aggregations: Sequence[Aggregation], destination: str, root: str, checkpoint: str | None = None, closing: str = "always", errors: TableOptions | None = None) -> CellTable:
    """Aggregate what the source holds now, then stop."""
    table, query = start_aggregate(spark, transports, schema, aggregations, destination, root, checkpoint, closing, errors=errors)
    finish(query)
    return table


def aggregate_errors(spark: SparkSession, transports: DataFrame, schema, options: TableOptions, checkpoint: str | None = None) -> AppendTable:
    """The dead letters alone, missing event times included, of what the source holds now."""
    table = AppendTable(spark, options)

    def handle(batch: DataFrame, batch_id: int) -> None:
        whole = in_one_frame(unpack_all(batch), schema, None, None).persist()
        try:
            late = F.col("error_class").isNull() & F.col("event_ts").isNull()
            failed = whole.filter(F.col("error_class").isNotNull()).select(*ERROR.fieldNames())
            table.write_errors(failed.unionByName(with_event_time(whole.filter(late)).failed), batch_id)
        finally:
            whole.unpersist()

    run_batches(transports, spark, "aggregate-errors", handle, checkpoint=checkpoint)
    return table


# -- files -------------------------------------------------------------------------------------


def write_window_files(spark: SparkSession, transports: DataFrame, path: str | None = None, fmt: str = "parquet", schema=None, length: str = "5 minutes", lateness_seconds: int = 0, shards: int | None = None, checkpoint: str | None = None, payloads: str = "JSON") -> WindowedFiles:
    """Streaming window files. Typed formats decode (``payloads`` is JSON or AVRO) and fail on a bad payload; ``json`` writes
    payload text verbatim. Envelopes are not unpacked here."""
    files = WindowedFiles(spark, path or fresh_dir(spark, f"files-{fmt}"), fmt, length, lateness_seconds, shards)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if fmt == "json":
            shaped = batch.select("event_ts", payload_text().alias("value"))
        else:
            shaped = decode_or_fail(batch, schema, payloads).drop("attributes")
        files.write(shaped, batch_id)

    run_batches(transports, spark, f"files-{fmt}", handle, checkpoint=checkpoint)
    return files
