"""Running streaming queries to completion, and staging bounded tables as arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ROCKSDB, Folder, fresh_dir, scoped_conf


def stateful_settings(spark: SparkSession, partitions: int | None = None) -> dict[str, str]:
    """RocksDB state (spills to disk, uploads changelogs) in UTC.

    The number of state partitions is fixed for the life of a checkpoint, so it is the user's to choose:
    ``partitions``, or else the session's ``spark.sql.shuffle.partitions``.
    """
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions or spark.conf.get("spark.sql.shuffle.partitions")),
        "spark.sql.session.timeZone": "UTC",
    }


def run_to_end(writer, spark: SparkSession, partitions: int | None = None) -> None:
    """Process everything available, finish in-flight work, stop. Failures are raised."""
    with scoped_conf(spark, stateful_settings(spark, partitions)):
        query = writer.trigger(availableNow=True).start()
    finish(query)


def drain(query) -> None:
    """Stop a running query after it has processed what its source holds now."""
    query.processAllAvailable()
    query.stop()


def append_to_files(df: DataFrame, spark: SparkSession, label: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), path: str | None = None, checkpoint: str | None = None) -> str:
    """Append-mode run into a new folder (exactly once); returns the folder."""
    path = path or fresh_dir(spark, label)
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    run_to_end(writer.option("checkpointLocation", checkpoint or fresh_dir(spark, label + "-checkpoint")), spark)
    return path


def start_batches(df: DataFrame, spark: SparkSession, label: str, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None, trigger: dict | None = None, state_partitions: int | None = None):
    """Start ``handle(batch, batch_id)`` for every micro-batch and return the running query.

    ``trigger`` is that of ``DataStreamWriter.trigger``; the default drains the source and stops.

    A stateful query runs without adaptive execution, since its state partitions are fixed. What
    ``handle`` does with a finished batch is ordinary batch work, so there it is switched on:
    small batches then write few files, whatever the number of state partitions.
    """

    def adaptively(batch: DataFrame, batch_id: int) -> None:
        with scoped_conf(batch.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
            handle(batch, batch_id)

    writer = df.writeStream.outputMode(mode).foreachBatch(adaptively)
    writer = writer.option("checkpointLocation", checkpoint or fresh_dir(spark, label + "-checkpoint"))
    with scoped_conf(spark, stateful_settings(spark, state_partitions)):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def finish(query) -> None:
    """Wait for a draining query; failures are raised."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


IDLE_SECONDS = 60


def stop_when(query, done: Callable[[], bool], most_batches: int) -> None:
    """Stop a query that would run on as soon as ``done()``.

    Whatever else ends the wait is raised: the query's failure, its end, ``most_batches`` batches, a minute without any. A batch
    may take as long as it needs.
    """
    idle = 0
    try:
        while not done():
            if query.awaitTermination(1):
                raise RuntimeError("the query ended before it was done")
            idle = 0 if query.status["isTriggerActive"] else idle + 1
            last = query.lastProgress
            over = last is not None and last["batchId"] >= most_batches
            if (over or idle >= IDLE_SECONDS) and not done():
                raise TimeoutError(f"the query is not done after {last['batchId'] + 1 if last else 0} batches")
        failure = query.exception()
        if failure is not None:
            raise failure
    finally:
        query.stop()


def run_batches(df: DataFrame, spark: SparkSession, label: str, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Drain the source through ``handle``."""
    finish(start_batches(df, spark, label, handle, mode, checkpoint))


def update_to_files(df: DataFrame, spark: SparkSession, label: str, mode: str = "update") -> str:
    """Keep every emitted row of an update-mode query; a replayed batch overwrites itself."""
    path = fresh_dir(spark, label)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run_batches(df, spark, label, handle, mode)
    return path


def stage_arrivals(df: DataFrame, batch: Column, files_per_batch: int = 1) -> str:
    """Write a table as files that a file stream reads one arrival batch at a time.

    Each batch becomes ``files_per_batch`` files with modification times in batch order. Rows are
    dealt to the files by position, not by value, so copies of one row spread too. Read it with
    ``maxFilesPerTrigger = files_per_batch``.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "arrivals")
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_batch)).cast("int")
    staged = df.withColumn("arrival_batch", batch.cast("int")).withColumn("arrival_slot", slot)
    staged.repartition("arrival_batch", "arrival_slot").write.partitionBy(
        "arrival_batch", "arrival_slot"
    ).parquet(path)
    for folder in Folder(spark, path).children():
        name = folder.getPath().getName()
        if not name.startswith("arrival_batch="):
            continue
        number = int(name.partition("=")[2])
        for slot_folder in Folder(spark, folder.getPath().toString()).children():
            inside = Folder(spark, slot_folder.getPath().toString())
            for status in inside.children():
                inside.set_mtime(status, 1_600_000_000_000 + number * 10_000)
    return path


def read_arrivals(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
