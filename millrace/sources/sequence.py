"""Paced integer sequences and stepped load ramps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def impulses_per_second(events_per_second: int, batch_size: int = 1) -> int:
    """Sequence elements per second when each element carries ``batch_size`` events; at least 1."""
    return max(1, events_per_second // max(1, batch_size))


def sequence(spark: SparkSession, count: int, per_second: int, partitions: int | None = None) -> DataFrame:
    """Bounded sequence 0..count-1 with the second in which each element is due."""
    return pace(spark.range(0, count, 1, partitions), "id", per_second)


def pace(df: DataFrame, number: str, per_second: int) -> DataFrame:
    """Add ``due_second``: element n of a sequence at rate r is due in second n div r."""
    return df.withColumn("due_second", F.expr(f"`{number}` div {per_second}"))


def unbounded_sequence(spark: SparkSession, per_second: int, ramp_up: str | None = None, partitions: int | None = None) -> DataFrame:
    """Streaming sequence at a rate, with columns ``timestamp`` and ``value``."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", per_second)
    if ramp_up:
        reader = reader.option("rampUpTime", ramp_up)
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def spread(df: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """Spread a narrow sequence over tasks by its number of rows.

    A split of ids is a few bytes per row, and each row becomes a whole record: partitions sized
    by input bytes would give one task far too much. Counting a Parquet table reads footers only.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if not df.isStreaming:
        tasks = max(tasks, -(-df.count() // rows_per_task))
    return df.repartition(tasks)


def expand_impulses(df: DataFrame, number: str, per_impulse: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per event of each sequence element: element n carries events n*k .. n*k + k-1.
    The events of an element stay together in its task, so packing them needs no shuffle."""
    each = F.explode(F.sequence(F.lit(0), F.lit(per_impulse - 1)))
    fanned = df.select(number, *keep, each.alias("_i"))
    return fanned.select((F.col(number) * per_impulse + F.col("_i")).alias(number), *keep)


def active_publishers(elapsed_seconds: Column, publishers: int, interval_seconds: int) -> Column:
    """Step function of a gradual ramp: one more publisher per interval, up to ``publishers``."""
    started = F.floor(elapsed_seconds / F.lit(interval_seconds)) + 1
    return F.least(F.lit(publishers).cast("bigint"), started)


def ramp(df: DataFrame, ts: str, publishers: int, interval_seconds: int, number: str) -> DataFrame:
    """Assign each element to one of the publishers running at its time."""
    def micros(column):
        return F.unix_micros(column.cast("timestamp"))

    start = df.agg(micros(F.min(ts))).scalar()
    elapsed = F.floor((micros(F.col(ts)) - start) / F.lit(1_000_000))
    timed = df.withColumn("active", active_publishers(elapsed, publishers, interval_seconds))
    return timed.withColumn("publisher", F.pmod(F.col(number), F.col("active")))
