"""Append-only tables: delivery guarantees, fan-out, time partitions, error tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.draws import LANES, Draws, with_lanes
from millrace.plans.config import TableOptions
from millrace.session import Folder, current_run

SKEW_DEGREE = 80  # fixed value: skew of fanned-out tables


def destination(df: DataFrame, base: str, count: int, row_id: str, skewed: bool = False, seed: int = 42) -> DataFrame:
    """Add ``destination``: ``<base>-<n>`` with n uniform or skewed over ``count`` tables."""
    draws = Draws(seed)
    number = draws.skewed(count, SKEW_DEGREE, "destination") if skewed else draws.below(count, "destination")
    routed = with_lanes(df, row_id, seed).withColumn(
        "destination", F.concat(F.lit(base + "-"), F.expr(number).cast("string"))
    )
    return routed.drop(*LANES)


def time_partition(column: str, unit: str) -> Column:
    """Start of the hour, day, month or year that holds the value."""
    return F.date_trunc(unit, F.col(column))


def spread_for_write(df: DataFrame, by: tuple[str, ...], shards: int) -> DataFrame:
    """Shuffle rows by output partition for fewer files, without a hot partition in one task.

    The salt is the map task number: it costs nothing, a retried task repeats it, and a partition
    value with a third of all rows still splits into ``shards`` tasks.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(shards))
    return df.withColumn("_salt", salt).repartition(*by, "_salt").drop("_salt")


class AppendTable:
    """A Parquet table written one micro-batch at a time.

    ``exactly_once`` writes batch n of a streaming query to ``query=<id>/batch_id=n`` and overwrites it on
    replay; another query has its own folders. ``at_least_once`` and ``row_inserts`` append.
    """

    def __init__(self, spark: SparkSession, options: TableOptions):
        self.spark = spark
        self.options = options
        if not options.create_if_needed and not Folder(spark, options.path).exists():
            raise FileNotFoundError(f"table does not exist: {options.path}")

    def write(self, batch: DataFrame, batch_id: int, row_id: str = "event_id") -> None:
        self._write(self._laid_out(batch, row_id), self.options.path, batch_id, self._partitions())

    def write_errors(self, errors: DataFrame, batch_id: int) -> None:
        """Errors always go to ``<table>-failed`` with their own schema."""
        self._write(errors, self.options.failed_path, batch_id, [])

    def read(self, schema: T.StructType) -> DataFrame:
        return self._read(self.options.path, schema)

    def read_errors(self, schema: T.StructType) -> DataFrame:
        return self._read(self.options.failed_path, schema)

    def _partitions(self) -> list[str]:
        columns = ["destination"] if self.options.destinations > 1 else []
        return columns + (["time_partition"] if self.options.time_column else [])

    def _laid_out(self, batch: DataFrame, row_id: str) -> DataFrame:
        opt = self.options
        if opt.destinations > 1:
            name = opt.path.rstrip("/").rpartition("/")[2]
            batch = destination(batch, name, opt.destinations, row_id, opt.skewed)
        if opt.time_column:
            batch = batch.withColumn("time_partition", time_partition(opt.time_column, opt.time_unit))
        by = tuple(self._partitions())
        shards = opt.streams
        if opt.autoshard:
            session = batch.sparkSession
            if session.conf.get("spark.sql.adaptive.enabled") == "true":
                return batch.hint("rebalance", *by)
            # Micro-batches may run without adaptive execution, where the hint would not split a
            # hot partition.
            shards = session.sparkContext.defaultParallelism
        if shards:
            return spread_for_write(batch, by, shards) if by else batch.repartition(shards)
        return batch

    def _write(self, df: DataFrame, path: str, batch_id: int, partitions: list[str]) -> None:
        writer = df.write.option("maxRecordsPerFile", self.options.rows_per_file)
        if partitions:
            writer = writer.partitionBy(*partitions)
        if self.options.guarantee == "exactly_once":
            writer.mode("overwrite").parquet(f"{path}/query={current_run(self.spark)}/batch_id={batch_id}")
        else:
            writer.mode("append").parquet(path)

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not Folder(self.spark, path).exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
