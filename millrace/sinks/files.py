"""Windowed files: partition folders carry the event-time window; hours are marked when complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import Folder, current_run
from millrace.sinks.tables import spread_for_write
from millrace.sources.avro_files import read_avro, write_avro

LAYOUT = ("date", "hour", "window")
FORMATS = ("parquet", "orc", "avro", "json")
STATE = "latest bigint, hours array<bigint>"


NONE = "none"  # folder name of rows without event time
MOST_HOURS = 1_000_000  # of one batch, about 114 years of event time


def with_window_folders(df: DataFrame, ts: str = "event_ts", length: str = "5 minutes") -> DataFrame:
    """Add ``date``, ``hour`` and ``window`` (start of the fixed window, HHmm) folder columns.

    Rows without event time belong to no window and go to folders named ``none``.
    """
    zero = "timestamp '1970-01-01 00:00:00'"
    micros = F.expr(f"unix_micros({zero} + interval {length}) - unix_micros({zero})")
    start = F.timestamp_micros(F.unix_micros(ts) - F.pmod(F.unix_micros(ts), micros))

    def part(pattern: str):
        return F.coalesce(F.date_format("_start", pattern), F.lit(NONE))

    return df.withColumn("_start", start).select(
        *df.columns, part("yyyy-MM-dd").alias("date"), part("HH").alias("hour"), part("HHmm").alias("window")
    )


class WindowedFiles:
    """Micro-batch writer of window folders plus the hourly markers.

    Order of one batch: data files, then markers for hours that the watermark has passed, then the
    batch's state (largest event time, hours still open). A marker therefore never precedes the data of
    its batch, and every step overwrites itself when the batch is replayed. A batch reads the state of
    the batch before it and nothing older; a new query on the same folder starts from the last states of the others.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", length: str = "5 minutes", lateness_seconds: int = 0, shards: int | None = None):
        if fmt not in FORMATS:
            raise ValueError(f"unknown file format: {fmt}")
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.length, self.lateness_seconds, self.shards = length, lateness_seconds, shards

    def write(self, batch: DataFrame, batch_id: int, ts: str = "event_ts") -> None:
        """For ``json`` the frame needs a text column ``value``, written verbatim."""
        seen = Observation(f"window files {batch_id}")
        hour = F.unix_seconds(F.date_trunc("HOUR", F.col(ts)))
        watched = batch.observe(
            seen, F.max(F.unix_micros(ts)).alias("latest"), F.collect_set(hour).alias("hours")
        )
        laid_out = with_window_folders(watched, ts, self.length)
        if self.fmt == "json":
            laid_out = laid_out.select("value", *LAYOUT)
        laid_out = self._spread(laid_out)
        run = current_run(self.spark)
        target = f"{self.path}/data/query={run}/batch_id={batch_id}"
        if self.fmt == "avro":
            write_avro(laid_out, target, "overwrite", LAYOUT)
        else:
            laid_out.write.format("text" if self.fmt == "json" else self.fmt).partitionBy(*LAYOUT).mode("overwrite").save(target)
        # Adaptive execution drops an empty plan and the observation with it.
        found = {} if batch.isEmpty() else seen.get
        self._mark(found.get("latest"), found.get("hours") or [], run, batch_id)

    def _spread(self, laid_out: DataFrame) -> DataFrame:
        """``shards`` tasks per window where asked for; otherwise adaptive execution sizes the tasks, so that
        small windows share one and a hot window splits."""
        if self.shards:
            return spread_for_write(laid_out, LAYOUT, self.shards)
        if laid_out.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            return laid_out.hint("rebalance", *LAYOUT)
        return laid_out

    def _state(self, run: str, batch_id: int) -> str:
        return f"{self.path}/state/query={run}/batch_id={batch_id}"

    def _before(self, run: str, batch_id: int) -> list:
        """States to start from: that of the batch before, or at a query's beginning the last ones of other queries."""
        if Folder(self.spark, self._state(run, batch_id - 1)).exists():
            paths = [self._state(run, batch_id - 1)]
        else:
            paths = []
            for other in Folder(self.spark, f"{self.path}/state").names():
                batches = [int(n.partition("=")[2]) for n in Folder(self.spark, f"{self.path}/state/{other}").names()]
                if batches and other != f"query={run}":
                    paths.append(f"{self.path}/state/{other}/batch_id={max(batches)}")
        return self.spark.read.schema(STATE).parquet(*paths).collect() if paths else []

    def _mark(self, latest: int | None, hours: list[int], run: str, batch_id: int) -> None:
        """Hours are few (the span of event time, not the rows), so they go through the driver."""
        if len(hours) > MOST_HOURS:
            raise ValueError(f"event times of one batch fall into {len(hours)} hours; check the source's clock")
        before = self._before(run, batch_id)
        times = [t for t in [latest, *[row["latest"] for row in before]] if t is not None]
        open_hours = set(hours).union(*[row["hours"] or [] for row in before])
        if times:
            watermark = max(times) - self.lateness_seconds * 1_000_000
            ended = sorted(h for h in open_hours if (h + 3600) * 1_000_000 <= watermark)
            open_hours -= set(ended)
            if ended:
                marks = self.spark.createDataFrame([(h,) for h in ended], "hour_start bigint")
                marks.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/markers/query={run}/batch_id={batch_id}")
        state = self.spark.createDataFrame([(max(times, default=None), sorted(open_hours))], STATE)
        state.coalesce(1).write.mode("overwrite").parquet(self._state(run, batch_id))
        Folder(self.spark, self._state(run, batch_id - 2)).remove()  # a replay needs only the batch before

    def markers(self) -> DataFrame:
        """One row per hour that is complete, with the query and batch that marked it first.

        An hour that late rows touch again is marked again; the first marker counts.
        """
        schema = "hour_start bigint, query string, batch_id bigint"
        if Folder(self.spark, f"{self.path}/markers").exists():
            marked = self.spark.read.schema(schema).parquet(f"{self.path}/markers")
        else:
            marked = self.spark.createDataFrame([], schema)
        firsts = marked.groupBy("hour_start").agg(F.min(F.struct("batch_id", "query")).alias("_first"))
        return firsts.select(F.timestamp_seconds("hour_start").alias("hour_start"), "_first.query", "_first.batch_id")

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Rows written so far, with the folder columns."""
        folders = [T.StructField(n, T.StringType()) for n in LAYOUT] + [T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType())]
        if self.fmt == "json":
            schema = T.StructType([T.StructField("value", T.StringType())])
        if schema is None:
            raise ValueError("reading typed files needs their schema")
        if self.fmt == "avro":
            return read_avro(self.spark, f"{self.path}/data", T.StructType(schema.fields + folders))
        reader = self.spark.read.format("text" if self.fmt == "json" else self.fmt)
        return reader.schema(T.StructType(schema.fields + folders)).load(f"{self.path}/data")
