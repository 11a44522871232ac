"""A topic as a folder: partitions, offsets, headers and append time, read and written as a stream, without a broker.

``<path>/segments`` holds immutable files of records, each of one topic partition, written by the tasks under names of their
own. ``<path>/log/<number>.json`` are the commits. A commit names the segments that one batch adds, the first offset of
each, and the offset that follows in every partition, so a record's offset is its segment's first plus its place in it. The
end of the topic is in the last commit, and a range of offsets is planned from the commits that added it alone.

Writing has two phases: tasks write segments and report them, then the driver appends one commit. What no commit names does
not exist: files of lost or repeated attempts are never read. A commit carries its producer's last batch, so a
batch that is replayed after a failure between the commit and Spark's own checkpoint adds nothing. Commits are numbered
by creating a name that must not exist; a writer that loses the race goes on from the winner's commit.

``timestampType`` is the reader's choice: ``CREATE_TIME`` is the record's own time, ``LOG_APPEND_TIME`` that of its commit, which never
goes back. Creating must not overwrite (local files and HDFS).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from millrace.session import Folder

FORMAT = "topic_log"
SCHEMA = (
    "key binary, value binary, headers array<struct<key:string,value:binary>>, topic string, `partition` int, `offset` bigint, "
    "timestamp timestamp, timestampType int"
)
HEADERS = pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))
STORED = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("headers", HEADERS), ("timestamp", pa.timestamp("us", tz="UTC"))])
READ = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("headers", HEADERS), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", tz="UTC")), ("timestampType", pa.int32()),
])
TIME_TYPES = {"CREATE_TIME": 0, "LOG_APPEND_TIME": 1}
ATTEMPTS = 200
ROWS_PER_TASK = 1_000_000


# -- files


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def put_new(uri: str, data: bytes) -> bool:
    """Create a file with its whole content at once; False if the name is taken."""
    files, path = opened(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(data)
    try:
        if isinstance(files, pafs.LocalFileSystem):
            os.link(draft, path)  # a local rename would overwrite
            files.delete_file(draft)
        else:
            files.move(draft, path)
    except OSError:
        files.delete_file(draft)
        if files.get_file_info(path).type == pafs.FileType.NotFound:
            raise
        return False
    return True


# -- the log


@dataclass(frozen=True)
class Segment:
    file: str
    partition: int
    base: int
    count: int
    appended: int  # microseconds


class TopicLog:
    """The commits of a topic. Reads files only, so it works on the driver and in Spark's Python workers alike."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def versions(self) -> list[int]:
        files, path = opened(f"{self.path}/log")
        found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return sorted(int(info.base_name[:-5]) for info in found if info.base_name.endswith(".json") and info.base_name[:-5].isdigit())

    def commit_of(self, version: int) -> dict:
        files, path = opened(f"{self.path}/log/{version}.json")
        with files.open_input_stream(path) as source:
            return json.loads(source.read())

    def last(self) -> tuple[int, dict]:
        versions = self.versions()
        return (versions[-1], self.commit_of(versions[-1])) if versions else (-1, {"ends": {}, "appended": 0, "producers": {}, "segments": []})

    def ends(self) -> dict[str, int]:
        """The next offset of every partition."""
        return self.last()[1]["ends"]

    def append(self, segments: list[tuple[str, int, int]], producer: str, batch: int) -> bool:
        """Give (file, partition, count) their offsets; False if the producer's batch is in the log already."""
        for _ in range(ATTEMPTS):
            version, before = self.last()
            if batch <= before["producers"].get(producer, -1):
                return False
            ends, added = dict(before["ends"]), []
            for file, partition, count in segments:
                base = ends.get(str(partition), 0)
                added.append({"file": file, "partition": partition, "base": base, "count": count})
                ends[str(partition)] = base + count
            appended = max(int(time.time() * 1e6), before["appended"])
            commit = {"ends": ends, "appended": appended, "producers": before["producers"] | {producer: batch}, "segments": added}
            if put_new(f"{self.path}/log/{version + 1}.json", json.dumps(commit).encode()):
                return True
        raise RuntimeError(f"no commit after {ATTEMPTS} attempts: {self.path}")

    def segments(self, start: dict[str, int], end: dict[str, int]) -> Iterator[Segment]:
        """What holds the offsets from ``start`` up to ``end``: read back from the end, no further than the start."""
        for version in reversed(self.versions()):
            commit = self.commit_of(version)
            if all(offset <= start.get(p, 0) for p, offset in commit["ends"].items()):
                return
            for s in commit["segments"]:
                p = str(s["partition"])
                if s["base"] < end.get(p, 0) and s["base"] + s["count"] > start.get(p, 0):
                    yield Segment(**s, appended=commit["appended"])


# -- reading


class Range(InputPartition):
    """Offsets ``first`` up to ``stop`` of one segment."""

    def __init__(self, segment: Segment, first: int, stop: int):
        super().__init__((segment.file, first, stop))
        self.segment, self.first, self.stop = segment, first, stop


class _Reading:
    def __init__(self, options):
        self.path, self.topic = options["path"], options.get("topic") or options["path"].rstrip("/").rpartition("/")[2]
        self.log = TopicLog(self.path)
        kind = options.get("timestampType", "CREATE_TIME")
        if kind not in TIME_TYPES:
            raise ValueError(f"unknown time type: {kind}")
        self.kind = TIME_TYPES[kind]
        self.starting = options.get("startingOffsets", "earliest")
        self.rows = int(options.get("rowsPerTask", ROWS_PER_TASK))

    def first_offsets(self) -> dict[str, int]:
        if self.starting == "earliest":
            return {}
        return self.log.ends() if self.starting == "latest" else {p: int(n) for p, n in json.loads(self.starting).items()}

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        """A task reads ``rowsPerTask`` records at most; a large segment is split."""
        out = []
        for segment in self.log.segments(start, end):
            p = str(segment.partition)
            low, high = max(segment.base, start.get(p, 0)), min(segment.base + segment.count, end.get(p, 0))
            out += [Range(segment, at, min(at + self.rows, high)) for at in range(low, high, self.rows)]
        return sorted(out, key=lambda r: (r.segment.partition, r.first))

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there are no ranges
            return
        segment, at = partition.segment, partition.segment.base
        files, path = opened(f"{self.path}/{segment.file}")
        with files.open_input_file(path) as source:
            stored = pq.ParquetFile(source)
            for number in range(stored.num_row_groups):
                rows = stored.metadata.row_group(number).num_rows
                low, high = max(partition.first, at), min(partition.stop, at + rows)
                if low < high:
                    for batch in stored.read_row_group(number).slice(low - at, high - low).cast(STORED).to_batches():
                        yield self.records(batch, segment, low)
                        low += len(batch)
                at += rows

    def records(self, batch: pa.RecordBatch, segment: Segment, first: int) -> pa.RecordBatch:
        n = len(batch)
        times = batch.column("timestamp") if self.kind == 0 else pa.array([segment.appended] * n, pa.int64()).cast(READ.field("timestamp").type)
        columns = [
            *(batch.column(c) for c in ("key", "value", "headers")), pa.array([self.topic] * n, pa.string()), pa.array([segment.partition] * n, pa.int32()),
            pa.array(range(first, first + n), pa.int64()), times, pa.array([self.kind] * n, pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=READ)


class TopicReader(_Reading, DataSourceReader):
    def partitions(self):
        return self.ranges(self.first_offsets(), self.log.ends())


class TopicStreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self):
        return self.first_offsets()

    def latestOffset(self):
        return self.log.ends()

    def partitions(self, start, end):
        return self.ranges(start, end)


# -- writing


@dataclass
class Written(WriterCommitMessage):
    task: int
    segments: list[tuple[str, int, int]]


class TopicWriter(DataSourceStreamArrowWriter):
    """Tasks write a segment for each topic partition they meet; the driver commits them together."""

    def __init__(self, options):
        self.path, self.producer = options["path"], options["producer"]

    def write(self, iterator):
        from pyspark import TaskContext

        open_, counts, names = {}, {}, {}
        files, root = opened(self.path)
        files.create_dir(f"{root}/segments", recursive=True)
        for batch in iterator:
            place = batch.column("partition")
            for partition in pc.unique(place).to_pylist():
                rows = batch.filter(pc.equal(place, partition)).select(STORED.names).cast(STORED)
                if partition not in open_:
                    names[partition] = f"segments/{uuid.uuid4().hex}.parquet"
                    open_[partition] = pq.ParquetWriter(f"{root}/{names[partition]}", STORED, filesystem=files, compression="zstd")
                open_[partition].write_batch(rows)
                counts[partition] = counts.get(partition, 0) + len(rows)
        for writer in open_.values():
            writer.close()
        return Written(TaskContext.get().partitionId(), [(names[p], p, counts[p]) for p in sorted(counts)])

    def commit(self, messages, batchId):
        segments = [s for m in sorted((m for m in messages if m), key=lambda m: m.task) for s in m.segments]
        if segments:
            TopicLog(self.path).append(segments, self.producer, batchId)

    def abort(self, messages, batchId):
        """Segments that no commit names are not part of the topic."""


class TopicSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TopicReader(self.options)

    def streamReader(self, schema):
        return TopicStreamReader(self.options)

    def streamWriter(self, schema, overwrite):
        return TopicWriter(self.options)


# -- for users


def _reader(spark: SparkSession, path: str, streaming: bool, options: dict) -> DataFrame:
    spark.dataSource.register(TopicSource)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).options(**options)
    return reader.load(Folder(spark, path).qualified())


def read_topic_log(spark: SparkSession, path: str, **options) -> DataFrame:
    """What the topic holds now, in the columns of a topic record."""
    return _reader(spark, path, False, options)


def stream_topic_log(spark: SparkSession, path: str, **options) -> DataFrame:
    """The topic as a stream; ``startingOffsets`` is earliest, latest or JSON text of offsets by partition."""
    return _reader(spark, path, True, options)


def topic_records(transports: DataFrame, partitions: int, partition: Column | None = None) -> DataFrame:
    """Transports as records: keys decide the partition unless ``partition`` does; rows without key go anywhere.

    A retried task may deal them differently: what counts is the segments of the attempt that is committed.
    """
    if partition is None:
        turn = F.floor(F.rand() * partitions)
        partition = F.when(F.col("event_id").isNull(), turn).otherwise(F.pmod(F.crc32(F.col("event_id").cast("binary")), F.lit(partitions)))
    pairs = F.transform(F.map_entries(F.coalesce("attributes", F.create_map().cast("map<string,string>"))), lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))
    return transports.select(
        F.col("event_id").cast("binary").alias("key"), F.col("payload").alias("value"), pairs.alias("headers"),
        F.coalesce(F.col("event_ts"), F.current_timestamp()).alias("timestamp"), partition.cast("int").alias("partition"),
    )


def write_topic_log(records: DataFrame, path: str, checkpoint: str, producer: str | None = None):
    """Streaming writer of :func:`topic_records`. A producer is known by its checkpoint unless it has a name of its own."""
    spark = records.sparkSession
    spark.dataSource.register(TopicSource)
    writer = records.writeStream.format(FORMAT).outputMode("append").option("path", Folder(spark, path).qualified())
    return writer.option("producer", producer or Folder(spark, checkpoint).qualified()).option("checkpointLocation", checkpoint)
