"""Avro container files as a Spark source and sink, without a module on the class path.

Reading splits large files: a task owns the blocks whose preceding sync marker begins inside its range, so every block has one owner
wherever the range is cut. Small files share a task; with the option ``tasks`` so do small ranges, up to a fair share of the bytes. Blocks are inflated in groups of bounded size and a group is decoded as columns.
A broken block (a size that does not fit, no marker behind it, bad compression, records that do not fill it) fails
the job, or with ``mode="PERMISSIVE"`` becomes one row whose ``_corrupt_block`` says where it lies; reading goes on
at the next marker. Folders ``name=value`` above the files are columns where the schema asks for them, and equality
filters on them skip files (``spark.sql.python.filterPushdown.enabled``).

Writing has two phases: tasks write below a staging folder, and the driver moves the files of the attempts that count to their place.
A lost or repeated task leaves nothing behind.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions import avro
from millrace.operators.outcome import Outcome
from millrace.schemas import ERROR, avro_schema, from_avro_schema, optional
from millrace.session import Folder
from millrace.sources.topic import opened

FORMAT = "avro_blocks"
MAGIC, SYNC = b"Obj\x01", 16  # fixed values of the format
BLOCK_BYTES = 64_000
SPLIT_BYTES = 64 << 20
GROUP_BYTES = 16 << 20
READ_BYTES = 1 << 16
MOST_INFLATED = 1 << 30  # of one block
CORRUPT = "_corrupt_block"
CORRUPT_FIELD = T.StructField(CORRUPT, T.StructType([
    T.StructField("file", T.StringType()), T.StructField("position", T.LongType()),
    T.StructField("records", T.LongType()), T.StructField("message", T.StringType()),
]))
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of null


class Broken(ValueError):
    """A part of a file that cannot be read."""


# -- frames


def read_long(source) -> int:
    folded = 0
    for shift in range(0, 70, 7):
        byte = source.read(1)
        if not byte:
            break
        folded |= (byte[0] & 127) << shift
        if byte[0] < 128:
            return (folded >> 1) ^ -(folded & 1)
    raise Broken("a number does not end")


def read_sized(source) -> bytes:
    size = read_long(source)
    data = source.read(size) if 0 <= size <= MOST_INFLATED else b""
    if len(data) != size:
        raise Broken("the header is cut")
    return data


@dataclass(frozen=True)
class Header:
    schema: str
    codec: str
    sync: bytes
    end: int


def read_header(source) -> Header:
    if source.read(len(MAGIC)) != MAGIC:
        raise Broken("not an Avro file")
    entries = {}
    while count := read_long(source):
        if count < 0:
            read_long(source)  # size in bytes
        for _ in range(abs(count)):
            key = read_sized(source)
            entries[key.decode()] = read_sized(source)
    sync = source.read(SYNC)
    if len(sync) < SYNC or "avro.schema" not in entries:
        raise Broken("the header is cut")
    return Header(entries["avro.schema"].decode(), entries.get("avro.codec", b"null").decode(), sync, source.tell())


def find_marker(source, sync: bytes, at: int) -> int | None:
    """Where the next sync marker begins, from ``at`` on."""
    source.seek(at)
    rest = b""
    while chunk := source.read(READ_BYTES):
        window = rest + chunk
        found = window.find(sync)
        if found >= 0:
            return at - len(rest) + found
        rest, at = window[-(SYNC - 1) :], at + len(chunk)
    return None


def inflate(body: bytes, codec: str) -> bytes:
    if codec == "null":
        return body
    if codec != "deflate":
        raise ValueError(f"unsupported codec: {codec}")
    stream = zlib.decompressobj(-15)
    try:
        raw = stream.decompress(body, MOST_INFLATED)
    except zlib.error as why:
        raise Broken(str(why)) from why
    if not stream.eof:
        raise Broken("the compressed block is cut or too large")
    return raw


def blocks(source, header: Header, start: int, stop: int, size: int) -> Iterator[tuple[int, int, bytes | None, str | None]]:
    """Position, number of records, and content or complaint of every block whose marker begins in [start, stop)."""
    first = header.end - SYNC
    mark = first if start <= first else find_marker(source, header.sync, start)
    while mark is not None and mark < stop and mark + SYNC < size:
        at, count = mark + SYNC, 0
        source.seek(at)
        try:
            count, length = read_long(source), read_long(source)
            if count < 0 or not 0 <= length <= size - source.tell() - SYNC:
                raise Broken("the size of the block does not fit")
            body = source.read(length)
            if source.read(SYNC) != header.sync:
                raise Broken("no sync marker behind the block")
        except Broken as why:
            yield at, count, None, str(why)
            mark = find_marker(source, header.sync, at)
            continue
        mark = source.tell() - SYNC
        try:
            raw, why = inflate(body, header.codec), None
        except Broken as broken:
            raw, why = None, str(broken)
        yield at, count, raw, why
        source.seek(mark)


# -- reading


@dataclass(frozen=True)
class Piece:
    file: str
    start: int
    stop: int
    size: int
    folders: dict[str, str | None]


class Pieces(InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(len(pieces))
        self.pieces = pieces


def data_files(path: str) -> Iterator[tuple[str, int, dict[str, str | None]]]:
    """Files below a path in the order of their names, hidden ones left out, and the values their folders carry."""
    files, root = opened(path)
    if files.get_file_info(root).type == pafs.FileType.File:
        found, root = [files.get_file_info(root)], root.rpartition("/")[0]
    else:
        found = files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    for info in sorted(found, key=lambda i: i.path):
        parts = info.path[len(root) :].strip("/").split("/")
        if info.type == pafs.FileType.File and not any(p.startswith(("_", ".")) for p in parts):
            pairs = [p.partition("=") for p in parts[:-1] if "=" in p]
            yield info.path, info.size, {unquote(k): None if v == NO_VALUE else unquote(v) for k, _, v in pairs}


class AvroReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.permissive = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.tasks = int(options.get("tasks", 0))
        self.wanted: dict[str, str] = {}

    def partitions(self):
        found = [
            (file, size, folders)
            for file, size, folders in data_files(self.path)
            if not any(folders.get(k) != v for k, v in self.wanted.items() if k in folders and self.textual(k))
        ]
        # Ranges smaller than a task's fair share of the bytes go together: a task has a cost of its own.
        share = -(-sum(size for _, size, _ in found) // self.tasks) if self.tasks else 0
        most = max(self.split_bytes, min(share, SPLIT_BYTES))
        tasks, full = [[]], 0
        for file, size, folders in found:
            for start in range(0, size, self.split_bytes):
                stop = min(start + self.split_bytes, size)
                if full and full + stop - start > most:
                    tasks.append([])
                    full = 0
                tasks[-1].append(Piece(file, start, stop, size, folders))
                full += stop - start
        return [Pieces(t) for t in tasks]

    def textual(self, name: str) -> bool:
        return isinstance(self.schema[name].dataType, T.StringType)

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        for file, pieces in groupby(partition.pieces, key=lambda piece: piece.file):
            pieces = list(pieces)
            with io.BufferedReader(files.open_input_file(file), READ_BYTES) as source:
                try:
                    header = read_header(source)
                except Broken as why:
                    if not self.permissive:
                        raise Broken(f"{file}: {why}") from why
                    if pieces[0].start == 0:
                        yield self.batch(pieces[0], None, [(0, 0, str(why))])
                    continue
                # Blocks are decoded side by side, so those of all the task's ranges of a file make groups together.
                found = (block for piece in pieces for block in blocks(source, header, piece.start, piece.stop, piece.size))
                yield from self.groups(pieces[0], header, found)

    def groups(self, piece: Piece, header: Header, found) -> Iterator[pa.RecordBatch]:
        node = avro.parse(header.schema)
        whole, broken, held = [], [], 0
        for at, count, raw, why in found:
            if raw is None:
                broken.append((at, count, why))
            else:
                whole.append((at, count, raw))
                held += len(raw)
            if held >= GROUP_BYTES:
                yield self.decoded(piece, node, whole, broken)
                whole, broken, held = [], [], 0
        if whole or broken:
            yield self.decoded(piece, node, whole, broken)

    def decoded(self, piece: Piece, node: avro.Node, whole: list, broken: list) -> pa.RecordBatch:
        records, _, bad = avro.decode_blocks(node, [raw for _, _, raw in whole], [count for _, count, _ in whole])
        broken = broken + [(*whole[n][:2], "the records do not fill the block") for n in np.flatnonzero(bad)]
        if broken and not self.permissive:
            raise Broken(f"{piece.file}, block at {broken[0][0]}: {broken[0][2]}")
        return self.batch(piece, records, sorted(broken))

    def batch(self, piece: Piece, records: pa.StructArray | None, broken: list) -> pa.RecordBatch:
        target = to_arrow_schema(self.schema)
        columns = {} if records is None else dict(zip((f.name for f in records.type), records.flatten()))
        rows, lost = (0 if records is None else len(records)), len(broken)
        out = []
        for field in target:
            if field.name == CORRUPT:
                notes = [{"file": piece.file, "position": at, "records": count, "message": why} for at, count, why in broken]
                values = pa.array([None] * rows + notes, field.type)
            elif field.name in columns:
                values = pa.concat_arrays([columns[field.name].cast(field.type), pa.nulls(lost, field.type)])
            elif field.name not in piece.folders:
                values = pa.nulls(rows + lost, field.type)
            else:
                values = pa.array([piece.folders.get(field.name)], pa.string()).cast(field.type).take(pa.array([0] * (rows + lost), pa.int64()))
            out.append(values)
        return pa.RecordBatch.from_arrays(out, names=target.names)


class SkippingAvroReader(AvroReader):
    """Skips files by equality filters on folders; Spark asks for a reader of its own where this is on."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1:
                self.wanted[f.attribute[0]] = str(f.value)
        return filters  # Spark tests them again: they may be on columns of the records


# -- writing


class Container:
    """One file that is being written."""

    def __init__(self, stream, text: str, codec: str):
        self.stream, self.node, self.codec, self.sync = stream, avro.parse(text), codec, uuid.uuid4().bytes
        head = MAGIC + self.number(2)
        for key, value in ((b"avro.schema", text.encode()), (b"avro.codec", codec.encode())):
            head += self.number(len(key)) + key + self.number(len(value)) + value
        stream.write(head + self.number(0) + self.sync)

    @staticmethod
    def number(value: int) -> bytes:
        return avro.varints(np.array([value], np.int64))[0].tobytes()

    def write(self, rows: pa.RecordBatch) -> None:
        data, lengths = avro.encode(self.node, pa.StructArray.from_arrays(rows.columns, names=rows.schema.names))
        ends = np.cumsum(lengths)
        edges = np.flatnonzero(np.diff((ends - lengths) // BLOCK_BYTES)) + 1
        for low, high in zip([0, *edges], [*edges, len(lengths)]):
            body = data[ends[low] - lengths[low] : ends[high - 1]].tobytes()
            if self.codec == "deflate":
                packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                body = packer.compress(body) + packer.flush()
            self.stream.write(self.number(int(high - low)) + self.number(len(body)) + body + self.sync)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]  # below the staging folder


class AvroWriter(DataSourceArrowWriter):
    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.path, self.overwrite, self.codec = options["path"], overwrite, options.get("codec", "deflate")
        if self.codec not in ("null", "deflate"):
            raise ValueError(f"unsupported codec: {self.codec}")
        self.folders = [name for name in options.get("partitionBy", "").split(",") if name]
        kept = T.StructType([f for f in schema.fields if f.name not in self.folders])
        self.text = options.get("avroSchema") or avro_schema(kept)
        self.names = kept.fieldNames()
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        files, root = opened(self.path)
        done, folder, stream = [], None, None
        for batch in iterator:
            for place, rows in self.by_folder(batch):
                if place != folder:
                    if stream:
                        stream.close()
                    done.append(f"{place}/part-{uuid.uuid4().hex}.avro".lstrip("/"))
                    target = f"{root}/{self.staging}/{done[-1]}"
                    files.create_dir(target.rpartition("/")[0], recursive=True)
                    folder, stream = place, files.open_output_stream(target)
                    container = Container(stream, self.text, self.codec)
                container.write(rows)
        if stream:
            stream.close()
        return Written(done)

    def by_folder(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        """Stretches of rows of one folder; rows sorted by folder make one file a folder and task."""
        if not len(batch):
            return
        columns = [batch.column(name).cast(pa.string()) for name in self.folders]
        changed = np.zeros(len(batch) - 1, bool)
        for column in columns:
            changed |= np.diff(pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)) != 0
        edges = [int(e) for e in np.flatnonzero(changed) + 1]
        for low, high in zip([0, *edges], [*edges, len(batch)]):
            values = [column[low].as_py() for column in columns]
            place = "/".join(f"{quote(n, safe='')}={NO_VALUE if v is None else quote(v, safe='')}" for n, v in zip(self.folders, values))
            yield place, batch.select(self.names).slice(low, high - low)

    def commit(self, messages):
        files, root = opened(self.path)
        files.create_dir(root, recursive=True)
        if self.overwrite:
            for info in files.get_file_info(pafs.FileSelector(root)):
                if info.base_name != self.staging:
                    (files.delete_dir if info.type == pafs.FileType.Directory else files.delete_file)(info.path)
        for name in [name for message in messages if message for name in message.files]:
            files.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            files.move(f"{root}/{self.staging}/{name}", f"{root}/{name}")
        self.abort(messages)
        files.open_output_stream(f"{root}/_SUCCESS").close()

    def abort(self, messages):
        files, root = opened(self.path)
        if files.get_file_info(f"{root}/{self.staging}").type == pafs.FileType.Directory:
            files.delete_dir(f"{root}/{self.staging}")


class AvroSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        """That of the first file, or of the option ``avroSchema``."""
        text = self.options.get("avroSchema")
        if text is None:
            files, _ = opened(self.options["path"])
            first = next((file for file, _, _ in data_files(self.options["path"])), None)
            if first is None:
                raise ValueError(f"no files, and no schema given: {self.options['path']}")
            with io.BufferedReader(files.open_input_file(first)) as source:
                text = read_header(source).schema
        return optional(from_avro_schema(text))

    def reader(self, schema):
        return (SkippingAvroReader if self.options.get("skipFiles") == "true" else AvroReader)(self.options, schema)

    def writer(self, schema, overwrite):
        return AvroWriter(self.options, schema, overwrite)


# -- for users


def read_avro(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Rows of the files below a path; a broken block fails the job. Without a schema that of the first file is taken."""
    spark.dataSource.register(AvroSource)
    options["skipFiles"] = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format(FORMAT).options(**options)
    return (reader if schema is None else reader.schema(optional(schema))).load(Folder(spark, path).qualified())


def read_avro_or_errors(spark: SparkSession, path: str, schema: T.StructType, **options) -> Outcome:
    """Rows of the sound blocks, and one dead letter for every broken block."""
    rows = read_avro(spark, path, T.StructType([*schema.fields, CORRUPT_FIELD]), mode="PERMISSIVE", **options)
    where = {name: F.col(CORRUPT).getField(name).cast("string") for name in ("file", "position", "records")}
    values = {
        "event_id": F.concat_ws("@", where["file"], where["position"]),
        "stage": F.lit("avro_block"),
        "error_class": F.lit("MalformedBlock"),
        "error_message": F.col(CORRUPT).getField("message"),
        "attributes": F.create_map(*[c for name, value in where.items() for c in (F.lit(name), value)]),
        "payload": F.lit(None).cast("binary"),
    }
    failed = rows.filter(F.col(CORRUPT).isNotNull()).select(*[values[n].alias(n) for n in ERROR.fieldNames()])
    return Outcome(rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), failed)


def write_avro(df: DataFrame, path: str, mode: str = "append", folders: tuple[str, ...] = (), **options) -> None:
    """Write container files; columns named in ``folders`` become folders and leave the records."""
    spark = df.sparkSession
    spark.dataSource.register(AvroSource)
    if folders:
        df = df.sortWithinPartitions(*folders)
        options["partitionBy"] = ",".join(folders)
    df.write.format(FORMAT).mode(mode).options(**options).save(Folder(spark, path).qualified())
