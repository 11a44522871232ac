"""Compressed envelopes: many transports in one payload.

An envelope's payload is a zlib-compressed Arrow stream of transport rows. Packing and unpacking
work on whole Arrow batches inside the tasks that hold the rows: no shuffle, no per-row Python,
and at most one envelope's rows in memory beyond the incoming batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.operators.outcome import Outcome, split
from millrace.schemas import TRANSPORT

COMPRESSION_KEY = "compression"
COMPRESSION_NAME = "ZLIB"
RECORDS_KEY = "records"
RAW_BYTES_KEY = "raw_bytes"
MAX_RECORDS = 4500  # fixed value: default records per envelope
MAX_RAW_BYTES = 64 << 20
INFLATE_LIMIT = 256 << 20  # bytes of an envelope's content; our own stay below 64 MiB
OUTPUT_ROWS, OUTPUT_BYTES = 10_000, 8 << 20  # held beside the incoming batch before they leave

UNPACKED = T.StructType(
    TRANSPORT.fields
    + [T.StructField("error_class", T.StringType()), T.StructField("error_message", T.StringType())]
)


def pack(df: DataFrame, max_records: int = MAX_RECORDS, level: int = 1, max_raw_bytes: int = MAX_RAW_BYTES) -> DataFrame:
    """Pack transports into envelopes of at most ``max_records`` rows.

    Each task packs the rows it already holds, as one generator element fills one envelope. An
    envelope also closes at ``max_raw_bytes``, so large payloads make more envelopes, not larger
    ones. Ids derive from the task and its sequence, so a retried task repeats them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        prefix = f"{task.partitionId()}"
        # A streaming task repeats its partition number in every micro-batch.
        batch = task.getLocalProperty("streaming.sql.batchId")
        prefix = f"{batch}-{prefix}" if batch else prefix
        held: list[pa.RecordBatch] = []
        rows, size, made = 0, 0, 0

        def envelope() -> pa.RecordBatch:
            nonlocal held, rows, size, made
            result = _seal(held, prefix, made, level)
            held, rows, size, made = [], 0, 0, made + 1
            return result

        for incoming in batches:
            lengths = pc.fill_null(pc.binary_length(incoming.column("payload")), 0).to_numpy(zero_copy_only=False)
            start = 0
            while start < incoming.num_rows:
                room = max_records - rows
                piece = lengths[start : start + room]
                fits = int((piece.cumsum() + size <= max_raw_bytes).sum())
                take = min(fits, len(piece))
                if take == 0 and rows == 0:
                    take = 1  # one payload above the byte limit travels alone
                if take:
                    held.append(incoming.slice(start, take))
                    rows += take
                    size += int(lengths[start : start + take].sum())
                    start += take
                if rows >= max_records or (take < len(piece) and rows):
                    yield envelope()
        if rows:
            yield envelope()

    return df.select(*TRANSPORT.fieldNames()).mapInArrow(run, TRANSPORT)


def _seal(held: list[pa.RecordBatch], prefix: str, number: int, level: int) -> pa.RecordBatch:
    import hashlib
    import zlib

    table = pa.Table.from_batches(held)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    payload = zlib.compress(sink.getvalue(), level)
    raw = pc.sum(pc.binary_length(table.column("payload"))).as_py() or 0
    attributes = [
        (COMPRESSION_KEY, COMPRESSION_NAME),
        (RECORDS_KEY, str(table.num_rows)),
        (RAW_BYTES_KEY, str(raw)),
    ]
    latest = pc.max(table.column("event_ts")).as_py()
    digest = hashlib.md5(payload).hexdigest()
    schema = table.schema
    return pa.RecordBatch.from_arrays(
        [
            pa.array([f"{prefix}-{number}-{digest}"], schema.field("event_id").type),
            pa.array([attributes], schema.field("attributes").type),
            pa.array([payload], schema.field("payload").type),
            pa.array([latest], schema.field("event_ts").type),
        ],
        schema=schema,
    )


def inflated(payload: bytes, limit: int = INFLATE_LIMIT) -> bytes:
    """An envelope's content. A foreign one may inflate to any size: above ``limit`` it is an error, and
    no more than that is ever held."""
    unpacker = zlib.decompressobj()
    body = unpacker.decompress(payload, limit + 1)
    if len(body) > limit:
        raise ValueError(f"the envelope inflates to more than {limit} bytes")
    if not unpacker.eof:
        raise ValueError("the envelope is cut off")
    return body


def unpack_all(df: DataFrame) -> DataFrame:
    """Plain transports pass through; envelopes are inflated into their rows.

    A row that cannot be inflated stays as it is, with ``error_class`` and ``error_message`` set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            kind = pc.map_lookup(incoming.column("attributes"), COMPRESSION_KEY, "first")
            packed = pc.fill_null(pc.equal(kind, COMPRESSION_NAME), False)
            if not pc.any(packed, min_count=0).as_py():
                yield _with_error(incoming, None, None)
                continue
            plain = incoming.filter(pc.invert(packed))
            if plain.num_rows:
                yield _with_error(plain, None, None)
            held: list[pa.RecordBatch] = []
            failed: list[tuple[int, str, str]] = []
            rows, size = 0, 0

            def joined() -> Iterator[pa.RecordBatch]:
                nonlocal held, failed, rows, size
                if held:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                if failed:
                    places, names, messages = zip(*failed)
                    yield _with_error(incoming.take(pa.array(places)), names, messages)
                held, failed, rows, size = [], [], 0, 0

            for number in np.flatnonzero(packed.to_numpy(zero_copy_only=False)).tolist():
                payload = incoming.column("payload")[number].as_py()
                try:
                    body = inflated(payload)
                    with pa.ipc.open_stream(body) as reader:
                        content = reader.read_all().select(incoming.schema.names).cast(incoming.schema)
                    made = [_with_error(b, None, None) for b in content.combine_chunks().to_batches()]
                except Exception as problem:  # any bad envelope is a dead letter, never a failed task
                    failed.append((number, type(problem).__name__, str(problem)))
                    rows, size = rows + 1, size + len(payload or b"")
                else:
                    held += made
                    rows += sum(b.num_rows for b in made)
                    size += sum(b.nbytes for b in made)
                if rows >= OUTPUT_ROWS or size >= OUTPUT_BYTES:
                    yield from joined()
            yield from joined()

    return df.select(*TRANSPORT.fieldNames()).mapInArrow(run, UNPACKED)


def _with_error(batch: pa.RecordBatch, names: Sequence[str] | None, messages: Sequence[str] | None) -> pa.RecordBatch:
    """The batch with its rows' errors, or with none."""
    text = batch.schema.field("event_id").type
    extra = [pa.nulls(batch.num_rows, text) if values is None else pa.array(values, text) for values in (names, messages)]
    fields = list(batch.schema) + [pa.field("error_class", text), pa.field("error_message", text)]
    return pa.RecordBatch.from_arrays(batch.columns + extra, schema=pa.schema(fields))


def maybe_decompress(df: DataFrame) -> Outcome:
    """Unpack envelopes and route those that cannot be inflated to dead letters."""
    return split(unpack_all(df), "decompress", TRANSPORT.fieldNames())
