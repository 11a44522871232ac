"""Wide records a column of a batch at a time, with the values that ``generator.FieldBuilder`` writes as SQL.

A record of several hundred fields is more code than Spark compiles, and lambda bodies never are compiled:
every node of every value would be interpreted. Here a field is a few numpy operations on a batch of rows;
the elements of its array are one longer batch. Only the hash of a fresh string is computed one by one.
What is computed from the records can be computed in the same task, before any value becomes a value of a Spark row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

try:
    from _sha2 import sha256  # OpenSSL prepares each hash for longer than it computes one block
except ImportError:
    from hashlib import sha256

from millrace import schemas
from millrace.functions.draws import DIGIT_LETTER, LANES, LETTERS_PER_HASH, SIGN_LETTER, coefficients, mixed

MANY_LEAVES = 200  # values of one element each; smaller records are compiled as SQL
ROWS = (256, 2048)  # fewest and most rows made at once
BATCH_BYTES = 128 << 20  # most of what is made at once, beyond the fewest rows
ROWS_OUT = 512  # rows sent to the JVM at once
LETTERS = np.frombuffer(
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + DIGIT_LETTER * 10 + SIGN_LETTER * 2).encode(), np.uint8
)
PAIRS = np.stack([np.repeat(LETTERS, 64), np.tile(LETTERS, 64)], axis=1).view(np.uint16)[:, 0]  # of twelve bits
NUMBERS = {T.ByteType: np.int8, T.ShortType: np.int16, T.IntegerType: np.int32, T.LongType: np.int64}
multipliers = cache(coefficients)


@dataclass(frozen=True)
class Places:
    """The rows of a batch, or the elements of all their collections on one path."""

    hashes: list[bytes]
    lane_a: np.ndarray
    lane_b: np.ndarray
    missing: np.ndarray  # rows without id: numbers are null, strings the repeated one, collections as small as may be
    row: np.ndarray  # at which of ``hashes``
    pos: np.ndarray | None = None


def leaves(schema: T.StructType) -> int:
    def below(kind: T.DataType) -> int:
        if isinstance(kind, T.ArrayType):
            return below(kind.elementType)
        return sum(below(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else 1

    return below(schema)


def rows_at_once(schema: T.StructType, options) -> int:
    """Every call of numpy costs the same for few rows; wide values in long collections are held in memory."""
    record = leaves(schema) * options.max_collection * options.max_chars // 4
    return int(np.clip(BATCH_BYTES // max(1, record), *ROWS))


def suits(schema: T.StructType, options) -> bool:
    """The record is wide, and of the types that :class:`Vectors` makes."""
    plain = (T.BooleanType, T.DoubleType, T.FloatType, T.StringType, T.BinaryType, T.TimestampType, *NUMBERS)

    def known(field: T.StructField) -> bool:
        kind = field.dataType
        if field.name in options.skewed_fields or any(field.metadata.get(note) for note in ("now", "unique", "symbols")):
            return False
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        return all(map(known, kind.fields)) if isinstance(kind, T.StructType) else isinstance(kind, plain)

    return options.complete and leaves(schema) >= MANY_LEAVES and all(map(known, schema.fields))


class Vectors:
    """Turns a data type and a field path into an Arrow array over places."""

    def __init__(self, options):
        self.opt = options

    def number(self, at: Places, path: str) -> np.ndarray:
        return mixed(at.lane_a, at.lane_b, multipliers(self.opt.seed, path), at.pos)

    def value(self, kind: T.DataType, arrow: pa.DataType, name: str, path: str, at: Places) -> pa.Array:
        if isinstance(kind, T.StructType):
            return self.struct(kind, arrow, path + ".", at)
        if isinstance(kind, T.ArrayType):
            return self.array(kind, arrow, name, path, at)
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return self.text(arrow, name, path, at)
        return pa.array(self.scalar(kind, path, at), mask=at.missing).cast(arrow)

    def struct(self, kind: T.StructType, arrow: pa.StructType, path: str, at: Places) -> pa.Array:
        if not kind.fields:
            return pa.array([{}] * len(at.row), arrow)
        members = [self.value(f.dataType, a.type, f.name, path + f.name, at) for f, a in zip(kind.fields, arrow, strict=True)]
        return pa.StructArray.from_arrays(members, fields=list(arrow))

    def scalar(self, kind: T.DataType, path: str, at: Places) -> np.ndarray:
        first = self.number(at, path)
        if isinstance(kind, T.BooleanType):
            return first % 2 == 0
        if isinstance(kind, T.ByteType):
            return (first % 256 - 128).astype(np.int8)
        if isinstance(kind, T.ShortType):
            return (first % 32768).astype(np.int16)
        second = self.number(at, path + "+")
        if isinstance(kind, T.IntegerType):
            return ((first - (1 << 30)) * 2 + second % 2).astype(np.int32)
        if isinstance(kind, T.TimestampType):
            return first * 1_000_000 + second % 1_000_000
        if isinstance(kind, T.LongType):
            return (first - (1 << 30)) * (1 << 33) + second * 4 + self.number(at, path + "++") % 4
        whole = (first * (1 << 22) + second % (1 << 22)).astype(np.float64) / float(1 << 53)
        return whole.astype(np.float32) if isinstance(kind, T.FloatType) else whole

    def text(self, arrow: pa.DataType, name: str, path: str, at: Places) -> pa.Array:
        from millrace.sources.generator import FRESH_PER_TEN_THOUSAND, repeated_text

        drawn = self.number(at, path + "*")
        fresh = np.flatnonzero((drawn % 10000 < FRESH_PER_TEN_THOUSAND) & ~at.missing)
        same = repeated_text(self.opt, name).encode()
        sizes = np.full(len(drawn), len(same), np.int64)
        sizes[fresh] = drawn[fresh] // 10000 % (self.opt.max_chars - self.opt.min_chars) + self.opt.min_chars
        made = np.zeros((len(drawn), self.opt.max_chars - 1), np.uint8)
        made[:, : len(same)] = np.frombuffer(same, np.uint8)
        for chunk in range(-(-made.shape[1] // LETTERS_PER_HASH)):
            start = chunk * LETTERS_PER_HASH
            which = fresh[sizes[fresh] > start]
            wide = min(LETTERS_PER_HASH, made.shape[1] - start)
            made[which, start : start + wide] = letters(self.hashed(which, path, chunk, at), wide)
        flat = made[np.arange(made.shape[1]) < sizes[:, None]]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(arrow, len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat)])

    def hashed(self, which: np.ndarray, path: str, chunk: int, at: Places) -> np.ndarray:
        """The hash of each string's chunk, a row of 32 bytes."""
        head, tail, rows = f"|{path}".encode(), f"|{chunk}".encode(), map(at.hashes.__getitem__, at.row[which].tolist())
        if at.pos is None:
            head += tail
            found = [sha256(row + head).digest() for row in rows]
        else:
            places = at.pos[which].tolist()
            ends = {pos: b"%b|%d%b" % (head, pos, tail) for pos in set(places)}
            found = [sha256(row + ends[pos]).digest() for row, pos in zip(rows, places, strict=True)]
        return np.frombuffer(b"".join(found), np.uint8).reshape(-1, 32)

    def array(self, kind: T.ArrayType, arrow: pa.ListType, name: str, path: str, at: Places) -> pa.Array:
        from millrace.sources.generator import POSITIONS

        most, smallest = self.opt.max_collection, 0 if self.opt.empty_arrays else 1
        sizes = np.where(at.missing, smallest, np.maximum(self.number(at, path + "%") % most, smallest))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        parent = np.repeat(np.arange(len(sizes)), sizes)
        i = np.arange(ends[-1]) - ends[parent] + 1
        pos = i if at.pos is None else (at.pos[parent] * max(1000, most) + i) % POSITIONS
        inner = Places(at.hashes, at.lane_a[parent], at.lane_b[parent], at.missing[parent], at.row[parent], pos)
        items = self.value(kind.elementType, arrow.value_type, name, path + "[]", inner)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items, type=arrow)


def letters(hashes: np.ndarray, wide: int) -> np.ndarray:
    """The first ``wide`` characters of the hashes' base64, with those that are not letters replaced."""
    triples = -(-wide // 4)
    bytes_ = np.zeros((len(hashes), 3 * triples), np.uint16)
    known = min(3 * triples, hashes.shape[1])
    bytes_[:, :known] = hashes[:, :known]
    a, b, c = bytes_[:, 0::3], bytes_[:, 1::3], bytes_[:, 2::3]
    made = np.stack([PAIRS[a << 4 | b >> 4], PAIRS[(b & 15) << 8 | c]], axis=2)
    return made.view(np.uint8).reshape(len(hashes), 4 * triples)[:, :wide]


def places(batch: pa.RecordBatch) -> Places:
    hashes, lane_a, lane_b = (batch.column(name) for name in LANES)
    numbers = [lane.fill_null(0).to_numpy(zero_copy_only=False) for lane in (lane_a, lane_b)]
    plain = [value.encode() for value in hashes.fill_null("").to_pylist()]
    return Places(plain, *numbers, lane_a.is_null().to_numpy(zero_copy_only=False), np.arange(batch.num_rows))


Made = Callable[[list[pa.Array], list[pa.Array]], pa.RecordBatch]


def with_fields(laned: DataFrame, schema: T.StructType, options, keep: tuple[str, ...], then: Made | None = None, shape: T.StructType | None = None) -> DataFrame:
    """Columns ``_k0``.. with the columns to keep and ``_f0``.. with the fields, for each row of a frame with lanes.

    With ``then``, what it makes of the columns to keep and the fields of a batch, in ``shape``.
    """
    kept = laned.select(*[F.col(c).alias(f"_k{n}") for n, c in enumerate(keep)], *LANES)
    fields = [T.StructField(f"_f{n}", schemas.optional(f.dataType)) for n, f in enumerate(schema.fields)]
    spec = T.StructType([*kept.schema.fields[: len(keep)], *fields])
    arrow = to_arrow_schema(spec)
    rows = rows_at_once(schema, options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(options)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                at = places(part)
                made = [
                    vectors.value(f.dataType, a.type, f.name, f.name, at)
                    for f, a in zip(schema.fields, list(arrow)[len(keep) :], strict=True)
                ]
                old = [part.column(n).cast(arrow.field(n).type) for n in range(len(keep))]
                if then is not None:
                    yield then(old, made)
                    continue
                whole = pa.RecordBatch.from_arrays(old + made, schema=arrow)
                yield from (whole.slice(first, ROWS_OUT) for first in range(0, whole.num_rows, ROWS_OUT))

    return kept.mapInArrow(run, spec if then is None else shape)
