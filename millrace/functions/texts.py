"""Rows of Arrow batches as text, a column at a time."""

from __future__ import annotations

from functools import reduce
from hashlib import md5

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

TWO_53 = 1 << 53  # drawn fractions are whole numbers of this part


def plain(kind: T.DataType, values: pa.Array) -> pa.Array:
    """Text of single values; null stays null."""
    if isinstance(kind, T.StringType):
        return values
    if isinstance(kind, T.DoubleType):
        return pc.multiply(values, float(TWO_53)).cast(pa.int64()).cast(pa.string())
    if isinstance(kind, T.TimestampType):
        return values.cast(pa.int64()).cast(pa.string())
    if isinstance(kind, (T.BooleanType, T.LongType)):
        return values.cast(pa.string())
    raise ValueError(f"no text for {kind.simpleString()}")


def joined(columns: list[pa.Array], sign: str) -> pa.Array:
    """As ``concat_ws``: what is null is left out."""
    if all(c.null_count for c in columns):  # Arrow leaves out whole rows where nothing is known; their text is empty
        nothing = reduce(pc.and_, [c.is_null() for c in columns])
        columns = [pc.if_else(nothing, pa.scalar("", columns[0].type), columns[0]), *columns[1:]]
    return pc.binary_join_element_wise(*columns, sign, null_handling="skip")


def leaves(kind: T.DataType, values: pa.Array) -> list[pa.Array]:
    """One column of texts for every value that is not a record; an array is one value."""
    if isinstance(kind, T.StructType):
        return [text for f, inner in zip(kind.fields, values.flatten(), strict=True) for text in leaves(f.dataType, inner)]
    if not isinstance(kind, T.ArrayType):
        return [plain(kind, values)]
    items = leaves(kind.elementType, values.values)
    texts = items[0] if isinstance(kind.elementType, T.StringType) else joined(items, ":")
    if texts.null_count or values.null_count:
        raise ValueError("strings in arrays, and arrays, must not be null")
    return [pc.binary_join(pa.ListArray.from_arrays(values.offsets, texts), ",")]


def digests(schema: T.StructType, columns: list[pa.Array]) -> pa.Array:
    """MD5 of every row: all values as text, in schema order."""
    parts = [text for f, values in zip(schema.fields, columns, strict=True) for text in leaves(f.dataType, values)]
    texts = joined(parts, "|")
    _, ends, flat = texts.buffers()
    at, whole = memoryview(ends).cast("i")[texts.offset : texts.offset + len(texts) + 1].tolist(), memoryview(flat or b"")
    return pa.array([md5(whole[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string())
