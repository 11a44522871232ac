"""Scalar encodings used by cells: big-endian values, ISO instants, grouping-key text."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def long_bytes(value: Column) -> Column:
    """Eight bytes, big endian, two's complement; stays on the JVM."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


@F.arrow_udf(BinaryType())
def double_bytes(values: pa.Array) -> pa.Array:
    """IEEE-754 bits of a double, big endian. Spark has no built-in for the raw bits."""
    return _big_endian(values, "<f8", "<u8", False)


@F.arrow_udf(BinaryType())
def float_bytes(values: pa.Array) -> pa.Array:
    """IEEE-754 bits of a float, widened to eight bytes with the sign bit extended."""
    return _big_endian(values, "<f4", "<i4", True)


def _big_endian(values: pa.Array, kind: str, bits: str, signed: bool) -> pa.Array:
    import numpy as np

    numbers = values.to_numpy(zero_copy_only=False).astype(kind)
    wide = numbers.view(bits).astype(np.int64 if signed else np.uint64)
    # Java's raw-bits call folds every NaN onto one pattern.
    nan = np.isnan(numbers)
    wide[nan] = 0x7FC00000 if signed else 0x7FF8000000000000
    raw = wide.astype(wide.dtype.newbyteorder(">")).tobytes()
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(values), [None, pa.py_buffer(raw)])
    whole = fixed.cast(pa.binary())
    if values.null_count == 0:
        return whole
    import pyarrow.compute as pc

    return pc.if_else(values.is_valid(), whole, pa.scalar(None, pa.binary()))


def iso_millis(ts: Column) -> Column:
    """``2024-01-01T00:14:59.999Z``"""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def key_text(columns: Sequence[Column | str]) -> Column:
    """One text for a grouping key of one or more fields.

    Distinct keys keep distinct texts: the separator and the escape sign are escaped inside
    values, and null is written as an escape that no value can produce.
    """
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        safe = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(safe, F.lit("\\N")))
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
