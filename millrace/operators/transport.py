"""Transports: identity, attributes and payload bytes of an event; schema text in attributes."""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import avro
from millrace.functions.encoding import key_text

SCHEMA_KEY = "schema_"
SCHEMA_CHUNK = 500  # fixed value: characters per attribute


def wrap(df: DataFrame, payload: Column | str, id_fields: tuple[str, ...] = (), attributes: Column | None = None, event_ts: Column | str | None = None) -> DataFrame:
    """Wrap rows as transports.

    ``id_fields`` give an id that a retried task reproduces; without them the id is a random UUID.
    """
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    event_id = F.sha2(key_text(id_fields), 256) if id_fields else F.expr("uuid()")
    return df.select(
        event_id.alias("event_id"),
        (attributes if attributes is not None else F.create_map().cast("map<string,string>")).alias("attributes"),
        col(payload).cast("binary").alias("payload"),
        (col(event_ts) if event_ts is not None else F.lit(None)).cast("timestamp").alias("event_ts"),
    )


def encode_json(record: Column) -> Column:
    """Record to JSON text bytes; absent optional fields are left out."""
    return F.to_json(record, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"}).cast("binary")


def encode_avro(record: Column, schema) -> Column:
    """Record to Avro binary, a column of records at a time; null records stay null. The bytes name no fields, so the reader needs the schema."""
    node = avro.parse(schemas.avro_schema(schema))

    @F.arrow_udf("binary")
    def encoded(records: pa.Array) -> pa.Array:
        there = records.is_valid()
        data, lengths = avro.encode(node, records.drop_null())
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        values = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        place = np.cumsum(there.to_numpy(zero_copy_only=False)) - 1
        return values.cast(pa.binary()).take(pa.array(place, mask=pc.invert(there).to_numpy(zero_copy_only=False)))

    return encoded(record)


def encode(record: Column, fmt: str, schema=None) -> Column:
    """``schema`` (a registered name or a record type) is needed for Avro alone."""
    if fmt.upper() == "AVRO":
        if schema is None:
            raise ValueError("Avro needs the schema of the record")
        return encode_avro(record, schema)
    if fmt.upper() not in ("JSON", "THRIFT"):
        raise ValueError(f"unknown format: {fmt}")
    return encode_json(record)


def schema_attributes(text: Column, size: int = SCHEMA_CHUNK) -> Column:
    """Cut a text into numbered attributes ``schema_1`` .. ``schema_n``."""
    count = F.ceil(F.length(text) / F.lit(size)).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.map_from_entries(
        F.transform(
            numbers,
            lambda i: F.struct(
                F.concat(F.lit(SCHEMA_KEY), i.cast("string")),
                F.substring(text, (i - 1) * size + 1, F.lit(size)),
            ),
        )
    )


def schema_text(attributes: Column) -> Column:
    """Inverse of :func:`schema_attributes`: numeric order of the keys, not text order."""
    mine = F.filter(F.map_entries(attributes), lambda e: e["key"].startswith(SCHEMA_KEY))
    numbered = F.transform(
        mine,
        lambda e: F.struct(F.substring_index(e["key"], "_", -1).cast("int").alias("n"), e["value"].alias("v")),
    )
    return F.array_join(F.transform(F.array_sort(numbered), lambda e: e["v"]), "")


def compress_schema(text: str) -> str:
    """One schema per stream: compressed on the driver and carried as a literal."""
    return base64.b64encode(zlib.compress(text.encode())).decode()


def expand_schema(text: str) -> str:
    return zlib.decompress(base64.b64decode(text)).decode()
