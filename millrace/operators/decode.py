"""Payload bytes to typed rows."""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import avro
from millrace.operators.outcome import Outcome, split
from millrace.schemas import TRANSPORT

CORRUPT = "_corrupt"
MARK = f"_{secrets.token_hex(8)}"


def payload_text(payload: str = "payload") -> Column:
    """Payload bytes as UTF-8 text, not parsed."""
    return F.col(payload).cast("string")


def missing_required(value: Column, kind: T.DataType, nullable: bool) -> Column | None:
    """True where a required field is absent, at any level; None if nothing below is required.

    A parser fills absent fields with null whatever the schema says. Absent optional parents hide
    what they would require.
    """
    inner: list[Column] = []
    if isinstance(kind, T.StructType):
        inner = [m for f in kind.fields if (m := missing_required(value.getField(f.name), f.dataType, f.nullable)) is not None]
    elif isinstance(kind, T.ArrayType):
        probe = missing_required(F.lit(None).cast(kind.elementType), kind.elementType, kind.containsNull)
        if probe is not None:
            inner = [F.exists(value, lambda x: missing_required(x, kind.elementType, kind.containsNull))]
    elif isinstance(kind, T.MapType):
        probe = missing_required(F.lit(None).cast(kind.valueType), kind.valueType, kind.valueContainsNull)
        if probe is not None:
            inner = [F.exists(F.map_values(value), lambda x: missing_required(x, kind.valueType, kind.valueContainsNull))]
    found = None
    for test in inner:
        test = F.coalesce(test, F.lit(False))
        found = test if found is None else found | test
    if found is not None:
        found = value.isNotNull() & found
    if not nullable:
        found = value.isNull() if found is None else value.isNull() | found
    return found


def framed(text: Column) -> Column:
    """The payload as first element of an array that ends in a mark, the array as a field of an object.

    A parser stops after the first value and ignores what follows. In the frame nothing can follow unnoticed: what comes after the
    payload's document makes the frame malformed, adds elements, or closes the array before the mark, whose
    name no payload can know.
    """
    return F.concat(F.lit(f'{{"{MARK}":['), text, F.lit(f',{{"{MARK}":1}}]}}'))


def parse(df: DataFrame, schema, carried: tuple[str, ...] = ()) -> DataFrame:
    """Add ``record`` (typed) and the error columns.

    ``carried`` columns pass unchanged; errors among them that are already set stay, with no record.

    Bad are payloads that are null, blank or not JSON, hold more than one document, or lack a required field.

    The parsed value passes through ``explode`` of a one-element array. A filter on the error
    column therefore cannot be pushed below it, and each payload is parsed once, not once for the
    filter and again for the projection.
    """
    target = schemas.resolve(schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    corrupt = T.StructField(CORRUPT, T.StringType())
    element = T.StructType([*target.fields, T.StructField(MARK, T.IntegerType())])
    text = framed(payload_text())
    if "error_class" in carried:  # what has failed before is not parsed
        text = F.when(F.col("error_class").isNull(), text)
    parsed = F.from_json(text, T.StructType([T.StructField(MARK, T.ArrayType(element)), corrupt]), options)
    names = [*TRANSPORT.fieldNames(), *[c for c in carried if c not in ("error_class", "error_message")]]
    known = [F.col(c).alias(f"_{c}") if c in carried else F.lit(None).cast("string").alias(f"_{c}") for c in ("error_class", "error_message")]
    once = df.select(*names, *known, F.explode(F.array(parsed)).alias("_once"))
    values = F.col("_once").getField(MARK)
    value = F.get(values, F.lit(0))
    sound = F.col("_once").getField(CORRUPT).isNull() & value.isNotNull() & F.col("payload").isNotNull()
    marked = (F.size(values) == 2) & (F.get(values, F.lit(1)).getField(MARK) == 1) & value.getField(MARK).isNull()
    marked = F.coalesce(marked, F.lit(False))
    bad = ~F.coalesce(sound & marked, F.lit(False))
    # Only rows that failed are looked at again, to say why: an object that ends well, and something else behind it.
    first = F.ltrim(payload_text()).startswith("{") & F.get_json_object(payload_text(), "$").isNotNull()
    why = F.when(~marked & F.coalesce(first, F.lit(False)), F.lit("payload holds more than one document"))
    reason = F.when(F.col("_error_class").isNotNull(), F.lit(None).cast("string")).when(bad, why.otherwise(F.lit("payload does not match the schema")))
    absent = missing_required(value, target, True)
    if absent is not None:
        reason = reason.when(absent, F.lit("payload lacks a required field"))
    record = F.struct(*[value.getField(f.name).alias(f.name) for f in target.fields])
    judged = once.select(*names, "_error_class", "_error_message", record.alias("record"), F.explode(F.array(reason)).alias("_reason"))
    fresh = F.when(F.col("_reason").isNotNull(), F.lit("MalformedPayload"))
    message = F.when(F.col("_error_class").isNull(), F.col("_reason")).otherwise(F.col("_error_message"))
    return judged.select(*names, "record", F.coalesce("_error_class", fresh).alias("error_class"), message.alias("error_message"))


def parse_avro(df: DataFrame, schema) -> DataFrame:
    """As :func:`parse` for Avro binary. Bad are payloads that are null, broken, or have bytes behind the record."""
    target = schemas.resolve(schema)
    node = avro.parse(schemas.avro_schema(target))
    shape = T.StructType([T.StructField("record", schemas.optional(target)), T.StructField("bad", T.BooleanType())])

    @F.arrow_udf(shape)
    def decoded(payloads: pa.Array) -> pa.Array:
        records, bad = avro.decode_payloads(node, payloads)
        records = records.take(pa.array(np.arange(len(bad)), mask=bad))
        return pa.StructArray.from_arrays([records, pa.array(bad)], names=["record", "bad"])

    names = TRANSPORT.fieldNames()
    once = df.select(*names, F.explode(F.array(decoded("payload"))).alias("_once"))
    bad = F.col("_once").getField("bad")
    return once.select(
        *names, F.col("_once").getField("record").alias("record"), F.when(bad, F.lit("MalformedPayload")).alias("error_class"),
        F.when(bad, F.lit("payload does not match the schema")).alias("error_message"),
    )


def parse_as(df: DataFrame, schema, fmt: str) -> DataFrame:
    if fmt.upper() not in ("JSON", "THRIFT", "AVRO"):
        raise ValueError(f"unknown format: {fmt}")
    return parse_avro(df, schema) if fmt.upper() == "AVRO" else parse(df, schema)


def decode(df: DataFrame, schema, fmt: str = "JSON") -> Outcome:
    """Typed rows (id, attributes, event time and the record's fields), malformed ones aside."""
    whole = split(parse_as(df, schema, fmt), "decode", ["event_id", "attributes", "event_ts", "record"])
    return Outcome(whole.ok.select("event_id", "attributes", "event_ts", "record.*"), whole.failed)


def decode_or_fail(df: DataFrame, schema, fmt: str = "JSON") -> DataFrame:
    """As :func:`decode` without a dead-letter side: a bad payload, also a null or empty one, fails the job."""
    parsed = parse_as(df, schema, fmt)
    failure = F.concat(F.lit("event "), F.coalesce("event_id", F.lit("without id")), F.lit(": MalformedPayload, "), F.col("error_message"))
    record = F.when(F.col("error_message").isNull(), F.col("record")).otherwise(F.raise_error(failure).cast(parsed.schema["record"].dataType))
    return parsed.select("event_id", "attributes", "event_ts", record.alias("record")).select(
        "event_id", "attributes", "event_ts", "record.*"
    )
