"""Wrapping, envelopes, decoding, user transforms, dead letters, payload statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import ntz, query, table
from millrace.operators.decode import decode, decode_or_fail, parse, payload_text
from millrace.operators.envelope import COMPRESSION_KEY, COMPRESSION_NAME, maybe_decompress, pack
from millrace.operators.outcome import union_errors
from millrace.operators.stats import payload_percentiles, payload_stats
from millrace.operators.transforms import apply_events, apply_frame, load_transform, map_events
from millrace.operators.transport import encode, encode_json, schema_attributes, schema_text, wrap
from millrace.sources.events import transport_from_table

PROPS = T.StructType([T.StructField("k", T.LongType())])
EVENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
RECORD_SQL = """'{"user_id":' || user_id || ',"event_type":"' || event_type ||
  '","value":' || value::VARCHAR || ',"props":"' || replace(props, '"', '\\"') || '"}'"""


def event_transports(spark, sf_dir):
    """The events' own JSON payloads."""
    return transport_from_table(table(spark, sf_dir, "events"), "event_id", "props", "ts")


def record_transports(spark, sf_dir):
    """Whole events encoded as JSON payloads."""
    events = table(spark, sf_dir, "events")
    record = encode_json(F.struct(*EVENT.fieldNames()))
    return transport_from_table(events.withColumn("record", record), "event_id", "record", "ts")


def text_transports(spark, sf_dir, name, event_id, compressed=False):
    """Raw text as payload; optionally (and wrongly) marked as compressed."""
    attributes = F.create_map(F.lit(COMPRESSION_KEY), F.lit(COMPRESSION_NAME)) if compressed else None
    rows = table(spark, sf_dir, name).withColumn("_id", F.concat(F.lit(name + "-"), F.expr(event_id)))
    return transport_from_table(rows, "_id", "text", attributes=attributes)


TURN = "concat(conv_id, '-', turn)"


@query(
    "transport_wrap",
    """SELECT sha256(event_id::VARCHAR) AS event_id, 0::INT AS n_attributes, props AS payload, ts AS event_ts FROM events""",
)
def transport_wrap(spark, sf_dir):
    wrapped = wrap(table(spark, sf_dir, "events"), "props", ("event_id",), event_ts="ts")
    return wrapped.select(
        "event_id", F.size("attributes").alias("n_attributes"), payload_text().alias("payload"), ntz("event_ts", "event_ts")
    )


@query("encode_json", f"SELECT event_id::VARCHAR AS event_id, {RECORD_SQL} AS payload FROM events")
def encode_json_query(spark, sf_dir):
    return record_transports(spark, sf_dir).select("event_id", payload_text().alias("payload"))


@query(
    "schema_attributes",
    """SELECT doc_id, CAST(ceil(length(text) / 500) AS INT) AS n_attributes,
      length(text) - 500 * (greatest(CAST(ceil(length(text) / 500) AS BIGINT), 1) - 1) AS last_length,
      md5(text) AS rejoined FROM documents""",
)
def schema_attributes_query(spark, sf_dir):
    """Long texts cut into numbered attributes and joined again in numeric order."""
    cut = table(spark, sf_dir, "documents").select("doc_id", schema_attributes(F.col("text")).alias("attributes"))
    last = F.concat(F.lit("schema_"), F.size("attributes").cast("string"))
    return cut.select(
        "doc_id",
        F.size("attributes").alias("n_attributes"),
        F.length(F.element_at("attributes", last)).cast("bigint").alias("last_length"),
        F.md5(schema_text(F.col("attributes"))).alias("rejoined"),
    )


@query(
    "envelope_pack",
    """SELECT count(*) AS n_records, sum(strlen(text))::BIGINT AS raw_bytes, true AS within_limit FROM conversations""",
)
def envelope_pack(spark, sf_dir):
    packed = pack(text_transports(spark, sf_dir, "conversations", TURN), max_records=100)
    records = F.col("attributes")["records"].cast("bigint")
    return packed.agg(
        F.sum(records).alias("n_records"),
        F.sum(F.col("attributes")["raw_bytes"].cast("bigint")).alias("raw_bytes"),
        (F.max(records) <= 100).alias("within_limit"),
    )


@query(
    "envelope_roundtrip",
    """SELECT 'documents-' || doc_id AS event_id, md5(text) AS payload FROM documents UNION ALL
      SELECT event_id::VARCHAR, md5(props) FROM events""",
)
def envelope_roundtrip(spark, sf_dir):
    """Envelopes are unpacked and plain transports pass through, in one pass."""
    packed = pack(text_transports(spark, sf_dir, "documents", "doc_id"), max_records=64)
    mixed = packed.unionByName(event_transports(spark, sf_dir))
    return maybe_decompress(mixed).ok.select("event_id", F.md5("payload").alias("payload"))


@query(
    "envelope_dead_letter",
    """SELECT 'documents-' || doc_id AS event_id, 'decompress' AS stage, 'error' AS error_class, md5(text) AS payload FROM documents""",
)
def envelope_dead_letter(spark, sf_dir):
    """Texts marked as compressed cannot be inflated; the events' envelopes can."""
    bad = text_transports(spark, sf_dir, "documents", "doc_id", compressed=True)
    mixed = pack(event_transports(spark, sf_dir)).unionByName(bad)
    return maybe_decompress(mixed).failed.select("event_id", "stage", "error_class", F.md5("payload").alias("payload"))


@query("decode_json", "SELECT event_id::VARCHAR AS event_id, user_id, event_type, value, props, ts AS event_ts FROM events")
def decode_json(spark, sf_dir):
    ok = decode(record_transports(spark, sf_dir), EVENT).ok
    return ok.select("event_id", *EVENT.fieldNames(), ntz("event_ts", "event_ts"))


MALFORMED = """SELECT 'documents-' || doc_id AS event_id, text FROM documents
  UNION ALL SELECT 'conversations-' || conv_id || '-' || turn, text FROM conversations"""


@query(
    "decode_dead_letter",
    f"""SELECT event_id, 'decode' AS stage, 'MalformedPayload' AS error_class, md5(text) AS payload
      FROM ({MALFORMED}) WHERE NOT json_valid(text) OR json_type(text) <> 'OBJECT'""",
)
def decode_dead_letter(spark, sf_dir):
    """Prose among JSON payloads ends up with the dead letters."""
    mixed = (
        event_transports(spark, sf_dir)
        .unionByName(text_transports(spark, sf_dir, "documents", "doc_id"))
        .unionByName(text_transports(spark, sf_dir, "conversations", TURN))
    )
    failed = decode(mixed, PROPS).failed
    return failed.select("event_id", "stage", "error_class", F.md5("payload").alias("payload"))


STRICT = T.StructType(
    [
        T.StructField("k", T.LongType(), False),
        T.StructField("inner", T.StructType([T.StructField("need", T.LongType(), False), T.StructField("may", T.LongType())])),
        T.StructField("list", T.ArrayType(T.StructType([T.StructField("need", T.LongType(), False)]))),
    ]
)


@query(
    "decode_strict",
    """SELECT event_id::VARCHAR AS event_id, CASE
        WHEN event_id % 10 IN (0, 6, 9) THEN 'ok'
        WHEN event_id % 10 IN (1, 2) THEN 'payload holds more than one document'
        WHEN event_id % 10 IN (3, 4) THEN 'payload does not match the schema'
        ELSE 'payload lacks a required field' END AS outcome,
      CASE WHEN event_id % 10 IN (0, 6, 9) THEN (props ->> '$.k')::BIGINT END AS k FROM events""",
)
def decode_strict(spark, sf_dir):
    """Payloads doubled, followed by junk, cut, emptied, or without a required field at some level."""
    events = event_transports(spark, sf_dir)
    text, case = payload_text(), F.expr("CAST(event_id AS BIGINT) % 10")
    body = F.regexp_replace(text, "[}]\\s*$", "")
    changed = (
        F.when(case == 1, F.concat(text, text))
        .when(case == 2, F.concat(text, F.lit(" junk")))
        .when(case == 3, body)
        .when(case == 4, F.lit(""))
        .when(case == 5, F.lit("{}"))
        .when(case == 6, F.concat(body, F.lit(', "inner": null}')))
        .when(case == 7, F.concat(body, F.lit(', "inner": {"may": 1}}')))
        .when(case == 8, F.concat(body, F.lit(', "list": [{"need": 1}, {}]}')))
        .when(case == 9, F.concat(body, F.lit(', "inner": {"need": 1}, "list": [{"need": 2}]}  ')))
        .otherwise(text)
    )
    parsed = parse(events.withColumn("payload", changed.cast("binary")), STRICT)
    return parsed.select(
        "event_id", F.coalesce("error_message", F.lit("ok")).alias("outcome"), F.when(F.col("error_class").isNull(), F.col("record.k")).alias("k")
    )


@query(
    "decode_tails",
    """SELECT event_id::VARCHAR AS event_id, CASE event_id % 8
        WHEN 0 THEN 'ok' WHEN 7 THEN 'payload does not match the schema'
        ELSE 'payload holds more than one document' END AS outcome,
      CASE WHEN event_id % 8 = 0 THEN (props ->> '$.k')::BIGINT END AS k FROM events""",
)
def decode_tails(spark, sf_dir):
    """Payloads whose tail closes or reopens what a reader might wrap around them."""
    events = event_transports(spark, sf_dir)
    text, case = payload_text(), F.expr("CAST(event_id AS BIGINT) % 8")
    tails = ["] junk", "],[{}", "}", "]}", ",{}", ']},{"a":[{}']
    changed = F.when(case == 7, F.concat(text, F.lit(","), text, F.lit("]")).substr(2, 1_000_000))
    for number, tail in enumerate(tails, 1):
        changed = changed.when(case == number, F.concat(text, F.lit(tail)))
    parsed = parse(events.withColumn("payload", changed.otherwise(text).cast("binary")), PROPS)
    return parsed.select(
        "event_id", F.coalesce("error_message", F.lit("ok")).alias("outcome"), F.when(F.col("error_class").isNull(), F.col("record.k")).alias("k")
    )


@query("decode_failfast", "SELECT event_id::VARCHAR AS event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def decode_failfast(spark, sf_dir):
    return decode_or_fail(event_transports(spark, sf_dir), PROPS).select("event_id", "k")


@query(
    "payload_text",
    """SELECT 'documents-' || doc_id AS event_id, length(text) AS n_chars, md5(text) AS digest FROM documents""",
)
def payload_text_query(spark, sf_dir):
    plain = text_transports(spark, sf_dir, "documents", "doc_id").select("event_id", payload_text().alias("value"))
    return plain.select("event_id", F.length("value").cast("bigint").alias("n_chars"), F.md5("value").alias("digest"))


@query("udf_transform", "SELECT event_id::VARCHAR AS event_id, 'yes' AS tagged, upper(props) AS payload FROM events")
def udf_transform(spark, sf_dir):
    changed = apply_frame(event_transports(spark, sf_dir), load_transform("catalog.transforms:tag_and_upper"))
    return changed.select("event_id", F.col("attributes")["tagged"].alias("tagged"), payload_text().alias("payload"))


@query(
    "udf_dead_letter",
    """SELECT event_id::VARCHAR AS event_id, CASE WHEN k > 90 THEN 'k is out of range: ' || k ELSE 'ok' END AS outcome,
      CASE WHEN k > 90 THEN props ELSE '{"k": ' || 2 * k || '}' END AS payload
    FROM (SELECT *, (props ->> '$.k')::BIGINT AS k FROM events)""",
)
def udf_dead_letter(spark, sf_dir):
    """Events that the user's function refuses keep their payload and go to the error path."""
    judged = map_events(event_transports(spark, sf_dir), load_transform("catalog.transforms:reject_large"))
    outcome = F.coalesce("error_message", F.lit("ok"))  # one frame: the function runs once per event
    return judged.select("event_id", outcome.alias("outcome"), payload_text().alias("payload"))


@query(
    "errors_union",
    """SELECT 'documents-' || doc_id AS event_id, 'decompress' AS stage, 'error' AS error_class, md5(text) AS payload FROM documents
    UNION ALL SELECT event_id::VARCHAR, 'transform', 'ValueError', md5(props) FROM events WHERE (props ->> '$.k')::BIGINT > 90
    UNION ALL SELECT 'conversations-' || conv_id || '-' || turn, 'decode', 'MalformedPayload', md5(text) FROM conversations
      WHERE NOT json_valid(text) OR json_type(text) <> 'OBJECT'""",
)
def errors_union(spark, sf_dir):
    """Dead letters of three stages in one bag, with one schema."""
    opened = maybe_decompress(text_transports(spark, sf_dir, "documents", "doc_id", compressed=True))
    changed = apply_events(event_transports(spark, sf_dir), load_transform("catalog.transforms:reject_large"))
    decoded = decode(text_transports(spark, sf_dir, "conversations", TURN), PROPS)
    return union_errors([opened.failed, changed.failed, decoded.failed]).select(
        "event_id", "stage", "error_class", F.md5("payload").alias("payload")
    )


def sized(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("lang", F.col("text").cast("binary").alias("payload"))


@query(
    "payload_stats",
    """SELECT lang, count(*) AS n, sum(b)::BIGINT AS total, min(b) AS smallest, max(b) AS largest, avg(b) AS mean
      FROM (SELECT lang, strlen(text) AS b FROM documents) GROUP BY lang""",
)
def payload_stats_query(spark, sf_dir):
    return payload_stats(sized(spark, sf_dir), by=("lang",))


@query(
    "payload_percentiles",
    """SELECT lang, quantile_cont(b, 0.5) AS p50, quantile_cont(b, 0.9) AS p90, quantile_cont(b, 0.95) AS p95
      FROM (SELECT lang, strlen(text) AS b FROM documents) GROUP BY lang""",
)
def payload_percentiles_query(spark, sf_dir):
    return payload_percentiles(sized(spark, sf_dir), by=("lang",))


AVRO_SQL = "SELECT event_id::VARCHAR AS event_id, user_id, event_type, value, props, ts AS event_ts FROM events"
CUT = "length(props) % 2 = 1"


def avro_transports(spark, sf_dir):
    """Whole events encoded as Avro payloads."""
    events = table(spark, sf_dir, "events")
    record = encode(F.struct(*EVENT.fieldNames()), "AVRO", EVENT)
    return transport_from_table(events.withColumn("record", record), "event_id", "record", "ts")


def zigzag_hex(number: str) -> str:
    """Avro's number as hex digits, in SQL: zigzag, then seven bits a byte, low ones first. For numbers of up to five bytes."""
    folded = f"(CASE WHEN {number} < 0 THEN -2 * ({number}) - 1 ELSE 2 * ({number}) END)"
    byte = [f"CASE WHEN {folded} >= {1 << 7 * k} OR {k} = 0 THEN printf('%02X', ({folded} // {1 << 7 * k}) % 128 + CASE WHEN {folded} >= {1 << 7 * (k + 1)} THEN 128 ELSE 0 END) ELSE '' END" for k in range(5)]
    return " || ".join(f"({b})" for b in byte)


def text_bytes_hex(column: str) -> str:
    return f"{zigzag_hex(f'octet_length(encode({column}))')} || hex(encode({column}))"


@query(
    "encode_avro",
    f"""SELECT event_id::VARCHAR AS event_id, hex(encode(event_type)) AS type_hex, {zigzag_hex('user_id')} AS user_hex,
      '02' || ({zigzag_hex('user_id')}) || '02' || ({text_bytes_hex('event_type')}) || '02' || ({text_bytes_hex('props')}) AS payload_hex FROM events""",
)
def encode_avro_query(spark, sf_dir):
    """The bytes themselves: optional number, optional text, optional text."""
    kept = T.StructType([EVENT[n] for n in ("user_id", "event_type", "props")])
    payload = encode(F.struct(*kept.fieldNames()), "AVRO", kept)
    user = encode(F.struct("user_id"), "AVRO", T.StructType([T.StructField("user_id", T.LongType(), False)]))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string"), F.hex("event_type").alias("type_hex"), F.hex(user).alias("user_hex"), F.hex(payload).alias("payload_hex")
    )


@query("decode_avro", AVRO_SQL)
def decode_avro(spark, sf_dir):
    """Avro payloads back to typed rows; the fail-fast form."""
    rows = decode_or_fail(avro_transports(spark, sf_dir), EVENT, "AVRO")
    return rows.select("event_id", *EVENT.fieldNames(), ntz("event_ts", "event_ts"))


@query(
    "decode_avro_dead_letters",
    f"""SELECT event_id::VARCHAR AS event_id, CASE WHEN {CUT} THEN NULL ELSE value END AS value,
      CASE WHEN {CUT} THEN 'MalformedPayload' END AS error_class FROM events""",
)
def decode_avro_dead_letters(spark, sf_dir):
    """Payloads that lost their last byte are dead letters, the others typed rows."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.expr(CUT).alias("_cut"))
    sent = avro_transports(spark, sf_dir).join(events, "event_id")
    payload = F.when(F.col("_cut"), F.expr("substring(payload, 1, length(payload) - 1)")).otherwise(F.col("payload"))
    out = decode(sent.withColumn("payload", payload), EVENT, "AVRO")
    good = out.ok.select("event_id", "value", F.lit(None).cast("string").alias("error_class"))
    return good.unionByName(out.failed.select("event_id", F.lit(None).cast("double").alias("value"), "error_class"))
