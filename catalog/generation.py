"""Deterministic synthetic data over the event sequence."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import duck
from catalog.registry import query, table, text_hex
from millrace import schemas
from millrace.functions import texts
from millrace.functions.draws import with_lanes
from millrace.functions.texts import TWO_53
from millrace.sources.generator import GeneratorOptions, generate, generate_records, generate_then, refresh_timestamps, sample_corpus
from millrace.sources.sequence import impulses_per_second, pace, ramp, spread

D = duck.DRAWS
EVENTS = duck.lanes("events", "event_id")
OPT = GeneratorOptions()
SMALL = GeneratorOptions(max_collection=5, min_chars=10, max_chars=20)


def numbers(spark, sf_dir):
    """The event ids, spread over tasks by row count."""
    return spread(table(spark, sf_dir, "events").select("event_id"))


def drawn(spark, sf_dir, **columns: str):
    """Draw expressions over the event sequence."""
    laned = with_lanes(numbers(spark, sf_dir), "event_id")
    return laned.select("event_id", *[F.expr(text).alias(name) for name, text in columns.items()])


def over_events(**columns: str) -> str:
    return "SELECT event_id, " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + f" FROM {EVENTS}"


RATE = impulses_per_second(9000, 4500)


@query("src_sequence", f"SELECT event_id AS n, event_id // {RATE} AS due_second FROM events")
def src_sequence(spark, sf_dir):
    """The event ids as a sequence paced at two envelopes per second."""
    return pace(table(spark, sf_dir, "events").select(F.col("event_id").alias("n")), "n", RATE)


@query(
    "src_ramp_schedule",
    """SELECT event_id, active, event_id % active AS publisher FROM (
      SELECT event_id, least(20, (epoch_us(ts) - min(epoch_us(ts)) OVER ()) // 1000000 // 3600 + 1) AS active FROM events)""",
)
def src_ramp_schedule(spark, sf_dir):
    """One more publisher each hour, up to twenty."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return ramp(events, "ts", 20, 3600, "event_id").select("event_id", "active", "publisher")


PRIMITIVES = dict(
    flag=D.boolean("flag"),
    tiny=D.byte("tiny"),
    small=D.short("small"),
    whole=D.integer("whole"),
    big=D.long("big"),
    ratio=D.fraction("ratio"),
)
PRIMITIVE_TYPES = T.StructType(
    [
        T.StructField("flag", T.BooleanType()),
        T.StructField("tiny", T.ByteType()),
        T.StructField("small", T.ShortType()),
        T.StructField("whole", T.IntegerType()),
        T.StructField("big", T.LongType()),
        T.StructField("ratio", T.DoubleType()),
    ]
)


@query("gen_primitives", over_events(**PRIMITIVES))
def gen_primitives(spark, sf_dir):
    return generate(numbers(spark, sf_dir), "event_id", PRIMITIVE_TYPES, OPT, ("event_id",))


SYMBOLS = "[" + ", ".join(f"'{s}'" for s in schemas.SOURCES) + "]"


@query("gen_enum", over_events(source=f"({SYMBOLS})[CAST({D.below(30, 'source')} + 1 AS INT)]"))
def gen_enum(spark, sf_dir):
    kind = T.StructType([T.StructField("source", T.StringType(), True, {"symbols": schemas.SOURCES})])
    return generate(numbers(spark, sf_dir), "event_id", kind, OPT, ("event_id",))


LENGTH = f"({D.below(60, 'word#')} + 20)"


@query("gen_string", over_events(word=duck.letters("word", LENGTH)))
def gen_string(spark, sf_dir):
    """Letters only, 20 to 79 of them."""
    return drawn(spark, sf_dir, word=D.letters("word", LENGTH, 79))


@query("gen_string_repeat", over_events(name=duck.text("name", "name", OPT)))
def gen_string_repeat(spark, sf_dir):
    """About half of the strings reuse the field's one cached value."""
    return generate(numbers(spark, sf_dir), "event_id", T.StructType([T.StructField("name", T.StringType())]), OPT, ("event_id",))


SKEWED = GeneratorOptions(skewed_fields=("uuid",), skew_degree=10, skew_buckets=1000)


def bucket_text(name: str, bucket: str) -> str:
    from millrace.functions.draws import fixed_number

    length = f"(({bucket} * 7919 + {fixed_number(42, name, 1 << 20)}) % 60 + 20)"
    return duck.letters_from(f"'42|{name}|bucket|' || CAST({bucket} AS VARCHAR)", length)


@query(
    "gen_skewed_key",
    f"""SELECT event_id, bucket, {bucket_text('uuid', 'bucket')} AS uuid
      FROM (SELECT *, {D.skewed(1000, 10, 'uuid^')} AS bucket FROM {EVENTS})""",
)
def gen_skewed_key(spark, sf_dir):
    made = generate_records(
        with_lanes(numbers(spark, sf_dir), "event_id").withColumn("bucket", F.expr(D.skewed(1000, 10, "uuid^"))).select("event_id", "bucket"),
        "event_id",
        T.StructType([T.StructField("uuid", T.StringType())]),
        SKEWED,
        ("event_id", "bucket"),
    )
    return made.select("event_id", "bucket", F.col("record.uuid").alias("uuid"))


@query("gen_binary", over_events(blob_hex=f"hex(encode({duck.text('blob', 'blob', OPT)}))"))
def gen_binary(spark, sf_dir):
    kind = T.StructType([T.StructField("blob", T.BinaryType())])
    made = generate(numbers(spark, sf_dir), "event_id", kind, GeneratorOptions(complete=False), ("event_id",))
    return made.select("event_id", text_hex("blob", "blob_hex"))


def duck_list(path: str, element: str, options: GeneratorOptions, smallest: int = 1) -> str:
    return f"list_transform(range(1, {duck.size(path, options.max_collection, smallest)} + 1), lambda i: {element})"


def distinct_in_order(items: str) -> str:
    return f"list_filter({items}, lambda x, n: list_position({items}, x) = n)"


NUMBERS = duck_list("numbers", D.long("numbers[]", "i"), SMALL)
KINDS = duck_list("kinds", f"({SYMBOLS})[CAST({D.below(30, 'kinds[]', 'i')} + 1 AS INT)]", SMALL)
KEYS = duck_list("pairs", duck.text("pairs{k}", "pairs", SMALL, "i"), SMALL)
FIRST = "list_filter(range(1, len(ks) + 1), lambda n: list_position(ks, ks[n]) = n)"


@query(
    "gen_collections",
    f"""SELECT event_id, CAST(len(numbers) AS INT) AS n_numbers, array_to_string(numbers, ',') AS numbers,
      array_to_string({distinct_in_order('kinds')}, ',') AS kinds, CAST(len({FIRST}) AS INT) AS n_pairs,
      array_to_string(list_sort(list_transform({FIRST}, lambda n: ks[n] || '=' || CAST({D.long("pairs{v}", "n")} AS VARCHAR))), ',') AS pairs
    FROM (SELECT *, {NUMBERS} AS numbers, {KINDS} AS kinds, {KEYS} AS ks FROM {EVENTS})""",
)
def gen_collections(spark, sf_dir):
    """A list, a set (duplicates dropped) and a map (the first value of a key stays)."""
    kind = T.StructType(
        [
            T.StructField("numbers", T.ArrayType(T.LongType())),
            T.StructField("kinds", T.ArrayType(T.StringType()), True, {"unique": True, "symbols": schemas.SOURCES}),
            T.StructField("pairs", T.MapType(T.StringType(), T.LongType())),
        ]
    )
    made = generate(numbers(spark, sf_dir), "event_id", kind, SMALL, ("event_id",))
    pairs = F.transform(F.map_entries("pairs"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return made.select(
        "event_id",
        F.size("numbers").alias("n_numbers"),
        F.array_join(F.col("numbers").cast("array<string>"), ",").alias("numbers"),
        F.array_join("kinds", ",").alias("kinds"),
        F.size("pairs").alias("n_pairs"),
        F.array_join(F.array_sort(pairs), ",").alias("pairs"),
    )


@query(
    "gen_optional",
    over_events(
        must=duck.text("must", "must", SMALL),
        may=f"coalesce(CASE WHEN {D.boolean('may?')} THEN {D.long('may')} END::VARCHAR, 'absent')",
        n_items=f"CAST(CASE WHEN {D.boolean('items?')} THEN {duck.size('items', 5)} ELSE 0 END AS INT)",
    ),
)
def gen_optional(spark, sf_dir):
    """Half of the optional values are absent; an absent collection is empty, not null."""
    kind = T.StructType(
        [
            T.StructField("must", T.StringType(), False),
            T.StructField("may", T.LongType()),
            T.StructField("items", T.ArrayType(T.LongType())),
        ]
    )
    options = GeneratorOptions(max_collection=5, min_chars=10, max_chars=20, complete=False)
    made = generate(numbers(spark, sf_dir), "event_id", kind, options, ("event_id",))
    may = F.coalesce(F.col("may").cast("string"), F.lit("absent"))
    return made.select("event_id", "must", may.alias("may"), F.size("items").alias("n_items"))


SIMPLE = dict(location="text", startup="long", description="text")


def list_text(path: str, members: dict[str, str]) -> str:
    """Element text of a generated list of structs, members joined by ``:``."""
    parts = [
        duck.text(f"{path}[].{m}", m, SMALL, "i") if k == "text" else f"CAST({D.long(f'{path}[].{m}', 'i')} AS VARCHAR)"
        for m, k in members.items()
    ]
    return duck_list(path, " || ':' || ".join(f"({p})" for p in parts), SMALL)


@query(
    "gen_compound_event",
    f"""SELECT event_id, uuid, name, "externalId", "clientEpoch", "createdTimestamp", data, source, destination,
      CAST(len(carriers) AS INT) AS n_carriers, array_to_string(carriers, ',') AS carriers,
      CAST(len({distinct_in_order('events')}) AS INT) AS n_events, array_to_string({distinct_in_order('events')}, ',') AS events
    FROM ({over_events(
        uuid=duck.text("uuid", "uuid", SMALL),
        name=duck.text("name", "name", SMALL),
        externalId=D.long("externalId"),
        clientEpoch=D.long("clientEpoch"),
        createdTimestamp=duck.text("createdTimestamp", "createdTimestamp", SMALL),
        data=duck.text("data", "data", SMALL),
        source=f"({SYMBOLS})[CAST({D.below(30, 'source')} + 1 AS INT)]",
        destination=duck.text("destination", "destination", SMALL),
        carriers=list_text("carriers", dict(id="text", value="long")),
        events=list_text("events", SIMPLE),
    )})""",
)
def gen_compound_event(spark, sf_dir):
    made = generate(numbers(spark, sf_dir), "event_id", "compound", SMALL, ("event_id",))

    def joined(column, *members):
        return F.array_join(
            F.transform(column, lambda e: F.concat_ws(":", *[e[m].cast("string") for m in members])), ","
        )

    return made.select(
        "event_id", "uuid", "name", "externalId", "clientEpoch", "createdTimestamp", "data", "source", "destination",
        F.size("carriers").alias("n_carriers"),
        joined("carriers", "id", "value").alias("carriers"),
        F.size("events").alias("n_events"),
        joined("events", "location", "startup", "description").alias("events"),
    )


MESSAGE_OPT = GeneratorOptions.for_format("JSON", min_chars=10, max_chars=20, max_collection=5)


def json_member(name: str, value: str, quoted: bool) -> str:
    quote = '"' if quoted else ""
    return f"""'"{name}":{quote}' || ({value}) || '{quote}'"""


def message_sql() -> str:
    def group(path: str, fields: dict[str, str]) -> str:
        parts = [
            json_member(f, duck.text(f"{path}.{f}", f, MESSAGE_OPT) if k == "text" else f"CAST({D.long(f'{path}.{f}')} AS VARCHAR)", k == "text")
            for f, k in fields.items()
        ]
        return f"""'"{path}":{{' || {" || ',' || ".join(parts)} || '}}'"""

    user = group("user", dict(location="text", startup="long", description="text", uuid="text"))
    topic = group("topic", dict(id="text", value="long", name="text"))
    message = json_member("message", duck.text("message", "message", MESSAGE_OPT), True)
    stamp = json_member("ts", "strftime(TIMESTAMP '2024-01-01' + INTERVAL (event_id) SECOND, '%Y-%m-%dT%H:%M:%S') || '.000Z'", True)
    return f"SELECT event_id, '{{' || {user} || ',' || {topic} || ',' || {message} || ',' || {stamp} || '}}' AS payload FROM {EVENTS}"


@query("gen_json_message", message_sql())
def gen_json_message(spark, sf_dir):
    """A JSON object with every property present and the generation time as text."""
    from dataclasses import replace

    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    now = F.timestamp_seconds(F.unix_seconds(start) + F.col("event_id"))
    made = generate_records(numbers(spark, sf_dir), "event_id", "message", replace(MESSAGE_OPT, now=now), ("event_id",))
    return made.select("event_id", F.to_json("record").alias("payload"))


JSON_ARRAY = """{"type": "object", "required": ["marks", "level"], "properties": {
  "marks": {"type": "array", "items": {"type": "integer", "minimum": -9223372036854775808, "maximum": 9223372036854775807}},
  "level": {"enum": ["low", "high"]}}}"""


@query(
    "gen_json_array",
    over_events(
        n_marks=f"CAST({duck.size('marks', 5, 0)} AS INT)",
        marks=f"array_to_string({duck_list('marks', D.long('marks[]', 'i'), MESSAGE_OPT, 0)}, ',')",
        level=f"(['low', 'high'])[CAST({D.below(2, 'level')} + 1 AS INT)]",
    ),
)
def gen_json_array(spark, sf_dir):
    """JSON arrays may be empty."""
    kind = schemas.from_json_schema(JSON_ARRAY)
    made = generate(numbers(spark, sf_dir), "event_id", kind, MESSAGE_OPT, ("event_id",))
    return made.select(
        "event_id",
        F.size("marks").alias("n_marks"),
        F.array_join(F.col("marks").cast("array<string>"), ",").alias("marks"),
        "level",
    )


@query(
    "gen_log_event",
    over_events(
        **{n: duck.text(n, n, OPT) for n in ("category", "createTimestamp", "data", "destination", "source", "uuid")},
        clientId=D.long("clientId"),
        epochId=D.long("epochId"),
        eventName=duck.text("event.eventName", "eventName", OPT),
        hostBootTime=D.long("event.hostBootTime"),
        hostName=duck.text("event.hostName", "hostName", OPT),
    ),
)
def gen_log_event(spark, sf_dir):
    made = generate(numbers(spark, sf_dir), "event_id", "log", GeneratorOptions.for_format("AVRO"), ("event_id",))
    return made.select("*", "event.*").drop("event")


@query(
    "gen_sample_corpus",
    f"""SELECT event_id, o_orderkey, o_custkey, o_orderstatus FROM
      (SELECT event_id, {D.number('corpus')} % (SELECT count(*) FROM orders) AS corpus_index FROM {EVENTS})
      JOIN (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS corpus_index FROM orders) USING (corpus_index)""",
)
def gen_sample_corpus(spark, sf_dir):
    """Each event emits one order, drawn uniformly with replacement."""
    corpus = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    events = table(spark, sf_dir, "events").select("event_id")
    made = sample_corpus(events, "event_id", corpus, order_by=("o_orderkey",))
    return made.select("event_id", "o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "gen_refresh_timestamps",
    "SELECT o_orderkey, o_totalprice, TIMESTAMP '2025-06-01 12:00:00' AS o_orderdate FROM orders",
)
def gen_refresh_timestamps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return refresh_timestamps(orders, F.lit("2025-06-01 12:00:00").cast("timestamp"))


# -- the record shapes of the load suites: every value of a row, as text, in one digest

def sql_leaves(fields, path: str = "", pos: str | None = None) -> list[str]:
    """DuckDB text of every value below ``fields``, in schema order."""
    out = []
    for spec in fields:
        where = f"{path}{spec.name}"
        if isinstance(spec.dataType, T.StructType):
            out += sql_leaves(spec.dataType.fields, where + ".", pos)
        elif isinstance(spec.dataType, T.ArrayType):
            inner = spec.dataType.elementType
            parts = sql_leaves(inner.fields, where + "[].", "i") if isinstance(inner, T.StructType) else [sql_leaf(inner, spec.name, where + "[]", "i")]
            out.append(f"array_to_string({duck_list(where, ' || chr(58) || '.join(f'({p})' for p in parts), SMALL)}, ',')")
        else:
            out.append(sql_leaf(spec.dataType, spec.name, where, pos))
    return out


def sql_leaf(kind: T.DataType, name: str, path: str, pos: str | None) -> str:
    if isinstance(kind, T.StringType):
        return duck.text(path, name, SMALL, pos)
    if isinstance(kind, T.DoubleType):
        return f"CAST(CAST({D.fraction(path, pos)} * {TWO_53} AS BIGINT) AS VARCHAR)"
    if isinstance(kind, T.TimestampType):
        return f"CAST({D.number(path, pos)} * 1000000 + {D.below(1_000_000, path + '+', pos)} AS VARCHAR)"
    return f"CAST({D.boolean(path, pos) if isinstance(kind, T.BooleanType) else D.long(path, pos)} AS VARCHAR)"


def spark_leaves(fields, column) -> list:
    out = []
    for spec in fields:
        value = column(spec.name)
        if isinstance(spec.dataType, T.StructType):
            out += spark_leaves(spec.dataType.fields, value.getField)
        elif isinstance(spec.dataType, T.ArrayType):
            out.append(F.array_join(each_element(value, spec.dataType.elementType), ","))
        else:
            out.append(spark_leaf(spec.dataType, value))
    return out


def each_element(value, kind: T.DataType):
    if isinstance(kind, T.StringType):  # as it is: a lambda would be interpreted
        return value

    def text(element):
        parts = spark_leaves(kind.fields, element.getField) if isinstance(kind, T.StructType) else [spark_leaf(kind, element)]
        return F.concat_ws(":", *parts)

    return F.transform(value, text)


def spark_leaf(kind: T.DataType, value):
    if isinstance(kind, T.DoubleType):
        value = (value * F.lit(float(TWO_53))).cast("bigint")
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def digest_sql(schema: T.StructType) -> str:
    return f"SELECT event_id, md5(concat_ws('|', {', '.join(sql_leaves(schema.fields))})) AS digest FROM {EVENTS}"


def digests(spark, sf_dir, schema: T.StructType):
    made = generate(numbers(spark, sf_dir), "event_id", schema, SMALL, ("event_id",))
    return made.select("event_id", F.md5(F.concat_ws("|", *spark_leaves(schema.fields, F.col))).alias("digest"))


def wide_digests(spark, sf_dir, schema: T.StructType):
    """As :func:`digests`, a column of a batch at a time: texts of two thousand values a row are too much for Spark's expressions."""
    ids = numbers(spark, sf_dir)
    shape = T.StructType([ids.schema["event_id"], T.StructField("digest", T.StringType(), False)])

    def digested(keep: list[pa.Array], fields: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*keep, texts.digests(schema, fields)], names=["event_id", "digest"])

    return generate_then(ids, "event_id", schema, digested, shape, SMALL, ("event_id",))


@query("gen_mid_event", digest_sql(schemas.mid_event()))
def gen_mid_event(spark, sf_dir):
    """50 fields with records inside records."""
    return digests(spark, sf_dir, schemas.mid_event())


@query("gen_wide_event", digest_sql(schemas.wide_event()))
def gen_wide_event(spark, sf_dir):
    """797 fields, 228 of them arrays."""
    return wide_digests(spark, sf_dir, schemas.wide_event())
