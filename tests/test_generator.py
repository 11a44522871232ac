import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.sources.generator import (
    GeneratorOptions,
    generate,
    generate_records,
    number_rows,
    refresh_timestamps,
    repeated_text,
    sample_corpus,
)
from millrace.sources.sequence import impulses_per_second, ramp, sequence, unbounded_sequence
from tests.conftest import wait_until

SMALL = GeneratorOptions(min_chars=5, max_chars=25, max_collection=4)


def count_fields(schema):
    total = 0
    for field in schema.fields:
        total += 1
        kind = field.dataType
        while isinstance(kind, (T.ArrayType, T.MapType)):
            kind = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType
        if isinstance(kind, T.StructType):
            total += count_fields(kind)
    return total


def test_shapes_of_the_large_records():
    assert len(schemas.mid_event().fields) == 50 and count_fields(schemas.mid_event()) == 88
    assert len(schemas.wide_event().fields) == 797 and count_fields(schemas.wide_event()) == 1063


@pytest.mark.parametrize("name", sorted(schemas.REGISTRY) + ["mid"])
def test_every_registered_type_is_generated(spark, name):
    made = generate(spark.range(20), "id", name, SMALL)
    assert made.columns == schemas.resolve(name).fieldNames()
    rows = made.collect()
    assert len(rows) == 20
    assert all(value is not None for row in rows for value in row)


def test_wide_record_is_one_projection(spark):
    made = generate(spark.range(3), "id", "wide", GeneratorOptions(min_chars=5, max_chars=10, max_collection=3))
    assert len(made.collect()) == 3
    depth = made._jdf.queryExecution().optimizedPlan().toString().count("Project ")
    assert depth <= 4


def test_strings_and_collections_stay_in_their_domain(spark):
    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("marks", T.ArrayType(T.StringType()))])
    rows = generate(spark.range(2000), "id", kind, SMALL).collect()
    lengths = {len(r["name"]) for r in rows}
    assert min(lengths) >= 5 and max(lengths) <= 24
    assert {len(r["marks"]) for r in rows} == {1, 2, 3}
    constant = repeated_text(SMALL, "name")
    share = sum(r["name"] == constant for r in rows) / len(rows)
    assert 0.45 < share < 0.55


def test_json_arrays_may_be_empty(spark):
    kind = T.StructType([T.StructField("marks", T.ArrayType(T.LongType()))])
    rows = generate(spark.range(500), "id", kind, GeneratorOptions.for_format("JSON", max_collection=4)).collect()
    assert {len(r["marks"]) for r in rows} == {0, 1, 2, 3}


def test_long_strings(spark):
    kind = T.StructType([T.StructField("blob", T.StringType())])
    rows = generate(spark.range(40), "id", kind, GeneratorOptions(min_chars=4000, max_chars=20_000)).collect()
    assert all(4000 <= len(r["blob"]) < 20_000 and r["blob"].isalpha() for r in rows)


def test_skewed_field_takes_few_values(spark):
    options = GeneratorOptions(skewed_fields=("uuid", " "), skew_degree=10, skew_buckets=50)
    assert options.skewed_fields == ("uuid",)
    rows = generate(spark.range(2000), "id", "compound", options).groupBy("uuid").count().collect()
    assert 1 < len(rows) <= 50
    assert max(r["count"] for r in rows) > 2000 / 50


def test_incomplete_objects(spark):
    options = GeneratorOptions(complete=False, max_collection=4)
    rows = generate(spark.range(400), "id", "compound", options).collect()
    assert all(r["uuid"] is not None for r in rows)
    missing = sum(r["name"] is None for r in rows) / len(rows)
    assert 0.4 < missing < 0.6
    assert any(r["carriers"] == [] for r in rows) and all(r["carriers"] is not None for r in rows)
    assert all(c["id"] is not None for r in rows for c in r["carriers"])


def test_generation_time_text(spark):
    row = generate_records(spark.range(1), "id", "message").select(F.to_json("record").alias("j")).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z", json.loads(row["j"])["ts"])


def test_unknown_type_and_bad_options():
    with pytest.raises(ValueError):
        schemas.resolve("nothing")
    with pytest.raises(ValueError):
        GeneratorOptions(min_chars=9, max_chars=9)
    with pytest.raises(ValueError):
        GeneratorOptions.for_format("XML")


def test_json_schema_reader():
    document = {
        "$ref": "#/definitions/m",
        "definitions": {
            "m": {
                "type": "object",
                "required": ["a", "b", "c", "d", "e"],
                "properties": {
                    "a": {"oneOf": [{"type": "null"}, {"$ref": "#/definitions/inner"}]},
                    "b": {"type": "integer"},
                    "c": {"type": "integer", "maximum": 9223372036854775807},
                    "d": {"type": "string", "default": "current-timestamp"},
                    "e": {"type": "array", "items": {"type": "number"}},
                    "f": {"enum": ["x", "y"]},
                },
            },
            "inner": {"type": "object", "properties": {"flag": {"type": "boolean"}}},
        },
    }
    schema = schemas.from_json_schema(json.dumps(document))
    assert schema.simpleString() == "struct<a:struct<flag:boolean>,b:int,c:bigint,d:string,e:array<double>,f:string>"
    assert schema["a"].nullable and not schema["b"].nullable and schema["f"].nullable
    assert schema["d"].metadata == {"now": True} and schema["f"].metadata == {"symbols": ["x", "y"]}


@pytest.mark.parametrize(
    "union",
    [
        [{"type": "string"}, {"type": "integer"}, {"type": "null"}],
        [{"type": "string"}, {"type": "integer"}],
        [{"type": "null"}],
    ],
)
def test_unsupported_unions_are_refused(union):
    with pytest.raises(ValueError):
        schemas.from_json_schema(json.dumps({"type": "object", "properties": {"x": {"oneOf": union}}}))


def test_avro_schema_reader():
    record = {
        "type": "record",
        "name": "r",
        "fields": [
            {"name": "a", "type": ["null", "string"]},
            {"name": "b", "type": {"type": "long", "logicalType": "timestamp-micros"}},
            {"name": "c", "type": ["null", {"type": "record", "name": "inner", "fields": [{"name": "x", "type": "double"}]}]},
            {"name": "d", "type": {"type": "array", "items": "inner"}},
            {"name": "e", "type": {"type": "map", "values": "int"}},
            {"name": "f", "type": {"type": "enum", "name": "k", "symbols": ["P", "Q"]}},
        ],
    }
    schema = schemas.from_avro_schema(json.dumps(record))
    assert schema.simpleString() == (
        "struct<a:string,b:timestamp,c:struct<x:double>,d:array<struct<x:double>>,e:map<string,int>,f:string>"
    )
    with pytest.raises(ValueError):
        schemas.from_avro_schema(json.dumps({"type": "record", "name": "r", "fields": [{"name": "a", "type": ["int", "string"]}]}))


def test_dense_numbering_with_copies_of_one_row(spark):
    rows = [(1, "same")] * 300 + [(i, "other") for i in range(2, 302)]
    corpus = spark.createDataFrame(rows, "k int, v string")
    numbered, total, weight = number_rows(spark, corpus, ("k",))
    assert total == 600 and weight > 0
    found = sorted((r["corpus_index"], r["k"]) for r in numbered.collect())
    assert [i for i, _ in found] == list(range(600))
    assert [k for _, k in found] == sorted(k for k, _ in rows)


def test_large_corpus_is_joined_by_shuffle(spark, monkeypatch):
    from millrace.sources import generator

    monkeypatch.setattr(generator, "SMALL_CORPUS_BYTES", 0)
    corpus = spark.createDataFrame([(i,) for i in range(3)], "v int")
    made = sample_corpus(spark.range(3000), "id", corpus)
    counts = {r["v"]: r["count"] for r in made.groupBy("v").count().collect()}
    assert sum(counts.values()) == 3000 and set(counts) == {0, 1, 2}
    assert all(850 < c < 1150 for c in counts.values())


def test_refresh_touches_only_timestamps(spark):
    df = spark.sql("select timestamp '2020-01-01' as t, 'x' as s, cast(null as timestamp) as u")
    df = df.select(F.expr("if(s = 'x', t, null)").alias("t"), "s", "u")
    row = refresh_timestamps(df, F.lit("2025-01-01").cast("timestamp")).first()
    assert str(row["t"]).startswith("2025") and str(row["u"]).startswith("2025") and row["s"] == "x"


def test_sequence_and_rate(spark):
    assert impulses_per_second(9000, 4500) == 2
    assert impulses_per_second(10, 4500) == 1
    rows = sequence(spark, 10, 4).orderBy("id").collect()
    assert [r["due_second"] for r in rows] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_ramp_adds_one_publisher_per_interval(spark):
    df = spark.range(100).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")))
    active = [r["active"] for r in ramp(df, "ts", 5, 10, "id").orderBy("id").collect()]
    assert active == [min(5, i // 10 + 1) for i in range(100)]


def test_unbounded_sequence_feeds_the_generator(spark):
    stream = unbounded_sequence(spark, 50, partitions=2)
    made = generate(stream, "value", "simple", SMALL)
    query = made.writeStream.format("memory").queryName("generated_stream").outputMode("append").start()
    try:
        wait_until(lambda: spark.table("generated_stream").count() > 0)
    finally:
        query.stop()
    assert spark.table("generated_stream").count() > 0
