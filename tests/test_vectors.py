"""Wide records by columns: the values of the SQL generator, and no interpreted values."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.sources import vectors
from millrace.sources.generator import GeneratorOptions, generate, generate_records
from tests.conftest import plan_text

PLAIN = [
    T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.TimestampType(), T.StringType(), T.BinaryType()
]
INNER = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("marks", T.ArrayType(T.StringType()))])
EVERY = T.StructType(
    [T.StructField(f"p{n}", kind) for n, kind in enumerate(PLAIN)]
    + [T.StructField(f"a{n}", T.ArrayType(kind)) for n, kind in enumerate(PLAIN)]
    + [T.StructField("one", INNER), T.StructField("many", T.ArrayType(INNER)), T.StructField("deep", T.ArrayType(T.ArrayType(T.LongType())))]
)
OPTIONS = [
    GeneratorOptions(min_chars=1, max_chars=9, max_collection=4, empty_arrays=True),
    GeneratorOptions(min_chars=20, max_chars=80, max_collection=1),
    GeneratorOptions(min_chars=40, max_chars=200, max_collection=3, seed=7),
]


@pytest.mark.parametrize("options", OPTIONS)
def test_columns_hold_the_values_of_the_sql(spark, monkeypatch, options):
    """Also for repeated ids and rows without id."""
    ids = spark.createDataFrame([(n, f"k{n}") for n in [*range(40), 3, None, None, -5, 2**62]], "id long, p0 string")

    def rows():
        made = generate(ids, "id", EVERY, options, ("id", "p0"))
        nested = generate_records(ids, "id", EVERY, options, ("p0",))
        assert made.columns == ["id", "p0", *EVERY.fieldNames()] and nested.columns == ["p0", "record"]
        whole = made.toDF("_id", "_key", *EVERY.fieldNames()).select("_id", "_key", F.to_json(F.struct(*EVERY.fieldNames())).alias("j"))
        return sorted(map(str, whole.collect())), sorted(map(str, nested.select("p0", F.to_json("record").alias("j")).collect()))

    assert not vectors.suits(EVERY, options)
    by_sql = rows()
    monkeypatch.setattr(vectors, "MANY_LEAVES", 1)
    assert vectors.suits(EVERY, options)
    assert rows() == by_sql


def test_wide_records_are_not_interpreted(spark):
    made = plan_text(generate(spark.range(3), "id", "wide"))
    assert "MapInArrow" in made and "lambdafunction" not in made


def test_digests_of_wide_records_are_made_from_columns(spark, monkeypatch, tmp_path):
    """The digests of the SQL expressions, also for repeated ids and rows without id, and none of those expressions."""
    import pyarrow as pa
    from pyarrow import parquet

    from catalog import generation

    parquet.write_table(pa.table({"event_id": pa.array([*range(3000), 3, 3, None, None, -5, 2**62], pa.int64())}), f"{tmp_path}/events.parquet")
    inner = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
    kinds = [T.BooleanType(), T.DoubleType(), T.StringType(), T.LongType(), T.TimestampType(), inner]
    schema = T.StructType([T.StructField(f"{part}{n}", made) for n, kind in enumerate(kinds) for part, made in (("p", kind), ("a", T.ArrayType(kind)))])
    by_sql = generation.digests(spark, str(tmp_path), schema)
    assert "MapInArrow" not in plan_text(by_sql)
    wanted = sorted(map(str, by_sql.collect()))
    monkeypatch.setattr(vectors, "MANY_LEAVES", 1)
    made = generation.wide_digests(spark, str(tmp_path), schema)
    assert made.schema == by_sql.schema and sorted(map(str, made.collect())) == wanted and len(wanted) == 3006
    plan = plan_text(generation.gen_wide_event(spark, str(tmp_path)))
    assert "MapInArrow" in plan and "concat_ws" not in plan


def test_long_records_are_made_in_smaller_batches():
    wide = schemas.wide_event()
    small = GeneratorOptions(max_collection=5, min_chars=10, max_chars=20)
    assert vectors.rows_at_once(wide, small) == 2048 and 256 <= vectors.rows_at_once(wide, GeneratorOptions()) < 512


def test_other_records_stay_sql():
    wide, options = schemas.wide_event(), GeneratorOptions()
    assert vectors.suits(wide, options)
    assert not vectors.suits(wide, GeneratorOptions(complete=False)) and not vectors.suits(wide, GeneratorOptions(skewed_fields=("text0",)))
    for field in (T.StructField("s", T.StringType(), True, {"symbols": ["x"]}), T.StructField("m", T.MapType(T.StringType(), T.LongType())), T.StructField("u", T.ArrayType(T.LongType()), True, {"unique": True})):
        assert not vectors.suits(T.StructType([*wide.fields, field]), options)
