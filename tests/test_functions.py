import math
import struct

import pytest
from pyspark.sql import functions as F

from millrace.functions.draws import Draws, fixed_letters, letters_from, with_lanes
from millrace.functions.encoding import double_bytes, float_bytes, iso_millis, key_text, long_bytes

D = Draws(7)


@pytest.mark.parametrize("value", [0, 1, -1, 2**63 - 1, -(2**63), 123456789])
def test_long_bytes(spark, value):
    got = spark.range(1).select(long_bytes(F.lit(value))).first()[0]
    assert bytes(got) == struct.pack(">q", value)


def test_double_and_float_bytes(spark):
    values = [0.0, -0.0, 1.5, -2.25, 1e300, -1e-300, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("i", double_bytes("v").alias("d"), float_bytes(F.col("v").cast("float")).alias("f")).collect()
    for row in rows:
        v = values[row["i"]]
        if v is None:
            assert row["d"] is None and row["f"] is None
            continue
        single = math.copysign(math.inf if abs(v) > 1e38 else (0.0 if abs(v) < 1e-50 else abs(v)), v) if not math.isnan(v) else v
        bits = 0x7FC00000 if math.isnan(v) else struct.unpack(">i", struct.pack(">f", single))[0]
        wide = 0x7FF8000000000000 if math.isnan(v) else struct.unpack(">q", struct.pack(">d", v))[0]
        assert bytes(row["d"]) == struct.pack(">q", wide)
        # a negative float's bits are sign-extended to eight bytes
        assert bytes(row["f"]) == struct.pack(">q", bits)


def test_iso_millis(spark):
    ts = F.lit("2024-01-01 00:14:59.999").cast("timestamp")
    assert spark.range(1).select(iso_millis(ts)).first()[0] == "2024-01-01T00:14:59.999Z"


def test_key_text_keeps_distinct_keys_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("", "c"), ("a\\", "b"), ("a", "\\|b")]
    df = spark.createDataFrame(rows, "x string, y string")
    texts = [r[0] for r in df.select(key_text(["x", "y"])).collect()]
    assert len(set(texts)) == len(rows)
    assert df.limit(1).select(key_text(["y"])).first()[0] == "c"


def test_draw_bounds_and_independence(spark):
    df = with_lanes(spark.range(20_000), "id", 7)
    made = df.select(
        F.expr(D.below(16, "a")).alias("a"),
        F.expr(D.below(16, "b")).alias("b"),
        F.expr(D.fraction("f")).alias("f"),
        F.expr(D.gaussian("g")).alias("g"),
        F.expr(D.byte("t")).alias("t"),
        F.expr(D.short("s")).alias("s"),
        F.expr(D.integer("i")).alias("i"),
        F.expr(D.long("l")).alias("l"),
    ).toPandas()
    cells = made.groupby(["a", "b"]).size()
    expected = len(made) / 256
    assert len(cells) == 256
    assert ((cells - expected) ** 2 / expected).sum() < 380  # 255 degrees of freedom
    assert made["f"].between(0, 1, inclusive="left").all() and abs(made["f"].mean() - 0.5) < 0.02
    assert abs(made["g"].mean()) < 0.05 and abs(made["g"].std() - 1) < 0.05
    assert made["t"].min() == -128 and made["t"].max() == 127
    assert made["s"].min() >= 0
    assert made["i"].min() < -(2**30) and made["i"].max() > 2**30
    assert made["l"].nunique() == len(made)


def test_neighbouring_rows_are_independent(spark):
    values = with_lanes(spark.range(20_000), "id", 7).select("id", F.expr(D.fraction("f")).alias("f")).toPandas().sort_values("id")["f"]
    assert abs(values.autocorr(1)) < 0.03


def test_draws_do_not_depend_on_partitioning(spark):
    one = with_lanes(spark.range(0, 500, 1, 1), "id", 7).select("id", F.expr(D.long("x")).alias("x"))
    many = with_lanes(spark.range(0, 500, 1, 7), "id", 7).select("id", F.expr(D.long("x")).alias("x"))
    assert sorted(one.collect()) == sorted(many.collect())


def test_draws_of_very_large_ids(spark):
    df = spark.range(3).select((F.lit(2**62) + F.col("id")).alias("id"))
    values = with_lanes(df, "id").select(F.expr(D.long("x")).alias("x")).collect()
    assert len({v[0] for v in values}) == 3


@pytest.mark.parametrize("degree", [0, 1, 10, 80])
def test_skew_stays_in_bounds(spark, degree):
    values = with_lanes(spark.range(5_000), "id", 7).select(F.expr(D.skewed(100, degree, "k")).alias("k")).toPandas()["k"]
    assert values.min() >= 0 and values.max() <= 99


def test_skew_spread_shrinks_with_degree(spark):
    spread = []
    for degree in (1, 10, 80):
        k = with_lanes(spark.range(5_000), "id", 7).select(F.expr(D.skewed(1000, degree, "k")).alias("k")).toPandas()["k"]
        spread.append(k.std())
        assert 450 < k.median() < 550
    assert spread[0] > spread[1] > spread[2]


@pytest.mark.parametrize("length", [1, 20, 43, 44, 86, 87, 500])
def test_letters_have_the_asked_length(spark, length):
    text = spark.range(1).select(F.expr(letters_from("'seed'", length, length))).first()[0]
    assert len(text) == length and text.isascii() and text.isalpha()
    assert text == fixed_letters("seed", length)
