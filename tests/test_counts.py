from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.cells import group_cells, keep_versions, latest_cells, to_cells
from millrace.operators.windows import count_windows, typed_results
from millrace.plans.config import (
    Aggregation,
    EarlyFirings,
    TableOptions,
    cell_destination,
    load_aggregations,
    millis,
)
from millrace.schemas import CELL
from tests.conftest import plan_text

CONFIG = """
aggregations:
  - type: COUNT
    window:
      length: 15m
      lateness: 1m
      earlyFirings:
        enabled: true
        count: 100000
        time: 60s
        accumulating: true
    input:
      format: THRIFT
      thriftClassName: some.Event
    fields:
      key:
        - uuid
"""


def test_configuration():
    (one,) = load_aggregations(CONFIG)
    assert one == Aggregation(("uuid",), 900_000, 60_000, EarlyFirings(True, 100_000, 60_000, True), "COUNT", "THRIFT", "some.Event")
    assert one.name == "count_uuid"


@pytest.mark.parametrize(
    "broken",
    [
        CONFIG.replace("lateness", "latenes"),
        CONFIG.replace("type: COUNT", "type: SUM"),
        CONFIG.replace("15m", "15 parsecs"),
        CONFIG.replace("        - uuid", "        []"),
        CONFIG + "extra: 1\n",
    ],
)
def test_broken_configuration_is_refused(broken):
    with pytest.raises(ValueError):
        load_aggregations(broken)


def test_durations_and_destinations():
    assert [millis(t) for t in ("250ms", "60s", "15m", "2h", "1d")] == [250, 60_000, 900_000, 7_200_000, 86_400_000]
    assert cell_destination("a.b.c") == ("a", "b", "c")
    for bad in ("a.b", "a.b.c.d", "a..c"):
        with pytest.raises(ValueError):
            cell_destination(bad)
    for bad in (dict(record_shape="X"), dict(guarantee="maybe"), dict(destinations=0), dict(time_unit="WEEK")):
        with pytest.raises(ValueError):
            TableOptions("p", **bad)
    assert TableOptions("p", flush_seconds=10).trigger == {"processingTime": "10 seconds"}


def skewed_events(spark, n=3000):
    """A third of all events belong to one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    return spark.range(n).select(key.alias("user"), (F.col("id") % 2).alias("side"), F.timestamp_seconds(F.col("id") * 7).alias("event_ts"))


def brute_force(rows, fields, minutes):
    step = timedelta(minutes=minutes)
    counts = Counter()
    for row in rows:
        start = datetime(1970, 1, 1) + ((row["event_ts"] - datetime(1970, 1, 1)) // step) * step
        counts["|".join(str(row[f]) for f in fields), start] += 1
    return counts


@pytest.mark.parametrize("fields,minutes", [(("user",), 15), (("user", "side"), 60)])
def test_counts_match_brute_force(spark, fields, minutes):
    df = skewed_events(spark)
    made = count_windows(df, [Aggregation(fields, minutes * 60_000)]).collect()
    assert {(r["agg_key"], r["window_start"]): r["result_long"] for r in made} == brute_force(df.collect(), fields, minutes)
    assert all(r["is_final"] and r["pane"] == "final" for r in made)


def test_shared_windows_read_the_input_once(spark):
    df = skewed_events(spark)
    both = count_windows(df, [Aggregation(("user",), 900_000), Aggregation(("user", "side"), 900_000)])
    assert plan_text(both).count("Range (") == 1
    expected = brute_force(df.collect(), ("user",), 15) | brute_force(df.collect(), ("user", "side"), 15)
    assert {(r["agg_key"], r["window_start"]): r["result_long"] for r in both.collect()} == expected


def test_different_windows_still_read_the_input_once(spark):
    df = skewed_events(spark)
    wanted = [Aggregation(("user",), 900_000), Aggregation(("side",), 3_600_000), Aggregation(("user", "side"), 900_000)]
    made = count_windows(df, wanted)
    assert plan_text(made).count("Range (") == 1 and plan_text(made).count("Exchange") == 1
    expected = Counter()
    for a in wanted:
        for (key, start), n in brute_force(df.collect(), a.key_fields, a.length_ms // 60_000).items():
            expected[a.name, key, start] = n
    assert {(r["agg_name"], r["agg_key"], r["window_start"]): r["result_long"] for r in made.collect()} == expected


def test_configuration_file(spark, tmp_path):
    from millrace.plans.config import read_aggregations

    (tmp_path / "counts.yaml").write_text(CONFIG)
    assert read_aggregations(spark, str(tmp_path / "counts.yaml")) == load_aggregations(CONFIG)


def test_hot_keys_are_counted_before_the_shuffle(spark):
    plan = plan_text(count_windows(skewed_events(spark), [Aggregation(("user",), 900_000)]))
    assert plan.count("partial_count") >= 1 and plan.count("Exchange") == 1 and "Python" not in plan


def test_counts_to_cells_stay_on_the_jvm(spark):
    cells = to_cells(count_windows(skewed_events(spark), [Aggregation(("user",), 900_000)]))
    assert "Python" not in plan_text(cells)
    row = cells.filter("row_key like 'hot#1970-01-01T00:14%'").first()
    assert row["row_key"] == "hot#1970-01-01T00:14:59.999Z"
    assert row["qualifier"] == "count_user_final:LONG:1970-01-01T00:14:59.999Z"
    assert row["ts_micros"] == 899_999_000 and row["family"] == "aggregation_results"
    assert int.from_bytes(row["value"], "big") == 43


@pytest.mark.parametrize("kind,length", [("DOUBLE", 8), ("FLOAT", 8), ("INT", 8), ("LONG", 8), ("STRING", 2)])
def test_unwindowed_results_of_every_type(spark, kind, length):
    df = spark.createDataFrame([("a", 42)], "k string, v int")
    results = typed_results(df, "n", ["k"], kind, F.col("v"), is_final=False)
    (row,) = to_cells(results, types=(kind,), epoch_millis=F.lit(5)).collect()
    assert row["row_key"] == "a" and row["qualifier"] == f"n:{kind}:NA" and row["ts_micros"] == 5000
    assert len(row["value"]) == length


def test_repeated_writes_collapse_before_grouping(spark):
    one = typed_results(spark.range(1).select(F.lit("a").alias("k")), "n", ["k"], "LONG", F.lit(1))
    cells = to_cells(one, epoch_millis=F.lit(1))
    many = cells.join(spark.range(5000).select(F.lit(1).alias("_")), how="left").select(cells.columns)
    (row,) = group_cells(many).collect()
    assert len(row["cells"]) == 1


def versions(spark):
    """One cell takes a third of all versions."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string"))
    return spark.range(0, 3000, 1, 4).select(
        key.alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.col("id").alias("ts_micros"), F.col("id").cast("string").cast("binary").alias("value"),
    )


def test_versions_are_capped_map_side(spark):
    kept = keep_versions(versions(spark), 5)
    assert kept.columns == CELL.fieldNames()
    rows = [r["ts_micros"] for r in kept.filter("row_key = 'hot'").collect()]
    assert sorted(rows) == [2985, 2988, 2991, 2994, 2997]
    plan = plan_text(kept)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_last_write_wins(spark):
    rows = [("r", "f", "q", 1, bytearray(b"old"), 1), ("r", "f", "q", 1, bytearray(b"new"), 2), ("r", "f", "q", 2, bytearray(b"x"), 0)]
    df = spark.createDataFrame(rows, "row_key string, family string, qualifier string, ts_micros bigint, value binary, n int")
    found = {r["ts_micros"]: bytes(r["value"]) for r in latest_cells(df, ["n"]).collect()}
    assert found == {1: b"new", 2: b"x"}
