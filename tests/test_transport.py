import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.decode import decode, decode_or_fail
from millrace.operators.envelope import COMPRESSION_KEY, COMPRESSION_NAME, maybe_decompress, pack
from millrace.operators.outcome import union_errors
from millrace.operators.stats import approximate_percentiles, observe_payloads, payload_percentiles
from millrace.operators.transforms import apply_events, apply_frame, load_transform
from millrace.operators.transport import (
    compress_schema,
    encode,
    expand_schema,
    schema_attributes,
    schema_text,
    wrap,
)
from millrace.schemas import ERROR, TRANSPORT
from millrace.session import fresh_dir
from millrace.streaming.running import append_to_files
from tests.conftest import plan_text

K = T.StructType([T.StructField("k", T.LongType())])


def transports(spark, n, size=10, partitions=3):
    return spark.range(0, n, 1, partitions).select(
        F.col("id").cast("string").alias("event_id"),
        F.create_map(F.lit("n"), F.col("id").cast("string")).alias("attributes"),
        F.repeat(F.lit("x"), size).cast("binary").alias("payload"),
        F.timestamp_seconds(F.col("id")).alias("event_ts"),
    )


def as_set(df):
    return sorted(
        (r["event_id"], tuple(sorted((r["attributes"] or {}).items())), bytes(r["payload"] or b""), r["event_ts"])
        for r in df.collect()
    )


@pytest.mark.parametrize("level", [0, 1, 9])
def test_envelopes_give_back_every_row(spark, level):
    df = transports(spark, 1000)
    packed = pack(df, max_records=70, level=level)
    sizes = [int(r["attributes"]["records"]) for r in packed.collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 70
    opened = maybe_decompress(packed)
    assert as_set(opened.ok) == as_set(df)
    assert opened.failed.count() == 0


def test_envelopes_close_at_the_byte_limit(spark):
    packed = pack(transports(spark, 100, size=1000, partitions=1), max_records=70, max_raw_bytes=10_500)
    assert sorted(int(r["attributes"]["records"]) for r in packed.collect()) == [10] * 10


def test_payload_above_the_byte_limit_travels_alone(spark):
    df = transports(spark, 5, size=1000, partitions=1)
    packed = pack(df, max_records=70, max_raw_bytes=100)
    assert [int(r["attributes"]["records"]) for r in packed.collect()] == [1] * 5
    assert as_set(maybe_decompress(packed).ok) == as_set(df)


def test_packing_needs_no_shuffle_and_ids_repeat(spark):
    packed = pack(transports(spark, 1000), max_records=50)
    assert "Exchange" not in plan_text(packed)
    first = sorted(r["event_id"] for r in packed.collect())
    assert first == sorted(r["event_id"] for r in packed.collect()) and len(set(first)) == len(first)


def test_null_payloads_and_times_survive(spark):
    df = spark.createDataFrame([("a", None, None, None), ("b", {}, bytearray(b""), None)], TRANSPORT)
    assert as_set(maybe_decompress(pack(df)).ok) == as_set(df)


def test_bad_envelopes_become_dead_letters(spark):
    mark = {COMPRESSION_KEY: COMPRESSION_NAME}
    rows = [
        ("plain", {}, bytearray(b"p"), None),
        ("text", mark, bytearray(b"not compressed"), None),
        ("other", mark, bytearray(zlib.compress(b"not an envelope")), None),
        ("empty", mark, None, None),
    ]
    good = pack(transports(spark, 10))
    opened = maybe_decompress(spark.createDataFrame(rows, TRANSPORT).unionByName(good))
    assert {r["event_id"] for r in opened.failed.collect()} == {"text", "other", "empty"}
    assert opened.failed.columns == ERROR.fieldNames()
    assert {r["event_id"] for r in opened.ok.collect()} == {"plain"} | {str(i) for i in range(10)}


def test_envelopes_in_a_stream(spark):
    path = fresh_dir(spark, "test-envelopes")
    pack(transports(spark, 300), max_records=40).write.parquet(path)
    stream = spark.readStream.schema(TRANSPORT).parquet(path)
    out = append_to_files(maybe_decompress(stream).ok, spark, "test-unpacked")
    assert as_set(spark.read.schema(TRANSPORT).parquet(out)) == as_set(transports(spark, 300))
    again = append_to_files(pack(spark.readStream.schema(TRANSPORT).parquet(path), 7), spark, "test-packed")
    assert as_set(maybe_decompress(maybe_decompress(spark.read.schema(TRANSPORT).parquet(again)).ok).ok) == as_set(
        transports(spark, 300)
    )


def test_schema_text_round_trip(spark):
    for text in ("", "a" * 499, "b" * 500, "c" * 501, "xyz" * 4000, "é€" * 700):
        attributes = spark.range(1).select(schema_attributes(F.lit(text)).alias("a"))
        row = attributes.select("a", schema_text(F.col("a")).alias("t")).first()
        assert row["t"] == text
        assert len(row["a"]) == -(-len(text) // 500)
        assert all(len(v) <= 500 for v in row["a"].values())
    assert expand_schema(compress_schema("schema" * 50)) == "schema" * 50


def test_wrap_ids(spark):
    df = spark.range(100)
    fixed = wrap(df, F.col("id").cast("string"), ("id",))
    assert fixed.schema.fieldNames() == TRANSPORT.fieldNames()
    assert sorted(r[0] for r in fixed.select("event_id").collect()) == sorted(r[0] for r in fixed.select("event_id").collect())
    random = wrap(df, F.col("id").cast("string"))
    assert random.select("event_id").distinct().count() == 100


def test_unknown_encoding():
    with pytest.raises(ValueError):
        encode(None, "XML")


def payloads(spark, *texts):
    rows = [(str(i), {}, None if t is None else bytearray(t.encode()), None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, TRANSPORT)


def test_decode_splits_good_and_bad(spark):
    df = payloads(spark, '{"k": 1}', "{", "prose", None, "", '{"k": "x"}', '{"other": 2}', '{"k": null}')
    both = decode(df, K)
    assert {r["event_id"]: r["k"] for r in both.ok.collect()} == {"0": 1, "6": None, "7": None}
    assert {r["event_id"] for r in both.failed.collect()} == {"1", "2", "3", "4", "5"}


def test_payload_is_parsed_once(spark):
    plan = decode(payloads(spark, '{"k": 1}').repartition(2), K).ok._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_decode_or_fail(spark):
    assert decode_or_fail(payloads(spark, '{"k": 5}'), K).first()["k"] == 5
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        decode_or_fail(payloads(spark, "{"), K).collect()


def test_transform_lookup():
    assert load_transform(None) is None and load_transform("  ") is None
    assert callable(load_transform("catalog.transforms:reject_large"))
    with pytest.raises(ValueError):
        load_transform("catalog.transforms")
    with pytest.raises(ModuleNotFoundError):
        load_transform("no.such.module:f")
    with pytest.raises(TypeError):
        load_transform("millrace.schemas:STR")


def test_no_transform_is_identity(spark):
    df = transports(spark, 5)
    assert apply_frame(df, None) is df
    both = apply_events(df, None)
    assert both.ok is df and both.failed.count() == 0 and both.failed.columns == ERROR.fieldNames()


def test_failing_transform_keeps_the_event(spark):
    def picky(event):
        if event["attributes"]["n"] == "3":
            raise KeyError("three")
        return event | {"payload": b"done"}

    both = apply_events(transports(spark, 6), picky)
    failed = both.failed.collect()
    assert [(r["event_id"], r["error_class"], bytes(r["payload"])) for r in failed] == [("3", "KeyError", b"x" * 10)]
    assert {bytes(r["payload"]) for r in both.ok.collect()} == {b"done"}
    union = union_errors([both.failed, both.failed])
    assert union.count() == 2 and union.columns == ERROR.fieldNames()


def test_transform_results_that_do_not_fit_are_dead_letters(spark):
    answers = [{"payload": "text"}, {"payload": 5}, None, {"event_id": 1}, {"event_ts": "now"}, {"attributes": {"a": 1}}]

    both = apply_events(transports(spark, 6, partitions=1), lambda event: answers[int(event["attributes"]["n"])])
    assert {r["event_id"]: r["error_class"] for r in both.failed.collect()} == dict.fromkeys("1234", "TypeError")
    ok = {r["event_id"]: r for r in both.ok.collect()}
    assert bytes(ok["0"]["payload"]) == b"text" and ok["0"]["event_ts"] is not None
    assert ok["5"]["attributes"] == {"a": "1"} and bytes(ok["5"]["payload"]) == b"x" * 10


def test_percentiles_match_numpy(spark):
    import numpy as np

    df = spark.range(1, 1001).select(F.repeat(F.lit("x"), F.col("id").cast("int")).cast("binary").alias("payload"), "id")
    row = payload_percentiles(df).first()
    assert [row["p50"], row["p90"], row["p95"]] == list(np.percentile(np.arange(1, 1001), [50, 90, 95]))
    near = approximate_percentiles(df, "id").first()
    assert abs(near["p90"] - 900) <= 2


def test_sizes_observed_while_writing(spark):
    df, seen = observe_payloads(transports(spark, 50, size=7), "sizes")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 50 and seen.get["total"] == 350 and seen.get["largest"] == 7


def test_inflating_is_bounded():
    import zlib

    from millrace.operators.envelope import inflated

    assert inflated(zlib.compress(b"x" * 1000), 1000) == b"x" * 1000
    for bad in (zlib.compress(b"x" * 1001), zlib.compress(b"x" * 500)[:-5], b"junk"):
        with pytest.raises((ValueError, zlib.error)):
            inflated(bad, 1000)


def test_no_tail_passes_for_one_document(spark):
    """What follows a document is never ignored, whatever it closes or reopens; the fail-fast form raises."""
    from millrace.operators import decode as d

    kind = T.StructType([T.StructField("k", T.LongType())])
    good = ['{"k": 1}', ' {"k": 1} \n', '{"k": 1, "x": [{"y": "]}"}]}', "{}"]
    bad = [
        '{"k":1}] junk', '{"k":1}],[{"k":2}', '{"k":1}} x', '{"k":1}]}', '{"k":1},{"k":2}', '{"k":1} {"k":2}', '{"k":1},', ',{"k":1}', '{"k":1}],"x":[{"k":2}',
        f'{{"k":1}}],"_corrupt":[', "[]", "[{\"k\":1}]", "1", '"{}"', "null", "", "  ", "]", "}", '{"k":"text"}', '{"k":1}/*', '{"k":1}],"_":[{"k":1}', "\x00", '{"k":1}\x00',
    ]
    rows = [(str(i), {}, bytearray(text.encode()), None) for i, text in enumerate(good + bad)]
    outcome = d.decode(spark.createDataFrame(rows, TRANSPORT), kind)
    assert sorted(int(r["event_id"]) for r in outcome.ok.collect()) == list(range(len(good)))
    why = {int(r["event_id"]) - len(good): r["error_message"] for r in outcome.failed.collect()}
    assert len(why) == len(bad)
    assert {bad[i] for i, text in why.items() if "more than one" in text} >= set(bad[:6]) and "schema" in why[bad.index('{"k":"text"}')]
    for i in range(len(good), len(rows)):
        with pytest.raises(Exception, match="MalformedPayload"):
            d.decode_or_fail(spark.createDataFrame([rows[i]], TRANSPORT), kind).collect()


class Steps:
    """Stands for a frame and gives the function that its tasks would run."""

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        self.run, self.schema = run, schema
        return self


def arrow_transports(payloads, attributes):
    from pyspark.sql.pandas.types import to_arrow_schema

    ids = [f"e{n}" for n in range(len(payloads))]
    columns = [ids, attributes, payloads, [None] * len(ids)]
    schema = to_arrow_schema(TRANSPORT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def test_failed_envelopes_leave_in_small_batches():
    from millrace.operators import envelope

    marked = [(envelope.COMPRESSION_KEY, envelope.COMPRESSION_NAME)]
    payloads = [bytes([n]) * (1 << 20) for n in range(40)] + [b"plain", None]
    batch = arrow_transports(payloads, [marked] * 40 + [None, marked])
    made = list(envelope.unpack_all(Steps()).run(iter([batch])))
    assert max(b.nbytes for b in made) < 12 << 20
    rows = {r["event_id"]: r for b in made for r in b.to_pylist()}
    assert sum(b.num_rows for b in made) == len(rows) == 42
    assert all(rows[f"e{n}"]["payload"] == p for n, p in enumerate(payloads))
    assert rows["e40"]["error_class"] is None and rows["e41"]["error_class"] == "TypeError"
    assert {rows[f"e{n}"]["error_class"] for n in range(40)} == {"error"}


def test_failed_rows_pass_user_functions_as_they_are():
    from millrace.operators import transforms

    batch = arrow_transports([b"x", b"y", b"z"], [None, None, [("a", "b")]])
    for name, values in (("error_class", ["error", None, None]), ("error_message", ["bad", None, None]), ("stage", ["decompress", None, None])):
        batch = batch.append_column(name, pa.array(values, pa.string()))
    steps = Steps()
    steps.schema = T.StructType([*TRANSPORT.fields, *[T.StructField(n, T.StringType()) for n in ("error_class", "error_message", "stage")]])
    seen = []

    def transform(event):
        seen.append(event["event_id"])
        if event["event_id"] == "e2":
            raise ValueError("no")
        return event | {"payload": b"done"}

    run = transforms.map_events(steps, transform, ("error_class", "error_message", "stage")).run
    rows = {r["event_id"]: r for b in run(iter([batch])) for r in b.to_pylist()}
    assert seen == ["e1", "e2"] and len(rows) == 3
    assert rows["e0"] == batch.to_pylist()[0]
    assert rows["e1"]["payload"] == b"done" and rows["e1"]["error_class"] is None
    assert (rows["e2"]["stage"], rows["e2"]["error_class"], rows["e2"]["payload"]) == ("transform", "ValueError", b"z")
