import datetime as dt
import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import avro
from millrace.operators.decode import decode, decode_or_fail
from millrace.operators.transport import encode
from millrace.plans import flows
from millrace.session import fresh_dir, scoped_conf
from millrace.sources import avro_files

NESTED = T.StructType([
    T.StructField("n", T.LongType(), False),
    T.StructField("i", T.IntegerType()),
    T.StructField("s", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("f", T.FloatType()),
    T.StructField("b", T.BooleanType()),
    T.StructField("raw", T.BinaryType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("day", T.DateType()),
    T.StructField("list", T.ArrayType(T.StructType([T.StructField("t", T.ArrayType(T.StringType(), False)), T.StructField("v", T.LongType(), False)]))),
    T.StructField("map", T.MapType(T.StringType(), T.ArrayType(T.LongType()))),
])
NODE = avro.parse(schemas.avro_schema(NESTED))
LONGS = st.integers(-(1 << 63), (1 << 63) - 1)
RECORDS = st.fixed_dictionaries({
    "n": LONGS,
    "i": st.none() | st.integers(-(1 << 31), (1 << 31) - 1),
    "s": st.none() | st.text(st.characters(codec="utf-8"), max_size=200),
    "x": st.none() | st.floats(allow_nan=False),
    "f": st.none() | st.floats(width=32, allow_nan=False),
    "b": st.none() | st.booleans(),
    "raw": st.none() | st.binary(max_size=20),
    "at": st.none() | st.datetimes(dt.datetime(1, 1, 2), dt.datetime(9999, 1, 1), timezones=st.just(dt.timezone.utc)),
    "day": st.none() | st.dates(),
    "list": st.none() | st.lists(st.none() | st.fixed_dictionaries({"t": st.none() | st.lists(st.text(max_size=3), max_size=3), "v": LONGS}), max_size=4),
    "map": st.none() | st.dictionaries(st.text(max_size=3), st.none() | st.lists(st.none() | LONGS, max_size=3), max_size=3).map(lambda d: list(d.items())),
})


# A plain encoder, one value at a time, straight from the format's rules.


def plain_long(value: int) -> bytes:
    folded = (value << 1) ^ (value >> 63)
    out = b""
    while folded > 127:
        out, folded = out + bytes([folded & 127 | 128]), folded >> 7
    return out + bytes([folded])


def plain(node: avro.Node, value) -> bytes:
    if node.null_branch is not None:
        if value is None:
            return plain_long(node.null_branch)
        return plain_long(1 - node.null_branch) + plain(avro.replace(node, null_branch=None), value)
    if node.kind == "record":
        return b"".join(plain(inner, value[name]) for name, inner in zip(node.names, node.inner))
    if node.kind in ("array", "map"):
        parts = [plain(node.inner[0], v) if node.kind == "array" else plain(node.inner[0], v[0]) + plain(node.inner[1], v[1]) for v in value]
        return (plain_long(len(parts)) + b"".join(parts) if parts else b"") + b"\x00"
    if node.kind in ("string", "bytes"):
        data = value.encode() if node.kind == "string" else value
        return plain_long(len(data)) + data
    if node.kind == "boolean":
        return bytes([value])
    if node.kind in ("float", "double"):
        return np.array([value], "<f4" if node.kind == "float" else "<f8").tobytes()
    if node.logical == "timestamp-micros":
        value = (value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    if node.logical == "date":
        value = (value - dt.date(1970, 1, 1)).days
    return plain_long(value)


@settings(max_examples=60, deadline=None)
@given(st.lists(RECORDS, max_size=6))
def test_bytes_are_those_of_the_plain_encoder_and_come_back(rows):
    values = pa.array(rows, avro.arrow_type(NODE))
    data, lengths = avro.encode(NODE, values)
    ends = np.cumsum(lengths)
    payloads = [data[e - n : e].tobytes() for e, n in zip(ends, lengths)]
    assert payloads == [plain(NODE, row) for row in values.to_pylist()]
    back, bad = avro.decode_payloads(NODE, pa.array(payloads, pa.binary()))
    assert not bad.any() and back.to_pylist() == values.to_pylist()
    back, owner, bad = avro.decode_blocks(NODE, [data.tobytes(), b""], [len(rows), 0])
    assert not bad.any() and back.to_pylist() == values.to_pylist() and not owner.any()


@settings(max_examples=60, deadline=None)
@given(RECORDS, st.binary(max_size=40))
def test_what_is_cut_or_too_long_is_bad_and_noise_never_crashes(row, noise):
    payload = plain(NODE, pa.array([row], avro.arrow_type(NODE)).to_pylist()[0])
    _, bad = avro.decode_payloads(NODE, pa.array([payload[:-1], payload + b"\x00", None, b"", payload, noise], pa.binary()))
    assert bad[:5].tolist() == [True, True, True, True, False]


def test_slices_and_sized_blocks_and_texts_that_are_not_utf8():
    values = pa.array([{"n": k, "list": [{"t": ["a"] * k, "v": k}] * k, "map": [("k", [k])]} for k in range(9)], avro.arrow_type(NODE))
    data, _ = avro.encode(NODE, values.slice(3, 4))
    back, _, bad = avro.decode_blocks(NODE, [data.tobytes()], [4])
    assert not bad.any() and back.to_pylist() == values.slice(3, 4).to_pylist()
    node = avro.parse(json.dumps({"type": "record", "name": "r", "fields": [{"name": "v", "type": {"type": "array", "items": "string"}}]}))
    sized = plain_long(-2) + plain_long(4) + b"\x02a\x02b" + plain_long(1) + b"\x02c" + b"\x00"
    wrong = plain_long(1) + b"\x02\xff" + b"\x00"
    endless = plain_long(1 << 40) + b"\x02a"
    back, bad = avro.decode_payloads(node, pa.array([sized, wrong, endless], pa.binary()))
    assert bad.tolist() == [False, True, True] and back[0].as_py() == {"v": ["a", "b", "c"]}


def test_enums_millis_and_null_behind():
    node = avro.parse(json.dumps({"type": "record", "name": "r", "fields": [
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}},
        {"name": "at", "type": [{"type": "long", "logicalType": "timestamp-millis"}, "null"]},
    ]}))
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 5000, tzinfo=dt.timezone.utc)
    values = pa.array([{"e": "B", "at": at}, {"e": "A", "at": None}], avro.arrow_type(node))
    data, lengths = avro.encode(node, values)
    assert data.tobytes() == b"\x02\x00" + plain_long(int(at.timestamp() * 1000)) + b"\x00\x02"
    back, bad = avro.decode_payloads(node, pa.array([data[: lengths[0]].tobytes(), data[lengths[0] :].tobytes(), b"\x04\x02"], pa.binary()))
    assert bad.tolist() == [False, False, True] and back.slice(0, 2).to_pylist() == values.to_pylist()
    with pytest.raises(ValueError, match="symbols"):
        avro.encode(node, pa.array([{"e": "C", "at": None}], avro.arrow_type(node)))


@pytest.mark.parametrize("text", ['["null", "int", "string"]', '{"type": "fixed", "name": "f", "size": 3}', '"nothing"', '{"type": "record", "name": "r", "fields": []}'])
def test_unsupported_schemas_are_refused(text):
    with pytest.raises(ValueError):
        avro.parse(text)


def test_schema_text_reads_back():
    for schema in (NESTED, schemas.mid_event(), schemas.wide_event()):
        assert schemas.from_avro_schema(schemas.avro_schema(schema)).simpleString() == schema.simpleString()
    with pytest.raises(ValueError, match="names"):
        schemas.avro_schema(T.StructType([T.StructField("a b", T.LongType())]))


# -- payloads


@pytest.mark.parametrize("kind", ["mid", "wide"])
def test_generated_records_travel_as_avro(spark, kind):
    made = flows.generate_events(spark.range(40), "id", flows.GenerateOptions(kind, "AVRO")).cache()
    out = decode(made, kind, "AVRO")
    assert out.failed.count() == 0
    names = schemas.resolve(kind).fieldNames()
    texts = {r.t for r in out.ok.select(F.to_json(F.struct(*names)).alias("t")).collect()}
    assert len(texts) == 40
    rebuilt = out.ok.select(F.struct(*names).alias("record"), "event_id").select("event_id", encode(F.col("record"), "AVRO", kind).alias("again"))
    assert made.join(rebuilt, "event_id").filter(~F.col("payload").eqNullSafe(F.col("again"))).count() == 0


def test_broken_payloads_are_dead_letters_or_fail_the_job(spark):
    made = flows.generate_events(spark.range(20), "id", flows.GenerateOptions("compound", "AVRO"))
    cut = made.withColumn("payload", F.when(F.col("event_id") < "8", F.expr("substring(payload, 1, length(payload) - 1)")).when(F.col("event_id") > "c", F.lit(None)).otherwise(F.col("payload")))
    rows = {r.event_id: r.payload for r in cut.collect()}
    out = decode(cut, "compound", "AVRO")
    failed = {r.event_id: (r.error_class, r.payload) for r in out.failed.collect()}
    assert failed == {k: ("MalformedPayload", rows[k]) for k in rows if k < "8" or k > "c"}
    assert {r.event_id for r in out.ok.collect()} == rows.keys() - failed.keys()
    with pytest.raises(Exception, match="MalformedPayload"):
        decode_or_fail(cut, "compound", "AVRO").collect()
    with pytest.raises(ValueError):
        encode(F.col("record"), "AVRO")
    with pytest.raises(ValueError):
        decode(cut, "compound", "XML")


# -- files


def table(spark, n=5000):
    return spark.range(n).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 > 0, F.array_repeat(F.col("id") * 7, (F.col("id") % 5).cast("int"))).alias("numbers"),
        F.timestamp_micros(F.col("id") * 1_000_003).alias("at"),
    )


def rows_of(df):
    return sorted(df.collect(), key=lambda r: r.id)


def files_below(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".avro"))


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_files_read_the_same_wherever_they_are_split(spark, codec):
    df, path = table(spark).coalesce(1), fresh_dir(spark, "avro")
    avro_files.write_avro(df, path, codec=codec)
    (file,) = files_below(path)
    expected = rows_of(df)
    for split in (97, 4_001, 40_000, 1 << 30):
        if split < 1000 and codec == "null":
            continue
        read = avro_files.read_avro(spark, path, df.schema, splitBytes=split)
        assert read.rdd.getNumPartitions() == -(-os.path.getsize(file) // split)
        assert rows_of(read) == expected
    assert rows_of(avro_files.read_avro(spark, path)) == expected
    assert rows_of(avro_files.read_avro(spark, file)) == expected


def test_broken_blocks_fail_the_job_or_become_dead_letters(spark):
    df, path = table(spark).coalesce(1), fresh_dir(spark, "avro")
    avro_files.write_avro(df, path, codec="null")
    (file,) = files_below(path)
    whole = bytearray(open(file, "rb").read())
    sync = bytes(whole[-16:])
    marks = [n for n in range(len(whole)) if whole.startswith(sync, n)]
    assert len(marks) > 6
    whole[marks[2] + 16 : marks[2] + 20] = b"\xff\xff\xff\x7f"  # a size that does not fit
    whole[marks[4] - 40 : marks[4] - 30] = b"\xff" * 10  # records that do not fill their block
    whole = whole[:-20]  # a cut end
    open(file, "wb").write(whole)
    with pytest.raises(Exception, match="block at"):
        avro_files.read_avro(spark, path, df.schema).collect()
    seen = None
    for split in (20_011, 1 << 30):
        out = avro_files.read_avro_or_errors(spark, path, df.schema, splitBytes=split)
        failed = sorted(int(r.attributes["position"]) for r in out.failed.collect())
        assert failed == [marks[2] + 16, marks[3] + 16, marks[-2] + 16]
        kept = rows_of(out.ok)
        assert 0 < len(kept) < 5000 and (seen is None or kept == seen)
        seen = kept
    everything = {r.id: r for r in df.collect()}
    assert all(everything[r.id] == r for r in seen)


def test_deflated_noise_and_files_that_are_none(spark):
    df, path = table(spark).coalesce(1), fresh_dir(spark, "avro")
    avro_files.write_avro(df, path)
    (file,) = files_below(path)
    whole = bytearray(open(file, "rb").read())
    marks = [n for n in range(len(whole)) if whole.startswith(bytes(whole[-16:]), n)]
    whole[marks[1] - 200 : marks[1] - 100] = os.urandom(100)
    open(file, "wb").write(whole)
    with open(os.path.join(path, "other.avro"), "wb") as other:
        other.write(b"not Avro")
    out = avro_files.read_avro_or_errors(spark, path, df.schema)
    assert sorted(int(r.attributes["position"]) for r in out.failed.collect()) == [0, marks[0] + 16]
    with pytest.raises(Exception, match="not an Avro file"):
        avro_files.read_avro(spark, os.path.join(path, "other.avro"), df.schema).collect()


def test_folders_become_columns_and_skip_files(spark):
    df, path = table(spark, 300), fresh_dir(spark, "avro")
    dealt = df.withColumn("part", F.when(F.col("id") % 4 == 0, F.lit("a/b =c")).when(F.col("id") % 4 == 1, F.lit("ü")))
    avro_files.write_avro(dealt, path, folders=("part",))
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.StringType())])
    assert rows_of(avro_files.read_avro(spark, path, schema)) == rows_of(dealt)
    for pushed in ("true", "false"):
        with scoped_conf(spark, {"spark.sql.python.filterPushdown.enabled": pushed}):
            one = avro_files.read_avro(spark, path, schema).filter(F.col("part") == "ü")
            assert one.count() == 75
    reader = avro_files.SkippingAvroReader({"path": path}, schema)
    reader.pushFilters([avro_files.EqualTo(("part",), "ü")])
    assert {p.folders["part"] for task in reader.partitions() for p in task.pieces} == {"ü"}


def test_overwriting_replaces_and_appending_adds(spark):
    df, path = table(spark, 10), fresh_dir(spark, "avro")
    avro_files.write_avro(df, path)
    avro_files.write_avro(df, path)
    assert avro_files.read_avro(spark, path, df.schema).count() == 20
    avro_files.write_avro(df, path, "overwrite")
    assert avro_files.read_avro(spark, path, df.schema).count() == 10
    assert not [n for n in os.listdir(path) if n.startswith("_staging")]
    empty = fresh_dir(spark, "avro")
    avro_files.write_avro(df.limit(0), empty)
    assert avro_files.read_avro(spark, empty, df.schema).count() == 0


def test_a_failed_write_leaves_nothing(spark):
    df, path = table(spark, 100), fresh_dir(spark, "avro")
    failing = df.withColumn("text", F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("text")))
    with pytest.raises(Exception):
        avro_files.write_avro(failing, path)
    assert list(avro_files.data_files(path)) == []
    avro_files.write_avro(df, path)
    assert avro_files.read_avro(spark, path, df.schema).count() == 100


def test_a_file_by_the_rules_of_the_format(spark):
    """Written by hand: several metadata blocks, a sized array block, an unknown codec refused."""
    schema = {"type": "record", "name": "r", "namespace": "n", "fields": [{"name": "v", "type": {"type": "array", "items": "long"}}]}

    def entry(key, value):
        return plain_long(len(key)) + key + plain_long(len(value)) + value

    def file(codec):
        sync = uuid.uuid4().bytes
        text = entry(b"avro.schema", json.dumps(schema).encode())
        head = b"Obj\x01" + plain_long(-1) + plain_long(len(text)) + text + plain_long(1) + entry(b"avro.codec", codec) + b"\x00" + sync
        body = plain_long(-2) + plain_long(2) + b"\x02\x04" + b"\x00" + b"\x00"
        packer = zlib.compressobj(wbits=-15)
        body = packer.compress(body) + packer.flush()
        return head + plain_long(2) + plain_long(len(body)) + body + sync

    folder = fresh_dir(spark, "avro")
    os.makedirs(folder)
    with open(f"{folder}/a.avro", "wb") as out:
        out.write(file(b"deflate"))
    assert [r.v for r in avro_files.read_avro(spark, folder).collect()] == [[1, 2], []]
    with open(f"{folder}/b.avro", "wb") as out:
        out.write(file(b"snappy"))
    with pytest.raises(Exception, match="unsupported codec"):
        avro_files.read_avro(spark, folder).collect()


def test_small_ranges_share_a_task(spark, tmp_path):
    """Ranges cut anywhere, but not a task for each."""
    path = str(tmp_path / "many")
    df = spark.range(3000).selectExpr("id", "concat('n', id) AS name")
    avro_files.write_avro(df.repartition(3), path)
    reader = avro_files.AvroReader({"path": path, "splitBytes": "200", "tasks": "4"}, df.schema)
    tasks = reader.partitions()
    ranges = [p for task in tasks for p in task.pieces]
    assert len(tasks) <= 8 < 20 < len(ranges)
    assert all(p.stop - p.start <= 200 for p in ranges)
    read = [list(reader.read(task)) for task in tasks]
    assert sum(map(len, read)) <= 2 * len(tasks)  # ranges are decoded together, not one by one
    names = [n for batches in read for batch in batches for n in batch.column("name").to_pylist()]
    assert sorted(names) == sorted(f"n{n}" for n in range(3000))
    back = avro_files.read_avro(spark, path, df.schema, splitBytes=200, tasks=4)
    assert back.rdd.getNumPartitions() == len(tasks)
    assert back.count() == 3000 and back.agg({"id": "sum"}).first()[0] == 3000 * 2999 // 2
