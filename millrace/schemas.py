"""Record types, and readers for the JSON-schema and Avro-schema subsets.

Facts a ``StructType`` cannot hold live in field metadata:
``symbols`` (enum domain), ``unique`` (set semantics), ``now`` (generation-time text).
Schemas are always explicit; nothing is inferred from data.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import types as T

TRANSPORT = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)

ERROR = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("error_class", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)

CELL = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("ts_micros", T.LongType()),
        T.StructField("value", T.BinaryType()),
    ]
)


def _f(name: str, kind: T.DataType, required: bool = False, **meta) -> T.StructField:
    return T.StructField(name, kind, not required, meta)


STR, I64 = T.StringType(), T.LongType()
SOURCES = [f"SOURCE_{i}" for i in range(1, 31)]

SIMPLE_EVENT = T.StructType(
    [_f("location", STR, True), _f("startup", I64, True), _f("description", STR, True)]
)
CARRIER = T.StructType([_f("id", STR, True), _f("value", I64, True)])

_COMMON = [
    _f("uuid", STR, True),
    _f("name", STR),
    _f("externalId", I64),
    _f("clientEpoch", I64),
    _f("createdTimestamp", STR),
    _f("data", STR),
]
COMPOUND_EVENT = T.StructType(
    _COMMON
    + [
        _f("source", STR, symbols=SOURCES),
        _f("destination", STR),
        _f("events", T.ArrayType(SIMPLE_EVENT), unique=True),
        _f("carriers", T.ArrayType(CARRIER)),
    ]
)
FLAT_COMPOUND_EVENT = T.StructType(
    _COMMON
    + [_f("source", STR), _f("destination", STR)]
    + [_f(f"events{n}", SIMPLE_EVENT) for n in ("", "2", "3", "4", "5")]
)
MAP_COMPOUND_EVENT = T.StructType([_f("eventMap", T.MapType(STR, COMPOUND_EVENT), True)])
LIST_MAP_COMPOUND_EVENT = T.StructType(
    [_f("listOfEventMaps", T.ArrayType(T.MapType(STR, COMPOUND_EVENT)), True)]
)
LOG_EVENT = T.StructType(
    [
        _f("category", STR),
        _f("clientId", I64),
        _f("createTimestamp", STR),
        _f("data", STR),
        _f("destination", STR),
        _f("epochId", I64),
        _f("event", T.StructType([_f("eventName", STR), _f("hostBootTime", I64), _f("hostName", STR)])),
        _f("source", STR),
        _f("uuid", STR),
    ]
)
MESSAGE = T.StructType(
    [
        _f("user", T.StructType([_f("location", STR), _f("startup", I64), _f("description", STR), _f("uuid", STR)])),
        _f("topic", T.StructType([_f("id", STR), _f("value", I64), _f("name", STR)])),
        _f("message", STR),
        _f("ts", STR, True, now=True),
    ]
)


def mid_event() -> T.StructType:
    """50 top-level fields, 88 in all, 7 nested records, 2 string arrays, 3 timestamps."""

    def record(prefix: str, strings: int, longs: int, inner: T.StructField | None = None):
        fields = [_f(f"{prefix}_s{i}", STR) for i in range(strings)]
        fields += [_f(f"{prefix}_n{i}", I64) for i in range(longs)]
        return T.StructType(fields + ([inner] if inner else []))

    deepest = _f("deep", record("deep", 0, 2))
    nested = [_f("tree", record("tree", 0, 1, _f("branch", record("branch", 0, 1, deepest))))]
    nested += [_f(f"part{i}", record(f"part{i}", 8, 0)) for i in range(4)]
    fields = [_f(f"text{i}", STR) for i in range(29)] + [_f(f"count{i}", I64) for i in range(11)]
    fields += nested
    fields += [_f(f"tags{i}", T.ArrayType(STR)) for i in range(2)]
    fields += [_f(f"at{i}", T.TimestampType()) for i in range(3)]
    return T.StructType(fields)


def wide_event() -> T.StructType:
    """797 top-level fields, 1,063 in all: 133 arrays of two-field records among them."""
    fields = [_f(f"flag{i}", T.BooleanType()) for i in range(105)]
    fields += [_f(f"ratio{i}", T.DoubleType()) for i in range(205)]
    fields += [_f(f"text{i}", STR) for i in range(130)]
    fields += [_f(f"count{i}", I64) for i in range(109)]
    fields += [_f(f"texts{i}", T.ArrayType(STR)) for i in range(76)]
    fields += [_f(f"ratios{i}", T.ArrayType(T.DoubleType())) for i in range(16)]
    fields += [_f(f"counts{i}", T.ArrayType(I64)) for i in range(3)]
    fields += [_f(f"at{i}", T.TimestampType()) for i in range(20)]
    pair = T.StructType([_f("label", STR), _f("score", T.DoubleType())])
    fields += [_f(f"pairs{i}", T.ArrayType(pair)) for i in range(133)]
    return T.StructType(fields)


REGISTRY = {
    "simple": SIMPLE_EVENT,
    "carrier": CARRIER,
    "compound": COMPOUND_EVENT,
    "flat_compound": FLAT_COMPOUND_EVENT,
    "map_compound": MAP_COMPOUND_EVENT,
    "list_map_compound": LIST_MAP_COMPOUND_EVENT,
    "log": LOG_EVENT,
    "message": MESSAGE,
}


def resolve(name_or_schema: str | T.StructType) -> T.StructType:
    """A registered name, or the schema itself."""
    if isinstance(name_or_schema, T.StructType):
        return name_or_schema
    if name_or_schema in REGISTRY:
        return REGISTRY[name_or_schema]
    if name_or_schema == "mid":
        return mid_event()
    if name_or_schema == "wide":
        return wide_event()
    raise ValueError(f"unknown event type: {name_or_schema}")


def optional(kind: T.DataType) -> T.DataType:
    """The bare type with null allowed at every level and no notes on fields, as readers of files give it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, optional(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(optional(kind.elementType))
    return T.MapType(kind.keyType, optional(kind.valueType)) if isinstance(kind, T.MapType) else kind


def from_json_schema(text: str) -> T.StructType:
    """Read the supported subset of JSON schema into a ``StructType``."""
    document = json.loads(text)

    def follow(node: dict) -> dict:
        while "$ref" in node:
            target = document
            for step in node["$ref"].lstrip("#/").split("/"):
                target = target[step]
            node = target
        return node

    def kind(node: dict) -> tuple[T.DataType, bool, dict]:
        node = follow(node)
        branches = node.get("oneOf") or node.get("anyOf")
        if branches:
            real = [b for b in branches if follow(b).get("type") != "null"]
            if len(branches) > 2:
                raise ValueError("a union may hold null and one other type")
            if len(real) == len(branches):
                raise ValueError("a union needs a null branch")
            if not real:
                raise ValueError("a union needs a branch other than null")
            inner, _, meta = kind(real[0])
            return inner, True, meta
        if "enum" in node:
            return T.StringType(), False, {"symbols": [str(v) for v in node["enum"]]}
        name = node.get("type")
        if name == "object":
            fields = []
            for field, spec in node.get("properties", {}).items():
                inner, nullable, meta = kind(spec)
                optional = nullable or field not in node.get("required", [])
                fields.append(T.StructField(field, inner, optional, meta))
            return T.StructType(fields), False, {}
        if name == "array":
            items = node.get("items")
            if isinstance(items, list):
                if len(items) != 1:
                    raise ValueError("an array needs exactly one item schema")
                items = items[0]
            if not items:
                raise ValueError("an array needs exactly one item schema")
            inner, nullable, meta = kind(items)
            return T.ArrayType(inner, nullable), False, meta
        if name == "integer":
            low, high = node.get("minimum", 0), node.get("maximum", 0)
            wide = low < -(1 << 31) or high > (1 << 31) - 1
            return (T.LongType() if wide else T.IntegerType()), False, {}
        if name == "number":
            return T.DoubleType(), False, {}
        if name == "boolean":
            return T.BooleanType(), False, {}
        if name == "string":
            return T.StringType(), False, {"now": True} if node.get("default") == "current-timestamp" else {}
        raise ValueError(f"unsupported JSON schema: {node}")

    root, _, _ = kind(document)
    if not isinstance(root, T.StructType):
        raise ValueError("the root must be an object")
    return root


def from_avro_schema(text: str) -> T.StructType:
    """Read the supported subset of an Avro record schema into a ``StructType``."""
    plain = {
        "boolean": T.BooleanType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "float": T.FloatType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "bytes": T.BinaryType(),
    }
    named: dict[str, T.DataType] = {}

    def kind(node) -> tuple[T.DataType, bool, dict]:
        if isinstance(node, str):
            if node in plain:
                return plain[node], False, {}
            return named[node], False, {}
        if isinstance(node, list):
            real = [b for b in node if b != "null"]
            if len(node) > 2 or len(real) != 1:
                raise ValueError("a union may hold null and one other type")
            inner, _, meta = kind(real[0])
            return inner, "null" in node, meta
        if str(node.get("logicalType", "")).startswith("timestamp-"):
            return T.TimestampType(), False, {}
        if node.get("logicalType") == "date":
            return T.DateType(), False, {}
        name = node["type"]
        if name == "record":
            fields = []
            for field in node["fields"]:
                inner, nullable, meta = kind(field["type"])
                fields.append(T.StructField(field["name"], inner, nullable, meta))
            named[node["name"]] = T.StructType(fields)
            return named[node["name"]], False, {}
        if name == "array":
            inner, nullable, meta = kind(node["items"])
            return T.ArrayType(inner, nullable), False, meta
        if name == "map":
            inner, nullable, _ = kind(node["values"])
            return T.MapType(T.StringType(), inner, nullable), False, {}
        if name == "enum":
            return T.StringType(), False, {"symbols": list(node["symbols"])}
        return kind(name)

    root, _, _ = kind(json.loads(text))
    if not isinstance(root, T.StructType):
        raise ValueError("the root must be a record")
    return root


AVRO_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def avro_schema(schema: str | T.StructType, name: str = "record") -> str:
    """Avro schema text of a record type: optional fields are unions with null, the null first."""
    plain = {
        T.BooleanType(): "boolean",
        T.IntegerType(): "int",
        T.LongType(): "long",
        T.FloatType(): "float",
        T.DoubleType(): "double",
        T.StringType(): "string",
        T.BinaryType(): "bytes",
        T.TimestampType(): {"type": "long", "logicalType": "timestamp-micros"},
        T.DateType(): {"type": "int", "logicalType": "date"},
    }

    def node(kind: T.DataType, nullable: bool, path: str):
        if isinstance(kind, T.StructType):
            wrong = [f.name for f in kind.fields if not AVRO_NAME.fullmatch(f.name)]
            if wrong:
                raise ValueError(f"not Avro names: {wrong}")
            fields = [{"name": f.name, "type": node(f.dataType, f.nullable, f"{path}_{f.name}")} for f in kind.fields]
            spec = {"type": "record", "name": path, "fields": fields}
        elif isinstance(kind, T.ArrayType):
            spec = {"type": "array", "items": node(kind.elementType, kind.containsNull, f"{path}_item")}
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            spec = {"type": "map", "values": node(kind.valueType, kind.valueContainsNull, f"{path}_value")}
        elif kind in plain:
            spec = plain[kind]
        else:
            raise ValueError(f"no Avro type for {kind.simpleString()}")
        return ["null", spec] if nullable else spec

    return json.dumps(node(resolve(schema), False, name))
