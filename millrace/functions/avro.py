"""Avro binary over Arrow arrays, whole columns at a time.

Encoding turns a column into its bytes and the length of every row; columns of a record are put together by scattering
their bytes to where the rows need them. Decoding walks many places of one buffer side by side (lanes): one lane a payload, a block of a
file, or an item of an array. Every step reads one field of all lanes at once, so the work in Python
grows with the fields and the longest array, not with the rows.

A lane that reads past its end, or meets a length, branch or symbol that cannot be, is marked bad and stays at its end.
Unions may hold null and one other type; fixed, decimals and recursive types are refused.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PLAIN = {
    "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(),
    "string": pa.string(), "bytes": pa.binary(),
}
TIME = pa.timestamp("us", tz="UTC")
MOST_BYTES = (1 << 31) - 1  # of one Arrow text column

Encoded = tuple[np.ndarray, np.ndarray]  # bytes, and the length of every row


@dataclass(frozen=True)
class Node:
    """A type: ``null_branch`` is the place of null in its union, None where a value is required."""

    kind: str
    null_branch: int | None = None
    names: tuple[str, ...] = ()  # of fields or symbols
    inner: tuple[Node, ...] = ()
    logical: str = ""


def parse(text: str) -> Node:
    """The type that a schema text describes."""
    named: dict[str, Node] = {}

    def read(spec, null_branch: int | None = None) -> Node:
        if isinstance(spec, list):
            if len(spec) != 2 or spec.count("null") != 1:
                raise ValueError("a union must hold null and one other type")
            place = spec.index("null")
            return read(spec[1 - place], place)
        if isinstance(spec, str):
            if spec not in PLAIN and spec not in named:
                raise ValueError(f"unsupported Avro type: {spec}")
            return Node(spec, null_branch) if spec in PLAIN else replace(named[spec], null_branch=null_branch)
        kind = spec["type"]
        if isinstance(kind, list | dict):
            return read(kind, null_branch)
        if kind == "record":
            if not spec["fields"]:
                raise ValueError("a record needs fields")
            node = Node("record", null_branch, tuple(f["name"] for f in spec["fields"]), tuple(read(f["type"]) for f in spec["fields"]))
        elif kind == "array":
            return Node("array", null_branch, inner=(read(spec["items"]),))
        elif kind == "map":
            return Node("map", null_branch, inner=(Node("string"), read(spec["values"])))
        elif kind == "enum":
            node = Node("enum", null_branch, tuple(spec["symbols"]))
        elif kind in PLAIN and spec.get("logicalType") != "decimal":
            return Node(kind, null_branch, logical=spec.get("logicalType", ""))
        else:
            raise ValueError(f"unsupported Avro type: {spec}")
        named[spec["name"]] = named[f"{spec.get('namespace', '')}.{spec['name']}"] = node
        return node

    return read(json.loads(text))


def arrow_type(node: Node) -> pa.DataType:
    """Every level may hold null, as in all frames that Spark reads from files."""
    if node.kind == "record":
        return pa.struct(fields(node))
    if node.kind == "array":
        return pa.list_(pa.field("element", arrow_type(node.inner[0])))
    if node.kind == "map":
        return pa.map_(pa.string(), arrow_type(node.inner[1]))
    if node.kind == "long" and node.logical in ("timestamp-micros", "timestamp-millis"):
        return TIME
    if node.kind == "int" and node.logical == "date":
        return pa.date32()
    return pa.string() if node.kind == "enum" else PLAIN[node.kind]


def fields(node: Node) -> list[pa.Field]:
    return [pa.field(name, arrow_type(inner)) for name, inner in zip(node.names, node.inner)]


# -- encoding


def varints(values: np.ndarray) -> Encoded:
    """Zigzag numbers, seven bits a byte."""
    folded = ((values << 1) ^ (values >> 63)).view(np.uint64)
    lengths = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        lengths += folded >= np.uint64(1 << bits)
    starts = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    for k in range(int(lengths.max(initial=0))):
        rows = np.flatnonzero(lengths > k)
        low = (folded[rows] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[rows] + k] = low.astype(np.uint8) | ((lengths[rows] > k + 1).astype(np.uint8) << 7)
    return out, lengths


def side_by_side(parts: list[Encoded]) -> Encoded:
    """Rows made of one piece from every part."""
    lengths = np.sum([own for _, own in parts], axis=0, dtype=np.int64)
    out = np.empty(int(lengths.sum()), np.uint8)
    at = np.cumsum(lengths) - lengths
    for data, own in parts:
        if len(data):
            out[np.repeat(at - (np.cumsum(own) - own), own) + np.arange(len(data))] = data
        at = at + own
    return out, lengths


def spread(lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Lengths of the chosen rows; the others have none."""
    out = np.zeros(len(rows), np.int64)
    out[rows] = lengths
    return out


def encode(node: Node, values: pa.Array) -> Encoded:
    """Every row's Avro bytes. A null where a value is required is an error."""
    n = len(values)
    if node.null_branch is not None:
        there = pc.is_valid(values).to_numpy(zero_copy_only=False)
        data, own = encode(replace(node, null_branch=None), values.drop_null())
        branch = np.where(there, 2 * (1 - node.null_branch), 2 * node.null_branch).astype(np.uint8)
        return side_by_side([(branch, np.ones(n, np.int64)), (data, spread(own, there))])
    if values.null_count:
        raise ValueError("null in a required field")
    if node.kind == "record":
        columns = dict(zip((f.name for f in values.type), values.flatten()))
        return side_by_side([encode(inner, columns[name]) for name, inner in zip(node.names, node.inner)])
    if node.kind in ("array", "map"):
        return collections(node, values)
    if node.kind in ("string", "bytes"):
        stored = values.cast(pa.large_binary())
        offsets = np.frombuffer(stored.buffers()[1], np.int64)[stored.offset : stored.offset + n + 1] if n else np.zeros(1, np.int64)
        body = np.frombuffer(stored.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        return side_by_side([varints(np.diff(offsets)), (body, np.diff(offsets))])
    if node.kind in ("float", "double"):
        width = 4 if node.kind == "float" else 8
        numbers = values.cast(PLAIN[node.kind]).to_numpy(zero_copy_only=False).astype(f"<f{width}")
        return numbers.view(np.uint8), np.full(n, width, np.int64)
    if node.kind == "boolean":
        return values.cast(pa.uint8()).to_numpy(zero_copy_only=False), np.ones(n, np.int64)
    if node.kind == "enum":
        values = pc.index_in(values, pa.array(node.names))
        if values.null_count:
            raise ValueError("a value is none of its symbols")
    elif node.logical.startswith("timestamp-"):
        values = values.cast(pa.timestamp("us", tz=getattr(values.type, "tz", None))).cast(pa.int64())
    elif node.logical == "date":
        values = values.cast(pa.int32())
    numbers = values.cast(pa.int64()).to_numpy(zero_copy_only=False).copy()
    return varints(numbers // 1000 if node.logical == "timestamp-millis" else numbers)


def collections(node: Node, values: pa.Array) -> Encoded:
    """A number of items, the items, and an end mark; empty ones are the end mark alone."""
    n = len(values)
    offsets = values.offsets.to_numpy().astype(np.int64) if n else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    parts = [values.keys, values.items] if node.kind == "map" else [values.values]
    data, own = side_by_side([encode(inner, part.slice(low, high - low)) for inner, part in zip(node.inner, parts)])
    ends = np.concatenate([[0], np.cumsum(own)])
    counts = np.diff(offsets)
    head, head_own = varints(counts[counts > 0])
    items = ends[offsets[1:] - low] - ends[offsets[:-1] - low]
    return side_by_side([(head, spread(head_own, counts > 0)), (data, items), (np.zeros(n, np.uint8), np.ones(n, np.int64))])


# -- decoding


class Lanes:
    """Places in a buffer, each with its end; all are read in one step."""

    def __init__(self, data: np.ndarray, at: np.ndarray, end: np.ndarray, bad: np.ndarray | None = None):
        self.data, self.at, self.end = data, at.astype(np.int64), end.astype(np.int64)
        self.bad = np.zeros(len(at), bool) if bad is None else bad

    def __len__(self) -> int:
        return len(self.at)

    def take(self, which: np.ndarray) -> Lanes:
        return Lanes(self.data, self.at[which], self.end[which], self.bad[which])

    def put(self, which: np.ndarray, part: Lanes) -> None:
        self.at[which] = part.at
        self.bad[which] |= part.bad

    def fail(self, which: np.ndarray) -> None:
        self.bad[which] = True
        self.at[which] = self.end[which]

    def varint(self) -> np.ndarray:
        folded = np.zeros(len(self), np.uint64)
        live = np.arange(len(self))
        for shift in range(0, 70, 7):
            inside = self.at[live] < self.end[live]
            self.fail(live[~inside])
            live = live[inside]
            byte = self.data[self.at[live]]
            folded[live] |= (byte & 127).astype(np.uint64) << np.uint64(shift)
            self.at[live] += 1
            live = live[byte >= 128]
            if not len(live):
                break
        self.fail(live)
        return (folded >> np.uint64(1)).view(np.int64) ^ -(folded & np.uint64(1)).view(np.int64)

    def plain(self, kind: str) -> np.ndarray:
        width = int(kind[-1])
        self.fail(np.flatnonzero(self.at + width > self.end))
        live = np.flatnonzero(~self.bad)
        out = np.zeros((len(self), width), np.uint8)
        out[live] = self.data[self.at[live, None] + np.arange(width)]
        self.at[live] += width
        return out.view(kind)[:, 0]

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of a text; the text of a bad lane is empty."""
        lengths = self.varint()
        self.fail(np.flatnonzero((lengths < 0) | (lengths > self.end - self.at)))
        lengths[self.bad] = 0
        starts = self.at.copy()
        self.at += lengths
        return starts, lengths


def steps(nodes: tuple[Node, ...], lanes: Lanes, counts: np.ndarray) -> tuple[list, list]:
    """Pass ``counts`` items in every lane; owners and starts of the items, in the order they were met."""
    owners, starts = [], []
    lanes.fail(np.flatnonzero((counts < 0) | (counts > lanes.end - lanes.at)))  # an item has a byte at least
    left = np.where(lanes.bad, 0, counts)
    live = np.flatnonzero(left > 0)
    while len(live):
        part = lanes.take(live)
        owners.append(live)
        starts.append(part.at.copy())
        for node in nodes:
            walk(node, part, False)
        lanes.put(live, part)
        left[live] -= 1
        live = live[(left[live] > 0) & ~part.bad]
    return owners, starts


def in_order(owners: list, starts: list) -> tuple[np.ndarray, np.ndarray]:
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner, start = np.concatenate(owners), np.concatenate(starts)
    order = np.argsort(owner, kind="stable")
    return owner[order], start[order]


def items(nodes: tuple[Node, ...], lanes: Lanes) -> tuple[np.ndarray, np.ndarray]:
    """Owner and start of every item of an array or map."""
    owners, starts = [], []
    live = np.flatnonzero(~lanes.bad)
    while len(live):
        part = lanes.take(live)
        counts = part.varint()
        sized = np.flatnonzero(counts < 0)  # such a number is followed by a size in bytes
        if len(sized):
            inner = part.take(sized)
            inner.varint()
            part.put(sized, inner)
            counts[sized] = -counts[sized]
        counts[part.bad] = 0
        more = counts > 0
        part_owners, part_starts = steps(nodes, part, counts)
        owners += [live[o] for o in part_owners]
        starts += part_starts
        lanes.put(live, part)
        live = live[more & ~part.bad]
    return in_order(owners, starts)


def walk(node: Node, lanes: Lanes, build: bool = True) -> pa.Array | None:
    """Read one value in every lane; bad lanes give something that is not to be used."""
    if node.null_branch is not None:
        branch = lanes.varint()
        lanes.fail(np.flatnonzero((branch != 0) & (branch != 1)))
        there = np.flatnonzero((branch != node.null_branch) & ~lanes.bad)
        part = lanes.take(there)
        values = walk(replace(node, null_branch=None), part, build)
        lanes.put(there, part)
        if not build:
            return None
        if not len(there):
            return pa.nulls(len(lanes), arrow_type(node))
        place, absent = np.zeros(len(lanes), np.int64), np.ones(len(lanes), bool)
        place[there], absent[there] = np.arange(len(there)), False
        return values.take(pa.array(place, mask=absent))
    if node.kind == "record":
        columns = [walk(inner, lanes, build) for inner in node.inner]
        return pa.StructArray.from_arrays(columns, fields=fields(node)) if build else None
    if node.kind in ("array", "map"):
        owner, start = items(node.inner, lanes)
        if not build:
            return None
        part = Lanes(lanes.data, start, lanes.end[owner])
        columns = [walk(inner, part) for inner in node.inner]
        lanes.fail(owner[part.bad])
        offsets = pa.array(np.searchsorted(owner, np.arange(len(lanes) + 1)).astype(np.int32))
        make = pa.MapArray if node.kind == "map" else pa.ListArray
        return make.from_arrays(offsets, *columns, type=arrow_type(node))
    if node.kind in ("string", "bytes"):
        starts, lengths = lanes.spans()
        return texts(node, lanes, starts, lengths) if build else None
    if node.kind in ("float", "double"):
        values = lanes.plain("<f4" if node.kind == "float" else "<f8")
        return pa.array(values) if build else None
    if node.kind == "boolean":
        values = lanes.plain("|u1")
        lanes.fail(np.flatnonzero(values > 1))
        return pa.array(values == 1) if build else None
    values = lanes.varint()
    if node.kind == "enum":
        lanes.fail(np.flatnonzero((values < 0) | (values >= len(node.names))))
        return pa.array(node.names, pa.string()).take(pa.array(np.where(lanes.bad, 0, values))) if build else None
    if node.kind == "int":
        lanes.fail(np.flatnonzero(values != values.astype(np.int32)))
        return pa.array(values.astype(np.int32)).cast(arrow_type(node)) if build else None
    if node.logical == "timestamp-millis":
        lanes.fail(np.flatnonzero(np.abs(values) > (1 << 63) // 1000 - 1))
        values = np.where(lanes.bad, 0, values) * 1000
    return pa.array(values).cast(arrow_type(node)) if build else None


def texts(node: Node, lanes: Lanes, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    def gathered() -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        if offsets[-1] > MOST_BYTES:
            raise ValueError("texts of one batch are over 2 GiB")
        body = lanes.data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
        return pa.Array.from_buffers(pa.binary(), len(lanes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body)])

    values = gathered()
    if node.kind == "bytes":
        return values
    try:
        return values.cast(pa.string())
    except pa.ArrowInvalid:  # rare: look for the lanes that are not UTF-8
        for lane, value in enumerate(values.to_pylist()):
            try:
                value.decode()
            except UnicodeDecodeError:
                lanes.fail(np.array([lane]))
                lengths[lane] = 0
        return gathered().cast(pa.string())


def decode_payloads(node: Node, payloads: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """One record from every payload, and which payloads are bad: null, broken, or with bytes behind the record."""
    absent = pc.is_null(payloads).to_numpy(zero_copy_only=False)
    stored = pc.fill_null(payloads.cast(pa.large_binary()), b"")
    n = len(stored)
    offsets = np.frombuffer(stored.buffers()[1], np.int64)[stored.offset : stored.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(stored.buffers()[2] or b"", np.uint8)
    lanes = Lanes(data, offsets[:-1], offsets[1:])
    records = walk(node, lanes)
    return records, absent | lanes.bad | (lanes.at != lanes.end)


def decode_blocks(node: Node, blocks: list[bytes], counts: list[int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The records of many blocks, the block of each record, and which blocks are bad; bad blocks give no records.

    Records of a block have no marks between them. A first walk over all blocks side by side finds where they begin, a second one reads
    all records side by side.
    """
    ends = np.cumsum([len(b) for b in blocks], dtype=np.int64)
    data = np.frombuffer(b"".join(blocks), np.uint8)
    lanes = Lanes(data, ends - [len(b) for b in blocks], ends)
    owner, start = in_order(*steps((node,), lanes, np.array(counts, np.int64)))
    bad = lanes.bad | (lanes.at != lanes.end)
    good = ~bad[owner]
    part = Lanes(data, start[good], ends[owner[good]])
    records, owner = walk(node, part), owner[good]
    bad[owner[part.bad]] = True
    whole = ~bad[owner]
    return records.filter(pa.array(whole)), owner[whole], bad
