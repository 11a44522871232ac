"""Aggregation configuration and the options of the composed flows."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

UNITS = {"ms": 1, "s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def millis(text: str | int) -> int:
    """``15m``, ``60s``, ``250ms``, ``2h``, ``1d`` to milliseconds."""
    found = re.fullmatch(r"\s*(\d+)\s*(ms|s|m|h|d)\s*", str(text))
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return int(found.group(1)) * UNITS[found.group(2)]


def interval(ms: int) -> str:
    """Milliseconds as a Spark interval."""
    return f"{ms} milliseconds"


def _only(section: dict, allowed: set[str], where: str) -> dict:
    unknown = set(section) - allowed
    if unknown:
        raise ValueError(f"unknown keys in {where}: {sorted(unknown)}")
    return section


@dataclass(frozen=True)
class EarlyFirings:
    enabled: bool = False
    count: int | None = None
    time_ms: int | None = None
    accumulating: bool = True


@dataclass(frozen=True)
class Aggregation:
    """One keyed count over fixed windows."""

    key_fields: tuple[str, ...]
    length_ms: int
    lateness_ms: int = 0
    early: EarlyFirings = field(default_factory=EarlyFirings)
    kind: str = "COUNT"
    input_format: str = "JSON"
    input_type: str = ""
    label: str = ""

    def __post_init__(self):
        if self.kind != "COUNT":
            raise ValueError(f"unsupported aggregation type: {self.kind}")
        if not self.key_fields:
            raise ValueError("an aggregation needs at least one key field")
        if self.length_ms <= 0 or self.lateness_ms < 0:
            raise ValueError("a window needs a positive length and no negative lateness")
        if self.early.enabled and not (self.early.count or self.early.time_ms is not None):
            raise ValueError("early firings need a count or a time")

    @property
    def name(self) -> str:
        """The label, or kind and key; see :func:`distinct_names` for several on one key."""
        return self.label or "_".join([self.kind.lower(), *self.key_fields])


def duration(ms: int) -> str:
    """Milliseconds as the shortest text that ``millis`` reads."""
    unit = max((u for u in UNITS if ms % UNITS[u] == 0), key=UNITS.get)
    return f"{ms // UNITS[unit]}{unit}"


def distinct_names(aggregations: Sequence[Aggregation]) -> list[Aggregation]:
    """Aggregations whose names, and so whose cells, never collide.

    Where several share a name, each gets its window length added; what is still equal counts the same
    thing twice and is refused.
    """
    times = Counter(a.name for a in aggregations)
    named = [a if times[a.name] == 1 else replace(a, label=f"{a.name}_{duration(a.length_ms)}") for a in aggregations]
    twice = [name for name, n in Counter(a.name for a in named).items() if n > 1]
    if twice:
        raise ValueError(f"aggregations with the same key and window length: {sorted(twice)}")
    return named


def parse_aggregations(document: dict) -> list[Aggregation]:
    _only(document, {"aggregations"}, "the document")
    parsed = []
    for entry in document["aggregations"]:
        _only(entry, {"type", "window", "input", "fields"}, "an aggregation")
        window = _only(entry["window"], {"length", "lateness", "earlyFirings"}, "window")
        early = _only(
            window.get("earlyFirings") or {}, {"enabled", "count", "time", "accumulating"}, "earlyFirings"
        )
        source = _only(entry.get("input") or {}, {"format", "thriftClassName"}, "input")
        keys = _only(entry["fields"], {"key"}, "fields")["key"]
        parsed.append(
            Aggregation(
                key_fields=tuple([keys] if isinstance(keys, str) else keys),
                length_ms=millis(window["length"]),
                lateness_ms=millis(window.get("lateness", "0ms")),
                early=EarlyFirings(
                    enabled=bool(early.get("enabled", False)),
                    count=early.get("count"),
                    time_ms=millis(early["time"]) if "time" in early else None,
                    accumulating=bool(early.get("accumulating", True)),
                ),
                kind=entry["type"],
                input_format=source.get("format", "JSON"),
                input_type=source.get("thriftClassName", ""),
            )
        )
    return distinct_names(parsed)


def load_aggregations(text: str) -> list[Aggregation]:
    """Parse YAML (or JSON, where no YAML reader is installed) text."""
    try:
        import yaml
    except ImportError:
        return parse_aggregations(json.loads(text))
    return parse_aggregations(yaml.safe_load(text))


def read_aggregations(spark, location: str) -> list[Aggregation]:
    """Configuration file from any file system Spark can reach."""
    return load_aggregations(spark.read.text(location, wholetext=True).first()[0])


def cell_destination(text: str) -> tuple[str, str, str]:
    """``<project>.<instance>.<table>``; anything but three parts is refused."""
    parts = text.split(".")
    if len(parts) != 3 or not all(parts):
        raise ValueError(f"a cell table is named by three parts with dots between, not {text!r}")
    return tuple(parts)


RECORD_SHAPES = ("TABLE_ROW", "ROW", "AVRO_GENERIC_RECORD")
GUARANTEES = ("exactly_once", "at_least_once", "row_inserts")


@dataclass(frozen=True)
class TableOptions:
    """Where and how rows are appended. All record shapes are one DataFrame here."""

    path: str
    create_if_needed: bool = True
    record_shape: str = "AVRO_GENERIC_RECORD"
    guarantee: str = "at_least_once"
    flush_seconds: int | None = None
    streams: int | None = None
    destinations: int = 1
    skewed: bool = False
    autoshard: bool = False
    rows_per_file: int = 5_000_000
    time_column: str | None = None
    time_unit: str = "DAY"

    def __post_init__(self):
        if self.record_shape not in RECORD_SHAPES:
            raise ValueError(f"unknown record shape: {self.record_shape}")
        if self.guarantee not in GUARANTEES:
            raise ValueError(f"unknown delivery guarantee: {self.guarantee}")
        if self.destinations < 1:
            raise ValueError("at least one destination is needed")
        if self.time_unit not in ("HOUR", "DAY", "MONTH", "YEAR"):
            raise ValueError(f"unknown time partitioning: {self.time_unit}")

    @property
    def trigger(self) -> dict:
        return {"processingTime": f"{self.flush_seconds} seconds"} if self.flush_seconds else {"availableNow": True}

    @property
    def failed_path(self) -> str:
        return self.path.rstrip("/") + "-failed"
