"""User transforms between decompression and storage."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.operators.envelope import UNPACKED
from millrace.operators.outcome import Outcome, split
from millrace.schemas import TRANSPORT


def load_transform(name: str | None) -> Callable | None:
    """``package.module:function`` to a callable; blank means no transform."""
    if not name or not name.strip():
        return None
    module, _, function = name.strip().partition(":")
    if not function:
        raise ValueError("a transform is named as package.module:function")
    found = getattr(importlib.import_module(module), function)
    if not callable(found):
        raise TypeError(f"{name} is not callable")
    return found


def apply_frame(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The fast form: the transform is DataFrame -> DataFrame and stays inside Catalyst."""
    return df if transform is None else transform(df)


def apply_events(df: DataFrame, transform: Callable[[dict], dict] | None) -> Outcome:
    """The per-event form: event dict -> event dict; an exception makes that event a dead letter.

    Both sides read one frame. Where both are used, persist :func:`map_events` and split that, so that the
    function is called once per event.
    """
    if transform is None:
        return Outcome(df, empty_errors(df))
    return split(map_events(df, transform), "transform", TRANSPORT.fieldNames())


def map_events(df: DataFrame, transform: Callable[[dict], dict], carried: tuple[str, ...] = ()) -> DataFrame:
    """Transports with the function applied, and the error columns of events on which it failed.

    ``carried`` columns pass unchanged; of rows that already have an ``error_class`` the function is not called,
    and where ``stage`` is carried, the rows that fail here get ``transform``.
    """
    names = TRANSPORT.fieldNames()
    out = T.StructType(UNPACKED.fields + [f for f in df.schema.fields if f.name in carried and f.name not in UNPACKED.fieldNames()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            incoming = whole
            if "error_class" in carried:  # what has failed before passes as it is, whatever its size
                lost = whole.column("error_class").is_valid()
                incoming = whole.filter(pc.invert(lost))
                if incoming.num_rows < whole.num_rows:
                    yield whole.filter(lost).select(out.fieldNames())
                if not incoming.num_rows:
                    continue
            rows = []
            for event in incoming.to_pylist():
                event["attributes"] = dict(event["attributes"] or [])
                known = {c: event.pop(c) for c in carried}
                made = event | known | {"error_class": None, "error_message": None}
                try:
                    made |= _checked(transform(dict(event)), event)
                except Exception as problem:
                    made |= {"error_class": type(problem).__name__, "error_message": str(problem)}
                    if "stage" in known:
                        made["stage"] = "transform"
                made["attributes"] = list((made.get("attributes") or {}).items())
                rows.append(made)
            text = incoming.schema.field("event_id").type
            fields = [incoming.schema.field(n) for n in names]
            fields += [pa.field(f.name, text) for f in out.fields[len(names) :]]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    return df.select(*names, *carried).mapInArrow(run, out)


def _checked(made: dict, event: dict) -> dict:
    """The function's result as transport values; what does not fit is that event's error.
    Fields that the function leaves out keep their value."""
    result = event | {name: made[name] for name in TRANSPORT.fieldNames() if name in made}
    if isinstance(result["payload"], str):
        result["payload"] = result["payload"].encode()
    if result["payload"] is not None:
        result["payload"] = bytes(memoryview(result["payload"]))
    if not isinstance(result["event_id"], str):
        raise TypeError("event_id must be text")
    if result["event_ts"] is not None and not isinstance(result["event_ts"], datetime):
        raise TypeError("event_ts must be a datetime")
    result["attributes"] = {str(k): None if v is None else str(v) for k, v in (result["attributes"] or {}).items()}
    return result


def empty_errors(df: DataFrame) -> DataFrame:
    """No dead letters, as a frame of the same kind (batch or streaming) as ``df``."""
    from pyspark.sql import functions as F

    from millrace.schemas import ERROR

    def typed(f: T.StructField):
        source = F.col(f.name) if f.name in ("event_id", "attributes", "payload") else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.filter(F.lit(False)).select(*[typed(f) for f in ERROR.fields])
