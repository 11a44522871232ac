"""Two-way results: rows that passed a stage and the dead letters of that stage."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import ERROR


@dataclass(frozen=True)
class Outcome:
    ok: DataFrame
    failed: DataFrame


def split(df: DataFrame, stage: str, keep: list[str]) -> Outcome:
    """Split a frame that carries ``error_class`` / ``error_message`` (null when a row passed).

    Both sides read one frame, so persist it first when both are written in one batch.
    """
    failed = df.filter(F.col("error_class").isNotNull()).select(
        F.col("event_id"),
        F.lit(stage).alias("stage"),
        F.col("error_class"),
        F.col("error_message"),
        F.col("attributes"),
        F.col("payload"),
    )
    return Outcome(df.filter(F.col("error_class").isNull()).select(*keep), failed)


def union_errors(errors: Iterable[DataFrame]) -> DataFrame:
    """Bag union of dead letters from several stages.

    Only the error columns are kept, so stages with different window columns can be merged.
    """
    names = ERROR.fieldNames()
    return reduce(DataFrame.unionByName, [df.select(*names) for df in errors])


def with_event_time(df: DataFrame, ts: str = "event_ts") -> Outcome:
    """Rows that have an event time, and the others as dead letters: no window holds them.

    Columns of the dead letter that ``df`` lacks are null.
    """
    def kept(name: str, kind: str):
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)

    failed = df.filter(F.col(ts).isNull()).select(
        kept("event_id", "string"),
        F.lit("event_time").alias("stage"),
        F.lit("MissingEventTime").alias("error_class"),
        F.lit("the event has no event time").alias("error_message"),
        kept("attributes", "map<string,string>"),
        kept("payload", "binary"),
    )
    return Outcome(df.filter(F.col(ts).isNotNull()), failed)
