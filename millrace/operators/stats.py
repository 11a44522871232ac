"""Size and time distributions of payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def distribution(size: Column) -> list[Column]:
    return [
        F.count(size).alias("n"),
        F.sum(size).alias("total"),
        F.min(size).alias("smallest"),
        F.max(size).alias("largest"),
        F.avg(size).alias("mean"),
    ]


def payload_stats(df: DataFrame, payload: str = "payload", by: tuple[str, ...] = ()) -> DataFrame:
    """min, max, avg, count, sum of payload bytes. Partial aggregation leaves one row per task."""
    return df.groupBy(*by).agg(*distribution(F.octet_length(payload).cast("bigint")))


def observe_payloads(df: DataFrame, name: str, payload: str = "payload") -> tuple[DataFrame, Observation | None]:
    """The same numbers as a side effect of a write, without another pass.

    Batch frames return an ``Observation``; streaming frames report under ``name`` in the progress
    of each micro-batch.
    """
    columns = distribution(F.octet_length(payload).cast("bigint"))
    if df.isStreaming:
        return df.observe(name, *columns), None
    seen = Observation(name)
    return df.observe(seen, *columns), seen


def payload_percentiles(df: DataFrame, payload: str = "payload", points: tuple[float, ...] = (0.5, 0.9, 0.95), by: tuple[str, ...] = ()) -> DataFrame:
    """Exact interpolated percentiles of payload bytes.

    Sizes are first counted per distinct size, so what reaches the final aggregation is a
    histogram (bounded by the largest payload), not the rows.
    """
    size = F.octet_length(payload).cast("bigint").alias("_size")
    histogram = df.select(*by, size).groupBy(*by, "_size").agg(F.count("*").alias("_n"))
    at = F.percentile("_size", [*points], F.col("_n"))
    named = [at[i].alias(f"p{round(p * 100)}") for i, p in enumerate(points)]
    return histogram.groupBy(*by).agg(*named)


def approximate_percentiles(df: DataFrame, value: str, points: tuple[float, ...] = (0.5, 0.9, 0.95), accuracy: int = 10_000, by: tuple[str, ...] = ()) -> DataFrame:
    """Sketch form for values with no bound on the number of distinct ones (such as times)."""
    at = F.percentile_approx(value, [*points], accuracy)
    return df.groupBy(*by).agg(*[at[i].alias(f"p{round(p * 100)}") for i, p in enumerate(points)])
