"""Queries by name, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in plain SQL."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir)

        run.__name__ = run.__qualname__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(column: Column | str, name: str) -> Column:
    """Timestamp without zone, the type both engines share."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz").alias(name)


def text_hex(column: Column | str, name: str) -> Column:
    return F.hex(column).alias(name)
