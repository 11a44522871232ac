"""Helpers that several operators share: typed Arrow passes, dense row numbers, stored frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import Folder, cut_lineage, fresh_dir

#: A word is a run of anything but these six characters; ``bytes.split()`` cuts at exactly them.
BLANKS = b" \t\n\r\x0b\x0c"
TEXTS = 512  # texts that a task takes apart at once
WORD = r"[^\x20\x09-\x0D]+"


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column of a batch as Python strings, null as empty."""
    return [value or "" for value in batch.column(name).to_pylist()]


def typed(column, kind: pa.DataType) -> pa.Array:
    return column.cast(kind) if isinstance(column, pa.Array) else pa.array(column, type=kind)


def map_rows(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[list]], schema: T.StructType | str, most_rows: int | None = None) -> DataFrame:
    """``mapInArrow`` for functions that turn a batch into lists, one per output column.

    ``most_rows``: the function gets a batch in pieces, for functions that hold much more than the batch itself.
    """
    spec = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(spec)

    def run(batches):
        for batch in batches:
            step = most_rows or max(1, batch.num_rows)
            for at in range(0, max(1, batch.num_rows), step):
                for columns in function(batch.slice(at, step)):
                    yield pa.RecordBatch.from_arrays(
                        [typed(column, field.type) for column, field in zip(columns, arrow, strict=True)], schema=arrow
                    )

    return df.mapInArrow(run, spec)


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that :func:`stored` writes inside are removed at the end, but those written with ``keep``.

    For steps whose result is itself stored: nothing that is returned may still read the others.
    """
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.remove(made)
        for path in made:
            Folder(spark, path).remove()


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: no recomputation, no lineage.

    ``keep``: the table outlives the innermost :func:`scratch`, up to the next one around it.
    """
    path = fresh_dir(df.sparkSession, label)
    open_ = _scratch[:-1] if keep else _scratch
    if open_:
        open_[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """Dense numbers 0.. in the order of ``keys``, without a global sort task.

    Rows are range-partitioned, frozen by a reliable checkpoint and numbered as partition offset
    plus position; one row per partition reaches the driver. A seeded random last key spreads
    repeated rows, which are interchangeable.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*keys, F.rand(11)).sortWithinPartitions(*keys)
    frozen = cut_lineage(spark, placed.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", 33)
    offsets, total = [], 0
    for row in frozen.groupBy(part.alias("p")).count().orderBy("p").collect():  # one row per partition
        offsets.append((row["p"], total))
        total += row["count"]
    starts = spark.createDataFrame(offsets, "_part bigint, _start bigint")
    numbered = (
        frozen.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid", "_part", "_start")
    )
    return numbered, total


def crc32_of(column: Column) -> Column:
    return F.crc32(F.coalesce(column, F.lit("")).cast("binary"))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
