"""Nearest neighbours by a block matrix join over int8 products with error bounds.

Vectors are quantised to int8, one scale a vector; the norm of what quantising lost (the noise) is kept exactly. Blocks of queries
meet blocks of candidates; a tile multiplies their codes (whole numbers that float32 adds without error, so that BLAS may
do it) and knows every distance up to ``2 (|q| noise(c) + noise(q) |c|)``, by Cauchy-Schwarz. A pair survives if its least possible
distance is not above the tile's k-th least greatest one, nor the k-th distance found before. Survivors
are recomputed from the original vectors in float64 and merged into a sorted heap of k a query. Nothing is approximate in the result.

Work is (queries x rows), as asked for; what bounds the rest: candidates are read once for each lot of query blocks, a lot is broadcast
and holds ``LOT_BYTES`` at most. A share of the candidates is searched first; the k-th distances found there go along
with the queries, so that tasks send few neighbours that others beat. Equal query vectors are searched once; of equal
candidate vectors in a block the smallest ids stay, as no other can be among the nearest.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without id;
vectors of another length are no candidates of a query; rows that share a query's id are its own; of repeated
rows of one id the nearest counts; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import stored

QUERY_ROWS, CANDIDATE_ROWS = 2048, 8192
TILE = 256  # queries of a tile that are held at once
LOT_BYTES = 64 << 20
SEEDS = 32  # one candidate in so many is searched first; results do not depend on it
EXACT = 1024  # products of codes up to 127 that float32 adds without rounding: 1024 * 127**2 < 2**24
SLACK = 1e-9  # of the squared norms: far above the rounding of float64
PAIRS = 1 << 15  # survivors recomputed at a time

BLOCK = "block long, dim int, ids binary, codes binary, scale binary, noise binary, raw binary"
FOUND = "query long, vec_id long, square double"


def usable(vector: str) -> Column:
    """True for vectors of finite components that are not all zero."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda c: c != 0), F.lit(False))


class Block:
    """Vectors of one length: original, as codes, and what is needed for bounds."""

    def __init__(self, ids, codes, scale, noise, raw):
        self.ids, self.codes, self.scale, self.noise, self.raw = ids, codes, scale, noise, raw
        self.square = (raw * raw).sum(axis=1)
        self.norm = np.sqrt(self.square)
        self.rounded = scale * np.sqrt((codes * codes).sum(axis=1, dtype=np.float64))  # norm of the quantised vector
        self.first = np.zeros(len(ids), bool)  # a threshold needs k different ids
        self.first[np.unique(ids, return_index=True)[1]] = True

    @staticmethod
    def quantised(raw: np.ndarray):
        scale = np.abs(raw).max(axis=1) / 127
        codes = np.rint(raw / np.maximum(scale, np.finfo(np.float64).tiny)[:, None]).clip(-127, 127)
        lost = raw - codes * scale[:, None]
        return codes.astype(np.int8), scale, np.sqrt((lost * lost).sum(axis=1))

    @classmethod
    def of(cls, row: dict) -> Block:
        raw = np.frombuffer(row["raw"]).reshape(-1, row["dim"])
        codes = np.frombuffer(row["codes"], np.int8).reshape(-1, row["dim"]).astype(np.float32)
        return cls(np.frombuffer(row["ids"], np.int64), codes, np.frombuffer(row["scale"]), np.frombuffer(row["noise"]), raw)


def smallest_ids(ids: np.ndarray, raw: np.ndarray, keep: int) -> np.ndarray:
    """Places of the rows left when each vector keeps its ``keep`` smallest ids, once each."""
    _, group = np.unique(np.ascontiguousarray(raw).view(np.dtype((np.void, raw.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    new = np.concatenate(([True], group[order][1:] != group[order][:-1]))
    once = new | np.concatenate(([True], ids[order][1:] != ids[order][:-1]))
    order, new = order[once], new[once]
    starts = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < keep]


def blocks(vectors: DataFrame, rows: int, keep: int | None) -> DataFrame:
    """(block, dim, ...) of up to ``rows`` vectors each; ``vectors`` holds (vec_id, vector).

    With ``keep``, equal vectors of a block leave only so many rows.
    """
    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), *[(c, pa.binary()) for c in ("ids", "codes", "scale", "noise", "raw")]])

    def packed(number: int, ids: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
        if keep is not None:
            left = smallest_ids(ids, raw, keep)
            ids, raw = ids[left], raw[left]
        codes, scale, noise = Block.quantised(raw)
        parts = [ids.tobytes(), codes.tobytes(), scale.tobytes(), noise.tobytes(), raw.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([number, raw.shape[1], *parts], schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        held: dict[int, list] = {}
        for batch in batches:
            vector, ids = batch.column("vector"), batch.column("vec_id").to_numpy(zero_copy_only=False)
            ends = vector.offsets.to_numpy().astype(np.int64)
            flat, sizes = vector.values.to_numpy(zero_copy_only=False), np.diff(ends)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                raw = flat[(ends[at][:, None] + np.arange(dim)).ravel()].reshape(-1, dim)
                for start in range(0, len(at), rows):
                    lot = held.setdefault(dim, [])
                    lot.append((ids[at[start : start + rows]], raw[start : start + rows]))
                    if sum(len(i) for i, _ in lot) >= rows:
                        whole, all_raw = (np.concatenate(side) for side in zip(*held.pop(dim), strict=True))
                        for a in range(0, len(whole), rows):
                            yield packed(number, whole[a : a + rows], all_raw[a : a + rows])
                            number += 1
        for lot in held.values():
            yield packed(number, *(np.concatenate(side) for side in zip(*lot, strict=True)))
            number += 1

    return vectors.mapInArrow(run, BLOCK)


class Heaps:
    """The k nearest found so far of every query of a block, in order of (distance, id); an id counts once."""

    def __init__(self, block: int, queries: Block, k: int, limits: list | None):
        self.block, self.queries, self.k = block, queries, k
        n = len(queries.ids)
        self.square, self.ids = np.full((n, k), np.inf), np.full((n, k), -1, np.int64)
        self.limit = np.full(n, np.inf)
        for limit in limits or []:
            self.limit[limit["at"]] = limit["square"]

    def meet(self, others: Block) -> None:
        """Products of the two blocks tile by tile; what may be near is recomputed and merged."""
        q, c = self.queries, others
        for a in range(0, len(q.ids), TILE):
            part = slice(a, a + TILE)
            product = np.zeros((len(q.ids[part]), len(c.ids)))
            for d in range(0, q.codes.shape[1], EXACT):
                product += q.codes[part, d : d + EXACT] @ c.codes[:, d : d + EXACT].T
            sums = q.square[part, None] + c.square
            likely = sums - 2 * (q.scale[part, None] * c.scale) * product
            error = 2 * (q.rounded[part, None] * c.noise + q.noise[part, None] * c.norm) + SLACK * sums
            limit = np.minimum(self.limit[part], self.square[part, -1])
            if c.first.sum() >= self.k:
                greatest = np.partition((likely + error)[:, c.first], self.k - 1, axis=1)[:, self.k - 1]
                limit = np.minimum(limit, greatest)
            at, other = np.nonzero(likely - error <= limit[:, None])
            for s in range(0, len(at), PAIRS):
                self.merge(at[s : s + PAIRS] + a, other[s : s + PAIRS], c)

    def merge(self, at: np.ndarray, other: np.ndarray, c: Block) -> None:
        apart = self.queries.raw[at] - c.raw[other]
        square = (apart * apart).sum(axis=1)
        touched = np.unique(at)
        at = np.concatenate((at, np.repeat(touched, self.k)))
        square = np.concatenate((square, self.square[touched].ravel()))
        ids = np.concatenate((c.ids[other], self.ids[touched].ravel()))
        real = np.isfinite(square)
        at, square, ids = at[real], square[real], ids[real]
        order = np.lexsort((square, ids, at))  # the nearest row of an id
        at, square, ids = at[order], square[order], ids[order]
        once = np.concatenate(([True], (at[1:] != at[:-1]) | (ids[1:] != ids[:-1])))
        at, square, ids = at[once], square[once], ids[once]
        order = np.lexsort((ids, square, at))
        at, square, ids = at[order], square[order], ids[order]
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        best = rank < self.k
        self.square[touched], self.ids[touched] = np.inf, -1
        self.square[at[best], rank[best]], self.ids[at[best], rank[best]] = square[best], ids[best]

    def rows(self) -> pa.RecordBatch:
        at, place = np.nonzero(np.isfinite(self.square))
        arrays = [pa.array((self.block << 16) + at), pa.array(self.ids[at, place]), pa.array(self.square[at, place])]
        return pa.RecordBatch.from_arrays(arrays, names=["query", "vec_id", "square"])


def tiles(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, vec_id, square): each task's k nearest; ``queries`` holds blocks (``q_`` columns) with ``limits``, a lot of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, Heaps] = {}
        number, others = None, None
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1)
                one = {c: row.column(c)[0].as_py() for c in ("block", "q_block")}
                if one["block"] != number:
                    number, others = one["block"], Block.of({c: row.column(c)[0].as_py() for c in ("dim", "ids", "codes", "scale", "noise", "raw")})
                if one["q_block"] not in heaps:
                    names = ("ids", "codes", "scale", "noise", "raw")
                    block = Block.of({"dim": row.column("dim")[0].as_py()} | {c: row.column(f"q_{c}")[0].as_py() for c in names})
                    heaps[one["q_block"]] = Heaps(one["q_block"], block, k, row.column("limits")[0].as_py())
                heaps[one["q_block"]].meet(others)
        for heap in heaps.values():
            yield heap.rows()

    return candidates.join(F.broadcast(queries), "dim").mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """(query, vec_id, square, rank): the k nearest of all tasks' heaps."""
    once = found.groupBy("query", "vec_id").agg(F.min("square").alias("square"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("square", "vec_id"))
    return once.withColumn("rank", place).filter(F.col("rank") <= k)


def lots(query_blocks: DataFrame) -> list[list[int]]:
    """Numbers of query blocks, in lots of at most ``LOT_BYTES``; one number per block reaches the driver."""
    out, room = [], 0
    for row in query_blocks.select("block", (F.length("raw") + F.length("codes")).alias("bytes")).orderBy("block").collect():
        if not out or row["bytes"] > room:
            out.append([])
            room = LOT_BYTES
        out[-1].append(row["block"])
        room -= row["bytes"]
    return out


def nearest(df: DataFrame, k: int = 10, is_query: Column | None = None, vector: str = "embedding", seeds: int = SEEDS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each query by Euclidean distance, ties to the smaller id."""
    kind = T.ArrayType(T.DoubleType())
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("vector"))
    queries = rows.filter(F.pmod("vec_id", F.lit(100)) == 0 if is_query is None else is_query)
    # Equal query vectors are one search, known by its block and place; one more neighbour, as a query may find itself.
    distinct = queries.groupBy("vector").agg(F.lit(0)).select("vector", F.monotonically_increasing_id().alias("vec_id"))
    distinct = stored(distinct, "nearest-queries")
    numbered = stored(blocks(distinct, QUERY_ROWS, None), "nearest-blocks")
    some = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(seeds)) == 0
    found = df.sparkSession.createDataFrame([], FOUND)
    for lot in lots(numbered):
        lot = numbered.filter(F.col("block").isin(lot))
        lot = lot.withColumnsRenamed({c: f"q_{c}" for c in ("block", "ids", "codes", "scale", "noise", "raw")})
        free = lot.withColumn("limits", F.lit(None).cast("array<struct<at:int,square:double>>"))
        first = stored(best_of(tiles(blocks(rows.filter(some), CANDIDATE_ROWS, k + 1), free, k + 1), k + 1), "nearest-seeds")
        last = first.filter(F.col("rank") == k + 1)
        at = F.struct(F.col("query").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("at"), "square")
        limits = last.groupBy(F.shiftright("query", 16).alias("q_block")).agg(F.collect_list(at).alias("limits"))  # one a query of a block
        rest = blocks(rows.filter(~some), CANDIDATE_ROWS, k + 1)
        found = found.unionByName(first.drop("rank")).unionByName(stored(tiles(rest, lot.join(limits, "q_block", "left"), k + 1), "nearest-found"))
    near = F.struct("square", "vec_id")
    best = best_of(found, k + 1).groupBy("query").agg(F.array_sort(F.collect_list(near)).alias("near"))
    names = numbered.select("block", "ids").mapInArrow(names_of, "query long, search long")
    named = names.join(distinct.select(F.col("vec_id").alias("search"), "vector"), "search").join(best, "query").select("vector", "near")
    each = queries.select(F.col("vec_id").alias("query_id"), "vector").join(named, "vector")
    others = each.select("query_id", F.inline(F.filter("near", lambda n: n["vec_id"] != F.col("query_id"))))
    once = others.groupBy("query_id", "vec_id").agg(F.min("square").alias("square"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("square", "vec_id"))
    ranked = once.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.sqrt("square").alias("score"))


def names_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, search): the number of each search by block and place, and its number among the distinct vectors."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((row["block"] << 16) + np.arange(len(ids))), pa.array(ids)], names=["query", "search"])
