"""Sharding by a Feistel permutation of global row numbers; the law is ``rows``.

Documents are numbered 0 .. N-1 in id order. A four-round Feistel network permutes the smallest
even-bit domain that holds N numbers; cycle walking (apply it again while the result is N or more)
restricts it to 0 .. N-1. Position p goes to shard ``p mod shards``, slot ``p div shards``: counts differ by one at
most, slots have no gaps, and shard and slot of any row number can be computed without the data
(``place``), or inverted. The seed alone decides the shuffle.

Only ids, sizes and checksums are moved to number the rows; equal texts are not kept together under
this law. Defined results: null text counts as empty; null ids come first; repeated rows get a place each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import crc32_of, map_rows, number_rows

ROUNDS = 4
SEED = 42
WORD32 = 1 << 32
MULTIPLY, MIX = 2654435761, 2246822507  # odd 32-bit multipliers of the round function


def half_bits(count: int) -> int:
    """Bits of either half: the smallest domain 4**bits that holds ``count``."""
    return max(1, -(-max(1, (count - 1).bit_length()) // 2))


def round_keys(seed: int) -> list[int]:
    return [(seed * 40503 + 977 * (number + 1) * (number + 1)) % WORD32 for number in range(ROUNDS)]


def mixed(half: np.ndarray, key: int, mask: int) -> np.ndarray:
    """Round function on unsigned 64-bit numbers: 32-bit multiply, shift and xor."""
    x = (half + np.uint64(key)) % np.uint64(WORD32) * np.uint64(MULTIPLY) % np.uint64(WORD32)
    x ^= x >> np.uint64(15)
    x = x * np.uint64(MIX) % np.uint64(WORD32)
    x ^= x >> np.uint64(13)
    return x & np.uint64(mask)


def permute(numbers: np.ndarray, bits: int, seed: int) -> np.ndarray:
    mask = (1 << bits) - 1
    left, right = numbers >> np.uint64(bits), numbers & np.uint64(mask)
    for key in round_keys(seed):
        left, right = right, left ^ mixed(right, key, mask)
    return left << np.uint64(bits) | right


def unpermute(numbers: np.ndarray, bits: int, seed: int) -> np.ndarray:
    mask = (1 << bits) - 1
    left, right = numbers >> np.uint64(bits), numbers & np.uint64(mask)
    for key in reversed(round_keys(seed)):
        left, right = right ^ mixed(left, key, mask), left
    return left << np.uint64(bits) | right


def walk(numbers: np.ndarray, count: int, step, seed: int) -> np.ndarray:
    """Apply ``step`` to each number until it falls below ``count``."""
    bits, out = half_bits(count), numbers.astype(np.uint64)
    out = step(out, bits, seed)
    while (far := out >= count).any():
        out[far] = step(out[far], bits, seed)
    return out


def place(numbers: np.ndarray, count: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers, without looking at any data."""
    position = walk(numbers, count, permute, seed)
    return (position % np.uint64(shards)).astype(np.int32), (position // np.uint64(shards)).astype(np.int64)


def row_at(shard: int, slot: int, count: int, shards: int, seed: int = SEED) -> int:
    """The row number that lies at a place: the inverse of ``place``."""
    return int(walk(np.array([slot * shards + shard]), count, unpermute, seed)[0])


def sharded(docs: DataFrame, shards: int = 40, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number) per document."""
    slim = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        crc32_of(F.col("text")).alias("text_crc32"),
    )
    numbered, count = number_rows(slim, ["doc_id", "size", "text_crc32"], "row_number")

    def run(batch: pa.RecordBatch):
        shard, slot = place(batch.column("row_number").to_numpy(), count, shards, seed)
        size = len(shard)
        yield [
            batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"), ["rows"] * size,
            shard, slot, [None] * size, batch.column("row_number"),
        ]

    schema = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, row_number long"
    return map_rows(numbered.select("doc_id", "size", "text_crc32", "row_number"), run, schema)
