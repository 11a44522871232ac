"""Deterministic draws: every random value is a pure function of (seed, row id, field path).

A retried task therefore regenerates the same rows, and a result can be recomputed elsewhere.
A row id is hashed once; the hash text and two 31-bit lanes taken from it are columns. Each field
mixes the lanes with multipliers derived from its path, in arithmetic that stays inside a signed
64-bit integer (no overflow under ANSI mode) and inside whole-stage code generation.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Primes just below 2**31.
PRIMES = (2147483647, 2147483629)
# Stand-ins for the base64 characters that are not letters.
DIGIT_LETTER, SIGN_LETTER = "n", "V"
LETTERS_PER_HASH = 43

ROW_HASH, LANE_A, LANE_B = "_row_hash", "_lane_a", "_lane_b"
LANES = (ROW_HASH, LANE_A, LANE_B)
GAUSSIAN_TERMS = 12


def coefficients(seed: int, path: str) -> list[int]:
    """Six odd multipliers below 2**30 for a field path."""
    digest = hashlib.sha256(f"{seed}/{path}".encode()).digest()
    words = [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(6)]
    return [(w % (1 << 29)) + (1 << 28) | 1 for w in words]


def fixed_letters(text: str, length: int) -> str:
    """Driver-side twin of :func:`letters_from` for values that do not depend on the row."""
    out = ""
    for chunk in range(-(-length // LETTERS_PER_HASH)):
        raw = base64.b64encode(hashlib.sha256(f"{text}|{chunk}".encode()).digest()).decode()
        raw = re.sub("[0-9]", DIGIT_LETTER, raw[:LETTERS_PER_HASH])
        out += re.sub("[+/]", SIGN_LETTER, raw)
    return out[:length]


def fixed_number(seed: int, text: str, bound: int) -> int:
    return int(hashlib.sha256(f"{seed}#{text}".encode()).hexdigest()[:12], 16) % bound


def with_lanes(df: DataFrame, row_id: Column | str, seed: int = 42) -> DataFrame:
    """Add the row hash and the two lanes. Every field uses them, so they are computed once."""
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    hashed = df.withColumn(ROW_HASH, F.md5(F.concat(F.lit(f"{seed}|"), rid.cast("string"))))

    def lane(start: int, prime: int) -> Column:
        return F.conv(F.substring(ROW_HASH, start, 8), 16, 10).cast("bigint") % prime

    return hashed.select("*", lane(1, PRIMES[0]).alias(LANE_A), lane(9, PRIMES[1]).alias(LANE_B))


def remainder(number, divisor: int):
    """``number % divisor`` of an array: numpy divides by a constant several times faster than it takes remainders."""
    return number - number // divisor * divisor


def mixed(lane_a, lane_b, k: list[int], pos=None):
    """Twin of :meth:`Draws.number` for arrays of 64-bit integers; ``k`` from :func:`coefficients`."""
    stride = remainder(lane_b * k[1] + k[2], PRIMES[1])
    if pos is not None:
        stride = stride * (pos + 1)
    return remainder(remainder(lane_a * k[0] + stride + k[5], PRIMES[0]) * k[3] + k[4], PRIMES[1])


@dataclass(frozen=True)
class Draws:
    """Draws over a frame prepared by :func:`with_lanes`, as Spark SQL expression text.

    Text, because a wide record needs tens of thousands of expression nodes: Spark parses one
    string per field instead of answering one call per node. ``pos`` (the text of an integer
    expression below 2**31) tells apart the elements of one collection.
    """

    seed: int = 42

    def number(self, path: str, pos: str | None = None) -> str:
        """Uniform integer in [0, 2**31)."""
        k = coefficients(self.seed, path)
        stride = f"({LANE_B} * {k[1]} + {k[2]}) % {PRIMES[1]}"
        if pos is not None:
            stride = f"({stride}) * ({pos} + 1)"
        return f"((({LANE_A} * {k[0]} + {stride} + {k[5]}) % {PRIMES[0]} * {k[3]} + {k[4]}) % {PRIMES[1]})"

    def below(self, bound: int, path: str, pos: str | None = None) -> str:
        return f"({self.number(path, pos)} % {bound})"

    def boolean(self, path: str, pos: str | None = None) -> str:
        return f"({self.below(2, path, pos)} = 0)"

    def byte(self, path: str, pos: str | None = None) -> str:
        return f"CAST({self.below(256, path, pos)} - 128 AS TINYINT)"

    def short(self, path: str, pos: str | None = None) -> str:
        return f"CAST({self.below(32768, path, pos)} AS SMALLINT)"

    def integer(self, path: str, pos: str | None = None) -> str:
        return f"CAST(({self.number(path, pos)} - {1 << 30}) * 2 + {self.below(2, path + '+', pos)} AS INT)"

    def long(self, path: str, pos: str | None = None) -> str:
        top, middle, low = self.number(path, pos), self.number(path + "+", pos), self.below(4, path + "++", pos)
        return f"(({top} - {1 << 30}) * {1 << 33} + {middle} * 4 + {low})"

    def fraction(self, path: str, pos: str | None = None) -> str:
        """Double in [0, 1) with 53 random bits."""
        bits = f"{self.number(path, pos)} * {1 << 22} + {self.below(1 << 22, path + '+', pos)}"
        return f"(CAST({bits} AS DOUBLE) / CAST({1 << 53} AS DOUBLE))"

    def gaussian(self, path: str, pos: str | None = None) -> str:
        """Sum of twelve uniforms minus six. The sum is of integers, so it is exact."""
        total = " + ".join(self.number(f"{path}~{term}", pos) for term in range(GAUSSIAN_TERMS))
        return f"(CAST({total} AS DOUBLE) / CAST({PRIMES[1]} AS DOUBLE) - CAST(6 AS DOUBLE))"

    def skewed(self, buckets: int, degree: int, path: str, pos: str | None = None) -> str:
        """Bucket in [0, buckets): a bounded bell whose spread shrinks as ``degree`` grows."""
        if degree <= 0:
            return self.below(buckets, path, pos)
        one = "CAST(1 AS DOUBLE)"
        bell = f"{one} / ({one} + exp(-({self.gaussian(path, pos)} / CAST({degree} AS DOUBLE))))"
        return f"least(CAST({buckets - 1} AS BIGINT), CAST(floor(({bell}) * CAST({buckets} AS DOUBLE)) AS BIGINT))"

    def letters(self, path: str, length: str | int, longest: int, pos: str | None = None) -> str:
        """Letters-only string of ``length`` (at most ``longest``) characters."""
        parts = [ROW_HASH, f"'|{path}'"]
        if pos is not None:
            parts += ["'|'", f"CAST({pos} AS STRING)"]
        return letters_from(f"concat({', '.join(parts)})", length, longest)


def letters_from(text: str, length: str | int, longest: int) -> str:
    """Letters derived from ``text``: base64 of its hash with the non-letters replaced. Strings
    longer than one hash are assembled chunk by chunk."""

    def chunk(number: str) -> str:
        encoded = f"base64(unhex(sha2(concat({text}, '|', {number}), 256)))"
        return f"substring(mask({encoded}, NULL, NULL, '{DIGIT_LETTER}', '{SIGN_LETTER}'), 1, {LETTERS_PER_HASH})"

    size = f"CAST({length} AS INT)"
    if longest <= LETTERS_PER_HASH:
        full = chunk("'0'")
    elif longest <= 2 * LETTERS_PER_HASH:
        full = f"concat({chunk(chr(39) + '0' + chr(39))}, IF({size} > {LETTERS_PER_HASH}, {chunk(chr(39) + '1' + chr(39))}, ''))"
    else:
        last = f"greatest(CAST(ceil({size} / {LETTERS_PER_HASH}) AS INT) - 1, 0)"
        full = f"array_join(transform(sequence(0, {last}), _c -> {chunk('CAST(_c AS STRING)')}), '')"
    return f"substring({full}, 1, {size})"
