"""Phrase collocations from one bidirectional FM-index over word ids per shard.

1. Each task cuts its documents into shards of about ``shard_words`` words: one text of shard-local word numbers, 0 between
   pieces, and the words behind the numbers. Words are counted over all shards; those used less than ``least``
   times cannot be in a phrase that is, and become 0.
2. A shard's index holds the Burrows-Wheeler transforms of its text and of the reversed text, sorted by as
   many symbols as a phrase has words. It is written once; a wavelet matrix of packed bits is built over each when it is read.
3. A phrase is a pair of intervals, one in each transform, kept in step: listing the symbols of the first interval gives
   all its extensions to the left with their counts, listing those of the second all to the right. Pairs come from extending words.
   A shard sends its phrases of one length with their counts, dealt into parts by their words, each part as one packed block; a
   task adds up a part. Each shard gets back one bit for each phrase that it sent, set if all shards together use it often enough; it lists its
   phrases anew, extends those, right and left in turn, by words that make another such pair, and sends the next length.

Everything is kept apart by language: a shard's word numbers are those of (language, word). What a phrase's longest
neighbours say (``drop``) needs the one-word extensions only: a longer phrase that holds it holds such an extension,
which is used at least as often.

Memory of a task: one shard, or one document where that is longer; where counts are added, one part, which has about
``PART_ROWS`` phrases at most, since the number of parts grows with the words.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count each time; ids
and other columns are not read; very long texts are read whole; ties are ordered as the query says; an empty table, or one
in which no phrase is used ``least`` times, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import scratch, stored
from millrace.llm.fmindex import BitRank
from millrace.session import scoped_conf

LEAST = 30
MOST_WORDS = 4
SHARD_WORDS = 1_500_000
LOT = 1 << 19  # occurrences whose extensions are listed at a time
PART_ROWS = 500_000  # phrases whose counts a task adds up at once
EDGE = b"\xff"  # in no UTF-8 text
FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + EDGE * 10 + b" ")
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # each step is stored, so its shuffle files can go

SHARD = "shard long, number int, lang string, word binary, uses long, text binary"
INDEX = "shard long, ids binary, forward binary, backward binary"
BLOCK = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])
SUMMED = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("size", pa.int32()), ("bits", pa.binary()), ("ids", pa.list_(pa.int64())), ("f", pa.int64())])


# -- shards


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, and ``EDGE`` between pieces."""
    return text.translate(FOLD).replace(EDGE, b" \xff ").split()


class Numbers(dict):
    """Word to number, from 1 in order of arrival, for one language of a shard; edges are 0."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        super().__init__({EDGE: 0})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        self[word] = number = len(self.names)
        return number


class Gathering:
    """The shard that a task is filling."""

    def __init__(self):
        self.names: list[tuple[str, bytes]] = []
        self.langs: dict[str, Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        numbers = self.langs.get(lang) or self.langs.setdefault(lang, Numbers(lang, self.names))
        words = tokens(text)
        part = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.parts += [part, np.zeros(1, np.int32)]
        self.size += len(part) + 1

    def rows(self, shard: int) -> pa.RecordBatch:
        text = np.concatenate(self.parts)
        uses = np.bincount(text, minlength=len(self.names) + 1)[1:]
        n = len(uses)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, shard)),
                pa.array(np.arange(n + 1, dtype=np.int32)),
                pa.array([None, *(lang for lang, _ in self.names)], pa.string()),
                pa.array([None, *(word for _, word in self.names)], pa.binary()),
                pa.array(np.concatenate(([0], uses)).astype(np.int64)),
                pa.array([packed(text), *[None] * n], pa.binary()),
            ],
            names=["shard", "number", "lang", "word", "uses", "text"],
        )


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpacked(data: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def word_shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per shard one row with its text (number 0) and one for each of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = TaskContext.get().partitionId() << 32, Gathering()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.add(lang, text)
                if held.size >= shard_words:
                    yield held.rows(shard)
                    shard, held = shard + 1, Gathering()
        if held.size:
            yield held.rows(shard)

    read = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    return stored(read.mapInArrow(run, SHARD), "collocations-shards")


# -- the index of a shard


def transform_of(text: np.ndarray, depth: int) -> np.ndarray:
    """Symbols before the suffixes of a cyclic text, suffixes sorted by ``depth`` symbols."""
    rank, width = text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        where = np.argsort(key)  # equal keys may stand in any order
        width *= 2
        if width >= depth:
            return text[where - 1]
        ordered = key[where]
        rank = np.empty(len(text), np.int64)
        rank[where] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))


class Wavelet:
    """A wavelet matrix over a Burrows-Wheeler transform."""

    def __init__(self, bwt: np.ndarray, sigma: int):
        self.bwt, self.sigma = bwt, sigma
        self.below = np.concatenate(([0], np.cumsum(np.bincount(bwt, minlength=sigma))))

    @cached_property
    def built(self) -> tuple[list[tuple[int, BitRank, int]], np.ndarray]:
        """The levels, and the shift from the last level to the sorted order; made when intervals are first asked for."""
        levels, rest = [], self.bwt
        for bit in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            bits = (rest >> bit & 1).astype(np.uint8)
            ones = bits.astype(bool)
            levels.append((bit, BitRank(bits), int(len(bits) - bits.sum())))
            rest = np.concatenate((rest[~ones], rest[ones]))
        first = np.flatnonzero(np.concatenate(([True], rest[1:] != rest[:-1])))
        shift = np.zeros(self.sigma, np.int64)
        shift[rest[first]] = self.below[rest[first]] - first
        return levels, shift

    def narrow(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of symbol + phrase, and the number of smaller symbols in those of the phrase."""
        smaller = np.zeros(len(symbol), np.int64)
        levels, shift = self.built
        for bit, rank, zeros in levels:
            low_ones, high_ones = rank.ones(low), rank.ones(high)
            one = (symbol >> bit & 1).astype(bool)
            smaller += np.where(one, high - low - (high_ones - low_ones), 0)
            low, high = np.where(one, zeros + low_ones, low - low_ones), np.where(one, zeros + high_ones, high - high_ones)
        return low + shift[symbol], high + shift[symbol], smaller

    def spread(self, low: np.ndarray, high: np.ndarray):
        """(place of the interval, symbol, its interval, number of smaller symbols) for each symbol in each interval."""
        place, symbol, smaller = np.arange(len(low)), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        levels, shift = self.built
        for bit, rank, zeros in levels:
            low_ones, high_ones = rank.ones(low), rank.ones(high)
            ones = high_ones - low_ones
            left, right = np.flatnonzero(high - low > ones), np.flatnonzero(ones)
            smaller = np.concatenate((smaller[left], (smaller + (high - low - ones))[right]))
            low, high = (
                np.concatenate(((low - low_ones)[left], (zeros + low_ones)[right])),
                np.concatenate(((high - high_ones)[left], (zeros + high_ones)[right])),
            )
            place = np.concatenate((place[left], place[right]))
            symbol = np.concatenate((symbol[left], symbol[right] | 1 << bit))
        return place, symbol, low + shift[symbol], high + shift[symbol], smaller


class TwoWay:
    """Phrases as pairs of intervals ``(at, back, size)`` in the transform of the text and in that of the reversed text."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, sigma: int):
        self.forward, self.backward = Wavelet(forward, sigma), Wavelet(backward, sigma)

    @classmethod
    def of(cls, text: np.ndarray, depth: int) -> TwoWay:
        return cls(transform_of(text, depth), transform_of(text[::-1], depth), int(text.max(initial=0)) + 1)

    def words(self, symbol: np.ndarray):
        start = self.forward.below[symbol]
        return start, start, self.forward.below[symbol + 1] - start

    def left(self, symbol, at, back, size):
        """The intervals of symbol + phrase."""
        low, high, smaller = self.forward.narrow(symbol, at, at + size)
        return low, back + smaller, high - low

    def right(self, symbol, at, back, size):
        low, high, smaller = self.backward.narrow(symbol, back, back + size)
        return at + smaller, low, high - low

    def lefts(self, at, back, size):
        """(place of the phrase, symbol, intervals) of every extension to the left, edges among them."""
        place, symbol, low, high, smaller = self.forward.spread(at, at + size)
        return place, symbol, (low, back[place] + smaller, high - low)

    def rights(self, at, back, size):
        place, symbol, low, high, smaller = self.backward.spread(back, back + size)
        return place, symbol, (at[place] + smaller, low, high - low)


def lots(size: np.ndarray) -> Iterator[slice]:
    """Runs of phrases with about ``LOT`` occurrences together."""
    start, ends = 0, np.cumsum(size)
    while start < len(size):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + LOT, "right")))
        yield slice(start, stop)
        start = stop


def word_pairs(index: TwoWay, sigma: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, next word, count) of every pair: all extensions of all words to the left, read off the transform at once."""
    word = np.repeat(np.arange(sigma), np.diff(index.forward.below[: sigma + 1]))
    codes, n = np.unique(word * sigma + index.forward.bwt, return_counts=True)
    word, before = np.divmod(codes, sigma)
    real = (word > 0) & (before > 0)
    yield before[real], word[real], n[real]


def longer_phrases(
    index: TwoWay, sigma: int, first: np.ndarray, second: np.ndarray, most_words: int, wanted: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, count) of the phrases of 3 words and more all of whose pairs are among the given ones.

    ``wanted`` says which of the phrases that are not of the full length are extended.
    """
    known = np.sort(first * sigma + second)

    def often(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * sigma + b
        return known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key

    for lot in lots(index.left(first, *index.words(second))[2]):
        words, where = np.column_stack((first[lot], second[lot])), index.left(first[lot], *index.words(second[lot]))
        for length in range(3, most_words + 1):
            if length % 2:
                place, symbol, where = index.rights(*where)
                keep = np.flatnonzero((symbol > 0) & often(words[place, -1], symbol))
                words = np.column_stack((words[place[keep]], symbol[keep]))
            else:
                place, symbol, where = index.lefts(*where)
                keep = np.flatnonzero((symbol > 0) & often(symbol, words[place, 0]))
                words = np.column_stack((symbol[keep], words[place[keep]]))
            where = tuple(side[keep] for side in where)
            yield words, where[2]
            if wanted and length < most_words:
                keep = np.flatnonzero(wanted(words))
                words, where = words[keep], tuple(side[keep] for side in where)


# -- Spark


def indexes(shards: DataFrame, known: DataFrame, depth: int) -> DataFrame:
    """(shard, ids, forward, backward): transforms over the shard's ``known`` (shard, number, id) words; ``ids`` names symbol 1, 2, ..."""

    def build(texts: pa.Table, words: pa.Table) -> pa.Table:
        number, ids = words.column("number").to_numpy(), words.column("id").to_numpy()
        rows = []
        if texts.num_rows and len(ids):
            text = unpacked(texts.column("text")[0].as_py())
            order = np.argsort(ids)
            symbol = np.zeros(int(text.max()) + 1, np.int32)
            symbol[number[order]] = np.arange(1, len(ids) + 1)
            text = symbol[text]
            text = text[(text != 0) | (np.roll(text, 1) != 0)]
            forward, backward = transform_of(text, depth), transform_of(text[::-1], depth)
            rows = [(texts.column("shard")[0].as_py(), packed(ids[order]), packed(forward), packed(backward))]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "ids", "forward", "backward"])

    texts = shards.filter("text IS NOT NULL").select("shard", "text")
    words = known.select(F.col("shard").alias("of"), "number", "id")
    return stored(texts.groupBy("shard").cogroup(words.groupBy("of")).applyInArrow(build, INDEX), "collocations-index", keep=True)


def opened(ids: bytes, forward: bytes, backward: bytes) -> tuple[np.ndarray, TwoWay, int]:
    names = unpacked(ids, np.int64)
    sigma = len(names) + 1
    return names, TwoWay(unpacked(forward), unpacked(backward), sigma), sigma


def block(words: np.ndarray, n: np.ndarray) -> bytes:
    """Ids of phrases and their counts, packed: a byte of all numbers, then the next."""
    numbers = np.concatenate((words.T, n[None]), dtype=np.int64, casting="unsafe")
    return packed(numbers.reshape(-1, 1).view(np.uint8).T)


def unblocked(data: bytes, columns: int) -> np.ndarray:
    """A row for each place of the phrases, and one of counts."""
    return np.ascontiguousarray(unpacked(data, np.uint8).reshape(8, -1).T).view(np.int64).reshape(columns, -1)


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    code = np.zeros(len(ids), np.uint64)
    for column in ids.T:
        code = (code ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return (code % np.uint64(parts)).astype(np.int64)


def blocks(shard: int, ids: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row per part that has phrases; within a part they keep their order."""
    part = part_of(ids, parts)
    order = np.argsort(part, kind="stable")
    part, ids, n = part[order], ids[order], n[order]
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
    data = [block(ids[a:b], n[a:b]) for a, b in zip(starts, [*starts[1:], len(part)], strict=True)] if len(part) else []
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), shard)), pa.array(part[starts].astype(np.int32)), pa.array(data, pa.binary())], schema=BLOCK)


class Passed:
    """What came back for a shard's phrases of one length, asked in the order in which they were sent."""

    def __init__(self, bits: pa.Table, names: np.ndarray, parts: int):
        self.names, self.parts, self.used = names, parts, np.zeros(parts, np.int64)
        each = {p: np.unpackbits(np.frombuffer(b, np.uint8), count=n) for p, n, b in zip(*(bits.column(c).to_pylist() for c in ("part", "size", "bits")), strict=True)}
        self.flat = np.concatenate([np.zeros(0, np.uint8), *each.values()]).astype(bool)
        self.starts = np.zeros(parts, np.int64)
        self.starts[list(each)] = np.cumsum([0, *map(len, each.values())])[:-1]

    def __call__(self, words: np.ndarray) -> np.ndarray:
        part = part_of(self.names[words - 1], self.parts)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(part), np.int64)
        place[order] = np.arange(len(part)) - np.searchsorted(part[order], part[order])
        out = self.flat[self.starts[part] + self.used[part] + place]
        self.used += np.bincount(part, minlength=self.parts)
        return out


def pairs_of(index: DataFrame, parts: int) -> DataFrame:
    """Blocks of every pair of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                names, two_way, sigma = opened(row["ids"], row["forward"], row["backward"])
                for a, b, n in word_pairs(two_way, sigma):
                    yield blocks(row["shard"], names[np.column_stack((a, b)) - 1], n, parts)

    return index.mapInArrow(run, "shard long, part int, data binary")


def longer_of(index: DataFrame, passed: DataFrame, length: int, parts: int) -> DataFrame:
    """Blocks of the shards' phrases of ``length`` words; ``passed`` holds the bits (shard, length, part, size, bits) of shorter ones."""

    def extend(shard: pa.Table, bits: pa.Table) -> pa.Table:
        out = []
        if shard.num_rows and bits.num_rows:
            names, two_way, sigma = opened(*(shard.column(c)[0].as_py() for c in ("ids", "forward", "backward")))
            often = {k: Passed(bits.filter(pc.equal(bits.column("length"), k)), names, parts) for k in range(2, length)}
            pairs = np.concatenate([np.column_stack((a, b)) for a, b, _ in word_pairs(two_way, sigma)])
            first, second = pairs[often[2](pairs)].T
            if len(first):
                found = [(w, n) for w, n in longer_phrases(two_way, sigma, first, second, length, lambda w: often[w.shape[1]](w)) if w.shape[1] == length]
                words, n = (np.concatenate(side) for side in zip(*found, strict=True))
                out.append(blocks(shard.column("shard")[0].as_py(), names[words - 1], n, parts))
        return pa.Table.from_batches(out, schema=BLOCK)

    back = passed.withColumnRenamed("shard", "of")
    return index.groupBy("shard").cogroup(back.groupBy("of")).applyInArrow(extend, "shard long, part int, data binary")


def summed(sent: DataFrame, length: int, least: int) -> DataFrame:
    """For each block its bits, (shard, part, size, bits); and (ids, f) of every phrase used ``least`` times in all shards together."""

    def add(part: pa.Table) -> pa.Table:
        each = [unblocked(data, length + 1) for data in part.column("data").to_pylist()]
        rows = np.concatenate(each, axis=1)
        order = np.lexsort(rows[:-1])
        rows = rows[:, order]
        new = np.concatenate(([True], (rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0)))
        starts = np.flatnonzero(new)
        f = np.add.reduceat(rows[-1], starts)
        often = f >= least
        bit = np.empty(len(order), bool)
        bit[order] = often[np.cumsum(new) - 1]
        cuts = np.cumsum([0, *(e.shape[1] for e in each)])
        bits = [np.packbits(bit[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        ids, none = rows[:-1, starts[often]].T, int(often.sum())
        back = pa.Table.from_arrays(
            [part.column("shard"), part.column("part"), pa.array(np.diff(cuts).astype(np.int32)), pa.array(bits, pa.binary()), pa.nulls(len(each), SUMMED.field("ids").type), pa.nulls(len(each), pa.int64())],
            schema=SUMMED,
        )
        lists = pa.ListArray.from_arrays(pa.array(np.arange(none + 1, dtype=np.int32) * length), pa.array(np.ascontiguousarray(ids).ravel()))
        empty = [pa.nulls(none, SUMMED.field(c).type) for c in ("shard", "part", "size", "bits")]
        return pa.concat_tables([back, pa.Table.from_arrays([*empty, lists, pa.array(f[often])], schema=SUMMED)])

    done = sent.groupBy("part").applyInArrow(add, "shard long, part int, size int, bits binary, ids array<long>, f long")
    return stored(done, f"collocations-{length}")


def used_often(rows: DataFrame, key: list[str], place: list[str], count: str, least: int) -> DataFrame:
    """The rows whose key is counted ``least`` times in all shards together, with ``f``, that count, and ``id``.

    A word has one row a shard at most, so summing before the shuffle saves nothing. Both sides of the join name the same
    columns, so one shuffle serves both (``last_`` is there for that). A task holds whole keys: the numbers that it gives
    them stand in its own output only.
    """
    real = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    dealt = rows.select(*key, *place, count).filter(real).repartition(*[F.col(k) for k in key])
    sums = dealt.groupBy(*key).agg(F.sum(count).alias("f"), *[F.max(c).alias(f"last_{c}") for c in place])
    seen = reduce(Column.__and__, [F.col(f"last_{c}").isNotNull() for c in place])
    often = sums.filter((F.col("f") >= least) & seen).select(*key, "f", F.monotonically_increasing_id().alias("id"))
    return dealt.join(often.hint("shuffle_hash"), key)


def phrase_counts(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): (ids, f) of every phrase of up to ``most_words`` words used ``least`` times in its
    language, words themselves included; (id, lang, word) of those words; (lang, n) of all word occurrences."""
    if most_words < 2 or least < 1:
        raise ValueError("phrases have two words at least and are used once at least")
    spark = docs.sparkSession
    with scratch(spark):
        with scratch(spark):  # the shards themselves are not needed beyond their indexes
            shards = word_shards(docs, shard_words)
            uses = shards.filter("number > 0")
            totals = stored(uses.groupBy("lang").agg(F.sum("uses").alias("n")), "collocations-totals", keep=True)
            known = stored(used_often(uses, ["lang", "word"], ["shard", "number"], "uses", least), "collocations-known")
            words = stored(known.groupBy("id", "lang", "word").agg(F.max("f").alias("f")), "collocations-words", keep=True)
            index = indexes(shards, known, most_words)
        size = words.agg(F.sum("f")).first()[0] or 0
        parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_ROWS))
        phrases, passed, sent = words.select(F.array("id").alias("ids"), "f"), None, pairs_of(index, parts)
        for length in range(2, most_words + 1):
            if passed is not None:
                sent = longer_of(index, passed, length, parts)
            done = summed(sent, length, least)
            phrases = phrases.unionByName(done.filter("ids IS NOT NULL").select("ids", "f"))
            bits = done.filter("shard IS NOT NULL").select("shard", F.lit(length).alias("length"), "part", "size", "bits")
            passed = bits if passed is None else passed.unionByName(bits)
        phrases = stored(phrases, "collocations-phrases", keep=True)
        words = stored(words.select("id", "lang", "word"), "collocations-names", keep=True)
        totals = stored(totals, "collocations-sums", keep=True)
    return phrases, words, totals


def extensions(phrases: DataFrame) -> DataFrame:
    """(ids, left, right, lefts, rights): the greatest count, and the number, of a phrase's frequent one-word extensions."""
    n = F.size("ids")
    long = phrases.filter(n > 1)
    sides = F.array(
        F.struct(F.slice("ids", 2, n - 1).alias("ids"), F.col("f").alias("left"), F.lit(None).cast("long").alias("right")),
        F.struct(F.slice("ids", 1, n - 1).alias("ids"), F.lit(None).cast("long").alias("left"), F.col("f").alias("right")),
    )
    return long.select(F.inline(sides)).groupBy("ids").agg(
        F.max("left").alias("left"), F.max("right").alias("right"), F.count("left").alias("lefts"), F.count("right").alias("rights")
    )


def whole(column: str):
    return F.col(column).cast("decimal(38,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """(ids, a, l, r, cut, score) by the lowest-scoring cut, ties to the smallest; score = floor(2000000 a / (l + r))."""
    n = F.size("ids")
    cuts = phrases.filter(n > 1).select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), n - 1)).alias("cut"))
    cuts = cuts.withColumn("_head", F.slice("ids", 1, F.col("cut"))).withColumn("_tail", F.expr("slice(ids, cut + 1, size(ids) - cut)"))
    heads = phrases.select(F.col("ids").alias("_head"), F.col("f").alias("l"))
    tails = phrases.select(F.col("ids").alias("_tail"), F.col("f").alias("r"))
    both = cuts.join(heads, "_head").join(tails, "_tail")
    score = F.expr("(2000000 * cast(a AS decimal(25,0))) div (cast(l AS decimal(25,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    return both.groupBy("ids", "a").agg(lowest).select("ids", "a", "low.*")


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, first: int = 2000, inside: int = 80, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The ``first`` phrases of each language: lang, rank, phrase, a, l, r, n, score, lefts, rights.

    A phrase goes if a longer one that holds it is used ``inside`` percent as often or more. ``lefts`` and ``rights`` are the
    numbers of frequent one-word extensions. Order: score and a descending, phrase ascending by bytes.
    """
    with scoped_conf(docs.sparkSession, {CLEAN: "true"}), scratch(docs.sparkSession):
        phrases, words, totals = phrase_counts(docs, least, most_words, shard_words)
        judged = scored(phrases).join(extensions(phrases), "ids", "left")
        most = F.coalesce(F.greatest("left", "right"), F.lit(0)).cast("decimal(38,0)")
        kept = judged.filter(most * 100 < whole("a") * inside)
        named = kept.withColumn("id", F.col("ids")[0]).join(words.select("id", "lang"), "id").drop("id")
        order = [F.col("score").desc(), F.col("a").desc()]
        tied = F.rank().over(Window.partitionBy("lang").orderBy(*order))  # ties at the last place are settled by text below
        near = stored(named.withColumn("_rank", tied).filter(F.col("_rank") <= first).drop("_rank"), "collocations-near")
        spelled = near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
        texts = spelled.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
        texts = texts.select("ids", F.concat_ws(" ", F.transform("parts", lambda p: p["word"].cast("string"))).alias("phrase"))
        place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.col("phrase").asc())).cast("long")
        ranked = near.join(texts, "ids").join(totals, "lang").withColumn("rank", place).filter(F.col("rank") <= first)
        count = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("lefts", "rights")]
        return stored(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", *count), "collocations", keep=True)
