"""Substring dedup with a compressed FM-index per shard.

A window is 50 consecutive words. A word goes if some window that covers it also starts in a document
with a smaller id. Comparing every document with an index of every other would cost the square of the
corpus, so windows first find their shard:

1. Each window names an anchor, its least 10-word hash; equal windows name equal anchors. Runs of windows with one
   anchor form a context, known by a hash of its words (long documents are never held as windows).
2. Contexts are counted by anchor and hash. Anchors seen in one document only are done. Of equal contexts,
   the smallest document keeps one for the index; the others are covered whole.
3. Anchors with several different contexts go to shards by anchor. A shard's contexts form one text with
   a Burrows-Wheeler transform in a wavelet matrix of packed bits (the FM-index) and a sparse table of least
   documents. Every context is streamed against it from right to left by backward search, until its suffix-array interval holds
   no smaller document: the matching statistics. Stretches of at least 50 words are reported.
4. An anchor with more than ``hot_contexts`` contexts would outgrow a shard: its contexts are split into single windows, counted
   by hash like contexts in step 2, which settles them.

Words are compared by 64-bit hashes. Nothing larger than one document or one shard is held by a task.

Defined results: null and empty texts have no words (the digest is that of the empty string); documents below
50 words are kept whole; rows without id keep all words and remove none elsewhere; repeated rows of
one id do not remove each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, stored, texts

WINDOW = 50
GRAM = 10  # words of an anchor
RUN = 64  # windows of a context at most
PRIME = 0x9E3779B97F4A7C15  # odd multiplier of all polynomial hashes, modulo 2**64
INVERSE = pow(PRIME, -1, 1 << 64)
KNOWN_WORDS = 300_000


@dataclass(frozen=True)
class Plan:
    window: int = WINDOW
    hot_contexts: int = 8_000
    shard_words: int = 1_000_000


class WordHashes(dict):
    """Word to 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KNOWN_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scrambled(values: np.ndarray) -> np.ndarray:
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Ranges:
    """Hashes of any stretch of words, from running sums of a polynomial."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(PRIME, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return scrambled(value ^ (ends - starts).astype(np.uint64) * np.uint64(INVERSE))


def least_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - reach :])


def sites_of(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, context hash, start, windows): runs of windows that share their anchor, at most ``RUN`` each."""
    n = len(hashes)
    ranges = Ranges(hashes)
    starts = np.arange(n - GRAM + 1)
    anchor = least_of_windows(ranges.of(starts, starts + GRAM), window - GRAM + 1)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.diff(np.concatenate((first, [len(anchor)])))
    if count.max() > RUN:  # repetitive text
        pieces = -(-count // RUN)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, count = np.repeat(first, pieces) + number * RUN, np.minimum(RUN, np.repeat(count, pieces) - number * RUN)
    return anchor[first], ranges.of(first, first + count - 1 + window), first, count


def sites(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, anchor, context, windows, starts): one row per document and context, with every place."""
    known = WordHashes()

    def run(batch: pa.RecordBatch):
        rows, places = [], []
        for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), texts(batch), strict=True):
            words = text.encode().split()
            if len(words) >= window:
                anchor, context, first, count = sites_of(known.of(words), window)
                order = np.argsort(context, kind="stable")
                context = context[order]
                one = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
                pick = order[one]
                rows.append((np.full(len(one), doc_id), np.full(len(one), key), anchor[pick].view(np.int64), context[one].view(np.int64), count[pick]))
                places.append((np.diff(np.concatenate((one, [len(order)]))), first[order]))
        if rows:
            sizes = np.concatenate([p[0] for p in places])
            starts = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate([p[1] for p in places]), pa.int32())
            )
            yield [*[np.concatenate(column) for column in zip(*rows, strict=True)], starts]

    return map_rows(
        docs.filter("doc_id IS NOT NULL"), run, "doc_id long, text_key int, anchor long, context long, windows int, starts array<int>"
    )


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("text_key"), "text")


# -- the index


LOW_BITS = np.array([(1 << k) - 1 for k in range(64)], np.uint64)


class BitRank:
    """Packed bits with counts every 64: rank in constant time at 1.5 bits a bit."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & LOW_BITS[at & 63])


class FmIndex:
    """Backward search over the wavelet matrix of a BWT; suffixes are sorted by ``order`` symbols."""

    def __init__(self, text: np.ndarray, owner: np.ndarray, order: int):
        """``text``: symbols from 0 (separator); ``owner``: document rank of every position."""
        self.n, self.sigma = len(text), int(text.max(initial=0)) + 1
        suffixes = sorted_suffixes(text, order)
        bwt = text[suffixes - 1]
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))))
        self.levels = []
        rest = bwt
        for bit in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            bits = (rest >> bit & 1).astype(np.uint8)
            rank = BitRank(bits)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((bit, rank, zeros))
            rest = np.concatenate((rest[bits == 0], rest[bits == 1]))
        # Where each symbol's block starts after the last level.
        self.block = np.zeros(self.sigma + 1, np.int64)
        present, first = np.unique(rest, return_index=True)
        self.block[present] = first
        # Row k: least document of the 2**k suffixes from each place on (a sparse table).
        self.least = np.empty((max(1, self.n.bit_length()), self.n), np.int32)
        self.least[0] = owner[suffixes]
        for level in range(1, len(self.least)):
            half, before = 1 << (level - 1), self.least[level - 1]
            self.least[level] = before
            np.minimum(before[:-half], before[half:], out=self.least[level, :-half])
        self.least = self.least.ravel()

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern, from those of the pattern."""
        both = np.concatenate((low, high))
        twice = np.concatenate((symbol, symbol))
        for bit, rank, zeros in self.levels:
            ones = rank.ones(both)
            both = np.where(twice >> bit & 1, zeros + ones, both - ones)
        both += np.concatenate((self.below[symbol] - self.block[symbol],) * 2)
        return both[: len(low)], both[len(low) :]

    def least_owner(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest document rank in each interval; beyond all ranks where it is empty."""
        size = high - low
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1].astype(np.int64) - 1
        row = level * self.n
        first = np.minimum(low, self.n - 1)  # of empty intervals any place will do
        last = np.maximum(high - (np.int64(1) << level), 0)
        found = np.minimum(self.least[row + first], self.least[row + last])
        return np.where(size > 0, found, np.iinfo(np.int32).max)


def sorted_suffixes(text: np.ndarray, order: int) -> np.ndarray:
    """Positions sorted by their first ``order`` symbols (cyclically), by prefix doubling."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, width = rank.astype(np.int64), 1
    where = np.argsort(rank)
    while width < order:
        key = rank * n + np.roll(rank, -width)
        where = np.argsort(key)  # equal keys may stand in any order
        ordered = key[where]
        rank = np.empty(n, np.int64)
        rank[where] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        width *= 2
        if rank[where[-1]] == n - 1:
            break
    return where


def dead_ends(index: FmIndex, text: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each stretch, the greatest p >= start with text[p:end] in no smaller document; start - 1 if none.

    Backward search from the right; a stretch leaves the search when its interval has no smaller document.
    """
    out = start - 1
    live = np.flatnonzero(end > start)
    low, high, at = np.zeros(len(live), np.int64), np.full(len(live), index.n, np.int64), end[live] - 1
    while len(live):
        low, high = index.step(text[at], low, high)
        alive = index.least_owner(low, high) < own[live]
        out[live[~alive]] = at[~alive]
        more = alive & (at > start[live])
        live, low, high, at = live[more], low[more], high[more], at[more] - 1
    return out


def covered_stretches(index: FmIndex, text: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray, window: int) -> list[tuple[np.ndarray, ...]]:
    """[(context, from, to)] of the stretches of at least ``window`` words that smaller documents hold.

    From the right end, a search runs to the first p where text[p:end] dies; what it passed is alive. Bisection
    finds the shortest text[p:cut] that is dead, and since no window may hold that, the next stretch ends before cut.
    """
    found = []
    who, first, last = np.arange(len(start)), start.copy(), end.copy()
    while len(who):
        dead = dead_ends(index, text, first, last, own[who])
        long = last - dead - 1 >= window
        found.append((who[long], dead[long] + 1, last[long]))
        rest = (dead >= first) & (dead + window > first)  # some window starts at or before p
        rest &= last - 1 - first >= window
        who, first, dead, last = who[rest], first[rest], dead[rest], last[rest]
        if not len(who):
            break
        alive_to, dead_to = dead.copy(), np.minimum(last, dead + window)
        # text[p : p + window] may be alive where the longer stretch is not; then nothing is cut off.
        short = dead_ends(index, text, dead, dead_to, own[who]) < dead
        whole = short & (dead_to < last)
        open_ = np.flatnonzero(~whole)
        alive_to[whole] = dead_to[whole]
        while len(open_):
            middle = (alive_to[open_] + dead_to[open_]) // 2
            todo = dead_to[open_] - alive_to[open_] > 1
            open_, middle = open_[todo], middle[todo]
            if not len(open_):
                break
            fine = dead_ends(index, text, dead[open_], middle, own[who[open_]]) < dead[open_]
            alive_to[open_[fine]] = middle[fine]
            dead_to[open_[~fine]] = middle[~fine]
        last = alive_to
        fits = last - first >= window
        who, first, last = who[fits], first[fits], last[fits]
    return found


# -- Spark


def fetch(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    known = WordHashes()
    lists = wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", "windows", "anchor", "context", "hot")).alias("spots")  # at most a document's words
    )

    def run(batch: pa.RecordBatch):
        for doc_id, text, spots in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("spots").to_pylist(), strict=True):
            hashes = known.of(text.encode().split())
            ranges = Ranges(hashes)
            signed = hashes.view(np.int64)
            rows = []
            for spot in spots:
                start, stop = spot["start"], spot["start"] + spot["windows"] - 1 + window
                if spot["hot"]:
                    begins = np.arange(start, start + spot["windows"])
                    words, keys = None, ranges.of(begins, begins + window).view(np.int64)
                else:
                    words, keys = signed[start:stop], None
                rows.append((spot["anchor"], spot["context"], doc_id, words, keys))
            yield list(map(list, zip(*rows, strict=True)))

    # Repeated rows of one text hold the same contexts.
    joined = docs.join(lists, ["doc_id", "text_key"]).select("doc_id", "text", "spots")
    return map_rows(joined, run, "anchor long, context long, first long, words array<long>, keys array<long>")


def search_shard(table: pa.Table, window: int) -> pa.Table:
    """(anchor, context, from, to) of the covered stretches of one shard's contexts."""
    words = table.column("words").combine_chunks()
    flat, ends = words.flatten().to_numpy(), np.diff(words.offsets.to_numpy())
    doc, own = np.unique(table.column("first").to_numpy(), return_inverse=True)
    names, symbols = np.unique(flat, return_inverse=True)
    count = len(ends)
    start = np.cumsum(ends + 1) - ends - 1  # each context is followed by a separator
    text = np.zeros(len(flat) + count, np.int64)
    place = np.arange(len(flat)) + np.repeat(np.arange(count), ends)
    text[place] = symbols + 1
    owner = np.repeat(own, ends + 1)
    longest = int(ends.max(initial=0))
    index = FmIndex(text, owner, longest + 1)
    found = covered_stretches(index, text, start, start + ends, own.astype(np.int64), window)
    who = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
    begin = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)]) - start[who]
    stop = np.concatenate([f[2] for f in found] or [np.zeros(0, np.int64)]) - start[who]
    return pa.table(
        {
            "anchor": table.column("anchor").combine_chunks().take(pa.array(who)),
            "context": table.column("context").combine_chunks().take(pa.array(who)),
            "from": pa.array(begin, pa.int32()),
            "to": pa.array(stop, pa.int32()),
        }
    )


def spans(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, text_key, from, to): word ranges that smaller documents hold."""
    window = plan.window
    found = stored(sites(docs, window), "fm-sites")
    contexts = found.groupBy("anchor", "context").agg(
        F.min(F.struct("doc_id", "text_key", F.get("starts", F.lit(0)).alias("start"), "windows")).alias("one"), F.max("doc_id").alias("last")
    )
    contexts = contexts.select("anchor", "context", "one.*", "last")
    shared = (
        contexts.groupBy("anchor")
        .agg(F.count("*").alias("contexts"), F.min("doc_id").alias("low"), F.max("last").alias("high"))
        .filter("low < high")
        .select("anchor", "contexts")
    )
    known = stored(contexts.join(shared, "anchor"), "fm-shared")
    wanted = known.filter("contexts > 1").withColumn("hot", F.col("contexts") > plan.hot_contexts)
    fetched = stored(fetch(docs, wanted, window), "fm-words")  # repeated rows repeat contexts, which changes nothing
    total = fetched.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(1, -(-total // plan.shard_words))
    searched = (
        fetched.filter("words IS NOT NULL")
        .select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "context", "first", "words")
        .groupBy("shard")
        .applyInArrow(lambda table: search_shard(table, window), "anchor long, context long, from int, to int")
    )
    windows = fetched.filter("keys IS NOT NULL").select("anchor", "context", "first", F.posexplode("keys").alias("from", "key"))
    least = windows.groupBy("anchor", "key").agg(F.min("first").alias("least"))
    settled = windows.join(least, ["anchor", "key"]).filter("least < first").select("anchor", "context", "from", (F.col("from") + window).alias("to"))
    stretches = searched.unionByName(settled).groupBy("anchor", "context").agg(F.collect_list(F.struct("from", "to")).alias("parts"))
    verdicts = known.select("anchor", "context", F.col("doc_id").alias("first")).join(stretches, ["anchor", "context"], "left")
    rows = found.join(verdicts, ["anchor", "context"])
    whole = F.array(F.struct(F.lit(0).alias("from"), (F.col("windows") - 1 + window).alias("to")))
    parts = F.when(F.col("first") < F.col("doc_id"), whole).otherwise(F.col("parts"))
    places = rows.filter(F.size(parts) > 0).select("doc_id", "text_key", parts.alias("parts"), F.explode("starts").alias("start"))
    return places.select("doc_id", "text_key", "start", F.inline("parts")).select(
        "doc_id", "text_key", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to")
    )


def deduplicated(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every document."""
    slim = keyed(docs)
    lists = spans(slim, plan).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("from", "to")).alias("cuts"))
    lists = stored(lists, "fm-cuts")

    def run(batch: pa.RecordBatch):
        rows = []
        for text, cuts in zip(texts(batch), batch.column("cuts").to_pylist(), strict=True):
            words = text.encode().split()
            total = len(words)
            for low, high in reversed(merged([(c["from"], c["to"]) for c in cuts or ()])):
                del words[low:high]
            kept = b" ".join(words)
            rows.append((total, total - len(words), hashlib.sha256(kept).hexdigest(), kept.decode()))
        if rows:
            yield [batch.column("doc_id"), *map(list, zip(*rows, strict=True))]

    joined = slim.join(lists, ["doc_id", "text_key"], "left").select("doc_id", "text", "cuts")
    return map_rows(joined, run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out
