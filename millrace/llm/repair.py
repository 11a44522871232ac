"""Token ids as Re-Pair grammars: encode, compress per shard, write binary files, read back.

Documents are put in id order by range, so each task holds a consecutive stretch and writes it as one
or more files. A file is a sequence of shards of at most ``shard_ids`` ids, each with a grammar of its own:
rounds of counting adjacent pairs and replacing the frequent ones by nonterminals. Within a round
many pairs are replaced at once; where occurrences overlap, the more frequent pair wins. Each
rule keeps the number of ids it expands to, so any range of ids is found by a running sum over the
compressed sequence and only its symbols are expanded. Memory is one shard, whatever a document's length.

File: magic; shards (a fixed header, rules, expansion lengths, sequence); a footer with the document
index (ids, first id, count), the shard index (offset, first id), and its own length. Files have names unique
to the attempt; the rows that a task returns name those that count.

Encoding asks the tokenizer library for each distinct stretch between single spaces once per cache: a
cut before a space between two other characters is always a cut of the tokenizer's own pattern, so the
ids are those of the whole text. Texts that hold the literal of one of the tokenizer's added tokens, such as ``<|endoftext|>``, go to
the library as they are, which gives that token's id.

Defined results: null text is empty and gets the end id alone; null doc ids come first; repeated rows
are documents of their own; other columns are ignored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, stored, texts
from millrace.llm.warc import create, opened, own_name
from millrace.session import Folder, fresh_dir

END_ID = 2
MAGIC = b"MRRP"
HEAD = struct.Struct("<IIIIII")  # ids, symbols, rules, first nonterminal, bytes a symbol, spare
TAIL = struct.Struct("<QQ4s")  # documents, shards
CACHED = 500_000  # stretches in a generation
SLOT_BITS = 18
TAILS = ",.;:!?"
LOOKUP = 2_000  # stretches looked up at once
#: Byte-level tokenizers write bytes as printable characters: printable Latin-1 stays, the others follow from U+0100 on.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {byte: 256 + at for at, byte in enumerate(b for b in range(256) if b not in _KEPT)}
SPACE_CHAR = chr(BYTE_CHARS[32])
_DOUBLE_SPACE = re.compile(r"\s\s")
_SPACE = re.compile(r"\s")
_CUTS = re.compile(r"(?<=\S)(?= \S)")


@dataclass(frozen=True)
class Grammar:
    shard_ids: int = 1 << 20
    least_uses: int = 12  # of a pair, for a rule
    most_symbols: int = 1 << 16  # ids and nonterminals; two bytes a symbol
    file_ids: int = 1 << 26


# -- encoding


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; keeps the ids of known stretches.

    ``known`` maps a stretch without its leading space to the ids of the stretch with it. When it is full it
    becomes the older generation, from which stretches that occur again are taken over, so frequent ones stay.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = sorted(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.model = self.tokenizer.model
        self.tails: dict[str, bytes] = {"": b""}
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, values: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(values, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def encode(self, values: list[str]) -> list[bytes]:
        special = [at for at, text in enumerate(values) if self.added.search(text)]
        if not special:
            return self.stretched(values)
        out = self.stretched(["" if self.added.search(text) else text for text in values])
        for at, ids in zip(special, self.whole([values[at] for at in special]), strict=True):
            out[at] = ids
        return out

    def stretched(self, values: list[str]) -> list[bytes]:
        """Ids of texts without added tokens, stretch by stretch."""
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        cut = []
        for text in values:
            if _DOUBLE_SPACE.search(text):
                first, *rest = _CUTS.split(text)
                cut.append((first, [part[1:] for part in rest]))
            else:
                first, *rest = text.split(" ")
                cut.append((first, rest))
        found = [list(map(self.known.get, rest)) for _, rest in cut]
        new = {s for (_, rest), got in zip(cut, found, strict=True) if None in got for s, ids in zip(rest, got, strict=True) if ids is None}
        self.learn(new)
        starts = self.whole([first for first, _ in cut])
        return [
            start + b"".join(got if None not in got else map(self.known.__getitem__, rest))
            for start, (_, rest), got in zip(starts, cut, found, strict=True)
        ]

    def learn(self, stretches: set[str]) -> None:
        older = self.older.keys() & stretches
        for stretch in older:
            self.known[stretch] = self.older[stretch]
        new = stretches - older
        other = []
        for stretch in new:
            word = stretch.rstrip(TAILS)
            if word.isalpha() and (word.isascii() or max(word) < "\u0250"):
                ids = self.known.get(word) or self.word(word)
                self.known[stretch] = ids if len(word) == len(stretch) else ids + self.tail(stretch[len(word) :])
            else:
                other.append(stretch)
        plain = [s for s in other if s and not _SPACE.search(s)]
        for at in range(0, len(plain), LOOKUP):
            self.look_up(plain[at : at + LOOKUP])
        other = [s for s in other if s not in self.known]
        self.known.update(zip(other, self.whole([" " + s for s in other]), strict=True))

    def word(self, word: str) -> bytes:
        """A space and Latin letters are one piece of the tokenizer's pattern, so its model alone is asked."""
        if word.isascii():
            piece = SPACE_CHAR + word
        else:
            piece = SPACE_CHAR + word.encode().decode("latin-1").translate(BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def tail(self, marks: str) -> bytes:
        """Punctuation after a word is the next piece."""
        if marks not in self.tails:
            if len(self.tails) > LOOKUP:
                self.tails = {"": b""}
            (self.tails[marks],) = self.whole([marks])
        return self.tails[marks]

    def look_up(self, stretches: list[str]) -> None:
        """Many stretches as one text with line breaks between, which the tokenizer keeps apart.

        None of them holds a line break, so the break's own id marks where each ends.
        """
        (data,) = self.whole([" " + "\n ".join(stretches)])
        cuts = np.flatnonzero(np.frombuffer(data, "<u4") == self.line_break)
        if len(cuts) != len(stretches) - 1:
            raise RuntimeError("this tokenizer does not keep line breaks apart")
        ends = [*(4 * cuts).tolist(), len(data)]
        for stretch, start, end in zip(stretches, [0, *[e + 4 for e in ends[:-1]]], ends, strict=True):
            self.known[stretch] = data[start:end]


@lru_cache(maxsize=1)
def encoder(tokenizer_file: str) -> Encoder:
    """One per Python worker: later tasks find the vocabulary and the known stretches loaded."""
    return Encoder(tokenizer_file)


# -- Re-Pair


def frequent_pairs(symbols: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair code at each place, codes of the frequent pairs from the most frequent down)."""
    codes = symbols[:-1] << 32 | symbols[1:]
    ordered = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.concatenate((first, [len(ordered)])))
    often = np.flatnonzero(counts >= least)
    # Equal counts in scattered order: else a cycle of pairs would leave one winner in each turn.
    order = np.lexsort((slot_of(ordered[first[often]]), -counts[often]))[:most]
    return codes, ordered[first[often[order]]]


def slot_of(codes: np.ndarray) -> np.ndarray:
    return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)


def chosen_places(codes: np.ndarray, pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, rank of the pair at each): no two overlap and every pair is used ``least`` times."""
    none = len(pairs)
    # A table of hashed codes; of pairs that share a slot the most frequent keeps it in this round.
    table = np.full(1 << SLOT_BITS, none, np.int64)
    slots = slot_of(pairs)
    table[slots[::-1]] = np.arange(none)[::-1]
    rank = table[slot_of(codes)]
    rank[np.append(pairs, -1)[rank] != codes] = none
    for last in (False, True):
        taken = separated(rank, none)
        weak = np.append(np.bincount(rank[taken], minlength=none) < least, False)
        if last or not weak.any():
            break
        rank[weak[rank]] = none  # frees the neighbours of pairs that lose too many places
    taken &= ~weak[rank]
    places = np.flatnonzero(taken)
    return places, rank[places]


def separated(rank: np.ndarray, none: int) -> np.ndarray:
    """Places no two of which are adjacent, the best ranks first: turns of taking local minima.

    In a run of one rank (one symbol repeated) every other place is taken at once.
    """
    taken = np.zeros(len(rank), bool)
    left = rank.copy()
    for _ in range(4):
        best = left < none
        best[1:] &= left[1:] <= left[:-1]
        best[:-1] &= left[:-1] <= left[1:]
        again = np.flatnonzero(best[1:] & best[:-1]) + 1  # neighbours of one rank
        if len(again):
            starts = np.concatenate(([True], np.diff(again) > 1))
            first = again[starts][np.cumsum(starts) - 1] - 1
            best[again[(again - first) % 2 == 1]] = False
        taken |= best
        left[best] = none
        left[1:][best[:-1]] = none
        left[:-1][best[1:]] = none
        if np.count_nonzero(left < none) * 50 < len(left):
            break
    return taken


def compress(ids: np.ndarray, how: Grammar = Grammar()) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, rules, expansion lengths, first nonterminal)."""
    symbols = ids.astype(np.int64)
    base = int(symbols.max(initial=0)) + 1
    rules: list[np.ndarray] = []
    count = 0
    while True:  # each round with a rule shortens the sequence, so the rounds end
        free = how.most_symbols - base - count
        if len(symbols) < 2 or free <= 0:
            break
        codes, pairs = frequent_pairs(symbols, how.least_uses, free)
        if not len(pairs):
            break
        places, rank = chosen_places(codes, pairs, how.least_uses)
        if not len(places):
            break
        used, number = np.unique(rank, return_inverse=True)
        rules.append(pairs[used])
        symbols[places] = base + count + number
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        symbols = symbols[keep]
        count += len(used)
    flat = np.concatenate(rules) if rules else np.zeros(0, np.int64)
    pairs = np.stack([flat >> 32, flat & 0xFFFFFFFF], axis=1)
    return symbols, pairs, expansion_lengths(pairs, base), base


def expansion_lengths(pairs: np.ndarray, base: int) -> np.ndarray:
    lengths: list[int] = []
    for left, right in pairs.tolist():
        lengths.append((1 if left < base else lengths[left - base]) + (1 if right < base else lengths[right - base]))
    return np.array(lengths, np.int64)


class Shard:
    """A grammar opened for reading: any range of ids, without expanding the rest."""

    def __init__(self, symbols: np.ndarray, pairs: np.ndarray, lengths: np.ndarray, base: int):
        self.symbols, self.base = symbols.astype(np.int64), base
        self.sizes = np.ones(len(self.symbols), np.int64)
        inner = self.symbols >= base
        self.sizes[inner] = lengths[self.symbols[inner] - base]
        self.ends = np.cumsum(self.sizes)
        self.starts_of = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else np.zeros(0, np.int64)
        self.flat = np.zeros(int(lengths.sum()), np.int64)
        at = 0
        for left, right in pairs.tolist():  # rules refer to earlier rules only
            for part in (left, right):
                if part < base:
                    self.flat[at] = part
                    at += 1
                else:
                    start, size = self.starts_of[part - base], lengths[part - base]
                    self.flat[at : at + size] = self.flat[start : start + size]
                    at += size

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard."""
        if start >= stop:
            return np.zeros(0, "<u4")
        first = int(np.searchsorted(self.ends, start, "right"))
        last = int(np.searchsorted(self.ends, stop, "left")) + 1
        symbols, sizes = self.symbols[first:last], self.sizes[first:last]
        begin = np.cumsum(sizes) - sizes
        out = np.repeat(symbols, sizes)
        inner = out >= self.base
        place = np.arange(len(out)) - np.repeat(begin, sizes)
        out[inner] = self.flat[self.starts_of[out[inner] - self.base] + place[inner]]
        skip = start - int(self.ends[first] - self.sizes[first])
        return out[skip : skip + stop - start].astype("<u4")


# -- files


class Writer:
    """One file: documents in order, cut into shards regardless of document bounds."""

    def __init__(self, uri: str, how: Grammar):
        self.uri, self.how, self.out = uri, how, create(uri)
        self.out.write(MAGIC)
        self.offset, self.total = len(MAGIC), 0
        self.pending: list[bytes] = []
        self.held = 0
        self.docs: list[tuple[int, int, int, int]] = []
        self.shards: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        count = len(ids) // 4
        self.docs.append((doc_id or 0, doc_id is None, self.total, count))
        self.total += count
        step = 4 * self.how.shard_ids
        at = 0
        while at < len(ids):
            part = ids[at : at + step - 4 * self.held]
            self.pending.append(part)
            self.held += len(part) // 4
            at += len(part)
            if self.held == self.how.shard_ids:
                self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        symbols, pairs, lengths, base = compress(ids, self.how)
        width = 2 if base + len(pairs) <= 1 << 16 else 4
        data = HEAD.pack(len(ids), len(symbols), len(pairs), base, width, 0)
        data += pairs.astype("<u4").tobytes() + lengths.astype("<u4").tobytes() + symbols.astype(f"<u{width}").tobytes()
        self.shards.append((self.offset, len(self.shards) * self.how.shard_ids))
        self.out.write(data)
        self.offset += len(data)
        self.pending, self.held = [], 0

    def close(self) -> None:
        self.flush()
        for column, kind in zip(zip(*self.docs, strict=True), ("<i8", "<i1", "<i8", "<i8"), strict=True):
            self.out.write(np.array(column, kind).tobytes())
        self.out.write(np.array(self.shards, "<i8").reshape(-1, 2).tobytes())
        self.out.write(TAIL.pack(len(self.docs), len(self.shards), MAGIC))
        self.out.close()


class Reader:
    """Opens the footer; loads one shard at a time."""

    def __init__(self, uri: str):
        files, path = opened(uri)
        self.source = files.open_input_file(path)
        size = self.source.size()
        docs, shards, magic = TAIL.unpack(self._at(size - TAIL.size, TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        start = size - TAIL.size - 16 * shards
        self.shards = np.frombuffer(self._at(start, 16 * shards), "<i8").reshape(-1, 2)
        index = self._at(start - 25 * docs, 25 * docs)
        self.doc_ids = np.frombuffer(index, "<i8", docs)
        self.null_ids = np.frombuffer(index, "<i1", docs, 8 * docs).astype(bool)
        self.starts = np.frombuffer(index[9 * docs :], "<i8", docs)
        self.counts = np.frombuffer(index[17 * docs :], "<i8", docs)
        self.number, self.shard = -1, None

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def load(self, number: int) -> Shard:
        if number != self.number:
            offset = int(self.shards[number, 0])
            self.size, symbols, rules, base, width, _ = HEAD.unpack(self._at(offset, HEAD.size))
            data = self._at(offset + HEAD.size, 12 * rules + width * symbols)
            pairs = np.frombuffer(data, "<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
            lengths = np.frombuffer(data, "<u4", rules, 8 * rules).astype(np.int64)
            self.shard = Shard(np.frombuffer(data, f"<u{width}", symbols, 12 * rules), pairs, lengths, base)
            self.number = number
        return self.shard

    def pieces(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Ids from ``start`` on, shard by shard."""
        number = int(np.searchsorted(self.shards[:, 1], start, "right")) - 1
        while count > 0:
            shard = self.load(number)
            inside = start - int(self.shards[number, 1])
            step = min(count, self.size - inside)
            yield shard.ids(inside, inside + step)
            start, count, number = start + step, count - step, number + 1

    def close(self) -> None:
        self.source.close()


# -- Spark


def write_files(docs: DataFrame, tokenizer_file: str, folder: str, how: Grammar = Grammar()) -> DataFrame:
    """Manifest (part, number, path, documents, ids) of the files, in document order."""
    folder = Folder(docs.sparkSession, folder).qualified()

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        coder, writer = encoder(tokenizer_file), None

        def closed():
            writer.close()
            row = {"part": [part], "number": [number], "path": [writer.uri], "documents": [len(writer.docs)], "ids": [writer.total]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))

        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            values = texts(batch)
            for at in range(0, len(values), 256):
                for doc_id, ids in zip(doc_ids[at : at + 256], coder.encode(values[at : at + 256]), strict=True):
                    writer = writer or Writer(own_name(folder, ".ids"), how)
                    writer.add(doc_id, ids + end)
                    if writer.total >= how.file_ids:
                        yield closed()
                        writer, number = None, number + 1
        if writer:
            yield closed()

    placed = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return placed.mapInArrow(run, "part int, number int, path string, documents long, ids long")


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    order = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0))).select("path", "base")
    tasks = max(based.sparkSession.sparkContext.defaultParallelism, min(10_000, manifest.count()))

    def run(batch: pa.RecordBatch):
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            reader = Reader(path)
            crcs = []
            for start, count in zip(reader.starts.tolist(), reader.counts.tolist(), strict=True):
                crc = 0
                for piece in reader.pieces(start, count):
                    crc = zlib.crc32(piece.tobytes(), crc)
                crcs.append(crc)
            doc_ids = pa.array(reader.doc_ids, mask=reader.null_ids)
            yield [doc_ids, reader.starts + base, reader.counts, crcs]
            reader.close()

    return map_rows(based.repartition(tasks, "path"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, tokenizer_file: str, folder: str | None = None, how: Grammar = Grammar()) -> DataFrame:
    """Write all documents and return what the files hold."""
    folder = folder or fresh_dir(docs.sparkSession, "repair")
    return read_files(stored(write_files(docs, tokenizer_file, f"{folder}/ids", how), "repair-manifest"))
