"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is cut into k + 1 pieces: a passage within k edits of it
holds at least one piece unchanged. All pieces form one Aho-Corasick automaton; each exact hit names
an item and the place where it would start, and the window around it is verified with Myers'
bit-parallel distance (semi-global: the item against any part of the window). Documents are
streamed once against the stated items; nothing is shuffled but the findings.

Text is compared case-folded with everything but letters and digits collapsed to one space, so
punctuation and line breaks do not count as edits. Normalised items are dealt to blocks of about
``block_chars`` characters in a table of the shared folder; each task opens its block there, one pass over the
documents for each block, so no automaton outgrows its worker and no item passes the driver.

Short items (under ``least_chars`` normalised characters) have budget 0 and count only where they stand whole, between word
bounds. Scripts written without spaces have a bound at every character.

Defined results: null or empty texts and items match nothing; items under ``least_piece`` characters after
normalising are ignored (a common word would condemn the corpus); equal items are reported each;
repeated rows are reported each; very long texts are searched whole; of equally good places the first counts; other columns
are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyarrow import dataset
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, stored, texts
from millrace.llm.warc import opened
from millrace.session import Folder, fresh_dir

MOST_WRITERS = 200  # tasks that write item blocks
SCHEMA = "doc_id long, item_id long, distance int, budget int, start long"
UNSPACED = "\u2e80"  # from here on characters of scripts without spaces
_GAPS = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Matching:
    edit_share: float = 0.08  # edits allowed per character of the item
    least_chars: int = 24
    least_piece: int = 8  # the budget is lowered where pieces would get shorter
    block_chars: int = 4_000_000


def normal(text: str) -> str:
    return _GAPS.sub(" ", text.lower()).strip()


def budget_of(item: str, how: Matching) -> int:
    if len(item) < how.least_chars:
        return 0
    return max(0, min(int(len(item) * how.edit_share), len(item) // how.least_piece - 1))


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): ``budget`` + 1 pieces of near-equal length that cover the item."""
    count = budget + 1
    cuts = [len(item) * n // count for n in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks_of(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for at, char in enumerate(item):
        out[char] = out.get(char, 0) | 1 << at
    return out


def myers(masks: dict[str, int], length: int, window: str) -> tuple[int, int]:
    """(least edit distance of the item to any part of the window, end of the first such part)."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for at, char in enumerate(window):
        equal = masks.get(char, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full  # a match may start anywhere
        down = down << 1 & full
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if score < best:
            best, end = score, at + 1
    return best, end


class Matcher:
    """The automaton and the items of one block; built once per task."""

    def __init__(self, items: list[tuple[int, str]], how: Matching):
        self.items = [(item_id, text, budget_of(text, how)) for item_id, text in items]
        self.short = [len(text) < how.least_chars for _, text, _ in self.items]
        self.masks = [masks_of(text) for _, text, _ in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, budget, start of the verified window) of each item found."""
        starts: dict[int, list[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, offset in where:
                if not self.short[number] or stands_alone(text, end + 1 - length, end + 1):
                    starts.setdefault(number, []).append(end + 1 - length - offset)
        for number, guesses in starts.items():
            item_id, item, budget = self.items[number]
            best = None
            for low, high in windows(sorted(guesses), budget):
                from_, to = max(0, low - budget), min(len(text), high + len(item) + budget)
                found, _ = myers(self.masks[number], len(item), text[from_:to])
                if found <= budget and (best is None or found < best[0]):
                    best = (found, from_)
                    if not found:
                        break
            if best:
                yield item_id, best[0], budget, best[1]


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether a passage begins and ends at word bounds."""
    return not (joined(text[start - 1 : start], text[start]) or joined(text[end - 1], text[end : end + 1]))


def joined(left: str, right: str) -> bool:
    return left.isalnum() and right.isalnum() and max(left, right) < UNSPACED


def windows(guesses: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Starts that lie within the error budget of each other share one verification."""
    low = high = guesses[0]
    for guess in guesses[1:]:
        if guess - high > 2 * budget:
            yield low, high
            low = guess
        high = guess
    yield low, high


def item_blocks(benchmark: DataFrame, how: Matching) -> list[str]:
    """Folders of normalised items, about ``block_chars`` characters each; the driver sees their names only."""
    spark = benchmark.sparkSession

    def run(batch: pa.RecordBatch):
        yield [batch.column("item_id"), [normal(text) for text in texts(batch)]]

    items = map_rows(benchmark.select(F.col("item_id").cast("long"), "text"), run, "item_id long, item string")
    items = stored(items.filter(F.length("item") >= how.least_piece).withColumn("at", F.monotonically_increasing_id()), "items")
    chars = items.agg(F.coalesce(F.sum(F.length("item")), F.lit(0))).first()[0]
    blocks = -(-chars // how.block_chars)
    if not blocks:
        return []
    folder = fresh_dir(spark, "item-blocks")
    block = F.pmod(F.xxhash64("at"), F.lit(blocks)).cast("int")  # by position: copies of one item spread
    items.withColumn("block", block).repartition(min(blocks, MOST_WRITERS), "block").write.partitionBy("block").parquet(folder)
    names = [name for name in Folder(spark, folder).names() if name.startswith("block=")]
    return [Folder(spark, f"{folder}/{name}").qualified() for name in sorted(names)]


def read_block(folder: str) -> list[tuple[int, str]]:
    files, path = opened(folder)
    table = dataset.dataset(path, format="parquet", filesystem=files).to_table(columns=["item_id", "item"])
    return sorted(zip(table.column("item_id").to_pylist(), table.column("item").to_pylist(), strict=True), key=repr)


@lru_cache(maxsize=1)
def matcher(folder: str, how: Matching) -> Matcher:
    """The block's automaton; a Python worker keeps that of its last task."""
    return Matcher(read_block(folder), how)


def contaminated(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching()) -> DataFrame:
    """One row per document and test item that it contains within the item's error budget."""
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    found = slim.sparkSession.createDataFrame([], SCHEMA)
    for block in item_blocks(benchmark, how):
        found = found.unionByName(map_rows(slim, searcher(block, how), SCHEMA))
    return found


def searcher(block: str, how: Matching):
    def run(batch: pa.RecordBatch):
        rows = [
            (doc_id, *hit)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
            for hit in matcher(block, how).search(normal(text))
        ]
        if rows:
            yield list(map(list, zip(*rows, strict=True)))

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching()) -> DataFrame:
    """The documents that contain no test item, with all their columns; filtered in place, no shuffle.

    Documents without text are clean; an empty benchmark keeps all; columns of any name pass unchanged.
    """
    for block in item_blocks(benchmark, how):
        docs = docs.mapInArrow(cleaner(block, how), docs.schema)
    return docs


def cleaner(block: str, how: Matching):
    def run(batches):
        for batch in batches:
            clean = [next(matcher(block, how).search(normal(text)), None) is None for text in texts(batch)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
