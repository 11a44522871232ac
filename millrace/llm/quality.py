"""Quality rules: word and repetition counts, then compression bands.

A text that compresses far better than prose of its length repeats itself; one that hardly
compresses is noise. Both the whole text and fixed chunks of it are compressed with zstandard, and
each ratio (compressed bytes / bytes) must lie in the band of its length. Short texts compress
worse, so the limits depend on length. Long documents can hide a bad stretch behind a good average
(or the reverse), hence the chunks, the last one whatever its length, each judged by the limits of its own length. A document of two
chunks or more goes if more than half of its bytes, or ``bad_run`` whole chunks in a row, are out of band.

Defined results: null or empty text counts as no words and fails the base rule; ties and repeated
rows are judged one by one, each the same; very long texts are judged whole; columns besides ``doc_id`` and ``text`` are ignored, so
their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from millrace.llm.common import BLANKS, TEXTS, map_rows, texts

SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long, verdict string"
)


@dataclass(frozen=True)
class Bands:
    """``whole``: (bytes below which the row holds, least ratio, greatest ratio), ascending."""

    level: int = 3
    chunk_bytes: int = 2048
    chunk_low: float = 0.43
    chunk_high: float = 0.66
    bad_share: float = 0.5
    bad_run: int = 4
    whole: tuple[tuple[float, float, float], ...] = (
        (128, 0.30, 2.00),
        (256, 0.45, 1.10),
        (512, 0.50, 0.85),
        (1024, 0.48, 0.76),
        (2048, 0.455, 0.70),
        (4096, 0.435, 0.66),
        (8192, 0.415, 0.64),
        (16384, 0.40, 0.62),
        (65536, 0.375, 0.62),
        (float("inf"), 0.32, 0.62),
    )

    def limits(self, size: int) -> tuple[float, float]:
        return next((low, high) for below, low, high in self.whole if size < below)

    def chunk_limits(self, size: int) -> tuple[float, float]:
        """Those of a whole chunk, or of a text as short as the last one."""
        return (self.chunk_low, self.chunk_high) if size == self.chunk_bytes else self.limits(size)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, until = Counter(windows), 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, until)
            until = start + 3
    return covered


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    data = text.encode()
    words = data.split()
    blanks = len(data) - len(data.translate(None, BLANKS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def compression(data: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, str]:
    """(ratio of the whole, chunks, chunks out of band, verdict)."""
    if not data:
        return None, 0, 0, "empty"
    ratio = len(packer.compress(data)) / len(data)
    low, high = bands.limits(len(data))
    step, chunks, bad, bad_bytes, run, longest = bands.chunk_bytes, 0, 0, 0, 0, 0
    for start in range(0, len(data), step):
        piece = data[start : start + step]
        share = len(packer.compress(piece)) / len(piece)
        least, most = bands.chunk_limits(len(piece))
        out = not least <= share <= most
        chunks += 1
        bad += out
        bad_bytes += out * len(piece)
        run = run + 1 if out and len(piece) == step else 0
        longest = max(longest, run)
    if ratio < low:
        return ratio, chunks, bad, "repetitive"
    if ratio > high:
        return ratio, chunks, bad, "incompressible"
    if chunks > 1 and (bad_bytes > bands.bad_share * len(data) or longest >= bands.bad_run):
        return ratio, chunks, bad, "chunks"
    return ratio, chunks, bad, "kept"


def judge(values: list[str], bands: Bands) -> list[tuple]:
    packer = zstandard.ZstdCompressor(level=bands.level)
    rows = []
    for text in values:
        counts = base_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        ratio, chunks, bad, verdict = compression(text.encode(), bands, packer)
        rows.append((*counts, failed, not failed and verdict == "kept", ratio, chunks, bad, verdict))
    return rows


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document with its counts, ratios and verdict; no shuffle."""

    def run(batch: pa.RecordBatch):
        rows = judge(texts(batch), bands)
        if rows:
            yield [batch.column("doc_id").to_pylist(), *map(list, zip(*rows, strict=True))]

    return map_rows(docs.select("doc_id", "text"), run, SCHEMA, TEXTS)


def kept_documents(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with all their columns; rejected rows are dropped in place.

    Null and empty texts are rejected, repeated rows stay or go together, columns of any name pass unchanged.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                yield some.filter(pa.array([row[6] for row in judge(texts(some), bands)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
