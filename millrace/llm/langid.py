"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams (1 to 3 letters of lower-cased words,
padded by one mark on each side) in order of frequency. A document's own list is compared with each
profile by the out-of-place distance: the sum over its n-grams of how far their ranks lie apart,
``profile_size`` where the profile lacks the n-gram. The nearest profile names the language.

Learning covers every labelled training text. Each task counts its n-grams by language, so one partial row
per language, n-gram and task is shuffled, and a map-side group limit leaves ``profile_size`` of them
for each language. Profiles are small (languages x 400).

Defined results: null text, or text without a letter, is ``und`` with score 0, as is everything when
nothing could be learned; ties go to the n-gram of smaller code and the language first by code point;
null ``lang`` rows teach nothing; repeated rows are judged alike (and count as often as they occur);
columns other than ``doc_id``, ``text`` and ``lang`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, texts

PROFILE_SIZE = 400
DOCUMENT_GRAMS = 400
FLUSH_GRAMS = 1_000_000  # distinct n-grams that a task holds before it sends its counts on
WAITING_GRAMS = 1_000_000  # n-grams of one language that wait to be counted
MARK = "\x01"
HELD_OUT = 2
UNKNOWN = "und"
_BETWEEN = re.compile(r"[\W\d_]+")


def is_held_out(doc_id: Column) -> Column:
    """The fixed fold: crc32 of the id's text modulo 4 is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams, 21 bits a character, so that codes order by text.

    Everything between words becomes one mark, which pads the word before and the word after it; n-grams
    with a mark inside would join two words and are left out.
    """
    marked = MARK + _BETWEEN.sub(MARK, text.lower()).strip(MARK) + MARK
    chars = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    inner = chars != ord(MARK)
    pairs = chars[:-1] << 21 | chars[1:]
    triples = (pairs[:-1] << 21 | chars[2:])[inner[1:-1]]
    return np.concatenate((chars[inner], pairs, triples)) if inner.any() else np.zeros(0, np.int64)


def counted(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, ascending; their occurrences)."""
    if weights is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, weights = codes[order], weights[order]
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    if weights is None:
        return codes[first], np.diff(np.concatenate((first, [len(codes)])))
    return codes[first], np.add.reduceat(weights, first)


def top_grams(codes: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent codes in order; ``codes`` ascend, so a stable sort breaks ties by code."""
    if len(codes) > most:
        enough = counts >= np.partition(counts, -most)[-most]
        codes, counts = codes[enough], counts[enough]
    return codes[np.argsort(-counts, kind="stable")[:most]]


def learn(docs: DataFrame, most: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profiles of every language among the rows given, from all their texts."""

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows():
            for lang, (codes, counts) in held.items():
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(codes), "gram": codes, "n": counts})
            held.clear()

        def add(lang, parts):
            codes, counts = counted(np.concatenate(parts))
            if lang in held:
                codes, counts = counted(np.concatenate((held[lang][0], codes)), np.concatenate((held[lang][1], counts)))
            held[lang] = codes, counts

        for batch in batches:
            fresh: dict[str, list[np.ndarray]] = {}
            waiting: dict[str, int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                fresh.setdefault(lang, []).append(gram_codes(text))
                waiting[lang] = waiting.get(lang, 0) + len(fresh[lang][-1])
                if waiting[lang] > WAITING_GRAMS:
                    add(lang, fresh.pop(lang))
                    waiting[lang] = 0
            for lang, parts in fresh.items():
                add(lang, parts)
            if sum(len(codes) for codes, _ in held.values()) > FLUSH_GRAMS:
                yield from rows()
        yield from rows()

    partial = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    total = partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    best = total.withColumn("rank", rank).filter(F.col("rank") <= most)
    profiles: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():  # profile_size rows per language
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return dict(sorted(profiles.items()))


class Judge:
    """Distances of one document to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], most: int = PROFILE_SIZE):
        self.langs, self.most = list(profiles), most
        self.codes = np.unique(np.concatenate([np.array(p, np.int64) for p in profiles.values()] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.codes) + 1, max(1, len(self.langs))), -1, np.int64)
        for number, profile in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.codes, np.array(profile, np.int64)), number] = np.arange(len(profile))

    def judge(self, text: str) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        own = top_grams(*counted(gram_codes(text)), DOCUMENT_GRAMS)
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == own, at, len(self.codes)) if len(self.codes) else np.zeros(len(own), np.int64)
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.most, np.abs(ranks - np.arange(len(own))[:, None]))
        distance = np.minimum(apart, self.most).sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.most * len(own)))


def predict(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); reads ids only to carry them and to name the fold."""
    held: list[Judge] = []

    def run(batch: pa.RecordBatch):
        if not held:
            held.append(Judge(profiles))
        rows = [held[0].judge(text) for text in texts(batch)]
        yield [batch.column("doc_id"), batch.column("held_out"), [r[0] for r in rows], [r[1] for r in rows]]

    slim = docs.select(F.col("doc_id").cast("long"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_rows(slim, run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn on the rows that are not held out and predict all of them."""
    return predict(docs, learn(docs.filter(~is_held_out(F.col("doc_id")))))
