import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations as c
from tests.conftest import SF
from tests.llm.helpers import awkward, nothing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least=30, most=4, first=2000, inside=80):
    """Counts of every phrase in a dictionary, cuts and containment by comparing words."""
    uses, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                uses.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {p: n for p, n in uses.items() if n >= least}
    buried = set()
    for (lang, ws), n in often.items():
        for k in range(2, len(ws)):
            buried |= {p for i in range(len(ws) - k + 1) if 100 * n >= inside * uses[p := (lang, ws[i : i + k])]}
    out = {}
    for (lang, ws), a in often.items():
        if len(ws) > 1 and (lang, ws) not in buried:
            sides = [(uses[lang, ws[:k]], uses[lang, ws[k:]], k) for k in range(1, len(ws))]
            score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for l, r, k in sides)
            out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), l, r))
    return {
        (lang, at + 1, text.decode(), -a, l, r, totals[lang], -score)
        for lang, found in out.items()
        for at, (score, a, text, l, r) in enumerate(sorted(found)[:first])
    }


def got(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_intervals_match_counted_phrases(depth):
    draw = random.Random(depth)
    text = np.array([draw.choice([0, 1, 1, 2, 3, 4, 5, 5]) for _ in range(700)] + [0], np.int32)
    text = text[(text != 0) | (np.roll(text, 1) != 0)]
    uses = Counter()
    for k in range(2, depth + 1):
        uses.update(p for i in range(len(text) - k + 1) if 0 not in (p := tuple(text[i : i + k].tolist())))
    index = c.TwoWay.of(text, depth)
    pairs = {(a, b): n for lot in c.word_pairs(index, 6) for a, b, n in zip(*(x.tolist() for x in lot), strict=True)}
    assert pairs == {p: n for p, n in uses.items() if len(p) == 2}
    some = sorted(p for p in pairs if p != (5, 1))
    first, second = (np.array(side) for side in zip(*some, strict=True))
    found = {}
    for words, n in c.longer_phrases(index, 6, first, second, depth):
        for p, count in zip(map(tuple, words.tolist()), n.tolist(), strict=True):
            assert p not in found
            found[p] = count
    assert found == {p: n for p, n in uses.items() if len(p) > 2 and all(q in some for q in zip(p, p[1:]))}


def test_left_and_right_keep_intervals_in_step():
    text = np.array([1, 2, 1, 2, 2, 1, 0, 2, 1, 2, 0], np.int32)
    index = c.TwoWay.of(text, 4)
    one = index.words(np.array([1]))
    for a in (index.left(np.array([2]), *index.right(np.array([2]), *one)), index.right(np.array([2]), *index.left(np.array([2]), *one))):
        assert [x.tolist() for x in a][2] == [2]  # 2 1 2
        place, symbol, sides = index.lefts(*a)
        assert dict(zip(symbol.tolist(), sides[2].tolist(), strict=True)) == {1: 1, 0: 1}
        place, symbol, sides = index.rights(*a)
        assert dict(zip(symbol.tolist(), sides[2].tolist(), strict=True)) == {2: 1, 0: 1}


def test_table_matches_counts_by_hand(spark, monkeypatch):
    monkeypatch.setattr(c, "LOT", 3000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    for least, words in ((30, 20_000), (3, 5_000)):
        assert got(c.collocations(docs, least=least, shard_words=words)) == by_hand(rows, least)


def test_few_words_many_repeats_and_ties(spark):
    draw = random.Random(4)
    rows = [("en", " ".join(draw.choice("a b c D e".split()) + draw.choice(["", "", "."]) for _ in range(200))) for _ in range(40)]
    rows += [(None, "x\x01 y\tz x y z; " * 40), ("und", "X y z"), ("en", "the the the the " * 30), ("de", "x " * 29)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(c.collocations(docs, shard_words=700)) == by_hand(rows)
    assert got(c.collocations(docs, least=5, first=7, most_words=3, shard_words=700)) == by_hand(rows, 5, 3, 7)
    assert got(c.collocations(docs, least=5, most_words=2)) == by_hand(rows, 5, 2)


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    result = c.collocations(docs, least=2)
    assert got(result) == by_hand(rows, 2) != set()
    assert c.collocations(nothing(spark)).count() == 0
    assert c.collocations(docs.filter("text = ''")).count() == 0


def test_a_shard_gets_bits_back_and_only_the_result_stays(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("millrace.llm.common.fresh_dir", lambda _, label: f"{tmp_path}/{label}")
    draw = random.Random(6)
    rows = [("en", " ".join(f"w{draw.randrange(300)}" for _ in range(4000))) for _ in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    index = c.indexes(shards := c.word_shards(docs, 20_000), c.stored(c.used_often(shards.filter("number > 0"), ["lang", "word"], ["shard", "number"], "uses", 30), "k"), 4)
    sent = c.pairs_of(index, 16)
    pairs = sum(c.unblocked(bytes(r.data), 3).shape[1] for r in sent.collect())
    assert pairs > 50_000 and sum(len(r.data) for r in sent.collect()) < 8 * pairs
    back = c.summed(sent, 2, 2).filter("shard IS NOT NULL").collect()
    assert sum(r["size"] for r in back) == pairs and all(len(r.bits) == -(-r["size"] // 8) for r in back)
    own = tmp_path / "own"
    monkeypatch.setattr("millrace.llm.common.fresh_dir", lambda _, label: f"{own}/{label}")
    assert got(c.collocations(docs, least=12, shard_words=20_000)) == by_hand(rows, 12)
    assert [p.name for p in own.iterdir()] == ["collocations"]
