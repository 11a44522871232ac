import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

import __spark_entry__ as entry
from millrace.llm import fmindex, repair
from tests.conftest import SF
from tests.llm.helpers import CLASHING, awkward, nothing, prose, rows_of

TOKENIZER = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.sampled_from("ab's 12!?\n\t\r\x1c\x85\xa0\u2003é漢🙂<|endoftext|>"), max_size=60))
def test_stretches_give_the_ids_of_the_whole_text(text, library):
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == ids


ENCODER = repair.Encoder(TOKENIZER)


def test_encoder_survives_a_full_cache(monkeypatch, library):
    monkeypatch.setattr(repair, "CACHED", 5)
    encoder = repair.Encoder(TOKENIZER)
    for seed in range(5):
        text = prose(seed, 50) + " <|endoftext|> x"
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(2, 6), st.data())
def test_grammar_round_trip_and_random_access(ids, least, data):
    how = repair.Grammar(least_uses=least)
    array = np.array(ids, "<u4")
    shard = repair.Shard(*repair.compress(array, how))
    start = data.draw(st.integers(0, len(ids)))
    stop = data.draw(st.integers(start, len(ids)))
    assert shard.ids(0, len(ids)).tolist() == ids
    assert shard.ids(start, stop).tolist() == ids[start:stop]


def test_special_tokens_are_the_librarys(library):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y<|endoftext|>", "", "plain <|endoftext"]
    assert 50256 in library.encode(texts[0], add_special_tokens=False).ids
    for text, ids in zip(texts, ENCODER.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_rounds_go_on_while_pairs_repeat():
    ids = np.tile(np.arange(4), 1 << 14)
    symbols, rules, lengths, base = repair.compress(ids)
    assert lengths.max() > 64 and len(symbols) < 50
    assert repair.Shard(symbols, rules, lengths, base).ids(0, len(ids)).tolist() == ids.tolist()


def test_grammar_shrinks_repetition():
    ids = np.tile(np.arange(64), 500)
    symbols, rules, lengths, base = repair.compress(ids)
    assert len(symbols) + 2 * len(rules) < len(ids) / 20
    assert all(left < base + i and right < base + i for i, (left, right) in enumerate(rules.tolist()))
    assert lengths.max() > 8


def expected_rows(texts, library):
    out, start = [], 0
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_matches_the_library(spark, library):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = rows_of(entry.queries()["op4_repair"](spark, SF), "doc_id", "start", "n_tokens", "ids_crc32")
    assert rows == sorted(expected_rows(texts, library), key=repr)


def test_small_shards_and_files_with_awkward_rows(spark, library):
    docs = awkward(spark)
    how = repair.Grammar(shard_ids=777, file_ids=5000, least_uses=3)
    rows = repair.encoded(docs, TOKENIZER, how=how).collect()
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == sorted(r[2:] for r in expected_rows(texts, library))
    assert repair.encoded(nothing(spark), TOKENIZER).count() == 0


# -- substring dedup


def removed_by_hand(docs, window):
    """{position in docs: (words, removed, digest)}"""
    words = [(doc_id, (text or "").encode().split()) for doc_id, text in docs]
    first = {}
    for doc_id, w in words:
        if doc_id is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[k : k + window])] < doc_id:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, docs, plan=fmindex.Plan()):
    frame = spark.createDataFrame([(i, t, "l", "s", 0, "k", "s", "z", "w", "f") for i, t in docs], CLASHING)
    rows = rows_of(fmindex.deduplicated(frame, plan), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows == removed_by_hand(docs, plan.window)
    return rows


def test_dedup_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = rows_of(entry.queries()["op5_fm_index"](spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows == removed_by_hand(docs, 50)


def passages(seed, count):
    """Documents stitched from shared passages, with single-word edits, few words and many repeats."""
    draw = random.Random(seed)
    shared = [[f"s{draw.randrange(3)}_{draw.randrange(12)}" for _ in range(draw.randint(40, 160))] for _ in range(6)]
    docs = []
    for doc_id in range(count):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += [f"u{draw.randrange(10**6)}" for _ in range(draw.randint(0, 40))]
            part = list(draw.choice(shared))
            if part and draw.random() < 0.5:
                part[draw.randrange(len(part))] = "edit"
            words += part[draw.randint(0, 20) :]
        docs.append((doc_id, " ".join(words)))
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("plan", [fmindex.Plan(), fmindex.Plan(hot_contexts=2), fmindex.Plan(shard_words=500)])
def test_dedup_of_stitched_passages(spark, plan):
    rows = check(spark, passages(5, 60), plan)
    assert sum(r[2] for r in rows) > 1000


def test_dedup_of_awkward_rows(spark):
    docs = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    check(spark, [*docs, (20, prose(7, 60_000)), (21, " ".join(["same"] * 300)), (None, prose(7, 400)), (22, prose(9, 80))])
    assert fmindex.deduplicated(nothing(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.data())
def test_backward_search_finds_every_occurrence(symbols, data):
    text = np.array([*symbols, 0])
    index = fmindex.FmIndex(text, np.arange(len(text)), len(text))
    pattern = data.draw(st.lists(st.integers(1, 3), min_size=1, max_size=6))
    low, high = np.array([0]), np.array([index.n])
    for symbol in reversed([p for p in pattern if p < index.sigma]):
        low, high = index.step(np.array([symbol]), low, high)
    kept = [p for p in pattern if p < index.sigma]
    places = [i for i in range(len(symbols) - len(kept) + 1) if symbols[i : i + len(kept)] == kept]
    if kept:
        assert high[0] - low[0] == len(places)
        assert index.least_owner(low, high)[0] == min(places, default=np.iinfo(np.int32).max)


def test_every_latin_letter_inside_a_word(library):
    letters = [chr(c) for c in range(128, 0x250) if chr(c).isalpha()]
    text = "start " + " ".join(f"b{c}d{c},. {c}" for c in letters)
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
