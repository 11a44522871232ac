import re
import zlib
from collections import Counter

import zstandard

import __spark_entry__ as entry
from millrace.llm import langid, quality
from tests.conftest import SF
from tests.llm.helpers import awkward, nothing, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_by_hand(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_base_counts_match_brute_force_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    result = entry.queries()["op1_compression_bands"](spark, SF).collect()
    assert len(result) == len(texts)
    for r in result:
        n_words, *rest = counts_by_hand(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, *rest)
        assert r.base_failed == (n_words < 50 or 100 * rest[3] > 50 * n_words)
        data = texts[r.doc_id].encode()
        assert abs(r.ratio - len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data)) < 1e-12
        assert not (r.kept and r.base_failed)


def test_quality_of_awkward_texts(spark):
    rows = {(r.doc_id, r.n_words): r for r in quality.quality_rules(awkward(spark)).collect()}
    assert rows[3, 0].base_failed and rows[3, 0].verdict == "empty"
    assert rows[5, 0].base_failed and not rows[5, 0].kept
    assert rows[11, 500].n_repeat_words == 500 and not rows[11, 500].kept
    assert rows[7, 60_000].n_chunks > 100
    assert quality.quality_rules(nothing(spark)).count() == 0
    assert quality.quality_rules(awkward(spark)).count() == awkward(spark).count()


def test_bands_reject_repetition_noise_and_bad_chunks():
    bands, packer = quality.Bands(), zstandard.ZstdCompressor(level=3)
    digits = "".join(f"{zlib.crc32(str(i).encode()):08x}" for i in range(2000))
    noise = bytes(33 + zlib.crc32(str(i).encode()) % 90 for i in range(20_000))
    assert quality.compression(b"again and again, " * 400, bands, packer)[3] == "repetitive"
    assert quality.compression(noise, bands, packer)[3] == "incompressible"
    assert quality.compression(digits.encode(), bands, packer)[3] in ("incompressible", "kept", "chunks")
    good = prose(5, 2500).encode()
    lenient = quality.Bands(chunk_high=0.1, whole=((float("inf"), 0.0, 2.0),))
    assert quality.compression(good, lenient, packer)[3] == "chunks"


def kept_by_hand(text, bands):
    """The base rule, then every band, written out anew."""
    words = (text or "").encode().split()
    if len(words) < 50 or 100 * counts_by_hand(text)[4] > 50 * len(words):
        return False
    data, pack = text.encode(), zstandard.ZstdCompressor(level=bands.level).compress
    band = lambda n: next((a, b) for below, a, b in bands.whole if n < below)
    inside = lambda piece, limits: limits[0] <= len(pack(piece)) / len(piece) <= limits[1]
    pieces = [data[k : k + 2048] for k in range(0, len(data), 2048)]
    good = [inside(p, (bands.chunk_low, bands.chunk_high) if len(p) == 2048 else band(len(p))) for p in pieces]
    if not inside(data, band(len(data))):
        return False
    if len(pieces) == 1:
        return True
    bad = sum(len(p) for p, g in zip(pieces, good, strict=True) if not g)
    runs = "".join("x" if not g and len(p) == 2048 else "." for p, g in zip(pieces, good, strict=True))
    return 2 * bad <= len(data) and "xxxx" not in runs


def test_kept_matches_a_plain_computation_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id: r.kept for r in entry.queries()["op1_compression_bands"](spark, SF).collect()}
    assert kept == {k: kept_by_hand(t, quality.Bands()) for k, t in texts.items()}


def test_bad_stretches_of_long_documents_and_tails():
    bands, packer = quality.Bands(), zstandard.ZstdCompressor(level=3)
    good, again = prose(5, 12_000).encode(), b"again and again, " * 600
    easy = quality.Bands(chunk_low=0.3, whole=((float("inf"), 0.1, 2.0),))
    assert quality.compression(good, easy, packer)[3] == "kept"
    at = 2048 * 6
    assert quality.compression(good[:at] + again[: 2048 * 4] + good[at:], easy, packer)[3] == "chunks"
    assert quality.compression(good[:at] + again[: 2048 * 3] + good[at:], easy, packer)[3] == "kept"
    for size in (2049, 2300, 4000, 4096, 4097):
        assert quality.compression(good[:size], bands, packer)[1] == -(-size // 2048)


def test_kept_documents_keep_their_columns(spark):
    docs = awkward(spark)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    verdicts = Counter((r.doc_id, r.n_words) for r in quality.quality_rules(docs).collect() if r.kept)
    assert kept.count() == sum(verdicts.values())


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = entry.queries()["op2_rank_order_profiles"](spark, SF).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.95


def out_of_place(text, profiles):
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = "\x01" + word + "\x01"
        for size in (1, 2, 3):
            for at in range(len(padded) - size + 1):
                if padded[at : at + size] != "\x01":
                    grams[padded[at : at + size]] += 1
    own = [g for g, _ in sorted(grams.items(), key=lambda kv: (-kv[1], langid_code(kv[0])))][: langid.DOCUMENT_GRAMS]
    best = None
    for lang, profile in profiles.items():
        ranks = {g: i for i, g in enumerate(profile)}
        total = sum(min(langid.PROFILE_SIZE, abs(ranks[langid_code(g)] - i)) if langid_code(g) in ranks else langid.PROFILE_SIZE for i, g in enumerate(own))
        if best is None or total < best[0]:
            best = (total, lang, 1 - total / (langid.PROFILE_SIZE * len(own)))
    return best[1:]


def langid_code(gram):
    code = 0
    for char in gram:
        code = code << 21 | ord(char)
    return code


def test_distance_matches_a_plain_computation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    profiles = langid.learn(docs)
    judge = langid.Judge(profiles)
    for r in docs.collect()[:25]:
        lang, score = judge.judge(r.text)
        expected = out_of_place(r.text, profiles)
        assert lang == expected[0] and abs(score - expected[1]) < 1e-9


def test_language_of_awkward_texts(spark):
    rows = langid.identify(awkward(spark)).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == awkward(spark).count()
    for empty in (3, 4, 5):
        assert (by_id[empty].lang_pred, by_id[empty].score) == ("und", 0.0)
    assert by_id[7].lang_pred != "und"
    assert langid.identify(nothing(spark)).count() == 0
    unlabelled = awkward(spark).selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
