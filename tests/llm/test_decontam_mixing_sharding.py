import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from catalog.compare import both_sides, open_tables
from millrace.llm import decontam, mixing, sharding
from pyspark.sql import functions as F
from tests.conftest import SF, plan_text
from tests.llm.helpers import awkward, nothing, prose, rows_of


def edit_to_any_part(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=90))
def test_myers_matches_dynamic_programming(item, text):
    assert decontam.myers(decontam.masks_of(item), len(item), text)[0] == edit_to_any_part(item, text)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 9), st.integers(30, 70))
def test_matches_within_the_budget_are_never_missed(seed, edits, words):
    item = decontam.normal(prose(seed, words))
    draw = np.random.default_rng(seed)
    chars = list(item)
    how = decontam.Matching()
    budget = decontam.budget_of(item, how)
    for _ in range(min(edits, budget)):
        chars[draw.integers(len(chars))] = draw.choice(["", "x", "yz"][:2])
    text = prose(seed + 1, 40) + " " + "".join(chars) + " " + prose(seed + 2, 40)
    hits = list(decontam.Matcher([(1, item)], how).search(decontam.normal(text)))
    best = edit_to_any_part(item, decontam.normal(text))
    assert best <= budget and [h[:2] for h in hits] == [(1, best)]


def test_decontamination_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 1500).limit(60)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(8)
    found = {(r.doc_id, r.item_id): r.distance for r in decontam.contaminated(docs, items).collect()}
    expected = {}
    for item in items.collect():
        text = decontam.normal(item.text)
        for doc in docs.collect():
            distance = edit_to_any_part(text, decontam.normal(doc.text))
            if distance <= decontam.budget_of(text, decontam.Matching()):
                expected[doc.doc_id, item.item_id] = distance
    assert found == expected


@pytest.mark.parametrize(
    ("text", "hit"),
    [("So: why is it BLUE? Because", True), ("why is it bluest", False), ("thewhy is it blue", False), ("why is it blu", False), ("why is it blue", True)],
)
def test_short_items_match_whole_at_word_bounds(text, hit):
    item = decontam.normal("Why is it blue?")
    found = list(decontam.Matcher([(1, item)], decontam.Matching()).search(decontam.normal(text)))
    assert [f[:3] for f in found] == [(1, 0, 0)] * hit


def test_short_items_of_scripts_without_spaces(spark):
    items = spark.createDataFrame([(1, "水の沸点は何度ですか"), (2, "the cat")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "問題水の沸点は何度ですか答え"), (2, "水の沸点は何度"), (3, "the cat")], "doc_id long, text string")
    assert rows_of(decontam.contaminated(docs, items), "doc_id", "item_id", "distance") == [(1, 1, 0)]
    assert rows_of(decontam.clean_documents(docs, items), "doc_id") == [(2,), (3,)]


def test_item_blocks_are_read_by_the_tasks(spark):
    rows = [(n, prose(n, 12)) for n in range(300)] + [(7, prose(7, 12))] * 100
    how = decontam.Matching(block_chars=3000)
    items = spark.createDataFrame(rows, "item_id long, text string")
    blocks = decontam.item_blocks(items, how)
    held = [decontam.read_block(block) for block in blocks]
    assert sorted(x for block in held for x in block) == sorted((n, decontam.normal(t)) for n, t in rows)
    assert len(blocks) > 5 and max(sum(len(t) for _, t in block) for block in held) < 3 * how.block_chars
    assert decontam.item_blocks(items.limit(0), how) == []


def test_decontamination_blocks_and_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, prose(1, 300)[:200], "x"), (1, prose(1, 300)[:200], "x"), (2, None, "x"), (3, "", "x"), (4, "word", "x"), (5, prose(12, 120)[50:300], "x")], "item_id long, text string, budget string")
    whole = rows_of(decontam.contaminated(docs, items), "doc_id", "item_id", "distance")
    parts = rows_of(decontam.contaminated(docs, items, decontam.Matching(block_chars=10)), "doc_id", "item_id", "distance")
    assert sorted(set(whole), key=repr) == sorted(set(parts), key=repr)
    assert {(d, i) for d, i, _ in whole} == {(0, 1), (1, 1), (2, 1), (12, 1), (12, 5)}
    clean = decontam.clean_documents(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 5
    assert decontam.contaminated(nothing(spark), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


# -- mixing


def test_mix_matches_sql(spark):
    left, right = both_sides(entry.queries()["op6_entropy_mix"](spark, SF), open_tables(SF), entry.oracle_sql()["op6_entropy_mix"])
    assert left == right


def level_by_hand(sizes, weights, most):
    capped = set()
    while True:
        left = sum(sizes) - sum(most * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped]
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= over


def test_targets_reshare_what_caps_leave_over(spark):
    sizes = [3, 500, 80, 1, 0, 9000, 40]
    totals = spark.createDataFrame([(f"s{i}" if i < 6 else None, s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(totals).collect()}
    expected = level_by_hand(sizes, [5, 2, 1, 5, 2, 1, 5], 3)
    for i, value in enumerate(expected):
        assert got[f"s{i}" if i < 6 else None] == pytest.approx(value)


def test_newton_solves_the_dual(spark):
    pairs = [(size, size * rate) for size in (1, 7, 10_000, 10**13) for rate in (1e-7, 0.3, 1.0, 2.999, 3.0)]
    df = spark.createDataFrame([(s, float(t)) for s, t in pairs], "s long, t double")
    for r in df.withColumn("rate", mixing.newton_rate(F.col("s"), F.col("t"))).collect():
        assert r.rate == pytest.approx(r.t / r.s, abs=2e-12)


def test_sources_come_near_their_targets(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (i * 37 % 60 + 1), ["hot", "b", "c", None][min(3, i % 9)]) for i in range(900)], "doc_id long, text string, source string"
    )
    rows = mixing.mix(docs).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
    for source, value in target.items():
        assert abs(taken[source] - value) <= 60
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))


def test_mix_is_native_and_repeats(spark):
    docs = awkward(spark)
    first = mixing.mix(docs)
    assert "Python" not in plan_text(first) and "Arrow" not in plan_text(first)
    assert rows_of(first, "doc_id", "size", "taken") == rows_of(mixing.mix(docs.repartition(5)), "doc_id", "size", "taken")
    assert first.count() == docs.count()
    assert mixing.mix(nothing(spark)).count() == 0
    many = mixing.mixed_documents(docs)
    assert many.columns == docs.columns


# -- sharding


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 50), st.integers(0, 2**31))
def test_places_are_a_permutation(count, shards, seed):
    shard, slot = sharding.place(np.arange(count), count, shards, seed)
    taken = Counter(zip(shard.tolist(), slot.tolist(), strict=True))
    assert len(taken) == count
    sizes = Counter(shard.tolist())
    assert max(sizes.values()) - (min(sizes.values()) if len(sizes) == shards else 0) <= 1
    for s, n in sizes.items():
        assert {slot for sh, slot in taken if sh == s} == set(range(n))
    row = count // 2
    assert sharding.row_at(int(shard[row]), int(slot[row]), count, shards, seed) == row


def test_shuffle_looks_random():
    count = 20_000
    shard, slot = sharding.place(np.arange(count), count, 1)
    assert abs(np.corrcoef(np.arange(count), slot)[0, 1]) < 0.03


def test_shards_of_the_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = entry.queries()["op8_feistel_shards"](spark, SF).collect()
    number = {doc_id: i for i, doc_id in enumerate(sorted(docs))}
    shard, slot = sharding.place(np.arange(len(docs)), len(docs), 40)
    assert len(rows) == len(docs)
    for r in rows:
        i = number[r.doc_id]
        assert (r.shard, r.slot) == (shard[i], slot[i])
        assert r.size == len(docs[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
        assert r.law == "rows" and r.grown_shard is None


def test_shards_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = sharding.sharded(docs, 4).collect()
    assert sorted(r.row_number for r in rows) == list(range(docs.count()))
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and math.isclose(sum(sizes.values()), docs.count())
    assert sharding.sharded(nothing(spark)).count() == 0


def test_mixed_documents_keep_columns_of_any_name(spark):
    docs = awkward(spark).select("*", *(F.lit(7).alias(c) for c in ("_copy", "_copies", "_id", "_key", "document", "_first", "rep", "taken")))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r.copies for r in mixing.mix(docs).groupBy("doc_id").agg(F.max("copies").alias("copies")).collect()}
    rows = mixed.collect()
    assert {(r._copy, r._copies, r._id, r._key, r.document) for r in rows} == {(7, 7, 7, 7, 7)}
    given = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    assert len(rows) == sum(given[k] * counts[k] for k in given)
    assert mixing.mixed_documents(nothing(spark)).count() == 0
