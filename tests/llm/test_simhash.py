import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.llm import simhash
from tests.conftest import SF
from tests.llm.helpers import awkward, nothing, rows_of


def by_hand(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance):
    """Component of each key by comparing all pairs."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: find(k) for k in prints}


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {k: by_hand(t) for k, t in texts.items()}
    roots = classes(prints, 4)
    rows = entry.queries()["op7_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {k: (f"{prints[k]:016x}", roots[k]) for k in texts}
    assert len(rows) == len(texts)


def planted(seed, centers, members, most_flips):
    draw, prints = random.Random(seed), {}
    for _ in range(centers):
        center = draw.getrandbits(64)
        for _ in range(members):
            value = center
            for bit in draw.sample(range(64), draw.randint(0, most_flips)):
                value ^= 1 << bit
            prints[len(prints)] = value
    return {k: v for k, v in {v: k for k, v in reversed(prints.items())}.items()}


@pytest.mark.parametrize("hot_bucket", [1500, 3])
@pytest.mark.parametrize("distance", [2, 4])
def test_links_connect_what_pairs_connect(spark, hot_bucket, distance):
    prints = {rep: fp for fp, rep in planted(3 + distance, 25, 16, 4).items()}
    frame = spark.createDataFrame([(simhash.signed(fp), rep) for rep, fp in prints.items()], "fp long, rep long")
    roots = {r.id: r.root for r in simhash.components(simhash.links(frame, distance, hot_bucket)).collect()}
    expected = classes(prints, distance)
    assert {k: roots.get(k, k) for k in prints} == expected
    assert len(set(expected.values())) < len(prints)


@pytest.mark.parametrize("block", [simhash.BLOCK, 20])
def test_hot_buckets_leave_a_row_a_member(spark, monkeypatch, block):
    """Members of a hot bucket are compared by blocks; midpoints are for buckets of too many blocks."""
    def refuse(*_):
        raise AssertionError("2081 rows a member")

    monkeypatch.setattr(simhash, "midpoint_stars", refuse)
    prints = {rep: fp for fp, rep in planted(11, 6, 20, 4).items()}
    frame = spark.createDataFrame([(simhash.signed(fp), rep) for rep, fp in prints.items()], "fp long, rep long")
    members = frame.withColumn("part", F.lit(0)).withColumn("value", F.lit(5).cast("long"))
    edges = simhash.crowded(members, 4, block)
    pairs = 1 if block > len(prints) else -(-len(prints) // block) * (-(-len(prints) // block) - 1) // 2
    assert edges.count() < pairs * min(len(prints), 3 * block)
    for graph in (edges, simhash.links(frame, 4, 3)):
        roots = {r.id: r.root for r in simhash.components(graph).collect()}
        assert {k: roots.get(k, k) for k in prints} == classes(prints, 4)


def test_buckets_of_too_many_blocks_meet_at_midpoints(spark):
    prints = {rep: fp for fp, rep in planted(12, 6, 20, 4).items()}
    frame = spark.createDataFrame([(simhash.signed(fp), rep) for rep, fp in prints.items()], "fp long, rep long")
    roots = {r.id: r.root for r in simhash.components(simhash.links(frame, 4, 3, block=1)).collect()}
    assert {k: roots.get(k, k) for k in prints} == classes(prints, 4)


def test_columns_of_any_name_and_small_plans(spark):
    docs = awkward(spark).select("*", *(F.lit(7).alias(c) for c in ("_first", "document", "rep", "root", "id")))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and {(r._first, r.document) for r in kept.collect()} == {(7, 7)}
    prints = spark.createDataFrame([(n * 977, n) for n in range(50)], "fp long, rep long")
    flipped = simhash.flipped(prints, [(2**64 - 1, simhash.flips(range(64), 2))])
    assert len(flipped._jdf.queryExecution().toString()) < 10_000
    assert flipped.count() == 50 * 2081
    values = {r.value for r in flipped.filter("rep = 3").collect()}
    assert len(values) == 2081 and all((v ^ 3 * 977).bit_count() <= 2 or v < 0 for v in values)


def test_thresholds_meet_the_pigeonhole_bound():
    draw = np.random.default_rng(1)
    sample = draw.integers(0, 2**63, 500, dtype=np.uint64)
    for distance in (2, 4, 6):
        for parts in range(2, distance + 2):
            groups = simhash.group_bits(draw.random((64, 64)), parts)
            assert sorted(b for g in groups for b in g) == list(range(64))
            _, chosen = simhash.allocate(sample, groups, 1_000_000, distance)
            assert sum(t + 1 for t in chosen) == distance + 1 and min(chosen) >= -1


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 400)]
    star = [(7, i) for i in range(1000, 1500)] + [(3, 7)]
    edges = spark.createDataFrame([(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(chain + star)], "a long, b long")
    roots = {r.id: r.root for r in simhash.components(edges).collect()}
    assert all(roots[i] == 100 for i in range(100, 401))
    assert all(roots[i] == 3 for i in [3, 7, *range(1000, 1500)])
    assert simhash.components(edges.limit(0)).count() == 0


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = simhash.near_duplicates(docs)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(rows, "doc_id", "fingerprint") == sorted(((k, f"{by_hand(t):016x}") for k, t in texts), key=repr)
    ids = {r.doc_id: r.component_id for r in rows.collect()}
    assert ids[0] == ids[1] == 0 and ids[3] == ids[4] == ids[5] == 3
    by_print = {(r.doc_id, r.fingerprint): r.component_id for r in rows.collect()}
    lonely = next(t for k, t in texts if k is None and t)
    assert by_print[None, f"{by_hand(lonely):016x}"] is None and by_print[None, "0" * 16] == 3
    assert simhash.near_duplicates(nothing(spark)).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {1, 4, 5}.isdisjoint({r.doc_id for r in kept.collect()})
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, distance=3)
