import random
from collections import defaultdict

import corpus_pipeline
from millrace.llm import jaccard
from tests.conftest import SF
from tests.llm.helpers import awkward, nothing, prose


def sets_by_hand(texts):
    out = {}
    for k, text in texts.items():
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        out[k] = frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)][: len(words)])
    return out


def kept_by_hand(texts):
    """Smallest id of each component of all pairs with five-word Jaccard of 0.8 or more, by comparing every pair that shares a shingle."""
    sets, root, holders = sets_by_hand(texts), {k: k for k in texts}, defaultdict(list)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in sorted(sets):
        for other in {o for s in sets[k] or [None] for o in holders[s]}:
            a, b = sets[k], sets[other]
            if 5 * len(a & b) >= 4 * len(a | b):
                low, high = sorted((find(k), find(other)))
                root[high] = low
        for s in sets[k] or [None]:
            holders[s].append(k)
    return {k for k in texts if find(k) == k}


def edited(seed, bases, copies, most):
    draw, made = random.Random(seed), []
    for n in range(bases):
        made.append(prose(seed * 1000 + n, draw.randint(20, 200)))
        for _ in range(copies):
            words = made[-1 if draw.random() < 0.5 else -1 - draw.randrange(min(len(made), 3))].split()
            for _ in range(draw.randint(0, most)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
            made.append(" ".join(words))
    return dict(enumerate(made))


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def test_stage_matches_all_pairs_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    wanted = kept_by_hand(texts)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()} == wanted
    assert len(wanted) < len(texts)


def test_edited_copies_and_chains_match_all_pairs(spark):
    texts = edited(3, 25, 12, 3)
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, texts), SF).collect()]
    assert len(got) == len(set(got)) and set(got) == kept_by_hand(texts)


def test_common_shingles_change_work_only(spark, monkeypatch):
    line = prose(5, 30)
    texts = {k: f"{line} {t}" for k, t in edited(4, 20, 6, 2).items()}
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "SALT", 3)
    assert len(jaccard.common_shingles(frame(spark, texts))) >= 26
    assert {r.doc_id for r in jaccard.one_of_each(frame(spark, texts)).collect()} == kept_by_hand(texts)


def test_awkward_documents(spark):
    docs = awkward(spark)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and {1, 2, 4, 5}.isdisjoint(ids) and {0, 3, 6, 7, 8, 11, 12} <= set(ids)
    assert jaccard.one_of_each(nothing(spark)).count() == 0


def test_bitmaps_bound_the_difference():
    draw = random.Random(8)
    for _ in range(200):
        a = jaccard.shingles(prose(draw.randrange(10**6), draw.randint(1, 400)))
        b = jaccard.np.union1d(draw.sample(a.tolist(), draw.randint(0, len(a))), jaccard.shingles(prose(draw.randrange(10**6), draw.randint(1, 60)))).astype("int64")
        apart = int(jaccard.np.bitwise_count((jaccard.parities(a) ^ jaccard.parities(b)).view("u8")).sum())
        assert apart <= len(jaccard.np.setxor1d(a, b)) and apart % 2 == len(jaccard.np.setxor1d(a, b)) % 2
    assert len(jaccard.parities(jaccard.shingles(""))) * 64 == jaccard.BITS


def test_common_passage_makes_no_pairs_and_columns_may_clash(spark):
    """Many documents share a passage and are not alike: the candidate join leaves few rows, and links stay whole."""
    passage = prose(6, 40)
    texts = {k: f"{prose(100 + k, 60)} {passage}" for k in range(120)} | {k + 200: t for k, t in edited(9, 10, 5, 2).items()}
    docs = frame(spark, texts).selectExpr("doc_id", "text", "doc_id AS _first", "1 AS rep", "2 AS root", "3 AS key", "4 AS document")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == kept_by_hand(texts)
    sets = jaccard.distinct_sets(docs)
    x, y = sets.alias("x"), sets.alias("y")
    met = x.join(y, (jaccard.F.col("x.key") < jaccard.F.col("y.key")) & jaccard.differ_little("x", "y")).count()
    assert met < 20 * len(texts)


def test_simhash_links_verified_pairs_first(spark):
    base = prose(5, 400)
    near = base + " one"
    docs = frame(spark, {1: base, 2: near, 3: prose(6, 400)})
    sets = jaccard.distinct_sets(docs)
    by_rep = {r.rep: r.key for r in sets.collect()}
    found = {frozenset((r.a, r.b)) for r in jaccard.print_links(docs, sets).collect()}
    assert found == {frozenset((by_rep[1], by_rep[2]))}


def test_groups_of_near_copies_verify_few_pairs(spark, monkeypatch):
    """All pairs of one group are candidates; linked sets meet once, and no component is lost."""
    base = prose(11, 300).split()
    texts = {k: " ".join([*base, f"x{k}"]) for k in range(60)} | {k + 100: t for k, t in edited(12, 6, 8, 3).items()}
    docs = frame(spark, texts)
    sets = jaccard.distinct_sets(docs)
    x, y = sets.alias("x"), sets.alias("y")
    pairs = x.join(y, jaccard.F.col("x.key") < jaccard.F.col("y.key")).selectExpr("x.key AS a", "y.key AS b", "x.size AS _n", "y.size AS _m").filter(
        jaccard.near_in_size(jaccard.F.col("_n"), jaccard.F.col("_m"))
    )
    whole = {(r.id, r.root) for r in jaccard.components(jaccard.verified(docs, sets, pairs)).collect()}
    met, verified = [], jaccard.verified

    def counted(docs, sets, some, width=5):
        met.append(some.count())
        return verified(docs, sets, some, width)

    monkeypatch.setattr(jaccard, "verified", counted)
    assert {(r.id, r.root) for r in jaccard.components(jaccard.linked(docs, sets, pairs)).collect()} == whole
    assert met[0] < len(texts) and sum(met) < pairs.count() - 1500
