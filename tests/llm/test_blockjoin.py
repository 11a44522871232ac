import numpy as np
import pytest

from millrace.llm import blockjoin as b
from tests.conftest import SF


def by_hand(rows, k, every=100):
    """All distances in float64; an id's nearest row counts, a query's own rows do not."""
    rows = [
        (i, np.array(v, dtype=np.float64)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    ]
    out = {}
    for q, x in rows:
        if q % every:
            continue
        near = out.setdefault(q, {})
        for i, y in rows:
            if i != q and len(x) == len(y):
                near[i] = min(near.get(i, np.inf), float(np.sqrt(((x - y) ** 2).sum())))
    return {(q, at + 1): (i, d) for q, near in out.items() for at, (d, i) in enumerate(sorted((d, i) for i, d in near.items())[:k])}


def same(df, wanted):
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in df.collect()}
    assert df.count() == len(got) and got.keys() == wanted.keys()
    for key, (vec, score) in wanted.items():
        assert got[key][0] == vec and got[key][1] == pytest.approx(score, rel=1e-12, abs=1e-300)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, i, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, label long, query string, square double")


def test_table_matches_all_distances(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    same(b.nearest(df), by_hand([(r.vec_id, r.embedding) for r in df.collect()], 10))


def test_bounds_hold_and_leave_few_pairs():
    draw = np.random.default_rng(3)
    raw = draw.normal(size=(400, 1500)) * draw.lognormal(0, 3, (400, 1))
    whole = [b.Block(np.arange(len(r)), codes.astype(np.float32), scale, noise, r) for r in (raw[:150], raw[150:]) for codes, scale, noise in [b.Block.quantised(r)]]
    q, c = whole
    product = sum(q.codes[:, d : d + b.EXACT] @ c.codes[:, d : d + b.EXACT].T.astype(np.float64) for d in range(0, 1500, b.EXACT))
    assert (product == q.codes.astype(np.int64) @ c.codes.T.astype(np.int64)).all()
    true = ((q.raw[:, None] - c.raw) ** 2).sum(axis=2)
    likely = q.square[:, None] + c.square - 2 * q.scale[:, None] * c.scale * product
    error = 2 * (q.rounded[:, None] * c.noise + q.noise[:, None] * c.norm)
    assert (np.abs(true - likely) <= error + b.SLACK * (q.square[:, None] + c.square)).all()
    met = []
    heaps = b.Heaps(0, q, 5, None)
    plain = heaps.merge
    heaps.merge = lambda at, other, block: (met.append(len(at)), plain(at, other, block))
    heaps.meet(c)
    assert (np.sort(true, axis=1)[:, :5] == heaps.square).all() and sum(met) < 150 * 250 / 2


def test_copies_ties_clusters_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(b, "QUERY_ROWS", 7)
    monkeypatch.setattr(b, "CANDIDATE_ROWS", 50)
    monkeypatch.setattr(b, "TILE", 3)
    monkeypatch.setattr(b, "PAIRS", 40)
    monkeypatch.setattr(b, "LOT_BYTES", 9 * 9 * 16)
    draw = np.random.default_rng(1)
    common = [1.0, 2.0, -3.0, 0.5]
    rows = [(i, common if i % 3 == 0 else draw.integers(-2, 3, 4).astype(float).tolist()) for i in range(900)]
    rows += [(i, (draw.normal(size=6) * 10.0 ** draw.integers(-30, 30)).tolist()) for i in range(900, 1400)]
    df = frame(spark, rows).repartition(5)
    monkeypatch.setattr(b, "SEEDS", 3)
    held = [(r.vec_id, r.embedding) for r in df.collect()]
    same(b.nearest(df, k=4), by_hand(held, 4))
    same(b.nearest(df, k=4, is_query=b.F.col("vec_id") % 25 == 0, seeds=4), by_hand(held, 4, 25))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [5.0, 5.0]), (2, [0.0, -0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (None, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (100, [-0.0, 1.0]), (-100, [3.4e38, -3.4e38]), (200, None), (300, [0.0, 0.0]), (400, [1.0]),
        (500, [1e-45, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]),
    ]
    df = frame(spark, rows)
    held = [(r.vec_id, r.embedding) for r in df.collect()]
    same(b.nearest(df), by_hand(held, 10))
    same(b.nearest(df, k=1), by_hand(held, 1))
    assert b.nearest(frame(spark, [])).count() == 0
    assert b.nearest(frame(spark, [(100, [1.0])])).count() == 0
