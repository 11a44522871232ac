import numpy as np
import pytest

from millrace.llm import whitening as w
from tests.conftest import SF


def by_hand(rows):
    """{row number: (n, deviation, whitened up to sign, explained)} from numpy's eigensolver and whole numbers."""
    kept = [(i, [int(np.floor(float(c) * 256)) for c in v]) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    fit = sorted(set(map(lambda r: tuple(r[1]), kept)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array(fit, dtype=np.float64) - np.array(sums) / n
    values, vectors = np.linalg.eigh(x.T @ x / n)
    lead = [-1 - k for k in range(min(4, len(values))) if values[-1 - k] > 1e-12 * values.sum()]
    out = []
    for i, v in kept:
        white = [(np.array(v) - np.array(sums) / n) @ vectors[:, k] / np.sqrt(values[k]) for k in lead]
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
        out += [(i, at + 1, n, deviation, y, values[k] / values.sum()) for at, (k, y) in enumerate(zip(lead, white, strict=True))]
    return out


def same(df, wanted, rel=1e-6):
    got = df.collect()
    assert len(got) == len(wanted)
    assert all(r.identity_error < 1e-9 for r in got) and len({r.identity_error for r in got}) <= 1

    def order(row):
        return (row[0] is None, row[0] or 0, row[1], row[3] or 0, abs(row[4]))

    for component in {r.component for r in got}:
        mine = sorted([tuple(r)[:6] for r in got if r.component == component], key=order)
        theirs = sorted([r for r in wanted if r[1] == component], key=order)
        sign = np.sign(sum(a[4] * b[4] for a, b in zip(mine, theirs, strict=True)))
        for a, b in zip(mine, theirs, strict=True):
            assert a[:3] == b[:3] and a[3] == (b[3] if b[3] < 1 << 63 else None)
            assert sign * a[4] == pytest.approx(b[4], rel=rel, abs=1e-8) and a[5] == pytest.approx(b[5], rel=1e-9)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.5) for i, v in rows], "vec_id long, embedding array<double>, n long, whitened double")


def test_table_matches_eigensolver(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    same(w.whitened(df.repartition(3)), by_hand([(r.vec_id, r.embedding) for r in df.collect()]))


@pytest.mark.parametrize("dim, rank", [(1, 1), (2, 2), (9, 9), (24, 5), (40, 40)])
def test_rank_one_updates_keep_the_spectral_form(dim, rank):
    draw = np.random.default_rng(dim)
    x = draw.normal(size=(150, rank)) @ draw.normal(size=(rank, dim)) * 10.0 ** draw.integers(-3, 4, dim)
    x[40:60] = x[10]
    parts = [w.Spectrum.empty(dim) for _ in range(3)]
    for i, row in enumerate(x):
        parts[i % 3 if i < 100 else 0].add(row)
    whole = parts[0]
    for part in parts[1:]:
        whole.take(part)
    moments = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    most = np.abs(moments).max()
    assert whole.m == 150 and np.abs(whole.basis @ np.diag(whole.values) @ whole.basis.T - moments).max() < 1e-11 * most
    assert np.abs(whole.basis.T @ whole.basis - np.eye(dim)).max() < 1e-11
    assert (np.diff(whole.values) >= 0).all()


def test_close_and_equal_eigenvalues_deflate():
    values = np.array([0.0, 0.0, 1.0, 1.0, 1.0 + 1e-15, 1.0 + 1e-9, 2.0])
    vector = np.array([0.0, 1e-3, 1.0, 1.0, 0.5, 1e-18, 1e-9])
    out, basis = w.rank_one(values, np.eye(7), 0.25, vector)
    whole = np.diag(values) + 0.25 * np.outer(vector, vector)
    assert np.abs(basis @ np.diag(out) @ basis.T - whole).max() < 1e-14
    assert np.abs(basis.T @ basis - np.eye(7)).max() < 1e-14
    assert w.rank_one(values, np.eye(7), 0.25, np.zeros(7))[0] is values


def test_copies_many_tasks_and_great_entries(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else draw.normal(size=3).tolist()) for i in range(600)]
    same(w.whitened(frame(spark, rows).repartition(11)), by_hand(rows))
    great = [(i, (draw.normal(size=2) * 1e13).tolist()) for i in range(60)]
    same(w.whitened(frame(spark, great)), by_hand(great))
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(50)]
    result = w.whitened(frame(spark, flat))
    same(result, by_hand(flat))
    assert {r.component for r in result.collect()} == {1}


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.5]), (2, [-0.0, 0.0]), (2, [-0.0, 0.0]), (None, [0.25, -3.0]), (4, [0.5, 1.501]), (0, [9.0, -9.0])]
    bad = [(3, None), (5, [nan, 1.0]), (6, [1.0, None]), (7, [inf, 0.0]), (8, [1.0]), (9, [])]
    same(w.whitened(frame(spark, rows + bad)), by_hand(rows))
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])], bad[:4]):
        empty = w.whitened(frame(spark, few))
        assert empty.count() == 0 and empty.columns[-1] == "identity_error"
