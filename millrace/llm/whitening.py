"""Embedding whitening by an incremental eigendecomposition of the covariance.

1. Each task keeps the spectral form of its centred second moments. A vector adds one rank-one term, ``m/(m+1) d d'`` for its distance
   d to the mean so far: the new eigenvalues are the roots of a secular equation, found between the old ones; directions that the
   term does not touch, or that share an eigenvalue, are deflated first. Weights are recomputed from the roots, so that the
   eigenvectors stay orthogonal.
2. Spectra meet in groups of ``MEET``, in rounds: one takes up the other's eigenpairs as rank-one terms, then the distance of the two means.
3. The result turns by the accumulated rounding of thousands of updates. One distributed Rayleigh-Ritz step removes that:
   the covariance is projected on the orthonormalised basis, each task summing products of exactly centred vectors,
   and the small projected matrix is solved.

What a task holds is one batch and a basis (dimensions squared); the driver sees one basis and sums over tasks.

Defined results: vectors that are null or hold null or non-finite entries are dropped; of the others those whose length is the most common one
take part (of equally common ones the greatest length); entries beyond a long saturate; equal vectors count once in the fit, however
often they are repeated; rows without id get their rows too; other columns are not read; components whose eigenvalue is rounding
(1e-12 of the trace) are left out, so an empty table, empty vectors or a single distinct vector give an empty
result; a deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

COMPONENTS = 4
SCALE = 256
MEET = 8
RANK = 1e-12  # of the trace: below, an eigenvalue is rounding
EPS = np.finfo(np.float64).eps

SPECTRUM = "number long, m long, mean array<double>, values array<double>, basis binary"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# -- rank-one updates


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots t of ``1 + rho sum z_i^2 / (d_i - t) = 0`` for rising d, no z of 0 and rho > 0.

    Returns the roots and the matrix ``d_i - t_j``, which is accurate although roots lie close to poles: each root is
    sought as its distance to the nearer pole, by interpolation between its two poles inside a shrinking bracket.
    """
    k = len(d)
    square = rho * z * z
    last = np.arange(k) == k - 1
    gap = np.append(np.diff(d), square.sum())
    middle = d + gap / 2
    value = 1 + (square[:, None] / (d[:, None] - middle)).sum(axis=0)
    origin = np.where((value >= 0) | last, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d[:, None] - d[origin]
    low = np.where(origin == np.arange(k), np.where((value < 0) & last, gap / 2, 0), -gap / 2)
    high = np.where(origin == np.arange(k), np.where(last & (value < 0), gap, gap / 2), 0)
    one = np.where(last, max(k - 2, 0), np.arange(k))  # the two poles of the interpolation
    two = np.minimum(one + 1, k - 1)
    root, ones = (low + high) / 2, np.ones(k)
    open_, part = np.arange(k), delta  # columns whose root is still sought
    below = (np.arange(k)[:, None] <= one).astype(np.float64)
    for _ in range(80):
        t, lo, hi = root[open_], low[open_], high[open_]
        apart = part - t
        terms = square[:, None] / apart
        slopes = terms / apart
        left, f = ones @ (terms * below), 1 + ones @ terms
        size = 1 + np.abs(left) + np.abs(f - 1 - left)
        lo, hi = np.where(f < 0, t, lo), np.where(f > 0, t, hi)
        low[open_], high[open_] = lo, hi
        more = (np.abs(f) > 8 * EPS * k * size) & (hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if not more.any():
            break
        psi = ones @ (slopes * below)
        phi = ones @ slopes - psi
        columns = np.arange(len(open_))
        near, far = apart[one[open_], columns], apart[two[open_], columns]
        with np.errstate(all="ignore"):
            c = f - near * psi - far * phi
            a = (near + far) * f - near * far * (psi + phi)
            b = near * far * f
            wide = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            wide = np.where(last[open_], -wide, wide)  # the last root has both poles on its left
            direct = np.where(last[open_], a >= 0, a <= 0)
            new = t + np.where(direct, (a - wide) / (2 * c), 2 * b / (a + wide))
            inside = (new > lo) & (new < hi)
        root[open_] = np.where(more, np.where(inside, new, (lo + hi) / 2), t)
        if 2 * more.sum() < len(open_):
            open_, part, below = open_[more], part[:, more], below[:, more]
    return d[origin] + root, delta - root


def merged_directions(values: np.ndarray, basis: np.ndarray, z: np.ndarray, most: float) -> None:
    """Turn directions of one eigenvalue so that the term touches one of them only; in place, values rise."""
    equal = np.flatnonzero(values[1:] - values[:-1] <= most)
    for i in equal:
        length = np.hypot(z[i], z[i + 1])
        if length > 0 and z[i] != 0:
            c, s = z[i + 1] / length, z[i] / length
            basis[:, [i, i + 1]] = np.column_stack((c * basis[:, i] - s * basis[:, i + 1], s * basis[:, i] + c * basis[:, i + 1]))
            z[i], z[i + 1] = 0.0, length


def rank_one(values: np.ndarray, basis: np.ndarray, rho: float, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectral form of ``basis diag(values) basis' + rho vector vector'`` for rising values and rho >= 0."""
    z = vector @ basis
    weight = rho * float(z @ z)
    if not weight > 0:
        return values, basis
    z = z / np.sqrt(z @ z)
    most = 8 * EPS * max(abs(values[-1]), weight)
    if (values[1:] - values[:-1] <= most).any():
        basis = basis.copy()
        merged_directions(values, basis, z, most)
    live = np.flatnonzero(weight * np.abs(z) > most)
    d, w = values[live], z[live]
    if len(live) == 1:
        roots, turned = d + weight * w * w, basis[:, live]
    else:
        roots, apart = secular_roots(d, w, weight)
        k = len(d)
        others = (d[:, None] - d)[~np.eye(k, dtype=bool)].reshape(k, k - 1)
        exact = (apart[:, :-1] / others).prod(axis=1) * -apart[:, -1] / weight  # squared weights for which these roots are exact
        exact = np.sqrt(np.abs(exact)) * np.sign(w)
        turn = exact[:, None] / apart
        turn /= np.sqrt((turn * turn).sum(axis=0))
        turned = basis[:, live] @ turn
    out, columns = values.copy(), basis if len(live) == len(values) else basis.copy()
    if len(live) == len(values):
        return roots, turned  # roots rise with the poles
    out[live], columns[:, live] = roots, turned
    order = np.argsort(out, kind="stable")
    return out[order], columns[:, order]


class Spectrum:
    """Number, mean and centred second moments (as rising eigenvalues and basis) of some vectors."""

    def __init__(self, m: int, mean: np.ndarray, values: np.ndarray, basis: np.ndarray):
        self.m, self.mean, self.values, self.basis = m, mean, values, basis

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        apart = x - self.mean
        self.values, self.basis = rank_one(self.values, self.basis, self.m / (self.m + 1), apart)
        self.m += 1
        self.mean = self.mean + apart / self.m

    def take(self, other: Spectrum) -> None:
        """The other's eigenpairs one by one, then what lies between the means."""
        for value, direction in zip(other.values, other.basis.T, strict=True):
            self.values, self.basis = rank_one(self.values, self.basis, max(value, 0.0), direction)
        m, apart = self.m + other.m, other.mean - self.mean
        self.values, self.basis = rank_one(self.values, self.basis, self.m * other.m / m, apart)
        self.m, self.mean = m, self.mean + apart * (other.m / m)

    def row(self, number: int) -> pa.RecordBatch:
        parts = [[number], [self.m], [self.mean], [self.values], [np.ascontiguousarray(self.basis).tobytes()]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds, strict=True)], names=["number", "m", "mean", "values", "basis"])

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        mean = np.array(row["mean"])
        return cls(row["m"], mean, np.array(row["values"]), np.frombuffer(row["basis"]).reshape(len(mean), -1))


# -- Spark


def whole_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x): ``floor(256 c)`` as long of every entry, rows with unusable vectors dropped."""
    entries = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    fine = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return entries.filter(F.coalesce(fine, F.lit(False))).select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dim)


def sums_of(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension; each task sends a row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total = 0, [0] * dim
        for batch in batches:
            x = matrix(batch, dim)
            m += len(x)
            safe = len(x) and int(np.abs(x.astype(np.float64)).max()) < (1 << 62) // len(x)
            part = x.sum(axis=0) if safe else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, part if len(x) else total, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([m] * dim, pa.int64()), pa.array([str(t) for t in total])], names=["at", "m", "total"]
        )

    rows = fit.select("x").mapInArrow(run, "at int, m long, total string")
    found = rows.groupBy("at").agg(F.sum("m").alias("m"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("at").collect()
    return (int(found[0]["m"]), [int(r["total"]) for r in found]) if found else (0, [0] * dim)


def spectrum_of(fit: DataFrame, dim: int) -> Spectrum | None:
    """The spectral form over all vectors: one per task by rank-one updates, then met in groups, round by round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mine = Spectrum.empty(dim)
        for batch in batches:
            for x in matrix(batch, dim).astype(np.float64):
                mine.add(x)
        if mine.m:
            yield mine.row(TaskContext.get().partitionId())

    def meet(rows: pa.Table) -> pa.Table:
        first, *others = sorted(rows.to_pylist(), key=lambda r: r["number"])
        whole = Spectrum.of(first)
        for other in others:
            whole.take(Spectrum.of(other))
        return pa.Table.from_batches([whole.row(first["number"] // MEET)])

    held = stored(fit.select("x").mapInArrow(run, SPECTRUM), "whitening-spectra")
    while held.count() > 1:
        held = stored(held.groupBy(F.expr(f"number div {MEET}")).applyInArrow(meet, SPECTRUM), "whitening-spectra")
    rows = held.collect()  # one basis
    return Spectrum.of(rows[0].asDict()) if rows else None


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n``: subtracted as whole numbers where they fit, so that nothing cancels."""
    if len(x) and (np.abs(x.astype(np.float64)).max() * n + np.abs(sums.astype(np.float64)).max()) < 2**62:
        return (x * n - sums.astype(np.int64)) / n
    return ((x.astype(object) * n - sums) / n).astype(np.float64)


def projected(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``basis' V basis``: products of centred and projected vectors, summed over the tasks."""
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = centred(matrix(batch, len(basis)), n, sums) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    rows = fit.select("x").mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((width, width))
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # one row per pair of directions
        out[r["i"], r["j"]] = r["v"] / n
    return (out + out.T) / 2


class Whitening:
    """The fitted transform: exact mean, and the unit eigenvectors of the leading components."""

    def __init__(self, n: int, sums: np.ndarray, vectors: np.ndarray, values: np.ndarray, trace: float, error: float):
        self.n, self.sums, self.vectors, self.values, self.trace, self.error = n, sums, vectors, values, trace, error


def fitted(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """``fit`` holds each distinct x once."""
    n, total = sums_of(fit, dim)
    spectrum = spectrum_of(fit, dim) if n > 1 else None
    if spectrum is None:
        return None
    sums = np.array(total, dtype=object)
    basis, _ = np.linalg.qr(spectrum.basis)
    values, turn = np.linalg.eigh(projected(fit, n, sums, basis))
    trace = float(values.sum())
    lead = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > RANK * trace]
    if not lead:
        return None
    vectors = basis @ turn[:, lead]
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(lead))])  # either sign will do; this one does not depend on tasks
    white = projected(fit, n, sums, vectors / np.sqrt(values[lead]))
    error = float(np.abs(white - np.eye(len(lead))).max())
    return Whitening(n, sums, vectors, values[lead], trace, error)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """``sum (n x - S)^2``, exact; null beyond a long."""
    reach = np.abs(x.astype(np.float64)).max(initial=0) * n + np.abs(sums.astype(np.float64)).max(initial=0)
    if reach * reach * x.shape[1] < 2**62:
        apart = x * n - sums.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = x.astype(object) * n - sums
    return [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]


def whitened(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(df, vector)
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    model = None
    if dim:
        rows = rows.filter(F.size("x") == dim)
        model = fitted(stored(rows.select("x").distinct(), "whitening-fit"), dim, components)
    if model is None:
        return df.sparkSession.createDataFrame([], RESULT)
    transform, explained, k = model.vectors / np.sqrt(model.values), model.values / model.trace, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, dim)
            m = len(x)
            white = centred(x, model.n, model.sums) @ transform
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, RESULT)
