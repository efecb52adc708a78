"""Whitening of embeddings by incremental eigendecomposition.

A vector's entries c become whole numbers x = floor(256 c); the fit list holds every distinct x once.  Each task keeps the
spectrum of what it has seen: count, exact sums, and eigenvalues and eigenvectors of the scatter about the mean.
A new vector is a centred rank-one update: the scatter grows by a multiple of the outer product of the vector less the
mean, so the new eigenvalues are the roots of a secular equation between the old ones, and
the new eigenvectors follow from the roots.  Directions in which the update has no part, and equal eigenvalues, are
deflated: they keep their value (equal ones are first turned so that one of them takes the whole part).
A block of more vectors than dimensions is centred and condensed by QR to as many rows as dimensions with the same
scatter; those rows and the shift of the mean are then the rank-one updates (``block`` = 1: each vector by itself).

Spectra of tasks meet in rounds, a few at a time: each eigenpair of one is a rank-one update of the other, and the
distance of the means another.  At last a distributed Rayleigh-Ritz step refines the basis: all tasks sum
the products of the fit list in the coordinates of the basis, centred by the exact mean before
multiplying, and the small matrix is solved on the driver, which removes what rounding the updates gathered.

Rows whose vector is null or holds null or non-finite entries are left out. Shorter vectors count as ended by zeros. Entries
beyond the range of 64-bit numbers stop at its ends; a deviation that doesn't fit is null.  Repeated rows come back as often as
they stand there, rows without an id keep a null id, and other columns play no part.  Components without variance (fewer
distinct vectors than dimensions) have whitened 0 and explained 0 and stay out of identity_error; equal eigenvalues leave
their components free inside their space.  An empty table gives an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.grouped import SUMMARY, meet, schema_of
from vitrine.session import materialize

STEP = 256
COMPONENTS = 4
#: vectors that are condensed at once
BLOCK = 512
#: eigenvalues below this share of the largest are none
NONE = 1e-12
_EPS = np.finfo(float).eps


# one rank-one update


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z_i^2 / (d_i - t)) = 0 for rising d and nonzero z: (nearest pole's number, distance from it).

    The root between two poles is found from the nearer one, so that differences keep their digits: a step of the
    two-pole interpolation, or half the bracket where that leaves it.
    """
    n, w = len(d), rho * z * z
    gap = np.append(np.diff(d), w.sum())
    middle = d[:, None] - d[None, :] - gap[None, :] / 2  # [i, j]: pole i from the middle of interval j
    left = 1 + (w[:, None] / middle).sum(axis=0) >= 0  # the root lies in the left half
    left[-1] = True
    at = np.where(left, np.arange(n), np.arange(n) + 1)
    poles = d[:, None] - d[at][None, :]
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, np.append(gap[:-1] / 2, gap[-1]), 0.0)
    t = (low + high) / 2
    below = np.arange(n)[:, None] <= np.arange(n)[None, :]
    one, two = poles[np.arange(n), np.arange(n)], np.append(poles[np.arange(1, n), np.arange(n - 1)], np.inf)
    for _ in range(60):
        far = poles - t
        part = w[:, None] / far
        slope = part / far
        f = 1 + part.sum(axis=0)
        size = 1 + np.abs(part).sum(axis=0)
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        done = (np.abs(f) <= 8 * _EPS * size) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        # each side's sum as a constant and one pole, with its value and slope
        p, dp = np.where(below, part, 0).sum(axis=0), np.where(below, slope, 0).sum(axis=0)
        q, dq = f - 1 - p, slope.sum(axis=0) - dp
        a, b = one - t, two - t
        a2, b2 = dp * a * a, np.where(np.isfinite(b), dq * np.where(np.isfinite(b), b, 0.0) ** 2, 0.0)
        c = 1 + p - dp * a + q - np.where(np.isfinite(b), dq * np.where(np.isfinite(b), b, 0.0), 0.0)
        # c + a2 / (a - s) + b2 / (b - s) = 0
        b_ = np.where(np.isfinite(b), b, 0.0)
        with np.errstate(all="ignore"):
            mid = np.where(np.isfinite(b), c * (a + b_) + a2 + b2, c * a + a2)
            end = np.where(np.isfinite(b), c * a * b_ + a2 * b_ + b2 * a, 0.0)
            root = np.sqrt(np.maximum(mid * mid - 4 * c * end, 0.0))
            s = np.where(np.isfinite(b), np.where(mid > 0, 2 * end / (mid + root), (mid - root) / (2 * c)), mid / c)
        new = t + s
        ok = np.isfinite(new) & (new > low) & (new < high)
        t = np.where(done, t, np.where(ok, new, (low + high) / 2))
    return at, t


def rank_one(values: np.ndarray, basis: np.ndarray, row: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of basis diag(values) basis^T + rho row row^T, for rho >= 0."""
    z = row @ basis
    norm = float(np.sqrt(z @ z))
    if rho <= 0 or norm == 0 or not np.isfinite(norm):
        return values, basis
    z, rho = z / norm, rho * norm * norm
    scale = max(float(np.abs(values).max()), rho)
    tiny = 8 * _EPS * scale
    basis = basis.copy()
    # equal eigenvalues: turn pairs so that the later one takes the whole part
    for i in np.flatnonzero(np.diff(values) <= tiny).tolist():
        r = float(np.hypot(z[i], z[i + 1]))
        if r and z[i]:
            c, s = z[i + 1] / r, z[i] / r
            basis[:, i], basis[:, i + 1] = c * basis[:, i] - s * basis[:, i + 1], s * basis[:, i] + c * basis[:, i + 1]
            z[i], z[i + 1] = 0.0, r
    active = np.flatnonzero(rho * np.abs(z) > tiny)
    if not len(active):
        return values, basis
    d, za = values[active], z[active]
    # what is still equal among the active ones (only after turning) is told apart by a hair
    d = np.maximum.accumulate(d + tiny * 1e-3 * np.arange(len(d))) if len(d) > 1 and (np.diff(d) <= 0).any() else d
    at, t = secular_roots(d, za, rho)
    far = (d[:, None] - d[at][None, :]) - t[None, :]  # d_i - root_j
    # the part for which these roots are exact (it keeps the eigenvectors orthogonal)
    n = len(d)
    gaps = d[:, None] - d[None, :] + np.eye(n)
    ratio = np.where(np.eye(n, dtype=bool), -far, far / np.where(gaps == 0, 1.0, gaps))
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1)) / rho) * np.where(za < 0, -1.0, 1.0)
    with np.errstate(all="ignore"):
        turn = exact[:, None] / far
    turn[~np.isfinite(turn)] = 0.0
    length = np.sqrt(np.square(turn).sum(axis=0))
    turn /= np.where(length == 0, 1.0, length)
    out = values.copy()
    out[active] = d[at] + t
    basis[:, active] = basis[:, active] @ turn
    order = np.argsort(out, kind="stable")
    return np.maximum(out[order], 0.0), basis[:, order]


class Spectrum:
    """Count, exact sums and scatter about the mean, as eigenvalues (rising) and eigenvectors."""

    def __init__(self, size: int, block: int = BLOCK) -> None:
        self.size, self.block = size, block
        self.n, self.sums = 0, [0] * size
        self.values, self.basis = np.zeros(size), np.eye(size)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(self.size)

    def _shifted(self, n: int, mean: np.ndarray) -> None:
        """What the distance to the mean of ``n`` more vectors adds to the scatter."""
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, mean - self.mean, self.n * n / (self.n + n))

    def add(self, x: np.ndarray) -> None:
        """Add whole-number rows."""
        for a in range(0, len(x), self.block):
            part = x[a : a + self.block]
            sums = [int(s) for s in part.astype(object).sum(axis=0)] if np.abs(part.astype(float)).max(initial=0) > 1e12 else part.sum(axis=0).tolist()
            mean = np.array([s / len(part) for s in sums])
            self._shifted(len(part), mean)
            if len(part) > 1:
                rows = part.astype(float) - mean
                for row in np.linalg.qr(rows, mode="r") if len(rows) > self.size else rows:
                    self.values, self.basis = rank_one(self.values, self.basis, row, 1.0)
            self.n += len(part)
            self.sums = [p + q for p, q in zip(self.sums, sums)]

    def join(self, other: Spectrum) -> None:
        """Add another spectrum, eigenpair by eigenpair."""
        if other.n:
            self._shifted(other.n, other.mean)
            for value, row in zip(other.values, other.basis.T):
                self.values, self.basis = rank_one(self.values, self.basis, row, float(value))
            self.n += other.n
            self.sums = [p + q for p, q in zip(self.sums, other.sums)]


# jobs


def whole(embedding: str) -> F.Column:
    """x of a row as array<long>, null if it takes no part."""
    c = F.col(embedding)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(c.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(c, lambda v: F.floor(v.cast("double") * STEP)))


def numbers(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """A list column of whole numbers as a matrix, shorter rows ended by zeros."""
    out = np.zeros((len(column), size), dtype=np.int64)
    for i, v in enumerate(column):
        v = v.values.to_numpy(zero_copy_only=False)
        out[i, : len(v)] = v
    return out


def summed(parts: list[bytes]) -> bytes:
    return pickle.dumps(sum(pickle.loads(p) for p in parts))


def summaries(fit: DataFrame, size: int, start) -> DataFrame:
    """One summary per task: ``start()`` gives a function of whole-number rows and one without arguments that ends it."""
    schema = schema_of(SUMMARY)

    def run(batches):
        add, end = start()
        for batch in batches:
            add(numbers(batch.column("x"), size))
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "summary": [pickle.dumps(end())]}, schema=schema)

    return fit.mapInArrow(run, SUMMARY)


def spectrum(fit: DataFrame, size: int, block: int = BLOCK) -> Spectrum:
    """The spectrum of a table of distinct x."""

    def start():
        own = Spectrum(size, block)
        return own.add, lambda: own

    def add(parts: list[bytes]) -> bytes:
        first = pickle.loads(parts[0])
        for p in parts[1:]:
            first.join(pickle.loads(p))
        return pickle.dumps(first)

    last = meet(summaries(fit, size, start), SUMMARY, add, "whiten-spectra")
    return pickle.loads(last) if last else Spectrum(size, block)


def products(fit: DataFrame, size: int, n: int, sums: list[int], basis: np.ndarray, name: str) -> np.ndarray:
    """Covariance of a table of x in the coordinates of a basis, centred before multiplying."""

    def start():
        total, mean = np.zeros((basis.shape[1], basis.shape[1])), np.array([s / n for s in sums])

        def add(x: np.ndarray) -> None:
            y = (x - mean) @ basis
            total[...] += y.T @ y

        return add, lambda: total

    last = meet(summaries(fit, size, start), SUMMARY, summed, name)
    return pickle.loads(last) / n if last else np.zeros((basis.shape[1], basis.shape[1]))


class Whitening:
    """n, S and the leading components (falling), their eigenvalues and shares, and what whitening misses of the identity."""

    def __init__(self, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray, shares: np.ndarray, error: float) -> None:
        self.n, self.sums, self.vectors, self.values, self.shares, self.error = n, sums, vectors, values, shares, error

    @property
    def scaled(self) -> np.ndarray:
        """Components over the roots of their eigenvalues; none where there is no variance."""
        return self.vectors * np.where(self.values > 0, 1 / np.sqrt(np.where(self.values > 0, self.values, 1.0)), 0.0)


def fit(rows: DataFrame, embedding: str = "embedding", components: int = COMPONENTS, block: int = BLOCK) -> Whitening | None:
    """Fit on the distinct x of all rows; None if no row takes part."""
    distinct = materialize(rows.select(whole(embedding).alias("x")).where("x IS NOT NULL").distinct(), "whiten-fit")
    size = distinct.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return None
    if not size:
        return Whitening(1, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    found = spectrum(distinct, size, block)
    n, sums = found.n, found.sums
    # Rayleigh-Ritz: solve the covariance in the found basis (made orthonormal to the last bit)
    basis = np.linalg.qr(found.basis)[0]
    values, turn = np.linalg.eigh(products(distinct, size, n, sums, basis, "whiten-ritz"))
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    values = np.where(values > NONE * max(values[0], 0.0), values, 0.0) if values[0] > 0 else np.zeros(size)
    shares = values / values.sum() if values.sum() > 0 else values
    k = min(components, size)
    model = Whitening(n, sums, vectors[:, :k], values[:k], shares[:k], 0.0)
    if (model.values > 0).any():
        measured = products(distinct, size, n, sums, model.scaled, "whiten-identity")
        model.error = float(np.abs(measured - np.diag((model.values > 0).astype(float))).max())
    return model


def whiten(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes part and each component."""
    ddl = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = schema_of(ddl)
    model = fit(rows, embedding, components, block)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], ddl)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        size, k = len(m.sums), len(m.values)
        mean, scaled = np.array([s / m.n for s in m.sums]), m.scaled
        for batch in batches:
            x = numbers(batch.column("x"), size)
            bound = size * (m.n * max(int(np.abs(x.astype(float)).max(initial=0)) + 1, 1) + max(abs(s) for s in m.sums)) ** 2
            if bound < 1 << 62:
                deviation = np.square(m.n * x - np.array(m.sums, dtype=np.int64)).sum(axis=1).tolist()
            else:
                exact = [sum((m.n * int(v) - s) ** 2 for v, s in zip(r, m.sums)) for r in x]
                deviation = [v if v < 1 << 63 else None for v in exact]
            y = (x - mean) @ scaled
            count = len(x)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(count), k))), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), count),
                "n": np.full(count * k, m.n), "deviation": pa.array([v for v in deviation for _ in range(k)], pa.int64()), "whitened": y.ravel(),
                "explained": np.tile(m.shares, count), "identity_error": np.full(count * k, m.error),
            }, schema=schema)

    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), whole(embedding).alias("x")).where("x IS NOT NULL").mapInArrow(run, ddl)
