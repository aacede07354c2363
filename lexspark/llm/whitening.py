"""Operator 12: whitening of embeddings by an incremental eigendecomposition.

Entries are scaled by SCALE and floored, and the fit is over each distinct vector once. Every task
walks its share of the fit list and keeps the eigenvalues and eigenvectors of its scatter matrix:
each vector, centred by the mean so far, is a symmetric rank-one update, whose eigenvalues are the
roots of the secular equation and whose vectors follow from them. Before the roots are sought,
coordinates that the update does not touch, and all but one of equal eigenvalues, are deflated.
Two tasks' spectra are combined by the same update, once for each direction of the one that is
added and once for the distance of the means; tasks are combined in a tree of FAN-wide nodes, so
neither the driver nor a task sees more than FAN of them. The last tree node's vectors are the basis
of a Rayleigh-Ritz step: one more pass sums the exactly centred fit list's covariance in that basis,
which is all but diagonal, and its eigenvectors correct what rounding left in the updates. A third
pass measures the covariance of the whitened fit list.

Cost: a vector of dimension d takes d * d * d multiplications and d * d a root step; a task has PART
vectors. What reaches the driver is d * d numbers a pass.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped, and so
are ones with an entry that is over 2^62 when scaled; repeated rows and null vec_ids are returned as
often as they come; vectors of each dimension are a fit of their own, and empty vectors have no
component; components whose eigenvalue is below LEAST of the trace have no scale and are not
returned, so a fit list of one vector returns no rows; a deviation that exceeds a long is null; an
empty table gives an empty table; only vec_id and embedding are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, slices

SCALE, COMPONENTS = 256, 4
PART, FAN = 4096, 16
LEAST = 1e-12
EPS = np.finfo(np.float64).eps
STATE = "part long, n long, sums array<decimal(38,0)>, eigenvalues array<double>, basis array<double>"
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def secular_roots(d: np.ndarray, w: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(w / (d - root)) for rising d, positive w and rho: one above each d.

    Returns the roots and the matrix d[j] - root[i], which is exact to the last digits because each
    root is held as its distance from the nearer of the two d around it. All roots step at once: by
    the rational function that has the same two poles, value and slopes, or by bisection where that
    step leaves the root's bracket.
    """
    k = len(d)
    row = np.arange(k)
    top = np.append(np.diff(d), rho * w.sum())
    origin = row.copy()
    if k > 1:
        middle = d[:-1] + top[:-1] / 2
        left = 1 + rho * (w / (d - middle[:, None])).sum(1) >= 0
        origin[:-1] += ~left
    at = d - d[origin][:, None]
    lo = np.where(origin == row, 0.0, -top / 2)
    hi = np.where(origin == row, np.where(row < k - 1, top / 2, top), 0.0)
    mu = (lo + hi) / 2
    lower, ones, weight = np.tri(k), np.ones(k), rho * w
    gap, t, part = np.empty((k, k)), np.empty((k, k)), np.empty((k, k))
    b_gap = np.zeros(k)
    for _ in range(80):
        np.subtract(at, mu[:, None], out=gap)
        np.divide(weight, gap, out=t)
        total = t @ ones
        f = 1 + total
        # Terms up to the root are negative, those behind it positive.
        done = np.abs(f) <= 4 * EPS * k * (1 + total - 2 * (np.multiply(t, lower, out=part) @ ones))
        lo, hi = np.where(f < 0, mu, lo), np.where(f >= 0, mu, hi)
        done |= hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        if done.all():
            break
        np.divide(t, gap, out=t)
        below = np.multiply(t, lower, out=part) @ ones
        above = t @ ones - below
        a_gap = gap[row, row]
        b_gap[:-1] = gap[row[:-1], row[1:]]
        with np.errstate(all="ignore"):
            c = f - a_gap * below - b_gap * above
            a = (a_gap + b_gap) * f - a_gap * b_gap * (below + above)
            b = a_gap * b_gap * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # The last root has one pole beside it.
            rest = f[-1] - below[-1] * a_gap[-1]
            step[-1] = a_gap[-1] + below[-1] * a_gap[-1] ** 2 / rest
            new = mu + step
            new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)
        mu = np.where(done, mu, new)
    gap = at - mu[:, None]
    # A root that rounding has put on its pole is moved off it by the least amount.
    on = gap[row, row] >= 0
    if on.any():
        gap[row[on], row[on]] = -EPS * EPS * np.maximum(top[on], np.finfo(np.float64).tiny)
    return d[origin] + mu, gap


def rank_one(values: np.ndarray, basis: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors (columns) of basis * diag(values) * basis' + rho * v * v', for rho >= 0."""
    z = basis.T @ v
    size = float(np.linalg.norm(z))
    rho *= size * size
    tolerance = 8 * EPS * max(float(values[-1]), rho)
    if not rho > 0:
        return values, basis
    z /= size
    d, q = values, basis
    live = np.flatnonzero(rho * np.abs(z) > tolerance)
    if not len(live):
        return values, basis
    a, b = live[:-1], live[1:]
    near = (d[b] - d[a]) * np.abs(z[a] * z[b]) <= tolerance * (z[a] ** 2 + z[b] ** 2)
    if near.any():
        d, q = d.copy(), q.copy()
        keep, last = [], live[0]
        for j in live[1:]:
            r = np.hypot(z[last], z[j])
            c, s = z[j] / r, -z[last] / r
            if (d[j] - d[last]) * abs(c * s) <= tolerance:
                z[last], z[j] = 0.0, r
                one, two = q[:, last].copy(), q[:, j].copy()
                q[:, last], q[:, j] = c * one + s * two, c * two - s * one
                d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
            else:
                keep.append(last)
            last = j
        live = np.array([*keep, last])
    live = live[np.argsort(d[live], kind="stable")]
    e = d[live]
    if len(live) == 1:
        roots, turned = e + rho * z[live] ** 2, q[:, live]
    else:
        roots, gap = secular_roots(e, z[live] ** 2, rho)
        # The z for which these roots are exact, so that the vectors are orthogonal.
        apart = e[None, :] - e[:, None]
        np.fill_diagonal(apart, -1.0)
        exact = np.sqrt(np.exp(np.log(np.maximum(gap / apart, np.finfo(np.float64).tiny)).sum(0)) / rho)
        u = (np.copysign(exact, z[live]) / gap).T
        turned = q[:, live] @ (u / np.linalg.norm(u, axis=0))
    out, vectors = d.copy(), q.copy()
    out[live], vectors[:, live] = roots, turned
    order = np.argsort(out, kind="stable")
    return out[order], vectors[:, order]


def _ints(x: np.ndarray, n: int = 1) -> np.ndarray:
    """x as integers wide enough for products with n, their differences, and sums over the rows."""
    most = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    return x if most * max(n, len(x)) < 1 << 60 else x.astype(object)


@dataclass
class Spectrum:
    """Vectors seen, their exact sums, and the eigendecomposition of their scatter matrix."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> "Spectrum":
        return cls(0, np.zeros(dim, object), np.zeros(dim), np.eye(dim))

    def mean(self) -> np.ndarray:
        return np.array([float(s) for s in self.sums]) / self.n if self.n < 1 << 53 and all(abs(s) < 1 << 53 for s in self.sums) else np.array([int(s) / self.n for s in self.sums])

    def add(self, x: np.ndarray) -> None:
        """Rows of x, one centred rank-one update each."""
        mean = self.mean() if self.n else np.zeros(x.shape[1])
        for v in x.astype(np.float64):
            if self.n:
                off = v - mean
                self.values, self.basis = rank_one(self.values, self.basis, self.n / (self.n + 1), off)
                mean = mean + off / (self.n + 1)
            else:
                mean = v
            self.n += 1
        self.sums = self.sums + _ints(x).sum(0).astype(object)

    def merge(self, other: "Spectrum") -> None:
        if self.n and other.n:
            apart = other.mean() - self.mean()
            for value, v in zip(other.values, other.basis.T, strict=True):
                if value > 0:
                    self.values, self.basis = rank_one(self.values, self.basis, float(value), v)
            self.values, self.basis = rank_one(self.values, self.basis, self.n * other.n / (self.n + other.n), apart)
        elif other.n:
            self.values, self.basis = other.values, other.basis
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def row(self, part: int) -> tuple:
        return part, self.n, [Decimal(int(s)) for s in self.sums], self.values.tolist(), self.basis.ravel().tolist()

    @classmethod
    def of(cls, row) -> "Spectrum":
        dim = len(row.eigenvalues)
        return cls(int(row.n), np.array([int(s) for s in row.sums], object), np.array(row.eigenvalues), np.array(row.basis).reshape(dim, dim))


def _matrices(batches, dim: int):
    """The vectors of a task as matrices of some thousand rows."""
    for batch in slices(batches):
        if batch.num_rows:
            yield batch, batch.column(0).flatten().to_numpy().reshape(-1, dim)


def _spectra(dim: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        state = Spectrum.empty(dim)
        for _, x in _matrices(batches, dim):
            state.add(x)
        if state.n:
            part, n, sums, values, basis = state.row(TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.decimal128(38, 0))), pa.array([values], pa.list_(pa.float64())), pa.array([basis], pa.list_(pa.float64()))],
                names=["part", "n", "sums", "eigenvalues", "basis"],
            )

    return run


def _merged(rows):
    import pandas as pd

    rows = rows.sort_values("part")
    state = None
    for row in rows.itertuples(index=False):
        if state is None:
            state = Spectrum.of(row)
        else:
            state.merge(Spectrum.of(row))
    return pd.DataFrame([state.row(int(rows.part.iloc[0]) // FAN)], columns=["part", "n", "sums", "eigenvalues", "basis"])


def _moments(dim: int, project):
    """Sums over a task of y and of y' * y, flat, for y = project(x)."""

    def run(batches):
        import pyarrow as pa

        total = None
        for _, x in _matrices(batches, dim):
            y = project(x)
            now = np.concatenate([y.sum(0), (y.T @ y).ravel()])
            total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    return run


def _covariance(fit: DataFrame, dim: int, n: int, width: int, project) -> np.ndarray:
    sums = fit.select("x").mapInArrow(_moments(dim, project), "sums array<double>")
    total = np.zeros(width + width * width)
    for r in sums.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect():
        total[r.pos] = r.s
    mean = total[:width] / n
    return total[width:].reshape(width, width) / n - np.outer(mean, mean)


def _centred(n: int, sums: list[int]):
    """Function from x to x less the mean, through exact integers."""
    most = max(abs(s) for s in sums)

    def centred(x: np.ndarray, whole: bool = False) -> np.ndarray:
        wide = x if most < 1 << 60 and _ints(x, 2 * n) is x else x.astype(object)
        y = wide * n - np.array(sums, np.int64 if wide.dtype != object else object)
        return y if whole else (y / n).astype(np.float64)

    return centred


@dataclass
class Whitening:
    """A fit: n vectors with per-dimension sums, components as rows, their eigenvalues and shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def function(self):
        centred, w = _centred(self.n, self.sums), (self.components / np.sqrt(self.eigenvalues)[:, None]).T
        return lambda x: centred(x) @ w


def fit_whitening(fit: DataFrame, dim: int, components: int, scratch: Scratch, part: int = PART) -> Whitening | None:
    """The whitening of fit, a stored table of distinct integer vectors x of dimension dim; None if it has no rows."""
    n = fit.count()
    if not n or not dim:
        return None
    # Dealt out by number, a task each: the vectors are small and the updates are what takes time.
    dealt = fit.select("x").repartition(-(-n // part))
    spectra = scratch.store(dealt.mapInArrow(_spectra(dim), STATE), "spectra")
    while spectra.count() > 1:
        merged = spectra.groupBy(F.floor(F.col("part") / FAN).alias("node")).applyInPandas(_merged, STATE)
        spectra = scratch.store(merged, "combined")
    last = Spectrum.of(spectra.first())
    sums, basis = [int(s) for s in last.sums], last.basis
    centred = _centred(n, sums)
    ritz = _covariance(fit, dim, n, dim, lambda x: centred(x) @ basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > LEAST * max(values.sum(), 0)]
    found = (basis @ turn[:, order]).T
    if not order:
        return Whitening(n, sums, found, values[order], values[order])
    found *= np.sign(found[np.arange(len(order)), np.abs(found).argmax(1)])[:, None]
    out = Whitening(n, sums, found, values[order], values[order] / values.sum())
    out.identity_error = float(np.abs(_covariance(fit, dim, n, len(order), out.function()) - np.eye(len(order))).max())
    return out


def _whitened(dim: int, w: Whitening):
    def run(batches):
        import pyarrow as pa

        apply, centred, k = w.function(), _centred(w.n, w.sums), len(w.eigenvalues)
        for batch, x in _matrices(batches, dim):
            y = apply(x)
            off = centred(x, whole=True)
            if off.dtype == object or dim * float(np.abs(off).max()) ** 2 >= 2.0**62:
                far = [s if s < 1 << 63 else None for s in (sum(int(v) * int(v) for v in r) for r in off)]
            else:
                far = (off * off).sum(1).tolist()
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n, np.int64)), pa.array(far, pa.int64()).take(at),
                 pa.array(y.ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, w.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten_embeddings(vectors: DataFrame, components: int = COMPONENTS, part: int = PART) -> DataFrame:
    """Per row with a sound vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < 2.0**62)), F.lit(False))
    x = F.when(sound, F.transform("v", lambda c: F.floor(c * SCALE).cast("long")))
    v = scratch.store(v.select(x.alias("x"), "vec_id").filter("x is not null"), "scaled")
    fit = scratch.store(v.select("x").distinct(), "distinct")
    out = spark.createDataFrame([], OUT)
    for (dim,) in sorted(fit.select(F.size("x")).distinct().collect()):
        w = fit_whitening(fit.filter(F.size("x") == dim), dim, components, scratch, part)
        if w is not None and len(w.eigenvalues):
            out = out.union(v.filter(F.size("x") == dim).mapInArrow(_whitened(dim, w), OUT))
    return out
