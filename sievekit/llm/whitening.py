"""Whitening of vectors: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Entries become integers x = floor(1024 * c) + 100000, so counts, sums and deviations are
exact.  Three distributed passes: sums per dimension, the centred scatter (one matrix a
task, added up by rows), and the whitened covariance as a check.  The driver and the
tasks hold matrices of the dimension only, never anything that grows with the rows.

The scatter A of the centred x is factored P'AP = LL' with the largest remaining
diagonal entry as pivot, until what is left is rounding.  Rotating pairs of columns of
L until all are orthogonal gives L J = U diag(s): column norms squared, over n, are the
eigenvalues, normalised columns the components (largest entry positive).  Disjoint pairs of
a round-robin tournament are rotated together.

Defined results: rows whose vector is null, empty, holds a null or non-finite entry, or an
entry whose x is no 64-bit integer, are left out, and so are vectors whose length is not the
most frequent one (the longer at ties).  Components with no variance left (constant or
repeated dimensions, fewer rows than components) are not returned; without any variance, or
without rows, the result is empty.  A deviation of over 38 digits is null.  Repeated rows and ids count each time; null ids stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import trimmed

SCALE, SHIFT = 1024, 100_000
SAFE = 2**62


def usable(rows: DataFrame, id: str, column: str) -> tuple[DataFrame, int]:
    """(vec_id, e) of the rows that take part, and the length of their vectors (0: none)."""
    bound = f"{SAFE / SCALE!r}D"
    e = f"transform(`{column}`, c -> CAST(c AS DOUBLE))"
    good = (rows.select(F.col(f"`{id}`").cast("long").alias("vec_id"), F.expr(e).alias("e"))
            .where(f"e IS NOT NULL AND size(e) > 0 AND forall(e, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < {bound})"))
    sizes = good.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    dim = int(top["d"]) if top else 0
    return good.where(F.size("e") == dim), dim


def integers(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("e"))
    c = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)
    return np.floor(c * SCALE).astype(np.int64) + SHIFT


def _wide(x: np.ndarray, factor: int) -> np.ndarray:
    """x as Python integers where products with ``factor`` could pass 64 bits."""
    if x.size and max(abs(int(x.min())), abs(int(x.max()))) * factor >= SAFE:
        return x.astype(object)
    return x


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact (64-bit integers, or Python's where they don't do)."""
    wide = _wide(x, 2 * n)
    if wide.dtype != object and max(map(abs, sums), default=0) >= SAFE:
        wide = x.astype(object)
    return wide * n - np.array(sums, dtype=wide.dtype)


def _sums(good: DataFrame, dim: int) -> tuple[int, list[int]]:
    exact = pa.decimal128(38, 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = _wide(integers(batch, dim), max(batch.num_rows, 1))
            n += len(x)
            if len(x):
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim + 1), pa.int32()), pa.array([str(v) for v in [*total, n]]).cast(exact)], ["i", "s"])

    rows = good.mapInArrow(sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    if not rows:
        return 0, []
    found = {r["i"]: int(r["s"]) for r in rows}
    return found[dim], [found[i] for i in range(dim)]


def _added(parts: DataFrame) -> DataFrame:
    """Rows (i, v) with the arrays v of one i added up; a task holds one array per i."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy()
                held[i] = held[i] + v if i in held else v.copy()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                              pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], ["i", "v"])

    return parts.repartition("i").mapInArrow(add, "i int, v array<double>")


def _matrix(good: DataFrame, size: int, part) -> np.ndarray:
    """The sum over all batches of the size x size matrices ``part`` makes of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        seen = False
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()),
                                              pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"])

    rows = _added(good.mapInArrow(trimmed(partial), "i int, v array<double>")).collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (d x rank, rows in the order of ``a``) with a = LL' up to rounding: the rows, sorted by
    pivot, are lower triangular.  Stops where the largest remaining diagonal is rounding."""
    d = len(a)
    left = np.array(np.diag(a), dtype=np.float64)
    floor = d * np.finfo(float).eps * (left.max() if d else 0.0)
    columns: list[np.ndarray] = []
    done = np.zeros(d, dtype=bool)
    for _ in range(d):
        p = int(np.argmax(np.where(done, -np.inf, left)))
        if not left[p] > floor:
            break
        column = a[:, p].astype(np.float64).copy()
        for earlier in columns:
            column -= earlier * earlier[p]
        column[done] = 0.0
        root = np.sqrt(left[p])
        column /= root
        column[p] = root
        done[p] = True
        left = left - column * column
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((d, 0))


def _rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A round-robin tournament: every pair of r columns once, in rounds of disjoint pairs."""
    seats = list(range(r + r % 2))
    out = []
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[:len(seats) // 2], reversed(seats[len(seats) // 2:])) if a < r and b < r]
        out.append((np.array([p[0] for p in pairs], dtype=int), np.array([p[1] for p in pairs], dtype=int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms falling, normalised columns) of ``factor`` after its columns were
    rotated pairwise until orthogonal.  Raises if that takes more than ``sweeps``."""
    a = factor.copy()
    r = a.shape[1]
    limit = max(len(a), 1) * np.finfo(float).eps
    rounds = _rounds(r) if r > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(cosine.max()))
            turn = cosine > limit
            if not turn.any():
                continue
            p, q, x, y = p[turn], q[turn], x[:, turn], y[:, turn]
            zeta = (yy[turn] - xx[turn]) / (2.0 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1.0 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * x - (c * t) * y, (c * t) * x + c * y
        if worst <= limit:
            break
    else:
        raise ArithmeticError("the columns did not become orthogonal")
    norms = (a * a).sum(0)
    order = np.argsort(-norms, kind="stable")
    units = a[:, order] / np.sqrt(norms[order])
    if r:
        strongest = units[np.argmax(np.abs(units), axis=0), np.arange(r)]
        units = units * np.where(strongest < 0, -1.0, 1.0)
    return norms[order], units


@dataclass
class Whitening:
    """The fitted transform: row count, sums of x, eigenvalues (falling) and components (columns)."""
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        d = centred(x, self.n, self.sums).astype(np.float64) / self.n
        return (d @ self.components[:, :k]) / np.sqrt(self.eigenvalues[:k])


def fit_whitening(good: DataFrame, dim: int) -> Whitening:
    n, sums = _sums(good, dim) if dim else (0, [])
    if n == 0:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)

    def scatter(batch: pa.RecordBatch) -> np.ndarray:
        d = centred(integers(batch, dim), n, sums).astype(np.float64) / n
        return d.T @ d

    a = _matrix(good, dim, scatter)
    a = (a + a.T) / 2.0
    norms, units = one_sided_jacobi(pivoted_cholesky(a))
    return Whitening(n, sums, norms / n, units, float(np.trace(a)) / n)


def whitened(rows: DataFrame, id: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """One row per usable vector and component (1 = largest variance, at most ``components``):
    vec_id, component, n, deviation decimal (sum of (n*x - S)^2, exact), whitened, explained (share
    of the total variance), identity_error (largest entry of the whitened rows' covariance minus
    the identity, measured on all rows)."""
    good, dim = usable(rows, id, column)
    fit = fit_whitening(good, dim)
    k = min(components, len(fit.eigenvalues))
    schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    if k == 0:
        return good.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                                (f.split(" ", 1) for f in schema.split(", ")[1:])])

    def outer(batch: pa.RecordBatch) -> np.ndarray:
        # the whitened rows have mean zero, as x - S/n has; their remaining mean is taken off below
        w = np.column_stack([fit.whiten(integers(batch, dim), k), np.ones(batch.num_rows)])
        return w.T @ w

    moments = _matrix(good, k + 1, outer) / fit.n
    mean = moments[:k, k]
    error = float(np.abs(moments[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())
    share = fit.eigenvalues[:k] / fit.trace
    exact = pa.decimal128(38, 0)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m == 0:
                continue
            x = integers(batch, dim)
            apart = _wide(centred(x, fit.n, fit.sums), 1)
            top = max(abs(int(apart.min())), abs(int(apart.max())))
            if apart.dtype != object and top * top * dim >= SAFE:
                apart = apart.astype(object)
            square = (apart * apart).sum(axis=1)
            deviation = (pa.array([str(v) if v < 10**38 else None for v in square], pa.string()).cast(exact) if square.dtype == object
                         else pa.array(square, pa.int64()).cast(exact))
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, fit.n, dtype=np.int64)), deviation.take(each),
                 pa.array(fit.whiten(x, k).ravel()), pa.array(np.tile(share, m)),
                 pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return good.mapInArrow(trimmed(rows_of), schema)
