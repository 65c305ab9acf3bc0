"""Embedding whitening with covariances by polarisation.

An entry c becomes the whole number x = floor(64 c) + 1000000. The fit list is
each distinct vector x once. With n vectors and sums S, z = n x - S is an exact
whole number, n times the centred value. The squares of z_i for every dimension
and of z_i + z_j for every pair of dimensions are summed exactly, per task and
then by Spark; no product of two dimensions is formed. The cross-covariances
are differences of variances:

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

They are whole numbers over n^3 until the one rounding to double, and are
assembled on the driver (one number per pair of dimensions) for ``eigh``.

Defined results: a row whose vector is null, empty, or has a null or
non-finite entry, or one whose x does not fit a long, is dropped; so is one
whose length is not the commonest (of equally common ones the longest).
Repeated rows and identifiers stay rows of their own. A component whose
eigenvalue is zero within double precision has no rows, so a table with fewer
than two distinct vectors, like an empty one, gives no rows. An eigenvector's
largest entry is positive (of equal ones the first). ``deviation`` is null where it does not fit a long. Other
columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.session import materialize

SCALE, SHIFT = 64, 1000000
COMPONENTS = 16
CHUNK_CELLS = 1 << 17      # vector entries that are worked on together
LIMB = (1 << 24) - 1
HALF = 1 << 60             # sums travel as two decimals, whole multiples of this and the rest
LONG = 1 << 63


def square_sums(z: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares of whole numbers along an axis of at most 16,384
    entries, as Python integers."""
    if z.dtype == object:
        return np.asarray((z * z).sum(axis), object)
    top = int(np.abs(z).max(initial=0))
    if top * top * z.shape[axis] < LONG:
        return (z * z).sum(axis).astype(object)
    z = np.abs(z)
    parts = [z & LIMB, (z >> 24) & LIMB, z >> 48]
    total = np.zeros(np.delete(z.shape, axis), object)
    for i in range(3):
        for j in range(i, 3):
            total = total + ((parts[i] * parts[j]).sum(axis).astype(object) << (24 * (i + j) + (i != j)))
    return total


def vectors(column: pa.Array) -> np.ndarray:
    """The (rows, dimensions) array of a column of lists of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def chunks(batches):
    for b in batches:
        d = max(1, len(b.column("x")[0])) if len(b) else 1
        rows = min(16384, max(1, CHUNK_CELLS // d))
        for lo in range(0, len(b), rows):
            yield b.slice(lo, rows)


class Centre:
    """z = n x - S for the fit list's n and S; in Python integers where 64 bits could overflow."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.middle = [s // n for s in sums]
        self.rest = np.array([s - n * m for s, m in zip(sums, self.middle)], object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        y = x.astype(object) - np.array(self.middle, object) if max(map(abs, self.middle)) >= LONG >> 1 or abs(x).max(initial=0) >= LONG >> 1 \
            else x - np.array(self.middle, np.int64)
        top = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
        if self.n * (top + 1) * 2 < LONG >> 2:
            return y.astype(np.int64) * self.n - self.rest.astype(np.int64)
        return y.astype(object) * self.n - self.rest


def _halves(name: str) -> str:
    return f"{name}_high decimal(38,0), {name}_low decimal(38,0)"


def _two(values: list[int]) -> list[pa.Array]:
    kind = pa.decimal128(38, 0)
    return [pa.array([Decimal(v // HALF) for v in values], kind), pa.array([Decimal(v % HALF) for v in values], kind)]


def _sums():
    """mapInArrow: per task the number of vectors and the sums per dimension."""
    def run(batches):
        n, total = 0, None
        for b in chunks(batches):
            x = vectors(b.column("x"))
            part = ((x >> 32).sum(0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)
            n, total = n + len(b), part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), *_two(list(total))],
                                             names=["i", "n", "s_high", "s_low"])
    return run


def _pair_squares(centre: Centre):
    """mapInArrow: per task the sums of the squares of z_i (at i, i) and z_i + z_j (at i, j)."""
    def run(batches):
        total = None
        for b in chunks(batches):
            z = centre(vectors(b.column("x")))
            found = [square_sums(z, 0)] + [square_sums(z[:, i:i + 1] + z[:, i + 1:], 0) for i in range(z.shape[1] - 1)]
            total = found if total is None else [t + f for t, f in zip(total, found)]
        for i, t in enumerate(total or []):
            a = np.arange(len(t)) if i == 0 else np.full(len(t), i - 1)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(np.arange(len(t)) + i, pa.int32()), *_two(list(t))],
                                             names=["i", "j", "v_high", "v_low"])
    return run


def _added(df: DataFrame, keys: list[str], name: str, *also) -> dict:
    """Sums over the tasks' rows by key, as Python integers."""
    rows = df.groupBy(*keys).agg(F.sum(f"{name}_high").alias("high"), F.sum(f"{name}_low").alias("low"), *also).collect()
    return {tuple(r[k] for k in keys): (int(r["high"]) * HALF + int(r["low"]), r) for r in rows}


def covariance(n: int, d: int, squares: dict) -> np.ndarray:
    """The covariance matrix from the sums of squares, each entry rounded once."""
    v = np.zeros((d, d))
    for (i, j), s in squares.items():
        v[i, j] = v[j, i] = s / n ** 3 if i == j else (s - squares[i, i] - squares[j, j]) / (2 * n ** 3)
    return v


def principal(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) above zero, falling."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    real = e > max(e.max(initial=0), 0) * len(e) * np.finfo(float).eps * 4
    e, u = e[real][:components], u[:, real][:, :components]
    return e, u * np.sign(np.take_along_axis(u, np.abs(u).argmax(0)[None, :], 0))


def _outer(centre: Centre, project: np.ndarray):
    """mapInArrow: per task the sums of the whitened values and of their products."""
    def run(batches):
        c = project.shape[1]
        total = np.zeros((c + 1, c))
        for b in chunks(batches):
            w = (centre(vectors(b.column("x"))).astype(float) / centre.n) @ project
            total[:c] += w.T @ w
            total[c] += w.sum(0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
                                         names=["i", "j", "v"])
    return run


def _rows(centre: Centre, project: np.ndarray, explained: np.ndarray, error: float):
    """mapInArrow: the result rows."""
    def run(batches):
        c = project.shape[1]
        for b in chunks(batches):
            z = centre(vectors(b.column("x")))
            w = (z.astype(float) / centre.n) @ project
            deviation = [s if s < LONG else None for s in square_sums(z, 1)]
            again = np.repeat(np.arange(len(b)), c)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(again)), pa.array(np.tile(np.arange(1, c + 1), len(b)), pa.int32()),
                 pa.array(np.full(len(again), centre.n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(again)),
                 pa.array(w.ravel()), pa.array(np.tile(explained, len(b))), pa.array(np.full(len(again), error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


ROWS = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """((id, x) of the rows that stay, their length or 0 without rows)."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
            .select("id", F.transform("v", lambda c: F.try_add(F.floor(c * F.lit(float(SCALE))), F.lit(SHIFT).cast("long"))).alias("x"))
            .where(F.forall("x", lambda c: c.isNotNull())))
    top = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = top["d"] if top else 0
    return rows.where(F.size("x") == d), d


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    rows, d = whole_vectors(table, id_col, vector_col)
    fit = materialize(rows.select("x").distinct(), "fit")
    sums = _added(fit.mapInArrow(_sums(), f"i int, n long, {_halves('s')}"), ["i"], "s", F.sum("n").alias("n"))
    if not sums:
        return spark.createDataFrame([], ROWS).withColumnRenamed("id", id_col)
    n = sums[0,][1]["n"]
    centre = Centre(n, [sums[i,][0] for i in range(d)])
    squares = {k: v for k, (v, _) in _added(fit.mapInArrow(_pair_squares(centre), f"i int, j int, {_halves('v')}"), ["i", "j"], "v").items()}
    cov = covariance(n, d, squares)
    e, u = principal(cov, components)
    if not len(e):
        return spark.createDataFrame([], ROWS).withColumnRenamed("id", id_col)
    project = u / np.sqrt(e)
    products = fit.mapInArrow(_outer(centre, project), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((len(e) + 1, len(e)))
    for r in products:
        m[r["i"], r["j"]] = r["v"] / n
    error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(len(e))).max())
    return rows.mapInArrow(_rows(centre, project, e / np.trace(cov), error), ROWS).withColumnRenamed("id", id_col)
