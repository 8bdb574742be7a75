"""Whitening of embeddings by the leading components of their covariance.

Spark sums the vectors and then, in a second pass, the products of what is
left after the mean has been taken off (so a large common offset costs no
digits).  Only a matrix of ``dim x dim`` numbers, whatever the number of rows,
reaches the driver, which reduces it to tridiagonal form by Householder
reflections, finds the leading eigenvalues by bisection on Sturm counts and
their vectors by inverse iteration, with the vectors of close eigenvalues made
orthogonal to one another.  The projection goes back to the tasks.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_width, ship_package, stage

LARGEST = 2.0 ** 52        # components from here on do not fit a long after scaling
LOW_BITS = 20              # sums are kept in two parts, so that no long overflows
EPS = np.finfo(float).eps


# --- the eigenproblem, on the driver --------------------------------------------------------------

def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors ``v`` (each over the rows
    after its own; zero: no reflection) with ``H A H = T``."""
    a = np.array(a, dtype=float)
    n, reflections = len(a), []
    for k in range(n - 2):
        x = a[k + 1:, k]
        v, norm = x.copy(), np.linalg.norm(x)
        if np.linalg.norm(x[1:]) > 0:
            v[0] += np.copysign(norm, x[0])
            v /= np.linalg.norm(v)
            rest = a[k + 1:, k + 1:]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, x[0])
            a[k + 2:, k] = a[k, k + 2:] = 0
        else:
            v = np.zeros(len(x))
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def sturm_count(d: np.ndarray, e: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each shift."""
    least = max(EPS * EPS * float(np.max(e * e, initial=0.0)), np.finfo(float).tiny)
    q = d[0] - shifts
    below = (q < 0).astype(int)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < least, -least, q)
        q = d[i] - shifts - e[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, each bisected until its bracket has no number inside."""
    n = len(d)
    reach = np.abs(np.concatenate([e, [0.0]])) + np.abs(np.concatenate([[0.0], e]))
    lo, hi = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    pad = EPS * max(abs(lo[0]), abs(hi[0]), np.finfo(float).tiny) * n
    lo, hi = lo - pad, hi + pad
    rank = n - 1 - np.arange(k)                       # the j-th largest has this many below it
    for _ in range(2100):
        mid = lo + (hi - lo) / 2
        if np.all((mid <= lo) | (mid >= hi)):
            break
        above = sturm_count(d, e, mid) <= rank
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return lo + (hi - lo) / 2


def _solve(d, e, shift, b, tiny):
    """``(T - shift) x = b`` by elimination with row exchanges."""
    n = len(d)
    diag, up, up2, x = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    below = e.copy()
    for i in range(n - 1):
        if abs(below[i]) > abs(diag[i]):
            diag[i], below[i] = below[i], diag[i]
            up[i], diag[i + 1] = diag[i + 1], up[i]
            if i + 1 < n - 1:
                up2[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if diag[i] == 0:
            diag[i] = tiny
        f = below[i] / diag[i]
        diag[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        x[i + 1] -= f * x[i]
    if abs(diag[-1]) < tiny:
        diag[-1] = tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= up2[i] * x[i + 2]
        x[i] /= diag[i]
        if abs(x[i]) > 1e150:                         # only the direction counts
            x /= abs(x[i])
    return x


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for falling eigenvalues; those of a cluster are reorthogonalised each step."""
    n, size = len(d), max(float(np.max(np.abs(d))), float(np.max(np.abs(e), initial=0.0)), np.finfo(float).tiny)
    out = np.zeros((n, len(values)))
    first, shift = 0, None
    rng = np.random.default_rng(7)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            first = j
        # eigenvalues that agree to rounding get shifts a little apart
        shift = value if j == first else min(value, shift - 4 * EPS * size)
        x = rng.uniform(-1, 1, n)
        for _ in range(6):
            for _ in range(2):
                x = x - out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
            x = _solve(d, e, shift, x, EPS * size)
            x /= np.max(np.abs(x))
        for _ in range(2):
            x = x - out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = float(np.max(np.abs(a), initial=0.0))
    if not scale:
        return np.zeros(k), np.eye(len(a))[:, :k]
    d, e, reflections = tridiagonalise(a / scale)
    values = leading_eigenvalues(d, e, k)
    vectors = inverse_iteration(d, e, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    return values * scale, vectors


# --- the passes over the rows ---------------------------------------------------------------------

def _matrix(column, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)


def _scaled(column, dim: int, scale: float, offset: int) -> np.ndarray:
    return np.floor(scale * _matrix(column, dim)).astype(np.int64) + offset


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``vec`` (array of double) of the rows whose components are all there and finite."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)) & ~F.isnan(x))
    return df.select(F.col(id_col).alias("id"), vec.alias("vec")).where(F.col("vec").isNotNull() & fine & (F.size("vec") > 0))


def _sums(vectors: DataFrame, dim: int, scale: float, offset: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sums of their scaled components."""
    def run(batches):
        n, hi, lo = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            x = _scaled(b.column(0), dim, scale, offset)
            n += len(x)
            hi, lo = hi + (x >> LOW_BITS).sum(axis=0), lo + (x & ((1 << LOW_BITS) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(hi), pa.array(lo), pa.array([n] * dim, pa.int64())],
                                         names=["i", "hi", "lo", "n"])

    wide = "decimal(38,0)"
    rows = (vectors.select("vec").mapInArrow(run, "i int, hi long, lo long, n long").groupBy("i")
            .agg(F.sum(F.col("hi").cast(wide)).alias("hi"), F.sum(F.col("lo").cast(wide)).alias("lo"), F.sum("n").alias("n")).collect())
    sums = [0] * dim
    for r in rows:
        sums[r["i"]] = (int(r["hi"]) << LOW_BITS) + int(r["lo"])
    return (rows[0]["n"] if rows else 0), sums


def _off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: longs where they hold it, else Python numbers."""
    largest = int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))))
    if n * largest + max(map(abs, sums), default=0) < 2 ** 62:
        return n * x - np.asarray(sums, np.int64)
    return n * x.astype(object) - np.asarray(sums, object)


def _square_sums(m: np.ndarray) -> list[Decimal]:
    largest = int(max(abs(int(m.min(initial=0))), abs(int(m.max(initial=0)))))
    if largest * largest * max(1, m.shape[1]) >= 2 ** 63:
        m = m.astype(object)
    return [Decimal(int(v)) for v in (m * m).sum(axis=1)]


def _products(vectors: DataFrame, dim: int, centred) -> np.ndarray:
    """Sum of the outer products of ``centred(column)``'s rows: a partial matrix a task, summed row by row on the cluster."""
    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            y = centred(b.column(0))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"])

    def merge(batches):
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1)):
                rows[i] = rows.get(i, 0.0) + np.frombuffer(raw.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())], names=["i", "row"])

    schema = "i int, row binary"
    width = min(dim, shuffle_width(vectors.sparkSession))
    out = np.zeros((dim, dim))
    for r in vectors.mapInArrow(run, schema).repartition(width, "i").mapInArrow(merge, schema).collect():
        out[r["i"]] = np.frombuffer(r["row"])
    return (out + out.T) / 2


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8,
           scale: float = 1024.0, offset: int = 100000) -> DataFrame:
    """One row per usable vector and component: ``id_col``, ``component`` (from
    1), ``n``, ``deviation`` (decimal), ``whitened``, ``explained``, ``identity_error``.

    A component c of a vector counts as the whole number ``floor(scale * c) +
    offset``.  ``n`` vectors are fitted, with sums S; ``deviation`` is the sum
    of (n x - S)^2, exact; ``whitened`` the centred vector on the component
    over the root of its eigenvalue e; ``explained`` e over the trace;
    ``identity_error`` how far the whitened columns' covariance is from the identity.

    Left out: vectors that are null, empty, hold a null, a NaN, an infinity or
    a component of 2^52 or more, or have another length than most (ties: the
    longer).  Repeated rows and null ids count and are returned like any.
    Components without extent (eigenvalue zero to rounding: a single row, equal
    rows, fewer rows than components) are returned with ``whitened`` 0 and left
    out of ``identity_error``.  No usable rows: no result.  Other columns are
    not read.
    """
    spark = df.sparkSession
    ship_package(spark)
    vectors = usable(df, id_col, vec_col)
    id_type = dict(vectors.dtypes)["id"]
    schema = (f"`{id_col}` {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    lengths = vectors.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dim = lengths[0]["dim"]
    vectors = vectors.where(F.size("vec") == dim)
    n, sums = _sums(vectors, dim, scale, offset)

    def centred(column):
        return _off_mean(_scaled(column, dim, scale, offset), n, sums).astype(np.float64) / n

    cov = _products(vectors.select("vec"), dim, centred) / n
    k = min(components, dim)
    values, axes = leading_components(cov, k)
    total = float(np.trace(cov))
    real = values > total * dim * EPS * 4
    turn = axes * np.where(real, 1 / np.sqrt(np.where(real, values, 1)), 0)
    explained = np.where(real, values / (total or 1), 0.0)

    def project(batches):
        for b in batches:
            m = _off_mean(_scaled(b.column(1), dim, scale, offset), n, sums)
            w = (m.astype(np.float64) / n) @ turn
            offsets = pa.array(np.arange(len(m) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(_square_sums(m), pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))],
                names=["id", "deviation", "w"])

    rows = stage(vectors.mapInArrow(project, f"id {id_type}, deviation decimal(38,0), w array<double>"), "whitened")
    mean = np.zeros(k)
    for r in rows.select(F.posexplode("w").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m")).collect():
        mean[r["i"]] = r["m"]
    check = _products(rows.select("w"), k, lambda column: _matrix(column, k) - mean) / n - np.eye(k)
    error = float(np.max(np.abs(check[np.ix_(real, real)]), initial=0.0))
    shares = F.array(*(F.lit(float(v)) for v in explained))
    return (rows.select("id", "deviation", F.posexplode("w").alias("i", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error")))
