"""Whitening of vectors by polarisation.

Entries become integers, so all sums are exact. The squares of every dimension
and of the sum of every two dimensions are added up over all vectors, centred;
the variance of a sum less the variances of its two dimensions is twice their
covariance, which gives the whole covariance matrix without a cross product:
V(i, j) = (Var(x_i + x_j) - Var(x_i) - Var(x_j)) / 2. It goes to ``eigh``.

Values are centred before they are squared, by an integer next to the mean; what
is left of the mean is taken out of the sums of squares in integers, so they are
those of the values centred by the exact mean. ``eigh`` is exact to the largest
eigenvalue only; rotations in extended precision then make every pair of
components orthogonal to its own scale, for dimensions of very unlike spread.

Vectors of different lengths are spaces of their own, each with its own fit.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = float(2 ** 50)      # larger entries have no exact long and count as not finite
ROWS = 4096                 # vectors squared at once
HELD = 1 << 25              # sums that a task holds before it passes them on
BROADCAST = 32 << 20        # bytes of fits that are broadcast
SALTS = 64
LIMB = 62                   # sums travel as hi * 2**62 + lo


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x, d): entries as longs, for vectors without null or non-finite entries."""
    v = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    # NaN is above all numbers
    good = (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(F.abs(c) <= F.lit(LIMIT), F.lit(False)))
    # the bound again, as conditions may be judged after the arithmetic
    x = F.transform("v", lambda c: F.when(F.abs(c) <= F.lit(LIMIT), F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long")))
    return rows.where(F.coalesce(good, F.lit(False))).select("vec_id", x.alias("x"), F.size("v").alias("d"))


def _attach(rows: DataFrame, own: DataFrame, size: int) -> DataFrame:
    """``own``, one row for each length d, joined to the rows; broadcast up to a
    bound in bytes, else each length is spread over several keys."""
    if size <= BROADCAST:
        return rows.join(F.broadcast(own), "d")
    spread = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["d", "salt"]).drop("salt")


class Squares:
    """Sums of squares of all dimensions (the diagonal) and of the sums of all
    two of them, exact."""

    def __init__(self, d: int):
        self.hi, self.lo = np.zeros((d, d), object), np.zeros((d, d), np.int64)  # hi: Python integers

    def add(self, y: np.ndarray) -> None:
        most = 2 * int(np.abs(y).max(initial=0))
        if most * most >= 1 << LIMB:  # beyond 64 bits: Python integers
            for row in y.astype(object):
                for i in range(len(row)):
                    w = row[i:] + row[i]
                    w[0] = row[i]
                    w = w * w
                    self._put(i, (w >> LIMB).astype(np.int64), (w & ((1 << LIMB) - 1)).astype(np.int64))
            return
        step = max(1, min(ROWS, ((1 << LIMB) - 1) // max(1, most * most)))
        for k in range(0, len(y), step):
            part = y[k:k + step]
            for i in range(part.shape[1]):
                w = part[:, i:] + part[:, i:i + 1]
                w[:, 0] = part[:, i]
                self._put(i, 0, np.einsum("rj,rj->j", w, w))

    def _put(self, i: int, hi, lo: np.ndarray) -> None:
        total = self.lo[i, i:] + lo
        self.hi[i, i:] += (hi + (total >> LIMB)).astype(object)
        self.lo[i, i:] = total & ((1 << LIMB) - 1)


def _square_batches(batches):
    held: dict[int, Squares] = {}

    def flush():
        for d, s in held.items():
            for i in range(d):
                yield pa.RecordBatch.from_pydict({
                    "d": pa.array(np.full(d - i, d, np.int32)), "i": pa.array(np.full(d - i, i, np.int32)),
                    "j": pa.array(np.arange(i, d, dtype=np.int32)), "hi": pa.array([Decimal(x) for x in s.hi[i, i:]], pa.decimal128(38, 0)), "lo": pa.array(s.lo[i, i:])})
        held.clear()

    for b in batches:
        lengths = b.column(0).to_numpy()
        flat = b.column(1).flatten().to_numpy()
        ends = np.cumsum(lengths, dtype=np.int64)
        for d in np.unique(lengths).tolist():
            own = ends[lengths == d, None] - d + np.arange(d)
            if d not in held:
                held[d] = Squares(d)
            held[d].add(flat[own])
        if sum(d * d for d in held) > HELD:
            yield from flush()
    yield from flush()


def _extended(x: int) -> np.longdouble:
    out, shift = np.longdouble(0), 0
    sign, x = (-1, -x) if x < 0 else (1, x)
    while x:
        out += np.ldexp(np.longdouble(x & ((1 << 32) - 1)), shift)
        x, shift = x >> 32, shift + 32
    return sign * out


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of a covariance
    matrix in extended precision. Values without any variance left are zero."""
    q = np.linalg.eigh(v.astype(np.float64))[1].astype(np.longdouble)
    q /= np.sqrt((q * q).sum(0))
    # eigh's vectors are orthogonal to double precision only: once more in extended
    for k in range(q.shape[1]):
        q[:, k] -= q[:, :k] @ (q[:, :k].T @ q[:, k])
        q[:, k] /= np.sqrt((q[:, k] * q[:, k]).sum())
    a = q.T @ v @ q
    floor = np.longdouble(1e-17) * len(v) * max(a.diagonal().max(), 0)
    for _ in range(40):
        own = np.sqrt(np.maximum(a.diagonal(), floor))
        far = np.triu(np.abs(a) > 1e-16 * np.outer(own, own), 1)
        todo = np.argwhere(far)
        if not len(todo) or floor == 0:
            break
        for i, j in todo.tolist():
            if a[i, j] == 0:
                continue
            tau = (a[j, j] - a[i, i]) / (2 * a[i, j])
            t = (1 if tau >= 0 else -1) / (abs(tau) + np.sqrt(1 + tau * tau))
            c = 1 / np.sqrt(1 + t * t)
            turn = np.array([[c, t * c], [-t * c, c]], np.longdouble)
            a[:, [i, j]] = a[:, [i, j]] @ turn
            a[[i, j]] = turn.T @ a[[i, j]]
            q[:, [i, j]] = q[:, [i, j]] @ turn
    e = a.diagonal()
    order = np.argsort(-e, kind="stable")
    e, q = e[order], q[:, order]
    q = q * np.where(q[np.argmax(np.abs(q), 0), np.arange(len(e))] < 0, -1, 1)
    return np.where(e > floor, e, 0), q


def covariance(n: int, sums: list[int], centre: list[int], squares: list[list[int]]) -> tuple[np.ndarray, int]:
    """V in extended precision, and n * n * trace(V) as an integer. ``squares[i][j]``
    (i <= j) are sums of squares of y_i or y_i + y_j, with y = x - centre."""
    d = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre)]
    # n * n * Var, an integer: the rest of the mean goes out of the sums
    own = [n * squares[i][i] - rest[i] ** 2 for i in range(d)]
    v = np.zeros((d, d), np.longdouble)
    scale = _extended(n) ** 2
    for i in range(d):
        v[i, i] = _extended(own[i]) / scale
        for j in range(i + 1, d):
            both = n * squares[i][j] - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = _extended((both - own[i] - own[j]) // 2) / scale
    return v, sum(own)


FIT = "d int, n long, centre array<long>, rest array<decimal(38,0)>, weights array<array<double>>, offset array<double>, explained array<double>"


def _fit(table: pa.Table) -> pa.Table:
    """One length's sums become its fit."""
    d = table.column("d")[0].as_py()
    i, j, hi, lo = (table.column(c).to_pylist() for c in ("i", "j", "hi", "lo"))
    n, sums, centre, squares = 0, [0] * d, [0] * d, [[0] * d for _ in range(d)]
    for a, b, h, l in zip(i, j, hi, lo):
        if b < 0:  # a dimension's sum (-1) with the count, its centre (-2)
            if b == -1:
                sums[a], n = int(h), int(l)
            else:
                centre[a] = int(h)
        else:
            squares[a][b] = (int(h) << LIMB) + int(l)
    v, trace = covariance(n, sums, centre, squares)
    e, q = components(v)
    rest = [s - n * c for s, c in zip(sums, centre)]
    whole = _extended(trace) / _extended(n) ** 2
    weights, explained = [], []
    for k in range(min(COMPONENTS, d)):
        weights.append([float(x) for x in q[:, k] / np.sqrt(e[k])] if e[k] > 0 else None)
        explained.append(float(e[k] / whole) if trace else 0.0)
    return pa.table({
        "d": pa.array([d], pa.int32()), "n": pa.array([n], pa.int64()), "centre": pa.array([centre], pa.list_(pa.int64())),
        "rest": pa.array([[Decimal(r) for r in rest]], pa.list_(pa.decimal128(38, 0))),
        "weights": pa.array([weights], pa.list_(pa.list_(pa.float64()))),
        "offset": pa.array([[float(_extended(r) / n) for r in rest]], pa.list_(pa.float64())),
        "explained": pa.array([explained], pa.list_(pa.float64()))})


def fit(rows: DataFrame) -> tuple[DataFrame, int]:
    """One row for each length of the vectors of ``integers``: count, centring,
    component weights over the roots of the eigenvalues, shares of the variance;
    and the fits' size in bytes."""
    sums = rows.select("d", F.posexplode("x").alias("i", "x")).groupBy("d", "i").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    sums = save(sums.withColumn("c", F.expr("s div n")))
    size = 8 * (COMPONENTS + 8) * sums.count()
    centres = sums.groupBy("d").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "c"))), lambda p: p["c"]).alias("centre"))
    near = _attach(rows, centres, size).select("d", F.zip_with("x", "centre", lambda x, c: x - c).alias("y"))
    squares = near.mapInArrow(_square_batches, "d int, i int, j int, hi decimal(38,0), lo long").groupBy("d", "i", "j").agg(
        F.sum("hi").alias("hi"), F.sum(F.col("lo").cast("decimal(38,0)")).alias("lo"))
    zero = F.lit(0).cast("decimal(38,0)")
    parts = squares.unionByName(sums.select("d", "i", F.lit(-1).alias("j"), F.col("s").alias("hi"), F.col("n").cast("decimal(38,0)").alias("lo"))
                                ).unionByName(sums.select("d", "i", F.lit(-2).alias("j"), F.col("c").cast("decimal(38,0)").alias("hi"), zero.alias("lo")))
    return save(parts.groupBy("d").applyInArrow(_fit, FIT)), size


def _deviation(y: Column, rest: Column) -> Column:
    """Sum of (n * y - rest) ** 2 over the dimensions, exact; null beyond 38 digits."""
    big = "decimal(38,0)"
    gap = F.zip_with(y, rest, lambda a, r: F.try_subtract(F.try_multiply(a.cast(big), F.col("n").cast(big)).cast(big), r).cast(big))
    return F.aggregate(F.transform(gap, lambda z: F.try_multiply(z, z).cast(big)), F.lit(0).cast(big), lambda a, z: F.try_add(a, z).cast(big))


def whiten(vectors: DataFrame) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact), one row for each vector and component up to 8, of fewer
    dimensions all; vectors that are null, empty or hold null or non-finite
    entries have none. Entries beyond 2**50 count as not finite, as their scaled
    value has no exact long. Vectors of different lengths are different spaces.

    ``deviation`` is null where the exact sum does not fit a long (from some
    millions of vectors on), ``deviation_exact`` has up to 38 digits. A component
    without variance (fewer vectors than dimensions, constant dimensions) has
    explained 0 and a null whitened value, and does not count for
    ``identity_error``, which is null if no component has variance. Rows with a
    null or repeated vec_id, and equal vectors, count like any other. Extra
    columns are ignored; an empty table gives an empty result."""
    rows = integers(vectors)
    fits, size = fit(rows)
    near = _attach(rows, fits, size).withColumn("y", F.zip_with("x", "centre", lambda x, c: x - c))
    value = F.zip_with("y", "offset", lambda y, o: y.cast("double") - o)
    w = F.transform("weights", lambda own: F.when(own.isNotNull(), F.aggregate(
        F.zip_with(value, own, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)))
    scored = near.select("d", "vec_id", "n", "explained", _deviation(F.col("y"), F.col("rest")).alias("deviation_exact"), w.alias("w"))
    # the covariance of the whitened values themselves, centred as it is gathered
    gaps = [F.abs(F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))) - float(a == b)) for a in range(COMPONENTS) for b in range(a, COMPONENTS)]
    errors = scored.groupBy("d").agg(F.greatest(*gaps).alias("identity_error"))
    out = _attach(scored, errors, size).select("*", F.posexplode("w").alias("k", "whitened"))
    return out.select("vec_id", (F.col("k") + 1).alias("component"), "n", F.col("deviation_exact").try_cast("long").alias("deviation"),
                      "whitened", F.get("explained", F.col("k")).alias("explained"), "identity_error", "deviation_exact")
