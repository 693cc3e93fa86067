"""Near-duplicate vectors by product quantisation.

Vectors lie in coarse inverted lists (k-means cells) as codes of their residual
subspaces. A query compares lookup-table distances with the codes of the lists
it probes and computes the exact cosine for the candidates.

Both bounds are sufficient, so no link is lost. A vector probes a list if its
distance to the plane between its own cell and the list's is at most half the
largest distance of two linked unit vectors: of two linked vectors in different
cells one at least is that close. A code is a candidate if its table distance
is at most that largest distance plus the code's own error, which is stored.

Equal vectors are one representative with a weight. List blocks hold a bounded
number of vectors; a block returns link counts and a spanning forest.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, partitions_for, save

COSINE = 0.9
TRAIN_ROWS = 20_000  # the index is fitted on at most so many vectors
SUBSPACES = 8
CODEWORDS = 256
MAX_LISTS = 512
MEMBERS = 2048   # vectors of a list in one block
QUERIES = 8192   # queries of a block
STEP = 256
SLACK = 1e-3     # for single precision table sums


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def train(x: np.ndarray, lists: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Cell centres and, for each subspace, the codewords of the residuals."""
    rng = np.random.default_rng(seed)
    centres = _kmeans(x, lists, rng)
    rest = x - centres[np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)]
    model = {"centres": centres}
    for m, dims in enumerate(np.array_split(np.arange(x.shape[1]), min(SUBSPACES, x.shape[1]))):
        model[f"words{m}"] = _kmeans(np.ascontiguousarray(rest[:, dims]), CODEWORDS, rng)
    return model


class Index:
    """A trained quantiser."""

    def __init__(self, blob: bytes, cosine: float):
        model = np.load(io.BytesIO(blob))
        self.centres = model["centres"]
        self.words = [model[f"words{m}"] for m in range(len(model.files) - 1)]
        self.dims = np.array_split(np.arange(self.centres.shape[1]), len(self.words))
        self.reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
        d = self.centres[:, None] - self.centres[None]
        self.apart = np.maximum(np.sqrt((d * d).sum(2)), 1e-12)

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list, and which lists each vector probes."""
        score = x @ self.centres.T - 0.5 * (self.centres * self.centres).sum(1)
        home = np.argmax(score, axis=1)
        margin = (score[np.arange(len(x)), home][:, None] - score) / self.apart[home]
        probes = margin <= self.reach / 2
        probes[np.arange(len(x)), home] = True
        return home, probes

    def encode(self, x: np.ndarray, cell: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Residual codes and each code's error."""
        rest = x - self.centres[cell]
        codes, error = [], np.zeros(len(x))
        for dims, w in zip(self.dims, self.words):
            r = rest[:, dims]
            code = np.argmax(r @ w.T - 0.5 * (w * w).sum(1), axis=1)
            codes.append(code)
            error += ((r - w[code]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def tables(self, x: np.ndarray, cell: int) -> list[np.ndarray]:
        """Squared distances of each query's residual to every codeword."""
        rest = x - self.centres[cell]
        return [((r := rest[:, dims]) ** 2).sum(1)[:, None].astype(np.float32) - (2 * r @ w.T).astype(np.float32)
                + (w * w).sum(1).astype(np.float32) for dims, w in zip(self.dims, self.words)]

    def links(self, queries: np.ndarray, members: np.ndarray, cell: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Query and member of each linked pair of unit vectors."""
        codes, error = self.encode(members, cell)
        limit = ((self.reach + error + SLACK) ** 2).astype(np.float32)
        rows, cols = [], []
        for i in range(0, len(queries), STEP):
            q = queries[i:i + STEP]
            d = np.zeros((len(q), len(members)), np.float32)
            for t, code in zip(self.tables(q, cell), codes):
                d += np.take(t, code, axis=1)
            near = d <= limit
            if near.mean() > 0.05:
                a, b = np.nonzero(near & (q @ members.T >= cosine))
            else:
                a, b = np.nonzero(near)
                ok = np.einsum("ij,ij->i", q[a], members[b]) >= cosine
                a, b = a[ok], b[ok]
            rows.append((a + i).astype(np.int32))
            cols.append(b.astype(np.int32))
        return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.empty(0, np.int32), np.empty(0, np.int32))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the bipartite links (a[i], b[i])."""
    left, a = np.unique(a, return_inverse=True)
    right, b = np.unique(b, return_inverse=True)
    link = np.zeros((len(left), len(right)), bool)
    link[a, b] = True
    across = np.ascontiguousarray(link.T)
    rows, cols = np.ones(len(left), bool), np.ones(len(right), bool)
    out = ([], [])
    for start in range(len(left)):
        if not rows[start]:
            continue
        rows[start] = False
        stack = [(0, start)]
        while stack:
            side, u = stack.pop()
            free, own = (cols, link) if side == 0 else (rows, across)
            hit = np.flatnonzero(own[u] & free)
            free[hit] = False
            out[side].append(np.full(len(hit), u))
            out[1 - side].append(hit)
            stack.extend((1 - side, v) for v in hit)
    if not out[0]:
        return left[:0], right[:0]
    return left[np.concatenate(out[0])], right[np.concatenate(out[1])]


def _matrix(column) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = chunk.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(chunk), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _train_task(lists: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("vec").to_numpy(), kind="stable")
        out = io.BytesIO()
        np.savez(out, **train(_unit(_matrix(table.column("x")))[order], lists))
        return pa.table({"model": pa.array([out.getvalue()], pa.binary())})

    return run


def _probe_task(blob: bytes, cosine: float):
    def run(batches):
        index = Index(blob, cosine)
        for b in batches:
            for i in range(0, b.num_rows, 8192):
                part = b.slice(i, 8192)
                if not part.num_rows:
                    continue
                home, probes = index.homes(_unit(_matrix(part.column(2))))
                lists = pa.array([np.flatnonzero(p).astype(np.int32) for p in probes], pa.list_(pa.int32()))
                mask = pa.array([p.tobytes() for p in np.packbits(probes, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home, pa.int32()), lists, mask],
                                                 ["vec", "weight", "x", "home", "probes", "mask"])

    return run


def _block_task(blob: bytes, cosine: float):
    def run(table: pa.Table) -> pa.Table:
        index = Index(blob, cosine)
        cell = table.column("list")[0].as_py()
        member = table.column("member").to_numpy(zero_copy_only=False).astype(bool)
        vec, weight = (table.column(k).to_numpy() for k in ("vec", "weight"))
        x = _unit(_matrix(table.column("x")))
        home = table.column("home").to_numpy()
        qi, mi = np.flatnonzero(~member), np.flatnonzero(member)
        a, b = index.links(x[qi], x[mi], cell, cosine)
        # a query's pair with itself is none; of a pair that both lists see, the
        # smaller list has it
        probes = np.unpackbits(np.frombuffer(b"".join(table.column("mask").to_pylist()), np.uint8).reshape(len(vec), -1), axis=1).astype(bool)
        q, m = qi[a], mi[b]
        q_home = home[q]
        twice = (q_home < cell) & probes[m, q_home]
        keep = (vec[q] != vec[m]) & ~twice
        q, m = q[keep], m[keep]
        found = np.zeros(len(vec), np.int64)
        np.add.at(found, q, weight[m])
        across = home[q] != cell  # in its own list a pair is seen from both ends
        np.add.at(found, m[across], weight[q[across]])
        a, b = forest(q, m)
        some = found > 0
        return pa.table({"vec": pa.array(np.r_[vec[some], vec[a]], pa.int64()),
                         "other": pa.array(np.r_[np.zeros(some.sum(), np.int64), vec[b]], pa.int64(),
                                           mask=np.r_[np.ones(some.sum(), bool), np.zeros(len(a), bool)]),
                         "n": pa.array(np.r_[found[some], np.zeros(len(a), np.int64)], pa.int64())})

    return run


def _links_of(reps: DataFrame, n: int, cosine: float, train_rows: int) -> DataFrame:
    """(vec, other, n) of representatives (vec, weight, x) of one dimension:
    counts, and links whose components are those of all links."""
    lists = max(1, min(MAX_LISTS, round(math.sqrt(n) / 2)))
    sample = reps.select("vec", "x").orderBy(F.xxhash64("vec"), "vec").limit(train_rows).withColumn("all", F.lit(0))
    blob = sample.groupBy("all").applyInArrow(_train_task(lists), "model binary").first()[0]
    kind = reps.schema["x"].dataType.simpleString()
    placed = save(reps.mapInArrow(_probe_task(blob, cosine), f"vec long, weight long, x {kind}, home int, probes array<int>, mask binary"))
    size = {r["home"]: r["n"] for r in placed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = {r["p"]: r["n"] for r in placed.select(F.explode("probes").alias("p")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # MAX_LISTS rows each at most

    def blocks(counts: dict, each: int):
        return F.array(*[F.lit(max(1, math.ceil(counts.get(k, 0) / each))) for k in range(lists)])

    mb, qb = blocks(size, MEMBERS), blocks(asked, QUERIES)
    own = F.xxhash64("vec")
    m = placed.withColumn("list", F.col("home"))
    m = m.withColumn("mblock", F.pmod(own, F.element_at(mb, F.col("list") + 1)).cast("int")).withColumn(
        "qblock", F.explode(F.sequence(F.lit(0), F.element_at(qb, F.col("list") + 1) - 1)))
    q = placed.withColumn("list", F.explode("probes"))
    q = q.withColumn("qblock", F.pmod(own, F.element_at(qb, F.col("list") + 1)).cast("int")).withColumn(
        "mblock", F.explode(F.sequence(F.lit(0), F.element_at(mb, F.col("list") + 1) - 1)))
    cols = ["list", "mblock", "qblock", "vec", "weight", "x", "home", "mask"]
    both = m.select(*cols, F.lit(True).alias("member")).unionByName(q.select(*cols, F.lit(False).alias("member")))
    return both.groupBy("list", "mblock", "qblock").applyInArrow(_block_task(blob, cosine), "vec long, other long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors link at a cosine of at least ``cosine``, whatever their labels.
    Null and zero vectors, and those with null or non-finite components, link
    with nothing, not even with copies of themselves; vectors of different
    dimensions do not link; rows without a vec_id link with nothing and have a
    null component. Every repeated row counts as a vector. An empty table gives
    no rows. Extra columns are ignored."""
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    x = F.col("embedding").cast(f"array<{kind}>")
    limit = F.lit(float("inf")).cast(kind)
    good = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)) & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), good.alias("good"))
    rows = rows.select("vec_id", "x", "good", F.size("x").alias("dim"), F.xxhash64("x").alias("h1"),
                       F.xxhash64(F.lit(20), F.reverse("x")).alias("h2"))
    reps = save(rows.where("good").groupBy("dim", "h1", "h2").agg(
        F.min(F.struct("vec_id", "x")).alias("first"), F.count(F.lit(1)).alias("weight")
    ).select("dim", "h1", "h2", F.col("first.vec_id").alias("vec"), "weight", F.col("first.x").alias("x")))
    found = reps.sparkSession.createDataFrame([], "vec long, other long, n long")
    for r in reps.groupBy("dim").count().collect():  # a row per dimension in use
        if r["count"] > 1:
            own = reps.where(F.col("dim") == r["dim"]).select("vec", "weight", "x")
            found = found.unionByName(_links_of(own, r["count"], cosine, train_rows))
    found = save(found)
    roots = connected_components(found.where("other is not null"), "vec", "other")
    counts = found.where("other is null").groupBy("vec").agg(F.sum("n").alias("n"))
    classes = (reps.select("dim", "h1", "h2", "vec", "weight").join(counts, "vec", "left")
               .join(roots, F.col("vec") == F.col("node"), "left")
               .select("dim", "h1", "h2", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                       F.coalesce("root", "vec").alias("component_id"), F.lit(True).alias("good")))
    out = rows.select("vec_id", "dim", "h1", "h2", "good").join(classes, ["dim", "h1", "h2", "good"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
