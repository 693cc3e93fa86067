"""Training on all labelled documents, on Spark.

Features are counted by one aggregate over all rows. The rows, cut to the chosen
features, are packed into blocks of some BLOCK rows; every step of the fit is one
pass over the blocks that returns sums, one record a partition. Rows are dealt and
ordered by hashes and sums are added in partition order, so a fit can be repeated.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import features
from .common import save, whole

BLOCK = 1024
BLOCKS_EACH = 8          # of a partition
BROADCAST = 500_000      # labels; more are joined by shuffle


def text_features(batches):
    """mapInArrow: all columns but the last, the text, and its features."""
    hasher = features.Hasher()
    for b in batches:
        texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
        dense = pa.array([features.densities(t) for t in texts], pa.list_(pa.float64()))
        ids = pa.array([x.astype(np.int32) for x in hasher.many(texts)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], dense, ids], [*b.schema.names[:-1], "dense", "ids"])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, quality, toxic, dense, ids) of all labelled documents; ``h`` deals and
    orders the rows. Null labels do not count; of several labels of a document the
    smallest quality and largest toxicity hold."""
    known = save(labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic")))
    if known.count() <= BROADCAST:
        known = F.broadcast(known)
    rows = docs.select("doc_id", whole(F.col("text").cast("string")).alias("text")).join(known, "doc_id")
    rows = rows.select("doc_id", "quality", "toxic", "text").mapInArrow(
        text_features, "doc_id long, quality int, toxic int, dense array<double>, ids array<int>")
    return save(rows.select(F.xxhash64("doc_id", F.sort_array("ids")).alias("h"), "quality", "toxic", "dense", "ids"))


def shares(rows: DataFrame, **labels: Column) -> DataFrame:
    """(id, n, one column a label): the rows that hold each hashed feature, and
    those of them with the label; written, as it is read once a label."""
    each = rows.select(F.explode("ids").alias("id"), *[c.cast("int").alias(k) for k, c in labels.items()])
    return save(each.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[F.sum(k).alias(k) for k in labels]))


def select(counts: DataFrame, label: str, rows: int, positive: int, most: int) -> list:
    """The (id, n, label) whose document shares differ most between labels; as
    ``features.select`` for rows in memory."""
    n1, n0 = max(1, positive), max(1, rows - positive)
    one, zero = F.col(label), F.col("n") - F.col(label)
    p = (F.col("n") + 1) / (n1 + n0 + 2)
    z = F.abs((one + 0.5) / (n1 + 1) - (zero + 0.5) / (n0 + 1)) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    best = counts.where("n >= 3").select("id", "n", F.col(label).alias("one"), z.alias("z")).where("z > 3")
    return best.orderBy(F.col("z").desc(), "id").limit(most).collect()


def _packed(arrays: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def pack(rows: DataFrame, marks: list[str], chosen: np.ndarray, blocks: int) -> DataFrame:
    """(block, data): the rows (h, block, dense, ids and the integer ``marks``) of
    each block as arrays, cut to the chosen features."""
    few = F.array_intersect("ids", F.array(*[F.lit(int(i)) for i in chosen])) if len(chosen) else F.slice("ids", 1, 0)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(k, "ascending") for k in ("h", *marks)]).combine_chunks()
        at = table.column("at").chunk(0)
        dense = table.column("dense").chunk(0).flatten().to_numpy().reshape(-1, features.N_DENSE)
        ends = np.cumsum(np.fromiter((len(x) for x in at), np.int64, len(at)))
        data = {"dense": dense, "ends": ends, "at": np.searchsorted(chosen, at.flatten().to_numpy()).astype(np.int32)}
        data |= {k: table.column(k).to_numpy() for k in marks}
        return pa.table({"block": table.column("block").slice(0, 1), "data": pa.array([_packed(data)], pa.binary())})

    parts = max(1, math.ceil(blocks / BLOCKS_EACH))
    cut = rows.select("block", "h", *marks, "dense", few.alias("at")).repartition(parts, "block")
    return save(cut.groupBy("block").applyInArrow(run, "block long, data binary")).coalesce(parts)


def matrix(block: dict, model: dict) -> np.ndarray:
    """Standardised densities and 0/1 columns of the chosen features."""
    n, d = len(block["dense"]), features.N_DENSE
    x = np.zeros((n, d + len(model["chosen"])), np.float32)
    x[:, :d] = np.clip((block["dense"] - model["mean"]) / model["std"], -5, 5)
    x[np.repeat(np.arange(n), np.diff(block["ends"], prepend=0)), d + block["at"]] = 1
    return x


def total(packed: DataFrame, task: Callable[[dict], list]) -> list:
    """The sums over all blocks of the arrays that ``task`` returns."""
    def run(batches):
        sums = None
        for b in batches:
            for blob in b.column(0).to_pylist():
                got = task(unpack(blob))
                sums = got if sums is None else [x + y for x, y in zip(sums, got)]
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([_packed({str(i): a for i, a in enumerate(sums)})], pa.binary())], ["sums"])

    out = None
    for r in packed.select("data").mapInArrow(run, "sums binary").collect():
        part = unpack(r[0])
        part = [part[str(i)] for i in range(len(part))]
        out = part if out is None else [x + y for x, y in zip(out, part)]
    return out


def moments(packed: DataFrame) -> dict[str, np.ndarray]:
    """Mean and deviation of the densities; copies of a row (``copy`` above 0) do
    not count again."""
    def task(block):
        dense = block["dense"][block["copy"] == 0] if "copy" in block else block["dense"]
        return [np.float64(len(dense)), dense.sum(0), np.square(dense).sum(0)]

    n, s, q = total(packed, task)
    mean = s / max(n, 1)
    return {"mean": mean, "std": np.sqrt(np.maximum(q / max(n, 1) - mean ** 2, 0)) + 1e-6}


def scales(held: np.ndarray, rows: int) -> np.ndarray:
    """What brings the columns to one scale, so that rare marks are learnt as fast
    as common ones; ``held`` counts the rows of each chosen feature."""
    p = np.asarray(held, np.float64) / max(rows, 1)
    return np.r_[np.ones(features.N_DENSE), 1 / np.maximum(np.sqrt(p * (1 - p)), 0.02)]


def minimise(loss: Callable, w: np.ndarray, rounds: int = 100, memory: int = 10, stop: float = 1e-4) -> np.ndarray:
    """L-BFGS with step halving; ``loss`` gives the value and the gradient."""
    f, g = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(g).max(initial=0) <= stop:
            break
        d, used = -g, []
        for s, y in reversed(steps):
            a = s @ d / (s @ y)
            used.append(a)
            d = d - a * y
        d = d * (steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.linalg.norm(g)))
        for (s, y), a in zip(steps, reversed(used)):
            d = d + (a - y @ d / (s @ y)) * s
        step = 1.0
        while True:
            new, (h, k) = w + step * d, loss(w + step * d)
            if h <= f + 1e-4 * step * (g @ d) or step < 1e-6:
                break
            step /= 2
        if h >= f:
            break
        if (k - g) @ (new - w) > 1e-12:
            steps = [*steps, (new - w, k - g)][-memory:]
        w, f, g = new, h, k
    return w
