"""Document quality by Bradley-Terry ranking.

A document's score is linear in its features; the better document of a
preference pair wins with the logistic probability of the score difference. All
labelled documents outside the held-out third are dealt to blocks, and the pairs
are all pairs of unlike labels in a block. The cut is the quantile of the training
scores that leaves the labelled share of good documents above it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import values_at_ranks
from . import features, learn
from .common import whole

FEATURES = 300
PENALTY = 1e-3
RARER = 64           # documents of the rarer label that a block shall have


def held_out(doc_id):
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _pairs(x: np.ndarray, quality: np.ndarray, w: np.ndarray) -> list:
    """Loss, gradient and number of all pairs of unlike labels."""
    s = x @ w
    gap = np.clip(s[quality == 0][None, :] - s[quality == 1][:, None], -40, 40)
    lost = features.sigmoid(gap)  # probability that the worse one wins
    pull = np.zeros(len(x))
    pull[quality == 1], pull[quality == 0] = -lost.sum(1), lost.sum(0)
    return [np.log1p(np.exp(gap)).sum(), x.T @ pull, np.float64(gap.size)]


def _weights(total, scale: np.ndarray) -> np.ndarray:
    """``total(w)`` sums ``_pairs`` over the blocks."""
    def loss(v):
        f, g, n = total(v * scale)
        return f / max(n, 1) + PENALTY / 2 * (v @ v), g * scale / max(n, 1) + PENALTY * v

    return learn.minimise(loss, np.zeros(len(scale))) * scale


def _cut(below: float, above: float, deviation: float) -> np.ndarray:
    """Halfway between the scores on both sides of the quantile."""
    return np.array([(below + above) / 2, max(1e-6, deviation / 4)])


def train(dense: np.ndarray, rows: list[np.ndarray], quality: np.ndarray) -> dict[str, np.ndarray]:
    """The model of rows in memory, which are one block."""
    n = len(rows)
    mean, std = (dense.mean(0), dense.std(0) + 1e-6) if n else (np.zeros(features.N_DENSE), np.ones(features.N_DENSE))
    model = {"chosen": features.select(rows, quality, FEATURES), "mean": mean, "std": std}
    x = _inputs(dense, rows, model)
    w, cut = np.zeros(x.shape[1]), np.array([0.0, 1.0])
    if (quality == 1).any() and (quality == 0).any():
        w = _weights(lambda w: _pairs(x, quality, w), learn.scales(x[:, features.N_DENSE:].sum(0), n))
        s, k = np.sort(x @ w), (quality == 0).sum()
        cut = _cut(s[k - 1], s[k], np.std(s))
    return model | {"w": w, "cut": cut}


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    """The model of all labelled documents."""
    rows = learn.labelled(docs, labels)
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    n, n1, n0 = rows.agg(F.count(F.lit(1)), F.count_if(good), F.count_if(bad)).first()
    if not n1 or not n0:
        return train(np.zeros((0, features.N_DENSE)), [], np.zeros(0, int))
    best = sorted(learn.select(learn.shares(rows, good=good), "good", n, n1, FEATURES), key=lambda r: r["id"])
    model = {"chosen": np.array([r["id"] for r in best], np.int64)}
    # every block gets some documents of the rarer label: where there are too few, in copies
    blocks, rare = math.ceil(n / learn.BLOCK), 1 if n1 < n0 else 0
    copies = min(blocks, math.ceil(RARER * blocks / min(n1, n0)))
    spread = F.when(F.col("quality") == rare, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.withColumn("copy", F.explode(spread)).withColumn(
        "block", F.pmod(F.pmod("h", F.lit(blocks)) + F.col("copy"), F.lit(blocks)).cast("long"))
    packed = learn.pack(dealt, ["quality", "copy"], model["chosen"], blocks)
    model |= learn.moments(packed)
    w = _weights(lambda w: learn.total(packed, lambda b: _pairs(learn.matrix(b, model), b["quality"], w)),
                 learn.scales([r["n"] for r in best], n))

    def own(block):
        return (learn.matrix(block, model) @ w)[block["copy"] == 0]

    def run(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(own(learn.unpack(blob)))], ["s"])

    sides = values_at_ranks(packed.select("data").mapInArrow(run, "s double"), "s",
                            {"below": lambda n: F.lit(n0 - 1), "above": lambda n: F.lit(n0)}).first()
    mean = learn.total(packed, lambda b: [own(b).sum()])[0] / n
    deviation = math.sqrt(learn.total(packed, lambda b: [np.square(own(b) - mean).sum()])[0] / n)
    return model | {"w": w, "cut": _cut(sides["below"], sides["above"], deviation)}


def _inputs(dense, rows, model) -> np.ndarray:
    z = np.clip((dense - model["mean"]) / model["std"], -5, 5).astype(np.float32)
    return np.concatenate([z, features.columns(rows, model["chosen"])], axis=1)


def scores(dense, rows, model) -> np.ndarray:
    cut, spread = model["cut"]
    return features.sigmoid((_inputs(dense, rows, model) @ model["w"] - cut) / spread)


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    ``score`` lies between 0 and 1 and rises with quality; ``predicted`` is 1
    from 0.5, the quantile cut. Only the text enters a score; null texts count
    as empty. Labels of held-out documents are not read; without labels of both
    kinds every score is 0.5. A null doc_id is not held out. Extra columns are
    ignored."""
    seen = labels.where(~held_out(F.col("doc_id")))
    # labels need no toxicity here
    seen = seen.select("doc_id", "quality", F.lit(0).alias("toxic"))
    model = fit(docs, seen)

    def run(batches):
        hasher = features.Hasher(model["chosen"])
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                texts = part.column(2).to_pylist()
                dense = np.array([features.densities(t) for t in texts]).reshape(-1, features.N_DENSE)
                s = scores(dense, hasher.many(texts), model).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       whole(F.col("text").cast("string")).alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
