"""Toxicity categories by a classifier chain.

The categories are predicted in order: ``low_quality`` (label quality = 0),
``toxic`` (label toxic = 1), ``severe`` (toxic, with several of the features
that mark toxic documents most). Each is a logistic model on text features and
on the probabilities of the categories before it. For training, those are out
of fold: predicted by models that have not seen the row. All labelled documents
train, in blocks spread over Spark's tasks.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features, learn
from .common import whole

CATEGORIES = ("low_quality", "toxic", "severe")
FOLDS = 3
FEATURES = 300       # hashed features of a category
PENALTY = 1e-3
THRESHOLD = 0.5
SEVERE_MARKS = 3


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)).astype(np.float32)[:, None]


def untrained() -> dict[str, np.ndarray]:
    """The model without any label: nothing belongs to a category."""
    model = {"chosen": np.empty(0, np.int64), "mean": np.zeros(features.N_DENSE), "std": np.ones(features.N_DENSE)}
    for i, name in enumerate(CATEGORIES):
        model[name] = np.r_[np.zeros(features.N_DENSE + i), -10.0]
    return model


def _losses(x: np.ndarray, y: np.ndarray, used: np.ndarray, w: np.ndarray) -> list:
    """Of the models in the columns of ``w``: logistic loss, its gradient and the
    number of rows, over the rows that ``used`` gives to each."""
    s = np.clip(x @ w, -40, 40)
    gap = (features.sigmoid(s) - y[:, None]) * used
    return [((np.log1p(np.exp(s)) - y[:, None] * s) * used).sum(0), x.T @ gap, used.sum(0).astype(np.float64)]


def _chain(block: dict, model: dict, folded: list[np.ndarray]) -> np.ndarray:
    """The inputs of the category after those of ``folded``, whose columns are the
    models of the whole and of each row set without one fold."""
    x = np.c_[learn.matrix(block, model), np.ones(len(block["fold"]), np.float32)]
    for w in folded:
        out = features.sigmoid(np.take_along_axis(x @ w, block["fold"][:, None] + 1, 1)[:, 0])
        x = np.concatenate([x[:, :-1], _logit(out), x[:, -1:]], axis=1)
    return x


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    """The chain's models. A category that the rows do not show keeps its rate
    as a constant."""
    rows = learn.labelled(docs, labels)
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    n, n_low, n_toxic = rows.agg(F.count(F.lit(1)), F.count_if(low), F.count_if(toxic)).first()
    if not n:
        return untrained()
    counts = learn.shares(rows, low_quality=low, toxic=toxic)
    marks = learn.select(counts, "toxic", n, n_toxic, 40)
    lift = [r["id"] for r in marks if 0 < n_toxic < n and r["one"] / n_toxic > (r["n"] - r["one"]) / (n - n_toxic)]
    many = F.size(F.array_intersect("ids", F.array(*[F.lit(i) for i in lift]))) >= SEVERE_MARKS if lift else F.lit(False)
    rows = rows.select("h", "dense", "ids", F.pmod(F.xxhash64("h"), F.lit(FOLDS)).cast("int").alias("fold"),
                       low.cast("int").alias("low_quality"), F.col("toxic").cast("int").alias("toxic"), (toxic & many).cast("int").alias("severe"))
    counts = learn.shares(rows, **{c: F.col(c) == 1 for c in CATEGORIES})
    positive = dict(zip(CATEGORIES, rows.agg(*[F.count_if(F.col(c) == 1) for c in CATEGORIES]).first()))
    best = {r["id"]: r["n"] for c in CATEGORIES for r in learn.select(counts, c, n, positive[c], FEATURES)}
    model = {"chosen": np.array(sorted(best), np.int64)}
    blocks = math.ceil(n / learn.BLOCK)
    packed = learn.pack(rows.withColumn("block", F.pmod("h", F.lit(blocks)).cast("long")), ["fold", *CATEGORIES], model["chosen"], blocks)
    model |= learn.moments(packed)
    scale = np.r_[learn.scales([best[i] for i in model["chosen"]], n), 1.0][:, None]
    folded: list[np.ndarray] = []
    for name in CATEGORIES:
        w = np.zeros((len(scale), 1 + FOLDS))
        if 0 < positive[name] < n:
            w = _category(packed, model, folded, name, scale)
        else:
            w[-1] = _logit(np.array([positive[name] / n]))[0, 0]
        model[name] = w[:, 0]
        folded = [*folded, w]
        scale = np.insert(scale, -1, 1.0, axis=0)
    return model


def _category(packed: DataFrame, model: dict, folded: list[np.ndarray], name: str, scale: np.ndarray) -> np.ndarray:
    """The weights of one category's models, all fitted in the same passes."""
    shape = (len(scale), 1 + FOLDS)

    def loss(v):
        v = v.reshape(shape)
        w = v * scale

        def task(block):
            used = np.c_[np.ones(len(block["fold"]), bool), block["fold"][:, None] != np.arange(FOLDS)]
            return _losses(_chain(block, model, folded), block[name], used, w)

        f, g, rows = learn.total(packed, task)
        rows = np.maximum(rows, 1)
        return (f / rows).sum() + PENALTY / 2 * np.square(v).sum(), (g * scale / rows + PENALTY * v).ravel()

    return learn.minimise(loss, np.zeros(shape[0] * shape[1])).reshape(shape) * scale


def _inputs(dense: np.ndarray, rows: list[np.ndarray], model) -> np.ndarray:
    z = np.clip((dense - model["mean"]) / model["std"], -5, 5).astype(np.float32)
    return np.concatenate([z, features.columns(rows, model["chosen"])], axis=1)


def predict(dense: np.ndarray, rows: list[np.ndarray], model) -> dict[str, np.ndarray]:
    x, out = _inputs(dense, rows, model), {}
    for name in CATEGORIES:
        w = model[name]
        out[name] = features.sigmoid(x @ w[:-1] + w[-1])
        x = np.concatenate([x, _logit(out[name])], axis=1)
    return out


def train_once(sample: DataFrame, task) -> bytes:
    """One task fits the model on the bounded sample; its packed arrays."""
    def run(table: pa.Table) -> pa.Table:
        out = io.BytesIO()
        np.savez(out, **task(table))
        return pa.table({"model": pa.array([out.getvalue()], pa.binary())})

    got = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(run, "model binary").first()
    return got[0] if got else b""


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def score(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, toxic, p_low_quality, p_toxic, p_severe), one row per input row:
    ``toxic`` where its probability reaches ``threshold``. Null texts count as
    empty; a null doc_id keeps its row. Extra columns are ignored."""
    def run(batches):
        hasher = features.Hasher(model["chosen"])
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                texts = part.column(1).to_pylist()
                dense = np.array([features.densities(t) for t in texts]).reshape(-1, features.N_DENSE)
                p = predict(dense, hasher.many(texts), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p["toxic"] >= threshold), *[pa.array(p[c].astype(np.float64)) for c in CATEGORIES]],
                    ["doc_id", "toxic", *[f"p_{c}" for c in CATEGORIES]])

    schema = "doc_id long, toxic boolean" + "".join(f", p_{c} double" for c in CATEGORIES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text").cast("string")).alias("text")).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the labelled documents and score all; see ``score``. Without any
    label nothing is toxic."""
    return score(docs, fit(docs, labels), threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents judged toxic, all columns kept; the
    verdict is computed beside each row, so rows that share an id or have none
    are judged by their own text."""
    model = fit(docs, labels)
    names = docs.columns
    flag = "_toxic_" + "_".join(names)[:40]
    schema = docs.select(*names).schema.add(flag, "boolean")
    at = names.index("text")

    def run(batches):
        hasher = features.Hasher(model["chosen"])
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                texts = [t or "" for t in part.column(at).to_pylist()]
                dense = np.array([features.densities(t) for t in texts]).reshape(-1, features.N_DENSE)
                p = predict(dense, hasher.many(texts), model)["toxic"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p >= threshold)], [*names, flag])

    return docs.mapInArrow(run, schema).where(~F.col(flag)).select(*names)
