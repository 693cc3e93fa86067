"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix.

Rows are dealt into source blocks by a hash. For every block the numbers of
rows it sends to each shard are drawn without replacement from the shards' open
places (multivariate hypergeometric), which is how a uniform permutation would
split the block. Each block permutes its rows and cuts the permutation at the
drawn counts; after the exchange each shard permutes what it got.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save, whole

SHARDS = 16
SEED = 20240607
BLOCK_ROWS = 20_000
MAX_BLOCKS = 4096  # bounds the matrix: MAX_BLOCKS x shards numbers
COPIES = 10_000    # rows alike that one task numbers


def hypergeometric(rng, good: int, bad: int, n: int) -> int:
    """How many of ``n`` places drawn without replacement from ``good`` + ``bad``
    are good ones, by inversion: the probabilities are built up from the most
    likely count by their exact ratios, 40 standard deviations to each side,
    beyond which nothing is left in double precision. One law for all sizes."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    share = good / total
    spread = math.sqrt(max(n * share * (1 - share) * (total - n) / max(1, total - 1), 0.0))
    reach = int(40 * spread) + 40
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)  # p(k + 1) / p(k)
    ratio = (good - k) / (k + 1) * ((n - k) / (bad - n + k + 1))
    up = np.cumprod(ratio[mode - first:])
    down = np.cumprod(1 / ratio[:mode - first][::-1])[::-1]
    chance = np.cumsum(np.concatenate([down, [1.0], up]))
    return first + int(np.searchsorted(chance, rng.random() * chance[-1], "right"))


def communication_matrix(block_rows: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Rows that block i sends to shard j; row sums are ``block_rows``, column
    sums differ by one at most. Each block draws from the shards' open places
    without replacement: one hypergeometric count a shard, given those before."""
    total = int(block_rows.sum())
    left = [total // shards + (j < total % shards) for j in range(shards)]
    rng = np.random.default_rng(seed)
    rng.shuffle(left)
    out = np.zeros((len(block_rows), shards), dtype=np.int64)
    for i, n in enumerate(map(int, block_rows)):
        rest = sum(left)
        for j in range(shards):
            rest -= left[j]
            out[i, j] = hypergeometric(rng, left[j], rest, n)
            n -= int(out[i, j])
        left = [a - int(b) for a, b in zip(left, out[i])]
    return out


def _copies(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``copy``, the number of each among the rows alike. Rows alike
    are interchangeable, so they are counted and written out again, a hot one
    by many tasks."""
    spark = rows.sparkSession
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}")))
    chunks = counted.select(*key, "n", chunk.alias("chunk"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(parts, F.xxhash64("chunk", *key))
    first = F.col("chunk") * COPIES
    return chunks.select(*key, F.explode(F.sequence(first, F.least(first + COPIES, F.col("n")) - 1)).alias("copy"))


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per
    input row. ``size``: UTF-8 bytes of the text (null: none) plus 1. The law is
    `rows`: shard sizes differ by one row at most; ``slot`` counts from 0
    without gaps in each shard. Deterministic for a table and seed, whatever
    its partitions. Rows alike in doc_id and text are interchangeable; each copy
    draws its own place. A null doc_id is a value like any other; extra columns
    are ignored. An empty table gives no rows."""
    spark = docs.sparkSession
    text = whole(F.col("text").cast("string"))
    row = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"))
    key = ["doc_id", "size", "text_crc32"]
    rows = save(_copies(row, key))
    key = [*key, "copy"]
    n = rows.count()
    blocks = min(MAX_BLOCKS, max(1, math.ceil(n / BLOCK_ROWS)))

    def draw(k: int):
        return F.xxhash64(F.lit(seed * 31 + k), *key)

    dealt = rows.withColumn("block", F.pmod(draw(0), F.lit(blocks)).cast("int"))
    counts = np.zeros(blocks, dtype=np.int64)
    for r in dealt.groupBy("block").count().collect():  # at most MAX_BLOCKS rows
        counts[r["block"]] = r["count"]
    ends = communication_matrix(counts, shards, seed).cumsum(axis=1)
    matrix = spark.createDataFrame([(i, [int(x) for x in e]) for i, e in enumerate(ends)], "block int, ends array<long>")
    local = Window.partitionBy("block").orderBy(draw(1), *key)
    sent = (dealt.withColumn("turn", F.row_number().over(local)).join(F.broadcast(matrix), "block")
            .select(*key, F.size(F.filter("ends", lambda e: e < F.col("turn"))).alias("shard")))
    # the second permutation: an order-preserving split of a fresh random key
    # keeps every sort small; the slots of a part follow from the counts
    sent = save(sent.withColumn("draw", draw(2)).withColumn(
        "part", F.floor((F.col("draw") / F.lit(2.0 ** 64) + 0.5) * F.lit(float(blocks))).cast("int")))
    parts = sent.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("draw", *key)
    return (sent.withColumn("turn", F.row_number().over(within))
            .join(F.broadcast(offsets), ["shard", "part"])  # at most shards x (MAX_BLOCKS + 1) rows
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("first") + F.col("turn") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the documents as Parquet, one folder per shard, sorted by slot."""
    text = whole(F.col("text").cast("string"))
    keyed = docs.withColumns({"_size": (F.octet_length(text) + 1).cast("long"), "_crc": F.crc32(text.cast("binary"))})
    once = Window.partitionBy("doc_id", "_size", "_crc").orderBy(F.lit(0))
    place = shuffle_into_shards(docs, shards, seed).withColumn(
        "_copy", F.row_number().over(Window.partitionBy("doc_id", "size", "text_crc32").orderBy("shard", "slot")))
    keyed = keyed.withColumn("_copy", F.row_number().over(once))
    p = place.select(F.col("doc_id").alias("_id"), "size", "text_crc32", "shard", "slot", F.col("_copy").alias("_n"))
    out = keyed.join(p, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("size"))
                     & (F.col("_crc") == F.col("text_crc32")) & (F.col("_copy") == F.col("_n")))
    out = out.select(*[docs[c] for c in docs.columns], "shard", "slot")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(max(shards, parts), "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
