"""SimHash near-duplicates by deletion-variant signatures.

With at most ``max_bits`` = 4 differing bits and 3 segments, some segment
differs by at most one bit. Every segment is indexed once per bit with that bit
left out (64 variants in all), so two linked fingerprints share a variant; an
equality shuffle brings them together and the whole fingerprints are compared.
Equal fingerprints are one node, and a group never emits all its pairs: groups
emit a spanning forest of their links.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, partitions_for, save, unused, whole

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit, number of bits
VARIANTS = 64
SMALL_GROUP = 16
MAX_GROUP = 200_000
MAX_HOT_VARIANTS = 100_000


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of UTF-8 bytes; 0 when there is no word."""
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = list(accumulate(map(len, words), lambda s, w: s + 1 + w))
    starts = [0] + [e + 1 for e in ends[:n - 1]]
    ends = ends[shingle - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[i:i + (1 << 16)], ends[i:i + (1 << 16)])),
                        dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp): one row per input row; fp is the fingerprint's 64
    bits as a long, text_key tells the texts of rows with one doc_id apart."""
    def run(batches):
        for b in batches:
            texts = b.column(2).cast(pa.large_binary()).to_pylist()
            fp = np.array([fingerprint(t or b"", shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["doc_id", "text_key", "fp"])

    return docs.select(F.col("doc_id").cast("long"), _text_key(), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, text_key long, fp long")


def _text_key():
    return F.xxhash64(whole(F.col("text").cast("string"))).alias("text_key")


def _variants(batches):
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = np.empty((len(fp), VARIANTS), dtype=np.int64)
        for lo, bits in SEGMENTS:
            value = (fp >> np.uint64(lo)) & np.uint64((1 << bits) - 1)
            for i in range(bits):
                keys[:, lo + i] = (value & ~np.uint64(1 << i)).astype(np.int64) | ((lo + i) << 22)
        for i in range(0, len(fp), 4096):
            part = keys[i:i + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.ravel()), pa.array(np.repeat(fp[i:i + 4096].view(np.int64), VARIANTS))], ["key", "fp"])


def _often(least: int):
    """Variants that ``least`` or more fingerprints of a task share."""
    def run(batches):
        parts = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        if not parts:
            return
        fp = np.concatenate(parts).view(np.uint64)
        for lo, bits in SEGMENTS:
            value = (fp >> np.uint64(lo)) & np.uint64((1 << bits) - 1)
            for i in range(bits):
                key, n = np.unique(value & ~np.uint64(1 << i), return_counts=True)
                many = n >= least
                yield pa.RecordBatch.from_arrays([pa.array(key[many].astype(np.int64) | ((lo + i) << 22)),
                                                  pa.array(n[many].astype(np.int64))], ["key", "n"])

    return run


def _first_variant(x: np.ndarray) -> np.ndarray:
    """The first variant that two fingerprints share, given their XOR."""
    out = np.full(len(x), -1, dtype=np.int64)
    for lo, bits in SEGMENTS:
        part = x & np.uint64(((1 << bits) - 1) << lo)
        one = np.bitwise_count(part)
        where = np.log2(np.maximum(part, 1).astype(np.float64)).astype(np.int64)
        out = np.where((out < 0) & (one <= 1), np.where(one == 0, lo, where), out)
    return out


def spanning_links(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``fp``: visited members leave the
    set that later ones are compared with, so a dense group costs little more
    than its size."""
    left, right = [], []
    rest = np.arange(len(fp))
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            u = stack.pop()
            near = np.bitwise_count(fp[rest] ^ fp[u]) <= max_bits
            if near.any():
                hit = rest[near]
                left.append(np.full(len(hit), u))
                right.append(hit)
                stack.extend(hit.tolist())
                rest = rest[~near]
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _link(max_bits: int):
    """Links inside one partition, which holds all rows of its keys."""
    def run(batches):
        keys, fps = [], []
        for b in batches:
            keys.append(b.column(0).to_numpy(zero_copy_only=False))
            fps.append(b.column(1).to_numpy(zero_copy_only=False))
        if not keys:
            return
        key, fp = np.concatenate(keys), np.concatenate(fps).view(np.uint64)
        del keys, fps
        order = np.argsort(key, kind="stable")
        key, fp = key[order], fp[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        found = []
        small = np.repeat(size <= SMALL_GROUP, size)
        for t in range(1, SMALL_GROUP):
            i = np.flatnonzero((key[t:] == key[:-t]) & small[:-t])
            if not len(i):
                break
            x = fp[i] ^ fp[i + t]
            i = i[(np.bitwise_count(x) <= max_bits)]
            x = fp[i] ^ fp[i + t]
            i = i[_first_variant(x) == (key[i] >> 22) % VARIANTS]
            found.append((fp[i], fp[i + t]))
        for s, n in zip(start[size > SMALL_GROUP], size[size > SMALL_GROUP]):
            own = fp[s:s + n]
            i, j = spanning_links(own, max_bits)
            found.append((own[i], own[j]))
        if not found:
            return
        a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0).view(np.int64)
        for i in range(0, len(pairs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[i:i + 100_000, 0].copy()), pa.array(pairs[i:i + 100_000, 1].copy())], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): a set of links among the distinct fingerprints ``fps`` (fp)
    whose connected components are those of all links. A variant shared by more
    than ``max_group`` fingerprints is dealt out over pairs of blocks."""
    if max_bits >= 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments find at most {2 * len(SEGMENTS) - 1} differing bits")
    spark = fps.sparkSession
    n = fps.count()
    keys = fps.select("fp").mapInArrow(_variants, "key long, fp long")
    parts = partitions_for(spark, n * VARIANTS, 2_000_000)
    if n > max_group:
        limit = max(max_group, math.ceil(n * VARIANTS / 100_000))
        tasks = fps.rdd.getNumPartitions()
        share = max(1, limit // tasks)  # a variant beyond the limit reaches this in some task
        often = fps.select("fp").mapInArrow(_often(share), "key long, n long").groupBy("key").agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("seen"))
        most = F.col("n") + (tasks - F.col("seen")) * share
        hot = save(often.select("key", F.ceil(most / limit).cast("int").alias("blocks")).where("blocks > 1"))
        if hot.count() <= MAX_HOT_VARIANTS:  # else joined by a shuffle
            hot = F.broadcast(hot)
        blocks, zero = F.col("blocks").cast("long"), F.lit(0).cast("long")
        own = F.pmod(F.xxhash64("fp"), blocks)
        pair = F.transform(F.sequence(zero, blocks - 1), lambda j: F.least(own, j) * 100_000 + F.greatest(own, j) + 1)
        keys = keys.join(hot, "key", "left").select(
            F.explode(F.when(F.col("blocks").isNull(), F.array(zero)).otherwise(pair)).alias("pair"), "key", "fp"
        ).select((F.col("key") + F.shiftleft("pair", 28)).alias("key"), "fp")
    return keys.repartition(parts, "key").mapInArrow(_link(max_bits), "a long, b long")


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, fp), and for each fingerprint the ``root`` of
    its group and the group's smallest doc_id."""
    rows = save(fingerprints(docs, shingle))
    nodes = save(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    comps = connected_components(fingerprint_links(nodes, max_bits))
    label = save(nodes.join(comps, nodes["fp"] == comps["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")))
    ids = label.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, label.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Two documents are linked when their fingerprints differ in at most
    ``max_bits`` bits; ``component_id`` is the smallest doc_id reachable. A
    null text counts as empty; texts without a word share fingerprint zero and
    are linked. A null doc_id gets a row and takes part, but is never a
    component's id (the id is null when no member has one). Extra columns are
    ignored."""
    rows, label = _grouped(docs, shingle, max_bits)
    return rows.join(label, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group: the one with the smallest doc_id (a null id comes
    last), of several with that id the one with the smallest hash of its text.
    Columns as in ``docs``, whatever their names."""
    rows, label = _grouped(docs.select("doc_id", "text"), shingle, max_bits)
    rows = rows.join(label, "fp").select("root", "doc_id", "text_key", F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key").alias("rank"))
    rows = save(rows)
    best = rows.groupBy("root").agg(F.min("rank").alias("best"))
    key, i, t = unused(docs, "_text_key", "_i", "_t")
    lost = rows.join(best, "root").where("rank <> best").select(
        F.col("doc_id").alias(i), F.col("text_key").alias(t)).distinct()
    keyed = docs.withColumn(key, _text_key())
    kept = keyed.join(lost, F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(key) == F.col(t)), "left_anti")
    again = rows.groupBy("doc_id", "text_key").count().where("count > 1")
    if not again.isEmpty():  # rows alike in id and text: one of them
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.drop(key)
