"""Exact substring deduplication with suffix arrays.

A byte goes if it lies in a ``window``-byte string that also starts in a
document with a smaller doc_id. Documents are dealt into shards by ranges of
doc_id, so a string found in an earlier shard is in a smaller document.

1. Anchors. In every window the smallest hash of its 24-byte substrings is its
   anchor; equal windows have equal anchors. Anchors that no second document
   has cannot lie in a repeated window, and their windows are left out of what
   follows. So are anchors whose windows are the same in every document that
   has them, as inside a copied passage: there the first document keeps the
   windows, and the others lose them. Both only spare work; what remains are
   the windows at the edges of passages and in passages that vary.
2. Each shard builds the suffix array of the remaining passages
   (Larsson-Sadakane refinement), takes common prefixes of neighbours by
   Kasai's scan, and so has its classes of equal windows, each with its
   smallest document.
3. Merging. The sorted 64-bit hashes of the classes' strings go to hash
   buckets; the smallest shard of every string is found there and each shard's
   list is looked up by binary search. Strings of an earlier shard are returned
   to the later ones, which cut the covered bytes.

Rows cross the shuffles as packed arrays, a few for each shard and bucket.
Step 3 identifies strings by 64-bit hashes (56 stored bits and the bucket).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 50
GRAM = 24
SHARD_BYTES = 4 << 20
PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def substring_hashes(a: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """64-bit hashes of all substrings of each size, by doubling."""
    part, length, power = a.astype(np.uint64) + np.uint64(1), 1, _BASE
    out, done = [None] * len(sizes), [0] * len(sizes)
    while True:
        for k, size in enumerate(sizes):
            if size & length:
                tail = part[size - done[k] - length:][:max(0, len(a) - size + 1)]  # the pieces from the right
                out[k] = tail if out[k] is None else tail * np.uint64(pow(_BASE, done[k], 1 << 64)) + out[k]
                done[k] += length
        if length * 2 > max(sizes):
            return [_mix(x) for x in out]
        part = part[:-length] * np.uint64(power) + part[length:]
        power, length = power * power % (1 << 64), 2 * length


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[:step - width], h[width - step:]) if width > step else h


def _pieces(texts: list[bytes], window: int):
    """Lists of (text number, offset, bytes) of about PIECE bytes, such that
    every window lies in exactly one piece."""
    out, size = [], 0
    for i, t in enumerate(texts):
        for o in range(0, len(t) - window + 1, PIECE):
            out.append((i, o, t[o:o + PIECE + window - 1]))
            size += len(out[-1][2])
            if size >= PIECE:
                yield out
                out, size = [], 0
    if out:
        yield out


def anchor_runs(texts: list[bytes], window: int = WINDOW):
    """(text, start, length, anchor, content): maximal runs of window starts
    with one anchor, for all windows of ``texts``. ``content`` is a hash of the
    run's bytes, 0 for a run so long that its first and last windows don't
    cover it."""
    width = window - GRAM + 1
    found = []
    for pieces in _pieces(texts, window):
        a = np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        first = np.cumsum(sizes) - sizes
        gram, string = substring_hashes(a, GRAM, window)
        low = _sliding_min(gram, width)
        piece = np.repeat(np.arange(len(pieces)), sizes - window + 1)
        starts = np.arange(len(piece)) + np.repeat(first - (np.cumsum(sizes - window + 1) - (sizes - window + 1)), sizes - window + 1)
        low = low[starts]
        new = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (piece[1:] != piece[:-1])])
        text, offset = (np.array([p[k] for p in pieces]) for k in (0, 1))
        k, length = piece[new], np.diff(np.r_[new, len(low)])
        at = starts[new]
        content = _mix(string[at] * np.uint64(_BASE) + string[at + length - 1] + length.astype(np.uint64)) >> np.uint64(16)
        found.append((text[k], offset[k] + at - first[k], length, low[new], np.where(length <= width, np.maximum(content, 1), 0)))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(5))


def _packed(a: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next 8 bytes of each position, big-endian, zeros after its end."""
    wide = np.concatenate([a, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(a), np.uint64)
    for i in range(8):
        out |= np.where(left > i, wide[i:i + len(a)], 0) << np.uint64(56 - 8 * i)
    return out


def suffix_array(a: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``a`` sorted by their suffixes' first ``depth`` bytes or
    more; ``left``: bytes up to the end of each position's passage. Starts from
    8-byte keys, then refines groups that are not yet single by the ranks at
    twice the distance."""
    n = len(a)
    key = _packed(a, left)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0

    def number(at: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Rank the suffixes at ``at`` of the array by where their group
        starts; what stays in groups of several."""
        start = np.flatnonzero(fresh)
        size = np.diff(np.r_[start, len(at)])
        rank[order[at]] = np.repeat(at[start] + 1, size)
        return at[np.repeat(size > 1, size)]

    key = key[order]
    open_ = number(np.arange(n), np.r_[True, key[1:] != key[:-1]]) if n else np.arange(0)
    h = 8
    while h < depth and len(open_):
        s = order[open_]
        both = rank[s].astype(np.uint64) * np.uint64(n + 2) + rank[np.where(left[s] > h, s + h, n)].astype(np.uint64)
        turn = np.argsort(both, kind="stable")
        order[open_], both = s[turn], both[turn]
        open_ = number(open_, np.r_[True, both[1:] != both[:-1]])
        h *= 2
    return order


def common_prefixes(a: np.ndarray, left: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Kasai's scan: for each of ``order`` (sorted positions) the bytes, up to
    ``most``, that it shares with the one before. Text order is cut into lanes
    that run side by side; in a lane the length falls by one at most from one
    position to the next."""
    n, lane = len(a), 64
    before = np.full(n + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.full(n + 2, n, np.int64)
    place[order] = np.arange(len(order))
    key = np.r_[_packed(a, left), np.zeros(most + 1, np.uint64)]
    out = np.zeros(n + 1, np.int64)
    at = np.arange(0, n, lane)
    h, last = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
    for _ in range(lane):
        keep = at < n
        at, h, last = at[keep], h[keep], last[keep]
        p = before[at]
        # the bound holds if what follows the last neighbour is sorted before
        # this one, which a sort to a bounded depth does not always give
        h = np.where((last >= 0) & (place[last + 1] < place[at]), np.maximum(h - 1, 0), 0)
        todo = np.flatnonzero(p >= 0)
        h[p < 0] = 0
        while len(todo):
            x = key[at[todo] + h[todo]] ^ key[p[todo] + h[todo]]
            same = x == 0
            more = np.where(same, 8, 7 - (np.frexp(x.astype(np.float64))[1] - 1) // 8)
            h[todo] += more
            todo = todo[same & (h[todo] < most)]
        own = np.minimum(left[at], left[np.maximum(p, 0)])
        h = np.where(p >= 0, np.minimum(np.minimum(h, own), most), 0)
        out[at] = h
        last = p
        at = at + 1
    return out[order]


def _passages(texts, text, start, length, window):
    """Runs joined where they touch: (text, start, windows) of each passage."""
    if not len(text):
        return text, start, length
    o = np.lexsort((start, text))
    text, start, length = text[o], start[o], length[o]
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (start[1:] != (start + length)[:-1])])
    return text[new], start[new], np.add.reduceat(length, new)


def _joined(texts, text, start, length, window):
    """Bytes of the passages in a row; of each position the bytes left in its
    passage and the text it is from."""
    data = b"".join(texts[t][s:s + k + window - 1] for t, s, k in zip(text, start, length))
    sizes = length + window - 1
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    return np.frombuffer(data, np.uint8), left, np.repeat(np.arange(len(text)), sizes)


def _shard(table: pa.Table):
    """Texts of a shard, each once, in doc_id order (a null id last), with the
    rank of its smallest doc_id; and each row's text number and rank."""
    ids = table.column("doc_id").to_pylist()
    data = table.column("data").to_pylist()
    known = sorted({i for i in ids if i is not None})
    rank = {i: k for k, i in enumerate(known)} | {None: len(known)}
    ranks = [rank[i] for i in ids]
    first: dict[bytes, int] = {}
    for t, r in zip(data, ranks):
        if r < first.get(t, r + 1):
            first[t] = r
    texts = sorted(first, key=lambda t: (first[t], t))
    number = {t: k for k, t in enumerate(texts)}
    return texts, np.array([first[t] for t in texts], np.int64), ids, data, ranks, number


def _rows(shard: int, buckets, blobs) -> pa.Table:
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "shard": pa.array([shard] * len(buckets), pa.int32()),
                     "data": pa.array(blobs, pa.binary())})


_PACKED = "bucket int, shard int, data binary"


CODE_BITS = 30
CANDIDATE, FIRST, LATER = 0, 1, 2


def _anchor_code(low: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 30 more bits; a chance collision only adds a candidate."""
    n = np.uint64(buckets)
    return (low % n) << np.uint64(CODE_BITS) | (low // n & np.uint64((1 << CODE_BITS) - 1))


def _anchors(window: int, buckets: int):
    """Of a shard, by bucket: each anchor with a mark if several documents have
    it, and the content of its runs, 0 if they differ."""
    def run(table: pa.Table) -> pa.Table:
        texts, rank, *_ = _shard(table)
        text, _, _, low, content = anchor_runs(texts, window)
        code = _anchor_code(low, buckets)
        o = np.argsort(code, kind="stable")
        code, r, content = code[o], rank[text[o]], content[o]
        new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.arange(0)
        if not len(new):
            return _rows(0, [], [])
        several = np.minimum.reduceat(r, new) != np.maximum.reduceat(r, new)
        least, most = np.minimum.reduceat(content, new), np.maximum.reduceat(content, new)
        content = np.where(least == most, most, 0)
        code = code[new]
        bucket = (code >> np.uint64(CODE_BITS)).astype(np.int64)
        value = ((code & np.uint64((1 << CODE_BITS) - 1)) << np.uint64(2) | several.astype(np.uint64)).astype(np.uint32)
        used, at = np.unique(bucket, return_index=True)
        blobs = [v.tobytes() + _bytes(c, 6) for v, c in zip(np.split(value, at[1:]), np.split(content, at[1:]))]
        return _rows(table.column("shard")[0].as_py(), used, blobs)

    return run


def _bytes(x: np.ndarray, n: int) -> bytes:
    """The n low bytes of each number."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.pad(np.frombuffer(data, np.uint8).reshape(-1, n), ((0, 0), (0, 8 - n))).view(np.uint64).ravel()


def _repeated(table: pa.Table) -> pa.Table:
    """Of each shard's anchors in a bucket those that a second document has:
    candidates, or settled because all their runs are alike, with a mark if
    this is the first shard that has them."""
    bucket, shards = table.column("bucket")[0].as_py(), np.array(table.column("shard").to_pylist())
    data = table.column("data").to_pylist()
    turn = np.argsort(shards, kind="stable")
    sizes = np.array([len(data[k]) // 10 for k in turn])
    value = np.concatenate([np.frombuffer(data[k], np.uint32, len(data[k]) // 10) for k in turn])
    content = np.concatenate([_numbers(data[k][len(data[k]) // 10 * 4:], 6) for k in turn])
    owner = np.repeat(shards[turn], sizes)
    o = np.argsort(value >> np.uint32(2), kind="stable")  # shards stay in order
    value, content, owner = value[o], content[o], owner[o]
    code = value >> np.uint32(2)
    new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    size = np.diff(np.r_[new, len(code)])
    again = (size > 1) | (value[new] & np.uint32(1) == 1)
    least, most = np.minimum.reduceat(content, new), np.maximum.reduceat(content, new)
    settled = (least == most) & (most > 0)
    kind = np.where(np.repeat(settled, size), LATER, CANDIDATE)
    kind[new] = np.where(settled, FIRST, CANDIDATE)
    keep = np.repeat(again, size)
    out, owner = (code << np.uint32(2) | kind.astype(np.uint32))[keep], owner[keep]
    o = np.argsort(owner, kind="stable")
    used, at = np.unique(owner[o], return_index=True)
    return pa.table({"bucket": pa.array([bucket] * len(used), pa.int32()), "shard": pa.array(used.tolist(), pa.int32()),
                     "data": pa.array([x.tobytes() for x in np.split(out[o], at[1:])] if len(used) else [], pa.binary())})


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def _pack(*arrays) -> bytes:
    return b"".join(np.int64(len(x)).tobytes() + x.astype(np.int64).tobytes() for x in arrays)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int(np.frombuffer(data, np.int64, 1, at)[0])
        out.append(np.frombuffer(data, np.int64, n, at + 8))
        at += 8 + 8 * n
    return out


def _classes(window: int, anchor_buckets: int, buckets: int):
    """Suffix array of a shard's candidate passages: the hash of each class of
    equal windows for its bucket; for the shard itself, in a bucket of its own,
    the passages and the windows known to go: settled ones, and those that a
    smaller document of the shard has."""
    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows or not found.num_rows:
            return _rows(0, [], [])
        shard = table.column("shard")[0].as_py()
        texts, rank, *_ = _shard(table)
        codes = [(np.uint64(b), np.frombuffer(x, np.uint32).astype(np.uint64))
                 for b, x in zip(found.column("bucket").to_pylist(), found.column("data").to_pylist())]
        kind = np.concatenate([x & np.uint64(3) for _, x in codes])
        codes = np.concatenate([b << np.uint64(CODE_BITS) | x >> np.uint64(2) for b, x in codes])
        text, start, length, low, _ = anchor_runs(texts, window)
        low = _anchor_code(low, anchor_buckets)
        gone = _member(np.sort(codes[kind == LATER]), low)
        first = np.sort(codes[kind == FIRST])
        mine = np.flatnonzero(_member(first, low))
        if len(mine):  # the first shard: its smallest document keeps the windows
            at, r = np.searchsorted(first, low[mine]), rank[text[mine]]
            smallest = np.full(len(first), len(rank) + len(table))
            np.minimum.at(smallest, at, r)
            gone[mine[r > smallest[at]]] = True
        gone = _passages(texts, text[gone], start[gone], length[gone], window)
        keep = _member(np.sort(codes[kind == CANDIDATE]), low)
        text, start, length = _passages(texts, text[keep], start[keep], length[keep], window)
        if not len(text):
            return _rows(shard, [-1 - shard], [_pack(text, start, length, *gone)])
        a, left, passage = _joined(texts, text, start, length, window)
        order = suffix_array(a, left, window)
        order = order[left[order] >= window]
        prefix = common_prefixes(a, left, order, window)
        new = np.flatnonzero(np.r_[True, prefix[1:] < window])
        size = np.diff(np.r_[new, len(order)])
        owner = rank[text[passage[order]]]
        smallest = np.minimum.reduceat(owner, new)
        later = order[owner > np.repeat(smallest, size)]
        value = np.sort(substring_hashes(a, window)[0][order[new]])
        bucket = (value % np.uint64(buckets)).astype(np.int64)
        o = np.argsort(bucket, kind="stable")
        value, bucket = (value // np.uint64(buckets))[o], bucket[o]
        used, at = np.unique(bucket, return_index=True)
        blobs = [_bytes(x, 7) for x in np.split(value, at[1:])]
        mark = np.zeros(len(a) + 1, bool)
        mark[later] = True
        s, n = _true_runs(mark)
        first = np.cumsum(length + window - 1) - (length + window - 1)
        p = passage[s] if len(s) else s
        later = (text[p], start[p] + s - first[p], n)
        later = [np.concatenate(x) for x in zip(gone, later)]
        return _rows(shard, [*used.tolist(), -1 - shard], [*blobs, _pack(text, start, length, *later)])

    return run


def _true_runs(mark: np.ndarray):
    edge = np.diff(np.r_[0, mark.astype(np.int8), 0])
    s = np.flatnonzero(edge == 1)
    return s, np.flatnonzero(edge == -1) - s


def _seen_earlier(table: pa.Table) -> pa.Table:
    """Of each shard's strings in a bucket those that an earlier shard has. A
    shard's own row (negative bucket) passes through."""
    bucket = table.column("bucket")[0].as_py()
    if bucket < 0:
        return table.select(["bucket", "shard", "data"])
    shards = np.array(table.column("shard").to_pylist())
    lists = [_numbers(x, 7) for x in table.column("data").to_pylist()]
    turn = np.argsort(shards, kind="stable")
    every = np.concatenate([lists[k] for k in turn])
    merged, first = np.unique(every, return_index=True)  # the first is of the smallest shard
    home = np.repeat(shards[turn], [len(lists[k]) for k in turn])[first]
    out = []
    for k, x in enumerate(lists):
        x = x[home[np.searchsorted(merged, x)] < shards[k]]
        if len(x):
            out.append((int(shards[k]), np.sort(x).tobytes()))
    return pa.table({"bucket": pa.array([bucket] * len(out), pa.int32()), "shard": pa.array([k for k, _ in out], pa.int32()),
                     "data": pa.array([x for _, x in out], pa.binary())})


def _cut(window: int, buckets: int, texts_too: bool):
    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        texts, rank, ids, data, ranks, number = _shard(table)
        gone = {}

        def remove(t, s, n):
            for t, s, n in zip(t.tolist(), s.tolist(), n.tolist()):
                gone.setdefault(t, []).append((s, s + n + window - 1))

        seen, own = [], None
        for b, x in zip(found.column("bucket").to_pylist(), found.column("data").to_pylist()):
            if b < 0:
                own = _unpack(x)
            else:
                seen.append(np.frombuffer(x, np.uint64) * np.uint64(buckets) + np.uint64(b))
        if own is not None:
            text, start, length, *later = own
            remove(*later)
            if seen and len(text):
                a, left, passage = _joined(texts, text, start, length, window)
                mark = _member(np.sort(np.concatenate(seen)), substring_hashes(a, window)[0])
                mark &= (left >= window)[:len(mark)]
                s, n = _true_runs(mark)
                first = np.cumsum(length + window - 1) - (length + window - 1)
                p = passage[s]
                remove(text[p], start[p] + s - first[p], n)
        result = {}
        for k, t in enumerate(texts):
            spans = []
            for s, e in sorted(gone.get(k, [])):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(e, spans[-1][1])
                else:
                    spans.append([s, e])
            kept, at = [], 0
            for s, e in spans:
                kept.append(t[at:s])
                at = e
            kept = b"".join(kept) + t[at:]
            result[k] = (len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)
        nothing = hashlib.sha256(b"").hexdigest()
        out = []
        for t, r in zip(data, ranks):
            k = number[t]
            # a copy of a smaller document goes as a whole
            out.append((len(t), 1, nothing, b"") if r > rank[k] and len(t) >= window else result[k])
        cols = {"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(t) for t in data], pa.int64()),
                "n_removed": pa.array([x[0] for x in out], pa.int64()), "n_spans": pa.array([x[1] for x in out], pa.int64()),
                "kept_sha256": pa.array([x[2] for x in out], pa.string())}
        if texts_too:
            cols["kept"] = pa.array([x[3] for x in out], pa.binary())
        return pa.table(cols)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]), one row per
    input row.

    Null texts count as empty. Rows that share a doc_id do not remove each
    other's bytes; a null doc_id counts as larger than all others. Copies of a
    text inside a shard are worked on once. Extra columns are ignored; an empty
    table gives no rows. ``with_text`` adds the remaining bytes."""
    if window <= GRAM:
        raise ValueError(f"window must be larger than {GRAM}")
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"))
    total, low = rows.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)), F.min("doc_id")).first()
    shards = max(1, math.ceil(total / shard_bytes))
    cuts = []
    if shards > 1 and low is not None:  # one bound per shard reaches the driver
        at = [k / shards for k in range(1, shards)]
        cuts = rows.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * shards))).first()[0]
    splits = [-math.inf, *sorted({float(c) + 0.5 for c in cuts or [0]}), math.inf]
    last = len(splits) - 1
    rows = rows.withColumn("_order", F.col("doc_id").cast("double"))
    rows = Bucketizer(splits=splits, inputCol="_order", outputCol="_shard", handleInvalid="keep").transform(rows)
    rows = rows.select(F.least(F.coalesce(F.col("_shard"), F.lit(last)), F.lit(last)).cast("int").alias("shard"), "doc_id", "data")
    anchor_buckets = max(32, math.ceil(total / (48 << 20)))
    buckets = max(256, math.ceil(total / (8 << 20)))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    shard = rows.groupBy("shard")
    anchors = shard.applyInArrow(_anchors(window, anchor_buckets), _PACKED)
    again = anchors.groupBy("bucket").applyInArrow(_repeated, _PACKED)
    classes = shard.cogroup(again.groupBy("shard")).applyInArrow(_classes(window, anchor_buckets, buckets), _PACKED)
    seen = classes.groupBy("bucket").applyInArrow(_seen_earlier, _PACKED)
    return shard.cogroup(seen.groupBy("shard")).applyInArrow(_cut(window, buckets, with_text), schema)
