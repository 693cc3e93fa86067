"""SimHash, suffix-array and PQ near-duplicates against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

from marketlens.llm import common, pq, queries, simhash, suffix

SF = "/root/testdata/sf0.001"


def components(ids, linked):
    """Smallest id reachable, for a set of pairs."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def check_simhash(rows, got):
    fps = {i: plain_fingerprint(t) for i, t in rows}
    ids = sorted(fps)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if bin(fps[a] ^ fps[b]).count("1") <= 4]
    want = components(ids, pairs)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == [
        (i, f"{fps[i]:016x}", want[i]) for i in ids]


def test_simhash_query(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    check_simhash(rows, queries.op10_simhash_near_dedup(spark, SF).collect())


def test_simhash_near_copies_and_edges(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "Ä ä É"), (6, "a b c d"), (7, "x " * 30_000)]
    for i in range(8, 70):  # a chain of edits: links that only hold step by step
        base[rnd.randrange(300)] = rnd.choice(words)
        rows.append((i, " ".join(base)))
    df = spark.createDataFrame([(i, t, "clash", i) for i, t in rows], "doc_id long, text string, fingerprint string, component_id long")
    check_simhash(rows, simhash.near_duplicates(df).collect())


def test_simhash_repeated_rows_null_ids_and_empty(spark):
    df = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (5, "quite another text of words"), (None, "a b c d e"),
                                (7, "a b c d e"), (None, "no one else has this")], "doc_id long, text string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == 6
    assert {r["component_id"] for r in got if r["fingerprint"] == f"{plain_fingerprint('a b c d e'):016x}"} == {5}
    assert [r["component_id"] for r in got if r["fingerprint"] == f"{plain_fingerprint('no one else has this'):016x}"] == [None]
    kept = sorted((r["doc_id"] or -1, r["text"]) for r in simhash.keep_one_per_group(df).collect())
    assert kept == [(-1, "no one else has this"), (5, "a b c d e"), (5, "quite another text of words")]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_simhash_hot_variants_split(spark):
    rnd = random.Random(9)
    base = rnd.getrandbits(64)
    fps = {base ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(120)}
    fps |= {rnd.getrandbits(64) for _ in range(40)}
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = components(fps, [(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 4])
    for group in (simhash.MAX_GROUP, 7):
        got = common.connected_components(simhash.fingerprint_links(df, max_group=group)).collect()
        by_root = {}
        for r in got:
            by_root.setdefault(r["root"], set()).add(r["node"] % 2 ** 64)
        plain = {}
        for f, c in want.items():
            plain.setdefault(c, set()).add(f)
        assert sorted(map(sorted, by_root.values())) == sorted(sorted(v) for v in plain.values() if len(v) > 1)


def test_components_of_long_path_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = dict(common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert set(got.items()) == {(i, 0) for i in range(201)} | {(1000 + i, 1000) for i in range(300)}


def cut(rows, window=50):
    seen = {}
    for i, t in rows:
        for s in range(len(t) - window + 1):
            k = t[s:s + window]
            seen[k] = min(seen.get(k, 10 ** 18), 10 ** 17 if i is None else i)
    out = []
    for i, t in rows:
        gone = [False] * len(t)
        for s in range(len(t) - window + 1):
            if seen[t[s:s + window]] < (10 ** 17 if i is None else i):
                gone[s:s + window] = [True] * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((-1 if i is None else i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def test_suffix_query(spark):
    rows = [(i, (t or "").encode()) for i, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()]
    assert removed(queries.op3_suffix_array_dedup(spark, SF)) == cut(rows)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij é", "\0a"])
def test_suffix_many_shards(spark, alphabet):
    rnd = random.Random(alphabet)
    base = ["".join(rnd.choices(alphabet, k=rnd.randint(40, 400))) for _ in range(8)]
    rows = [(0, ""), (None, None), (1, "x" * 49), (2, "x" * 50), (3, "x" * 51), (4, "y" * 3000)]
    for i in range(5, 80):
        text = ""
        for _ in range(rnd.randint(0, 4)):
            b = rnd.choice(base)
            x = rnd.randrange(len(b))
            text += b[x:x + rnd.randint(20, 300)] + "".join(rnd.choices(alphabet, k=rnd.randint(0, 40)))
        rows.append((rnd.randint(5, 60) if i % 9 else None, text))
    rows += [rows[9], rows[12], (99, rows[14][1]), (7, rows[14][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_bytes int")
    want = cut([(i, (t or "").encode()) for i, t in rows])
    for size in (1 << 20, 4000):
        assert removed(suffix.remove_repeats(df, shard_bytes=size)) == want
    assert suffix.remove_repeats(df.limit(0)).collect() == []


def test_suffix_array_and_prefixes_match_sorting():
    rnd = random.Random(2)
    for _ in range(20):
        parts = [bytes(rnd.choices(b"ab", k=rnd.randint(1, 120))) for _ in range(4)]
        a = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts])
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(a))
        text = a.tobytes()
        order = suffix.suffix_array(a, left, 50)
        cut50 = [text[i:i + min(50, left[i])] for i in order]
        assert cut50 == sorted(cut50)
        lcp = suffix.common_prefixes(a, left, order, 50)
        for k in range(1, len(order)):
            x, y = cut50[k - 1], cut50[k]
            assert lcp[k] == next((j for j in range(min(len(x), len(y))) if x[j] != y[j]), min(len(x), len(y)))


def check_vectors(rows, got, cosine=0.9):
    x = [None if v is None or any(c is None or not np.isfinite(c) for c in v) or not any(v) else np.array(v, float) for _, v in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if x[a] is not None and x[b] is not None and len(x[a]) == len(x[b]):
                if x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= cosine:
                    pairs.append((rows[a][0], rows[b][0]))
    ids = [i for i, _ in rows]
    want = components(ids, pairs)
    links = {i: sum(i in p for p in pairs) for i in ids}
    assert sorted(tuple(r) for r in got) == [(i, links[i], want[i], want[i] == i) for i in sorted(ids)]


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for c in rng.normal(size=(6, 16)):  # dense groups around centres, and strays
        for _ in range(60):
            rows.append((n, (c + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.5])).astype(np.float32).tolist()))
            n += 1
    rows += [(n + k, rows[7][1]) for k in range(5)]
    n += 5
    rows += [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] * 16), (n + 3, [None] + [1.0] * 15), (n + 4, [float("inf")] * 16),
             (n + 5, []), (n + 6, [1.0, 0.0]), (n + 7, [2.0, 0.1])]
    rng.shuffle(rows)
    rows = [(int(i), v) for i, v in rows]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, label int, kept int")
    check_vectors(rows, pq.near_duplicates(df).collect())
    monkeypatch.setattr(pq, "MEMBERS", 20)  # many blocks
    monkeypatch.setattr(pq, "QUERIES", 30)
    check_vectors(rows, pq.near_duplicates(df).collect())


def test_vectors_query_repeated_rows_and_empty(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    check_vectors(rows, queries.op2_embedding_near_dedup(spark, SF).collect())
    df = spark.createDataFrame([(3, [1.0, 2.0]), (3, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(str, pq.near_duplicates(df).collect())) == sorted(map(str, [
        *[pq_row(3, 1, 3, True)] * 2, pq_row(None, 0, None, False)]))
    assert pq.near_duplicates(df.limit(0)).collect() == []


def test_vectors_in_double_precision(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9 + 1e-9, 0.19 ** 0.5]), (3, [0.9 - 1e-9, 0.19 ** 0.5]), (4, [1e-300, 0.0]), (5, [1e300, 1e280])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pq.near_duplicates(df).collect()}
    assert got == {1: 3, 2: 4, 3: 1, 4: 3, 5: 3}  # 3 is too far from the first axis by a billionth


def pq_row(vec, n, component, kept):
    from pyspark.sql import Row
    return Row(vec_id=vec, n_links=n, component_id=component, kept=kept)
