"""Whitening by polarisation, against exact sums and numpy."""

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from marketlens.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def good(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def plain(vectors):
    """n, deviation of each row, V: exact integers and fractions."""
    xs = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, sums = len(xs), [sum(c) for c in zip(*xs)]
    y = [[n * c - s for c, s in zip(x, sums)] for x in xs]
    d = len(sums)
    v = [[Fraction(sum(r[i] * r[j] for r in y), n ** 3) for j in range(d)] for i in range(d)]
    return n, [sum(c * c for c in r) for r in y], v, [[Fraction(c, n) for c in r] for r in y]


def check(rows, vectors):
    """``rows``: collected rows of vectors 0.. in order of vec_id."""
    n, deviation, v, centred = plain(vectors)
    d = len(v)
    trace = sum(v[i][i] for i in range(d))
    per = {}
    for r in rows:
        per.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(per) == list(range(n))
    assert all(sorted(p) == list(range(1, min(8, d) + 1)) for p in per.values())
    scale = np.array([[float(c) for c in r] for r in v])
    values = np.linalg.eigvalsh(scale)[::-1]
    for k, p in per.items():
        for r in p.values():
            assert r["n"] == n and r["deviation_exact"] == deviation[k]
            assert r["deviation"] == (deviation[k] if deviation[k] < 2 ** 63 else None)
    white = np.array([[np.nan if per[k][c]["whitened"] is None else per[k][c]["whitened"] for c in sorted(per[k])] for k in range(n)])
    live = ~np.isnan(white[0])
    w = white[:, live]
    assert (np.isnan(white) == ~live).all()
    if live.any():
        w0 = w - w.mean(0)
        gap = np.abs(w0.T @ w0 / n - np.eye(live.sum())).max()
        assert gap < 1e-4 and rows[0]["identity_error"] < 1e-4 and abs(gap - rows[0]["identity_error"]) < 1e-6
    else:
        assert rows[0]["identity_error"] is None
    explained = [per[0][c]["explained"] for c in sorted(per[0])]
    assert explained == sorted(explained, reverse=True)
    if trace:
        big = values[:len(explained)] > 1e-9 * values[0]
        assert np.allclose(np.array(explained)[big], (values[:len(explained)] / float(trace))[big], rtol=1e-6)
    return np.array(explained), live, w


def rows_of(spark, vectors):
    table = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)], SCHEMA)
    return whitening.whiten(table).collect()


def test_query(spark):
    found = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' order by vec_id").fetchall()
    kept = [(i, v) for i, v in found if good(v)]
    got = queries.op11_embedding_whitening(spark, SF).collect()
    place = {i: k for k, (i, _) in enumerate(kept)}
    vectors = [v for _, v in kept]
    assert {r["vec_id"] for r in got} == set(place)
    n, deviation, v, centred = plain([[*x[:4]] for x in vectors])  # the first dimensions, exactly
    x = np.floor(np.array(vectors) * 1024).astype(np.int64) + 100_000
    want = ((len(x) * x - x.sum(0)) ** 2).sum(1)
    cov = np.cov(x.T, bias=True)
    values, axes = np.linalg.eigh(cov)
    for r in got:
        k = place[r["vec_id"]]
        assert r["n"] == len(x) and r["deviation"] == want[k] and r["identity_error"] < 1e-9
        e, axis = values[-r["component"]], axes[:, -r["component"]]
        assert r["explained"] == pytest.approx(e / np.trace(cov), rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs((x[k] - x.mean(0)) @ axis / math.sqrt(e)), abs=1e-6)


def test_one_sign_for_all_rows_and_near_dimensions(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 3))
    vectors = base @ rng.normal(size=(3, 5)) + 1e-2 * rng.normal(size=(60, 5)) + 50  # far from zero: x**2 would cancel
    rows = rows_of(spark, vectors)
    check(rows, vectors.tolist())
    first = {r["vec_id"]: r["whitened"] for r in rows if r["component"] == 1}
    x = np.floor(vectors * 1024)
    axis = np.linalg.eigh(np.cov(x.T, bias=True))[1][:, -1]
    side = np.sign([first[i] * ((x - x.mean(0))[i] @ axis) for i in range(60)])
    assert abs(side.sum()) == 60


def test_dimensions_of_unlike_spread(spark):
    """Variances 10**16 apart: eigh alone loses the small ones."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(40, 6)) @ np.diag([1e7, 1, 1e-1, 1e5, 3, 1e3])
    vectors[:, 1] += 1e-7 * vectors[:, 0]
    rows = rows_of(spark, vectors)
    _, live, _ = check(rows, vectors.tolist())
    assert live.all()


@pytest.mark.parametrize("vectors", [
    [[0.5, 0.25]], [[1.0, 2.0]] * 5, [[1.0], [2.0], [2.0]], [[0.0, 0.0, 7.0], [1.0, 0.0, 7.0], [0.0, 1.0, 7.0], [1.0, 1.0, 7.0]],
    [[1e-4, -1e-4], [-1e-4, 1e-4]], [[2.0 ** 49, 1.0], [-2.0 ** 49, 2.0], [0.0, 4.0]], [[float(i == j) for j in range(12)] for i in range(5)]])
def test_small_tables(spark, vectors):
    explained, live, _ = check(rows_of(spark, vectors), vectors)
    rank = np.linalg.matrix_rank(np.cov(np.floor(np.array(vectors).T * 1024), bias=True).reshape(len(vectors[0]), -1))
    assert live.sum() == min(8, rank) and (explained[~live] == 0).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [2.0, 4.5], 1), (2, [3.0, 1.0], 1), (2, [3.0, 1.0], 1), (None, [0.0, 0.0], 1),
            (5, None, 1), (6, [], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [-inf, 1.0], 1), (11, [1e300, 1.0], 1),
            (20, [1.0, 2.0, 3.0], 1), (21, [1.5, 0.0, 3.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, d int").selectExpr("*", "1 as n", "2 as x", "3 as salt")
    got = whitening.whiten(table).collect()
    two = [r for r in got if r["n"] == 5]
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in two) == sorted(
        (i is None, i or 0, c) for i in (0, 1, 2, 2, None) for c in (1, 2))
    three = [r for r in got if r["n"] == 2]
    assert len(got) == len(two) + len(three) and {r["vec_id"] for r in three} == {20, 21}
    assert [r["whitened"] is None for r in three if r["component"] > 1] == [True] * 4
    assert [abs(r["whitened"]) for r in three if r["component"] == 1] == [pytest.approx(1.0)] * 2
    none = whitening.whiten(table.where("false"))
    assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
    assert none.count() == 0


def test_many_lengths_without_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(3)
    table = spark.createDataFrame([(i, rng.normal(size=2 + i % 3).tolist(), 0) for i in range(90)], SCHEMA)
    want = sorted((r["vec_id"], r["component"], r["deviation"], round(r["whitened"], 9)) for r in whitening.whiten(table).collect())
    monkeypatch.setattr(whitening, "BROADCAST", -1)
    got = sorted((r["vec_id"], r["component"], r["deviation"], round(r["whitened"], 9)) for r in whitening.whiten(table).collect())
    assert got == want


def test_sums_beyond_64_bits():
    rng = np.random.default_rng(4)
    for top in (1 << 20, 1 << 31, 1 << 61):
        y = rng.integers(-top, top, size=(50, 4))
        s = whitening.Squares(4)
        s.add(y)
        z = y.astype(object)
        for i in range(4):
            for j in range(i, 4):
                w = z[:, i] if i == j else z[:, i] + z[:, j]
                assert (int(s.hi[i, j]) << whitening.LIMB) + int(s.lo[i, j]) == (w * w).sum()
