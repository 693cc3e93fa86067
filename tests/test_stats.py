"""Distributed helpers against brute force: row numbers, exact quantiles,
order statistics, top-k sums; and invariance to the shuffle partition count."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import stats
from marketlens.operators.stats import exact_quantiles, range_row_number, top_k_sum, values_at_ranks, with_range_bucket


def _values(seed=7, n=3000):
    rng = np.random.default_rng(seed)
    v = np.concatenate([rng.lognormal(5, 2, n // 2), rng.normal(0, 50, n // 4), np.full(n // 4, 123.45)])
    g = rng.integers(0, 4, len(v))
    g[: n // 3] = 0                       # one hot group holding a third of the rows
    return [(int(a), float(round(b, 2))) for a, b in zip(g, v)]


def test_exact_quantiles_match_numpy_linear(spark):
    data = _values()
    df = spark.createDataFrame(data, "g int, v double")
    probs = {"p0": 0.0, "p20": 0.2, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in exact_quantiles(df, "v", probs, keys=["g"]).collect()}
    for g in set(a for a, _ in data):
        vals = np.array([b for a, b in data if a == g])
        for name, p in probs.items():
            assert abs(getattr(got[g], name) - np.percentile(vals, p * 100)) < 1e-6, (g, name)
    glob = exact_quantiles(df, "v", probs).collect()[0]
    allv = np.array([b for _, b in data])
    for name, p in probs.items():
        assert abs(getattr(glob, name) - np.percentile(allv, p * 100)) < 1e-6


def test_values_at_ranks(spark):
    data = _values(3, 500)
    df = spark.createDataFrame(data, "g int, v double")
    r = values_at_ranks(df, "v", {"first": lambda n: F.lit(0), "last": lambda n: n - 1,
                                  "mid": lambda n: F.floor(n / 2)}).collect()[0]
    s = sorted(b for _, b in data)
    assert (r.first, r.last, r.mid, r.n) == (s[0], s[-1], s[len(s) // 2], len(s))


def test_range_row_number_equals_global_window(spark):
    data = _values(11, 2000)
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)] + [(-1, 0, None)], "id int, g int, v double").repartition(7)
    ours = range_row_number(df, [F.col("v").desc_nulls_last(), F.col("id").asc()])
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy(F.col("v").desc_nulls_last(), F.col("id"))))
    joined = ours.join(ref.select("id", "rn2"), "id")
    assert ours.columns == ["id", "g", "v", "rn"] and joined.count() == len(data) + 1
    assert joined.where(F.col("rn") != F.col("rn2")).count() == 0
    assert range_row_number(df.limit(0), [F.col("id")]).count() == 0


BUNCHED = {"a narrow band": "1e6 + id * 5e-6", "a band beside far values": "case when id % 1000 = 0 then id * 1e9 else 7e5 + id * 1e-7 end",
           "powers": "pow(1.0001, id % 50000) + id * 1e-9"}


def test_bunched_values_are_spread(spark):
    """200,000 distinct values of nearly the same size: no range, so no task
    that orders one, holds more than a few hundredths of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    laid, plain = [], stats._laid_by_range

    def spy(*a):
        laid.append(plain(*a))
        return laid[-1]

    try:
        stats._laid_by_range = spy
        for name, expr in BUNCHED.items():
            df = spark.range(200_000).selectExpr(f"cast({expr} as double) as v")
            got = exact_quantiles(df, "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
            want = np.percentile(np.array([r["v"] for r in df.collect()]), [10, 50, 99])
            assert np.allclose([got["p10"], got["p50"], got["p99"]], want, rtol=1e-12, atol=0), name
            sizes = [r["count"] for r in laid[-1].groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) > 48 and max(sizes) < 200_000 / 16, (name, max(sizes))
    finally:
        stats._laid_by_range = plain
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_top_k_sum_with_ties(spark):
    data = [(0, x) for x in [5.0, 5.0, 5.0, 4.0, 3.0, 1.0, 1.0, 0.5, 0.1, 0.0]]
    df = spark.createDataFrame(data, "g int, v double")
    r = top_k_sum(df, "v", lambda n: F.lit(2)).collect()[0]
    assert (r.k, r.threshold, r.top_sum) == (2, 5.0, 10.0)
    r = top_k_sum(df, "v", lambda n: F.floor(n * F.lit(0.5))).collect()[0]
    assert r.top_sum == sum(sorted((b for _, b in data), reverse=True)[:5])


def test_quantiles_independent_of_partition_count(spark):
    df = spark.createDataFrame(_values(5, 1500), "g int, v double")
    res = []
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        res.append(sorted(tuple(r) for r in exact_quantiles(df, "v", {"m": 0.5, "q": 0.75}, keys=["g"]).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1]


def test_rank_with_a_hot_tie_group(spark):
    """A third of the rows share one value: ranks still equal the global window."""
    from marketlens.operators.marts import rank_desc
    rng = np.random.default_rng(9)
    n = 3000
    vals = np.where(np.arange(n) < n // 3, 500.0, np.round(rng.lognormal(5, 1.5, n), 2))
    df = spark.createDataFrame([(i * 7919 % 100003, float(v)) for i, v in enumerate(vals)], "k long, v double")
    ours = rank_desc(df, "v", "k", "rk")
    ref = df.withColumn("rk2", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("k"))))
    joined = ours.join(ref, ["k", "v"])
    assert joined.count() == n and joined.where(F.col("rk") != F.col("rk2")).count() == 0


def test_range_buckets_spread_common_prefixes_and_bunched_scores(spark):
    ids = spark.range(100_000).selectExpr("concat('CUST', lpad(id, 9, '0')) as k")
    scores = spark.range(100_000).selectExpr("0.5 + id * 1e-9 as k")
    for df in (ids, scores):
        got = with_range_bucket(df, "k", "b", 64)
        sizes = [r["count"] for r in got.groupBy("b").count().collect()]
        assert len(sizes) > 32 and max(sizes) < 10_000
        w = Window.orderBy("k")
        assert got.select((F.col("b") < F.lag("b").over(w)).alias("down")).where("down").count() == 0
    few = spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "k string")
    assert with_range_bucket(few, "k", "b").count() == 4 and with_range_bucket(few.limit(0), "k", "b").count() == 0


def test_rank_with_all_rows_tied_on_the_value(spark):
    from marketlens.operators.marts import rank_desc
    df = spark.range(20_000).selectExpr("concat('CUST', lpad(id, 9, '0')) as k", "1.0 as v")
    got = rank_desc(df, "v", "k", "r").orderBy("k").collect()
    assert [r["r"] for r in got] == list(range(1, 20_001))


def test_roc_auc_of_bunched_scores(spark):
    from marketlens.operators.ml import roc_auc
    rng = np.random.default_rng(3)
    s = 0.7 + rng.integers(0, 400, 3000) * 1e-8
    y = (rng.random(3000) < 0.3 + (s - 0.7) * 1e5).astype(int)
    got = roc_auc(spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")).first()
    diff = s[y == 1][:, None] - s[y == 0][None]
    assert abs(got["roc_auc"] - ((diff > 0).mean() + (diff == 0).mean() / 2)) < 1e-9
