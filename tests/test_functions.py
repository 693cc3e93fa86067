"""Scalar semantics: floor-day differences, right-closed buckets, padding,
safe division, display labels, weekday numbering."""

import datetime as dt

from pyspark.sql import functions as F

from marketlens.functions import (DELAY_EDGES, DELAY_LABELS, category_display, floor_days, late_severity,
                                  right_closed_bucket, safe_div, seller_display, weekday_monday0, zero_pad)


def test_floor_days_floors_towards_minus_infinity(spark):
    est = dt.datetime(2020, 1, 10, 12, 0)
    rows = [(est - dt.timedelta(hours=5), -1), (est + dt.timedelta(hours=5), 0),
            (est + dt.timedelta(hours=24), 1), (est - dt.timedelta(days=3), -3), (None, None)]
    df = spark.createDataFrame([(act, est, exp) for act, exp in rows],
                               "act timestamp_ntz, est timestamp_ntz, expected bigint")
    got = df.select(floor_days("act", "est").alias("d"), "expected").collect()
    assert [r.d for r in got] == [r.expected for r in got]


def test_late_flag_from_floor_days(spark):
    # delivered 5 h before / after the estimate: on time; 24 h after: late
    est = dt.datetime(2020, 1, 10, 12, 0)
    df = spark.createDataFrame([(est - dt.timedelta(hours=5),), (est + dt.timedelta(hours=5),),
                                (est + dt.timedelta(hours=24),)], "act timestamp_ntz")
    late = df.select((floor_days(F.col("act"), F.lit(est).cast("timestamp_ntz")) > 0).alias("late")).collect()
    assert [r.late for r in late] == [False, False, True]


def test_delay_buckets_are_right_closed(spark):
    vals = [-8, -7, -6, -3, -2, 0, 1, 3, 4, 7, 8, 14, 15, None]
    expected = ["Early >7d", "Early >7d", "Early 3-7d", "Early 3-7d", "Early 0-3d", "Early 0-3d", "Late 1-3d",
                "Late 1-3d", "Late 4-7d", "Late 4-7d", "Late 8-14d", "Late 8-14d", "Late >14d", None]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = [r.b for r in df.select(right_closed_bucket(F.col("x"), DELAY_EDGES, DELAY_LABELS).alias("b")).collect()]
    assert got == expected


def test_bounded_buckets_exclude_out_of_range(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (50.0,), (50.01,), (1e9,)], "x double")
    got = [r.b for r in df.select(right_closed_bucket(F.col("x"), [0, 50, 100], ["a", "b"]).alias("b")).collect()]
    assert got == [None, "a", "a", "b", None]


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([("1037",), ("123456",), ("12345",), ("7",)], "z string")
    assert [r.p for r in df.select(zero_pad(F.col("z")).alias("p")).collect()] == ["01037", "123456", "12345", "00007"]


def test_safe_div_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "a int, b int")
    assert [r.q for r in df.select(safe_div(F.col("a"), F.col("b")).alias("q")).collect()] == [None, 0.25, None]


def test_display_labels(spark):
    df = spark.createDataFrame([("health_beauty", "abcdef0123456789"), ("tv_LED", "42")], "c string, s string")
    got = df.select(category_display(F.col("c")).alias("c"), seller_display(F.col("s")).alias("s")).collect()
    assert [(r.c, r.s) for r in got] == [("Health Beauty", "...23456789"), ("Tv LED", "...42")]
    over = df.select(category_display(F.col("c"), {"health_beauty": "Health & Beauty"}).alias("c")).collect()
    assert over[0].c == "Health & Beauty"


def test_weekday_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)], "t timestamp_ntz")
    assert [r.w for r in df.select(weekday_monday0("t").alias("w")).collect()] == [0, 6]


def test_late_severity_bands(spark):
    df = spark.createDataFrame([(16.0,), (12.0,), (8.0,), (5.0,)], "p double")
    got = [r.s for r in df.select(late_severity(F.col("p"), F.lit(6.77)).alias("s")).collect()]
    assert got == ["high", "medium", "above_national", "normal"]


def test_spend_above_every_edge_falls_in_the_top_bucket(spark):
    from marketlens.operators.customers import customer_spending_dist
    rfm = spark.createDataFrame([("a", 10.0), ("b", 1500.0), ("c", 1_200_000.0), ("d", 9e12)], "customer_unique_id string, monetary double")
    got = {r.spend_bucket: r for r in customer_spending_dist(spark, rfm).collect()}
    assert got["R$2000+"].customer_count == 2 and got["R$2000+"].total_revenue == 1_200_000.0 + 9e12
    assert abs(sum(r.customer_pct for r in got.values()) - 100) < 1e-9 and abs(sum(r.revenue_pct for r in got.values()) - 100) < 1e-9


def test_checkpoint_dir_must_be_set_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from marketlens.session import ensure_checkpoint_dir
    unset = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: unset, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=unset))
