"""Profiling, integrity checks and reconciliations.

Every check returns rows of the same shape — ``check``, ``value``,
``expected``, ``passed`` — so a run's checks can be unioned, stored and
asserted on. Each check is one aggregate pass (or a left-anti join for
orphans); nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import attach

from .marts import delivered, is_delivered

TOLERANCE = 0.01


def _check(df_one_row: DataFrame, name: str, value: F.Column, expected: F.Column,
           tol: float | None = TOLERANCE) -> DataFrame:
    v, e = value.cast("double"), expected.cast("double")
    passed = (F.abs(v - e) < F.lit(tol)) if tol is not None else (v == e)
    return df_one_row.select(F.lit(name).alias("check"), v.alias("value"), e.alias("expected"),
                             F.coalesce(passed, F.lit(False)).alias("passed"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ------------------------------------------------------------------ profiling

def profile_nulls(df: DataFrame, table: str) -> DataFrame:
    """Per column: null count, row count and null %. One pass for all columns."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = one.unpivot(["__rows"], cols, "column", "null_count")
    return long.select(F.lit(table).alias("table"), "column", "null_count",
                       F.col("__rows").alias("row_count"),
                       (F.try_divide(F.col("null_count").cast("double"), F.col("__rows").cast("double")) * 100)
                       .alias("null_pct"))


def null_totals(profile: DataFrame) -> DataFrame:
    """Per table of a null profile: null cells, all cells and null %."""
    return profile.groupBy("table").agg(
        F.sum("null_count").alias("null_cells"), F.sum("row_count").alias("cells")).withColumn(
        "null_pct", F.try_divide(F.col("null_cells").cast("double"), F.col("cells").cast("double")) * 100)


def profile_exact_duplicates(df: DataFrame, table: str) -> DataFrame:
    """Rows equal to an earlier row (all columns), via a grouped count."""
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
                 F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("exact_duplicate_rows")) \
            .select(F.lit(table).alias("table"), "row_count", "exact_duplicate_rows")


def status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))


def category_cardinality(products: DataFrame) -> DataFrame:
    """Distinct categories in both languages, by grouping: every value is one
    row of a shuffled count, no task holds all of them."""
    names = ["product_category_name", "product_category_name_english"]
    long = products.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "__col", "__val")
    values = long.groupBy("__col", "__val").agg(F.count(F.lit(1)).alias("__n"))
    known, pt = F.col("__val").isNotNull(), F.col("__col") == names[0]
    return values.agg(F.count_if(known & pt).alias("distinct_categories_pt"), F.count_if(known & ~pt).alias("distinct_categories_en"),
                      F.coalesce(F.sum(F.when(~known & pt, F.col("__n"))), F.lit(0)).alias("missing_category_pt"))


# ------------------------------------------------------------------ integrity

def orphan_check(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, label: str) -> DataFrame:
    """Child rows whose key has no parent (null keys are orphans)."""
    keys = parent.select(F.col(parent_col).alias("__k")).distinct()
    orphans = child.join(keys, child[child_col] == keys["__k"], "left_anti")
    o = orphans.agg(F.count(F.lit(1)).alias("orphans"))
    t = child.agg(F.count(F.lit(1)).alias("total"))
    return o.transform(attach(t)).select(F.lit(label).alias("relation"), "orphans", "total")


def check_referential_integrity(ctx) -> DataFrame:
    return union_all([
        orphan_check(ctx.orders, "customer_id", ctx.customers, "customer_id", "orders.customer_id -> customers"),
        orphan_check(ctx.items, "order_id", ctx.orders, "order_id", "items.order_id -> orders"),
        orphan_check(ctx.items, "product_id", ctx.products, "product_id", "items.product_id -> products"),
        orphan_check(ctx.items, "seller_id", ctx.sellers, "seller_id", "items.seller_id -> sellers"),
        orphan_check(ctx.payments_agg, "order_id", ctx.orders, "order_id", "payments.order_id -> orders"),
        orphan_check(ctx.reviews_agg, "order_id", ctx.orders, "order_id", "reviews.order_id -> orders"),
    ])


def check_unique_key(df: DataFrame, key: str, name: str) -> DataFrame:
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1) \
        .agg(F.count(F.lit(1)).alias("dups"))
    return _check(dup, name, F.col("dups"), F.lit(0), None)


def structural_checks(ctx) -> DataFrame:
    """Grain, row preservation, order validity, prices and master invariants."""
    m, full, orders, items = ctx.master, ctx.full, ctx.orders, ctx.items
    rows = orders.agg(F.count(F.lit(1)).alias("o")).transform(attach(m.agg(F.count(F.lit(1)).alias("m"))))
    no_items = m.select("order_id").join(items.select("order_id").distinct(), "order_id", "left_anti") \
        .agg(F.count(F.lit(1)).alias("e"))
    grain = full.agg(F.count(F.lit(1)).alias("f")).transform(attach(items.agg(F.count(F.lit(1)).alias("i")))).transform(attach(no_items))
    validity = orders.agg(
        F.count_if((F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull()).alias("nd"),
        F.count_if(F.col("order_estimated_delivery_date") < F.col("order_purchase_timestamp")).alias("be"))
    neg = items.agg(F.count_if(F.col("price") < 0).alias("neg"))
    inv = m.agg(
        F.count_if(F.col("order_value") != F.col("product_sales_value") + F.col("freight_value_total")).alias("ov"),
        F.count_if(F.col("is_late").isNotNull() & ~is_delivered()).alias("il"))
    return union_all([
        check_unique_key(m, "order_id", "master_unique_order_id"),
        check_unique_key(ctx.rfm, "customer_unique_id", "rfm_unique_customer"),
        _check(rows, "master_row_count_preserved", F.col("m"), F.col("o"), None),
        _check(grain, "full_rows_eq_items_plus_empty_orders", F.col("f"), F.col("i") + F.col("e"), None),
        _check(validity, "delivered_without_delivery_date", F.col("nd"), F.lit(0), None),
        _check(validity, "estimated_before_purchase", F.col("be"), F.lit(0), None),
        _check(neg, "negative_price_items", F.col("neg"), F.lit(0), None),
        _check(inv, "order_value_eq_sales_plus_freight", F.col("ov"), F.lit(0), None),
        _check(inv, "is_late_only_when_delivered", F.col("il"), F.lit(0), None),
    ])


# ------------------------------------------------------------------ reconciliation

def reconciliations(ctx, marts: dict | None = None) -> DataFrame:
    """Totals rebuilt along a second path must agree: item grain vs order
    grain, category / RFM / segment / type totals, and the delivery
    deep-dive vs the topline KPIs. ``marts`` may pass already materialised
    marts (kpis, cat_perf, rfm_seg, repeat, del_ov, delay_dist, buckets,
    del_by_cat3, del_cat); missing ones are built here."""
    from . import customers as cu
    from . import delivery as dl
    from . import marts as mt
    m, full = ctx.master, ctx.full
    mk = dict(marts or {})
    build = {
        "kpis": lambda: mt.topline_kpis(m),
        "cat_perf": lambda: mt.category_performance(full, m, ctx.first_cat),
        "rfm_seg": lambda: cu.rfm_segment_summary(ctx.rfm),
        "repeat": lambda: cu.repeat_vs_onetime(ctx.rfm, m),
        "del_ov": lambda: dl.delivery_overview(m),
        "delay_dist": lambda: mt.delivery_delay_dist(ctx.spark, m),
        "buckets": lambda: dl.delay_bucket_counts(ctx.spark, m),
        "del_by_cat3": lambda: mt.delivery_by_category(ctx.first_cat, m),
        "del_cat": lambda: dl.delivery_by_category_enriched(ctx.first_cat, m),
        "del_state": lambda: dl.delivery_by_state_enriched(m),
        "del_by_state3": lambda: mt.delivery_by_state(m),
        "rev_delay": lambda: dl.review_by_delay_detailed(m),
        "rev_vs_delay3": lambda: mt.review_vs_delay(ctx.spark, m),
    }
    for k, f in build.items():
        if k not in mk:
            mk[k] = f()
    dm = delivered(m)
    dfull = full.where(is_delivered())
    order_side = dm.agg(F.sum("product_sales_value").alias("s"), F.sum("freight_value_total").alias("f"),
                        F.count("order_id").alias("n"), F.sum("order_value").alias("ov"))
    item_side = dfull.agg(F.sum("price").alias("si"), F.sum("freight_value").alias("fi"),
                          F.count_distinct("order_id").alias("ni"))
    k = order_side.transform(attach(item_side))
    cat = mk["cat_perf"].agg(F.sum("product_sales_value").alias("cs"))
    rfm = ctx.rfm.agg(F.sum("monetary").alias("mon"), F.count(F.lit(1)).alias("rc"))
    seg = mk["rfm_seg"].agg(F.sum("customer_count").alias("sc"), F.sum("total_revenue").alias("sr"))
    typ = mk["repeat"].agg(F.sum("customer_count").alias("tc"), F.sum("total_revenue").alias("tr"))
    kpi = mk["kpis"]
    ov = mk["del_ov"]
    d3 = mk["delay_dist"].agg(F.sum("order_count").alias("b3"))
    d5 = mk["buckets"].agg(F.sum("order_count").alias("b5"))
    c3 = mk["del_by_cat3"].agg(F.sum("order_count").alias("c3"))
    c5 = mk["del_cat"].agg(F.sum("order_count").alias("c5"))
    kd = kpi.select(F.col("avg_delivery_days").alias("kd"), "on_time_delivery_pct", "late_delivery_pct",
                    "avg_order_value")
    t = 0.05
    st = mk["del_state"].select("customer_state", F.col("late_pct").alias("l5")).join(
        mk["del_by_state3"].select("customer_state", F.col("late_pct").alias("l3")), "customer_state") \
        .agg(F.coalesce(F.max(F.abs(F.col("l5") - F.col("l3"))), F.lit(0.0)).alias("d"))
    bs = mk["rev_delay"].select("delay_bucket", F.col("avg_review_score").alias("s5")).join(
        mk["rev_vs_delay3"].select("delay_bucket", F.col("avg_review_score").alias("s3")), "delay_bucket") \
        .agg(F.coalesce(F.max(F.abs(F.col("s5") - F.col("s3"))), F.lit(0.0)).alias("d"))
    return union_all([
        _check(k, "kpi_sales_item_vs_order", F.col("si"), F.col("s")),
        _check(k, "kpi_freight_item_vs_order", F.col("fi"), F.col("f")),
        _check(k, "kpi_delivered_orders_item_vs_order", F.col("ni"), F.col("n"), None),
        _check(k.transform(attach(kd)), "kpi_aov_recomputed",
               F.try_divide(F.col("ov").cast("double"), F.col("n").cast("double")), F.col("avg_order_value")),
        _check(cat.transform(attach(item_side)), "category_sales_vs_items", F.col("cs"), F.col("si")),
        _check(rfm.transform(attach(order_side)), "rfm_monetary_vs_order_value", F.col("mon"), F.col("ov")),
        _check(seg.transform(attach(rfm)), "segment_customers_vs_rfm", F.col("sc"), F.col("rc"), None),
        _check(seg.transform(attach(rfm)), "segment_revenue_vs_rfm", F.col("sr"), F.col("mon")),
        _check(typ.transform(attach(rfm)), "type_customers_vs_rfm", F.col("tc"), F.col("rc"), None),
        _check(typ.transform(attach(rfm)), "type_revenue_vs_rfm", F.col("tr"), F.col("mon")),
        _check(ov.transform(attach(kd)), "delivery_on_time_pct_vs_kpi", F.col("on_time_pct"), F.col("on_time_delivery_pct"), t),
        _check(ov.transform(attach(kd)), "delivery_late_pct_vs_kpi", F.col("late_pct"), F.col("late_delivery_pct"), t),
        _check(ov.transform(attach(kd)), "delivery_avg_days_vs_kpi", F.col("avg_delivery_days"), F.col("kd"), t),
        _check(d5.transform(attach(d3)), "delay_bucket_totals_phase5_vs_phase3", F.col("b5"), F.col("b3"), None),
        _check(c5.transform(attach(c3)), "category_order_totals_phase5_vs_phase3", F.col("c5"), F.col("c3"), None),
        _check(st, "state_late_pct_phase5_vs_phase3_max_diff", F.col("d"), F.lit(0.0), t),
        _check(bs, "bucket_review_phase5_vs_phase3_max_diff", F.col("d"), F.lit(0.0), 0.001),
    ])
