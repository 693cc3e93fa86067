"""KPIs, monthly trends and the category / state / seller / delivery /
review marts of the analytics phase.

Conventions: revenue, delivery and review metrics use delivered orders only;
order and customer counts use all statuses; customers are counted by
``customer_unique_id``; rows whose dimension key (category, state) is null
are left out of that dimension's mart, as a pandas ``groupby`` does. Percentages are left unrounded (rounding is a
presentation concern and would make results depend on the rounding rule).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DELAY_EDGES, DELAY_LABELS, bucket_dimension, pct, right_closed_bucket, safe_div
from .stats import attach, range_row_number, with_scalars

def is_delivered() -> F.Column:
    return F.col("order_status") == "delivered"


def delivered(master: DataFrame) -> DataFrame:
    return master.where(is_delivered())


def del_valid(master: DataFrame) -> DataFrame:
    """Delivered orders with a known late flag (i.e. with a delivery date)."""
    return master.where(is_delivered() & F.col("is_late").isNotNull())


def _dsum(c: str) -> F.Column:
    """Sum over delivered rows; 0 when the group has delivered rows but only nulls."""
    return F.coalesce(F.sum(F.when(is_delivered(), F.col(c))), F.lit(0))


def _late_pct(late: str = "late_count", on: str = "on_time_count") -> F.Column:
    return pct(F.col(late), F.col(late) + F.col(on))


def topline_kpis(master: DataFrame) -> DataFrame:
    """One row: sales, freight, order value (delivered), order / delivered /
    customer counts (all statuses), AOV, review mean, on-time / late %, mean
    delivery days, repeat-customer rate and the record counts behind them.
    Master is unique on order_id, so order counts need no distinct."""
    base = master.agg(
        F.coalesce(F.sum(F.when(is_delivered(), F.col("product_sales_value"))), F.lit(0)).alias("total_product_sales"),
        F.coalesce(F.sum(F.when(is_delivered(), F.col("freight_value_total"))), F.lit(0)).alias("total_freight_value"),
        F.coalesce(F.sum(F.when(is_delivered(), F.col("order_value"))), F.lit(0)).alias("total_order_value"),
        F.count("order_id").alias("total_orders"),
        F.count(F.when(is_delivered(), F.col("order_id"))).alias("total_delivered_orders"),
        F.count_distinct("customer_unique_id").alias("total_customers"),
        F.avg(F.when(is_delivered(), F.col("review_score"))).alias("avg_review_score"),
        (F.avg(F.when(is_delivered(), F.col("on_time"))) * 100).alias("on_time_delivery_pct"),
        (F.avg(F.when(is_delivered(), F.col("is_late"))) * 100).alias("late_delivery_pct"),
        F.avg(F.when(is_delivered(), F.col("delivery_days"))).alias("avg_delivery_days"),
        F.count(F.when(is_delivered(), F.col("review_score"))).alias("review_record_count"),
        F.count(F.when(is_delivered(), F.col("is_late"))).alias("delivery_record_count"))
    base = base.withColumn("avg_order_value", safe_div(F.col("total_order_value"), F.col("total_delivered_orders")))
    return base.transform(attach(repeat_rate(master)))


def repeat_rate(master: DataFrame) -> DataFrame:
    """Customers with more than one delivered order over customers with at least one."""
    per = delivered(master).groupBy("customer_unique_id").agg(F.count("order_id").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("repeat_customer_base"),
                   F.count(F.when(F.col("n") > 1, 1)).alias("repeat_customers")) \
              .withColumn("repeat_customer_rate_pct",
                          F.coalesce(pct(F.col("repeat_customers"), F.col("repeat_customer_base")), F.lit(0.0)))


def monthly_trends(master: DataFrame, min_orders: int = 50) -> DataFrame:
    """Per purchase month: all-order counts plus delivered money, review,
    delivery days and on-time share, in one aggregate; months with fewer
    than ``min_orders`` orders are dropped."""
    g = master.groupBy(F.col("purchase_month_label").alias("ym")).agg(
        F.count("order_id").alias("order_count"),
        F.count_distinct("customer_unique_id").alias("customer_count"),
        F.count(F.when(is_delivered(), F.col("order_id"))).alias("delivered_count"),
        _dsum("product_sales_value").alias("product_sales_value"),
        _dsum("freight_value_total").alias("freight_value_total"),
        _dsum("order_value").alias("order_value"),
        F.avg(F.when(is_delivered(), F.col("review_score"))).alias("avg_review_score"),
        F.avg(F.when(is_delivered(), F.col("delivery_days"))).alias("avg_delivery_days"),
        _dsum("on_time").alias("on_time_count"),
        _dsum("is_late").alias("late_count"))
    has_del = F.col("delivered_count") > 0
    for c in ["delivered_count", "product_sales_value", "freight_value_total", "order_value",
              "on_time_count", "late_count"]:
        g = g.withColumn(c, F.when(has_del, F.col(c)))
    g = g.withColumn("on_time_pct", pct(F.col("on_time_count"), F.col("on_time_count") + F.col("late_count")))
    return g.where(F.col("order_count") >= min_orders)


def peak_month(monthly: DataFrame) -> DataFrame:
    """Month with the most orders and month with the highest sales (earliest on ties)."""
    return monthly.agg(
        F.min_by("ym", F.struct((-F.col("order_count")).alias("k"), F.col("ym"))).alias("peak_orders_month"),
        F.max("order_count").alias("peak_order_count"),
        F.min_by("ym", F.struct((-F.col("product_sales_value")).alias("k"), F.col("ym"))).alias("peak_sales_month"),
        F.max("product_sales_value").alias("peak_sales_value"))


def _order_level(first_cat: DataFrame, master: DataFrame, key: str) -> DataFrame:
    od = delivered(master).select("order_id", "review_score", "delivery_days", "is_late",
                                  "on_time", "delivery_delay_days")
    return first_cat.join(od, "order_id", "left").where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg("review_score").alias("avg_review_score"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.coalesce(F.sum("is_late"), F.lit(0)).alias("late_count"),
        F.coalesce(F.sum("on_time"), F.lit(0)).alias("on_time_count"),
        F.avg("delivery_delay_days").alias("avg_delay_days"))


def rank_desc(df: DataFrame, value: str, tie: str, out: str) -> DataFrame:
    """Positional rank by ``value`` descending, ties by ``tie`` ascending, from
    places in ranges: even a third of the rows tied on one value are ranked by
    many tasks."""
    return range_row_number(df, [F.col(value).desc_nulls_last(), F.col(tie).asc()], out)


def category_performance(full: DataFrame, master: DataFrame, first_cat: DataFrame) -> DataFrame:
    """Item-grain money and counts per English category, joined to
    order-grain review / delivery metrics by each order's first item."""
    items = full.where(is_delivered() & F.col("price").isNotNull())
    fin = items.where(F.col("product_category_name_english").isNotNull()).groupBy("product_category_name_english").agg(
        F.sum("price").alias("product_sales_value"),
        F.sum("freight_value").alias("freight_value_total"),
        F.count("order_item_id").alias("item_count"),
        F.count_distinct("order_id").alias("order_count"))
    fin = (fin.withColumn("order_value", F.col("product_sales_value") + F.col("freight_value_total"))
              .withColumn("avg_item_price", safe_div(F.col("product_sales_value"), F.col("item_count")))
              .withColumn("avg_order_value", safe_div(F.col("order_value"), F.col("order_count"))))
    sat = _order_level(first_cat, master, "product_category_name_english") \
        .withColumn("late_pct", _late_pct())
    cat = fin.join(sat, "product_category_name_english", "left")
    return rank_desc(cat, "product_sales_value", "product_category_name_english", "rank_by_sales")


def state_performance(master: DataFrame) -> DataFrame:
    """Per customer state: all-order counts and delivered money, review,
    delivery and late share in one conditional aggregate."""
    g = master.where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("order_count"),
        F.count_distinct("customer_unique_id").alias("customer_count"),
        F.count(F.when(is_delivered(), 1)).alias("__dc"),
        _dsum("product_sales_value").alias("product_sales_value"),
        _dsum("freight_value_total").alias("freight_value_total"),
        _dsum("order_value").alias("order_value"),
        safe_div(F.sum(F.when(is_delivered(), F.col("order_value"))),
                 F.count(F.when(is_delivered(), F.col("order_value")))).alias("avg_order_value"),
        F.avg(F.when(is_delivered(), F.col("review_score"))).alias("avg_review_score"),
        F.avg(F.when(is_delivered(), F.col("delivery_days"))).alias("avg_delivery_days"),
        _dsum("is_late").alias("late_count"),
        _dsum("on_time").alias("on_time_count"),
        F.avg(F.when(is_delivered(), F.col("delivery_delay_days"))).alias("avg_delay_days"))
    for c in ["product_sales_value", "freight_value_total", "order_value", "late_count", "on_time_count"]:
        g = g.withColumn(c, F.when(F.col("__dc") > 0, F.col(c)))
    return g.withColumn("late_pct", _late_pct()).drop("__dc")


def seller_performance(full: DataFrame, master: DataFrame, order_sellers: DataFrame) -> DataFrame:
    """Per seller: item-grain money and counts, location, and order-grain
    satisfaction over the seller's distinct delivered orders; ranked by sales."""
    items = full.where(is_delivered() & F.col("seller_id").isNotNull())
    fin = items.groupBy("seller_id").agg(
        F.sum("price").alias("product_sales_value"),
        F.sum("freight_value").alias("freight_value_total"),
        F.count("order_item_id").alias("item_count"),
        F.count_distinct("order_id").alias("order_count"),
        F.min("seller_state").alias("seller_state"),
        F.min("seller_city").alias("seller_city"))
    od = delivered(master).select("order_id", "review_score", "delivery_days", "is_late", "on_time")
    sat = order_sellers.select("order_id", "seller_id").join(od, "order_id", "left").groupBy("seller_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.coalesce(F.sum("is_late"), F.lit(0)).alias("late_count"),
        F.coalesce(F.sum("on_time"), F.lit(0)).alias("on_time_count")) \
        .withColumn("late_pct", _late_pct())
    s = fin.join(sat, "seller_id", "left")
    return rank_desc(s, "product_sales_value", "seller_id", "rank_by_sales")


def _bucketed_counts(spark: SparkSession, df: DataFrame, value: str, labels, edges, name: str,
                     aggs: list) -> DataFrame:
    b = df.withColumn(name, right_closed_bucket(F.col(value), edges, labels))
    counts = b.where(F.col(name).isNotNull()).groupBy(name).agg(*aggs)
    dim = bucket_dimension(spark, labels, name)
    # the dimension has exactly len(labels) rows: broadcasting it is bounded
    return F.broadcast(dim).join(counts, name, "left")


def delivery_delay_dist(spark: SparkSession, master: DataFrame) -> DataFrame:
    """Delivered orders with a delivery time per delay bucket (all 7 buckets,
    empty ones with 0) and their share."""
    dv = delivered(master).where(F.col("delivery_days").isNotNull())
    out = _bucketed_counts(spark, dv, "delivery_delay_days", DELAY_LABELS, DELAY_EDGES, "delay_bucket",
                           [F.count(F.lit(1)).alias("order_count")])
    out = out.withColumn("order_count", F.coalesce(F.col("order_count"), F.lit(0)))
    total = dv.agg(F.count(F.lit(1)).alias("__total"))
    return with_scalars(out, total).withColumn("pct", pct(F.col("order_count"), F.col("__total"))).drop("__total")


def delivery_by_state(master: DataFrame) -> DataFrame:
    return delivered(master).where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("order_count"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        (F.avg("is_late") * 100).alias("late_pct"),
        F.avg("review_score").alias("avg_review_score"))


def delivery_by_category(first_cat: DataFrame, master: DataFrame) -> DataFrame:
    od = delivered(master).select("order_id", "delivery_days", "delivery_delay_days", "is_late", "review_score")
    return first_cat.join(od, "order_id", "left").where(F.col("product_category_name_english").isNotNull()).groupBy("product_category_name_english").agg(
        F.count("order_id").alias("order_count"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        (F.avg("is_late") * 100).alias("late_pct"),
        F.avg("review_score").alias("avg_review_score"))


def review_score_dist(master: DataFrame) -> DataFrame:
    dm = delivered(master).where(F.col("review_score").isNotNull())
    counts = dm.groupBy("review_score").agg(F.count(F.lit(1)).alias("order_count"))
    total = dm.agg(F.count(F.lit(1)).alias("__total"))
    return with_scalars(counts, total).withColumn("pct", pct(F.col("order_count"), F.col("__total"))).drop("__total")


def satisfaction_over_time(master: DataFrame, min_reviews: int = 50) -> DataFrame:
    dm = delivered(master).where(F.col("review_score").isNotNull())
    return dm.groupBy(F.col("purchase_month_label").alias("ym")).agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("review_score").alias("review_count")).where(F.col("review_count") >= min_reviews)


def review_vs_delay(spark: SparkSession, master: DataFrame) -> DataFrame:
    """Mean review per delay bucket; every bucket is present (empty: n=0, mean null)."""
    dm = delivered(master).where(F.col("review_score").isNotNull() & F.col("delivery_delay_days").isNotNull())
    out = _bucketed_counts(spark, dm, "delivery_delay_days", DELAY_LABELS, DELAY_EDGES, "delay_bucket",
                           [F.avg("review_score").alias("avg_review_score"),
                            F.count("order_id").alias("order_count")])
    return out.withColumn("order_count", F.coalesce(F.col("order_count"), F.lit(0)))
