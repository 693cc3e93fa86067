"""Deterministic marketplace fixtures derived from the driver's testdata.

The testdata is a TPC-H-like star schema; it has no delivery dates, reviews
or payments, so the nine marketplace source tables are derived from it with
fixed rules (see FIXTURES.md §2). The derivation is plain DataFrame code and
scales with the testdata; the only ranking is that of the items of an order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .readers import read_testdata

# The translation misspelling present in the fixture and its fix.
FIXTURE_SPELLING_FIXES = {"costruction_large": "construction_large"}


def _hours(ts: str, hours) -> F.Column:
    return F.timestamp_add("HOUR", hours, F.col(ts))


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = lambda name: read_testdata(spark, sf_dir, name)
    orders, customer, nation = t("orders"), t("customer"), t("nation")
    lineitem, events, part, supplier = t("lineitem"), t("events"), t("part"), t("supplier")

    # customers: one row per order; every 200th order is placed from the next nation
    nat_key = F.when(F.col("o_orderkey") % 200 == 0, (F.col("c_nationkey") + 1) % 25) \
               .otherwise(F.col("c_nationkey"))
    customers = (orders.select("o_orderkey", "o_custkey")
                 .join(customer.select("c_custkey", "c_nationkey"),
                       F.col("o_custkey") == F.col("c_custkey"))
                 .join(nation.select("n_nationkey", "n_name"), nat_key == F.col("n_nationkey"))
                 .select(F.col("o_orderkey").alias("customer_id"),
                         F.col("o_custkey").alias("customer_unique_id"),
                         F.col("n_name").alias("customer_state"),
                         F.concat(F.lit("CITY_"), (F.col("o_custkey") % 40).cast("string")).alias("customer_city"),
                         (F.col("o_custkey") % 997).cast("string").alias("customer_zip_code_prefix")))

    k = F.col("o_orderkey")
    orders_fx = orders.select(
        k.alias("order_id"), k.alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", "canceled").otherwise("delivered").alias("order_status"),
        _hours("o_orderdate", k % 24).alias("order_purchase_timestamp"),
        F.when(k % 97 != 0, _hours("o_orderdate", k % 24 + k % 72)).alias("order_approved_at"),
        F.when(k % 499 != 0, _hours("o_orderdate", k % 24 + 24 * ((7 * k + F.col("o_custkey")) % 40) + k % 5))
         .alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.lit(24), F.col("o_orderdate")).alias("order_estimated_delivery_date"))

    # items: (l_orderkey, l_linenumber) repeats in the testdata, so the item id is assigned
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_extendedprice", "l_quantity", "l_shipdate", "l_tax")
    # within one order, which holds a handful of items
    in_order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    li = li.withColumn("order_item_id", F.row_number().over(in_order))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    items = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("freight_value"))

    payments = lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"))

    et = F.col("event_type")
    reviews = events.select(
        F.col("event_id").alias("review_id"),
        F.floor(F.col("event_id") * 2 / F.lit(3.0)).cast("bigint").alias("order_id"),
        F.when(et != "signup", 1 + F.floor(F.col("value")).cast("bigint") % 5).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.when(et.isin("error", "view"), F.col("props")).alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"))

    pk = F.col("p_partkey")
    products = part.select(
        pk.alias("product_id"),
        F.when(pk % 53 != 0, F.lower("p_type")).alias("product_category_name"),
        F.lit(None).cast("int").alias("product_photos_qty"),
        F.when(pk % 17 != 0, F.col("p_size") * 100).cast("double").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        (F.col("p_size") + 1).cast("double").alias("product_height_cm"),
        (F.col("p_size") + 2).cast("double").alias("product_width_cm"))

    sellers = (supplier.select("s_suppkey", "s_nationkey")
               .join(nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
               .select(F.col("s_suppkey").alias("seller_id"),
                       F.lit(None).cast("string").alias("seller_zip_code_prefix"),
                       F.concat(F.lit("CITY_"), (F.col("s_suppkey") % 20).cast("string")).alias("seller_city"),
                       F.col("n_name").alias("seller_state")))

    translation = (part.where(F.col("p_type") != "SMALL")
                   .select(F.lower("p_type").alias("product_category_name"),
                           F.when(F.col("p_type") == "LARGE", F.lit("costruction_large"))
                            .otherwise(F.concat(F.lower("p_type"), F.lit("_goods")))
                            .alias("product_category_name_english"))
                   .distinct())

    geolocation = (customer.select("c_custkey", "c_acctbal", "c_nationkey")
                   .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
                   .select((F.col("c_custkey") % 97).cast("string").alias("geolocation_zip_code_prefix"),
                           (F.col("c_acctbal") / 1000).cast("decimal(9,6)").cast("double").alias("geolocation_lat"),
                           ((F.col("c_custkey") % 360) - 180).cast("decimal(9,6)").cast("double").alias("geolocation_lng"),
                           F.concat(F.lit("CITY_"), (F.col("c_custkey") % 3).cast("string")).alias("geolocation_city"),
                           F.col("n_name").alias("geolocation_state")))

    return {"customers": customers, "orders": orders_fx, "items": items, "payments": payments,
            "reviews": reviews, "products": products, "sellers": sellers,
            "geolocation": geolocation, "translation": translation}
