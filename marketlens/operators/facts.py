"""Order-level and item-level fact tables.

``orders_master``: one row per order. Items, payments and reviews are first
rolled up to one row per ``order_id`` and then left-joined, so no join can fan
out; all three rollups and the join share the key ``order_id``.

``orders_full``: one row per order item, plus one null-item row for each order
without items (left join from the master).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import floor_days, month_label

ITEM_ROLLUP_COLS = ["product_sales_value", "freight_value_total", "order_value", "item_count"]
REVIEW_COLS = ["review_score", "review_event_count", "review_comment_message", "review_creation_date"]


def items_per_order(items: DataFrame) -> DataFrame:
    return (items.groupBy("order_id").agg(
                F.sum("price").alias("product_sales_value"),
                F.sum("freight_value").alias("freight_value_total"),
                F.count("order_item_id").alias("item_count"))
            .withColumn("order_value", F.col("product_sales_value") + F.col("freight_value_total")))


def delivery_features(df: DataFrame) -> DataFrame:
    """Day counts floor towards minus infinity. Delivery days, delay and the
    late flag exist only for delivered orders; estimated days for all."""
    delivered = F.col("order_status") == "delivered"
    delay = floor_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return (df.withColumn("delivery_days",
                          F.when(delivered, floor_days("order_delivered_customer_date",
                                                       "order_purchase_timestamp")))
              .withColumn("estimated_days",
                          floor_days("order_estimated_delivery_date", "order_purchase_timestamp"))
              .withColumn("delivery_delay_days", F.when(delivered, delay))
              .withColumn("is_late", F.when(F.col("delivery_delay_days").isNotNull(),
                                            (F.col("delivery_delay_days") > 0).cast("int")))
              .withColumn("on_time", (F.lit(1) - F.col("is_late")).cast("int")))


def time_features(df: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    return (df.withColumn("purchase_year", F.year(ts))
              .withColumn("purchase_month", F.month(ts))
              .withColumn("purchase_month_label", month_label(ts)))


def orders_master(orders: DataFrame, customers: DataFrame, payments_agg: DataFrame,
                  reviews_agg: DataFrame, items: DataFrame) -> DataFrame:
    cust = customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                            "customer_city", "customer_state")
    rev = reviews_agg.select("order_id", *[c for c in REVIEW_COLS if c in reviews_agg.columns])
    df = (orders.join(cust, on="customer_id", how="left")
                .join(items_per_order(items), on="order_id", how="left")
                .join(payments_agg, on="order_id", how="left")
                .join(rev, on="order_id", how="left"))
    return time_features(delivery_features(df))


def with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    pcols = ["product_id", "product_category_name", "product_category_name_english",
             "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
             "product_photos_qty"]
    return items.join(products.select(*[c for c in pcols if c in products.columns]), "product_id", "left")


def with_sellers(items: DataFrame, sellers: DataFrame) -> DataFrame:
    scols = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    return items.join(sellers.select(*[c for c in scols if c in sellers.columns]), "seller_id", "left")


def item_attributes(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with product attributes and seller location. Products and sellers
    are joined without a forced broadcast: the catalogue may be large, and
    adaptive execution broadcasts them when they are small."""
    return with_sellers(with_products(items, products), sellers)


def item_values(df: DataFrame) -> DataFrame:
    return (df.withColumn("item_value", F.col("price") + F.col("freight_value"))
              .withColumn("product_volume_cm3", F.col("product_length_cm") * F.col("product_height_cm")
                          * F.col("product_width_cm")))


def item_enrich(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with their attributes, item value and volume."""
    return item_values(item_attributes(items, products, sellers))


def orders_with_items(master: DataFrame, attributes: DataFrame) -> DataFrame:
    """The item-level fact from the master and the items' attributes. Where both
    are bucketed by order, the merge join needs no exchange."""
    slim = master.drop(*[c for c in ITEM_ROLLUP_COLS if c in master.columns])
    return slim.join(item_values(attributes).hint("merge"), on="order_id", how="left")


def orders_full(master: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    return orders_with_items(master, item_attributes(items, products, sellers))


def first_item_category(full: DataFrame) -> DataFrame:
    """Category of each delivered order's first priced item (lowest
    order_item_id). A min_by combines map-side: no sort, no window."""
    it = full.where((F.col("order_status") == "delivered") & F.col("price").isNotNull())
    return it.groupBy("order_id").agg(
        F.min_by(F.struct("product_category_name_english", "product_category_name"),
                 F.struct("order_item_id", "product_id", "seller_id")).alias("c")) \
        .select("order_id", F.col("c.product_category_name_english").alias("product_category_name_english"),
                F.col("c.product_category_name").alias("product_category_name"))


def order_seller_pairs(full: DataFrame) -> DataFrame:
    """Distinct (order, seller) pairs of delivered orders, with the seller's
    state and city from the pair's first item."""
    it = full.where((F.col("order_status") == "delivered") & F.col("seller_id").isNotNull())
    return it.groupBy("order_id", "seller_id").agg(
        F.min_by(F.struct("seller_state", "seller_city"), F.struct("order_item_id", "product_id")).alias("s")) \
        .select("order_id", "seller_id", F.col("s.seller_state").alias("seller_state"),
                F.col("s.seller_city").alias("seller_city"))
