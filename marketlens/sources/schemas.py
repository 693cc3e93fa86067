"""Explicit source schemas. Never infer: zip codes would lose leading zeros and
money would become binary floating point."""

from pyspark.sql.types import (DecimalType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

S, I, D, T = StringType(), IntegerType(), DoubleType(), TimestampNTZType()
MONEY = DecimalType(18, 4)   # one money scale from the files to the marts


def _schema(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


SOURCE_SCHEMAS = {
    "customers": _schema(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", S), ("customer_city", S),
                         ("customer_state", S)),
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", T), ("order_approved_at", T),
                      ("order_delivered_carrier_date", T),
                      ("order_delivered_customer_date", T),
                      ("order_estimated_delivery_date", T)),
    "items": _schema(("order_id", S), ("order_item_id", I), ("product_id", S),
                     ("seller_id", S), ("shipping_limit_date", T),
                     ("price", MONEY), ("freight_value", MONEY)),
    "payments": _schema(("order_id", S), ("payment_sequential", I),
                        ("payment_type", S), ("payment_installments", I),
                        ("payment_value", MONEY)),
    "reviews": _schema(("review_id", S), ("order_id", S), ("review_score", I),
                       ("review_comment_title", S), ("review_comment_message", S),
                       ("review_creation_date", T), ("review_answer_timestamp", T)),
    "products": _schema(("product_id", S), ("product_category_name", S),
                        ("product_name_lenght", I), ("product_description_lenght", I),
                        ("product_photos_qty", I), ("product_weight_g", D),
                        ("product_length_cm", D), ("product_height_cm", D),
                        ("product_width_cm", D)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", S),
                       ("seller_city", S), ("seller_state", S)),
    "geolocation": _schema(("geolocation_zip_code_prefix", S), ("geolocation_lat", D),
                           ("geolocation_lng", D), ("geolocation_city", S),
                           ("geolocation_state", S)),
    "translation": _schema(("product_category_name", S),
                           ("product_category_name_english", S)),
}

SOURCE_TABLES = list(SOURCE_SCHEMAS)
