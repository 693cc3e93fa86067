"""Registered queries: cleaning, facts, KPIs, trends and the analytics marts."""

from __future__ import annotations

from ..operators import facts, marts
from .contracts import MASTER, parse
from .registry import register

from .params import MONTH_MIN_ORDERS, MONTH_MIN_REVIEWS
from .shared import mart

# ---------------------------------------------------------------- facts

register("orders_master", MASTER, "SELECT * FROM master")(lambda c: c.master)

register("items_per_order",
         "order_id:i, product_sales_value:d, freight_value_total:d, item_count:i, order_value:d",
         "SELECT * FROM items_per_order")(lambda c: facts.items_per_order(c.items))

register("payments_per_order",
         "order_id:i, total_payment_value:d, payment_installments:i, payment_type:s, payment_methods_count:i",
         "SELECT * FROM payments_agg")(lambda c: c.payments_agg)

register("reviews_latest_per_order",
         "order_id:i, review_id:i, review_score:i, review_comment_message:s, review_creation_date:t, review_event_count:i",
         "SELECT * FROM reviews_agg")(lambda c: c.reviews_agg)

register("clean_products",
         "product_id:i, product_category_name:s, product_category_name_english:s, product_weight_g:d, "
         "product_length_cm:d, product_height_cm:d, product_width_cm:d",
         "SELECT * FROM products_c")(lambda c: c.products)

register("clean_customers",
         "customer_id:i, customer_unique_id:i, customer_zip_code_prefix:s, customer_city:s, customer_state:s",
         "SELECT * FROM customers_c")(lambda c: c.customers)

register("geolocation_by_zip",
         "geolocation_zip_code_prefix:s, lat:d, lng:d, city:s, state:s",
         """SELECT z AS geolocation_zip_code_prefix, median(lat) AS lat, median(lng) AS lng,
                   arg_min(city, (-nc, city)) AS city, arg_min(state, (-ns, state)) AS state
            FROM (SELECT CASE WHEN length(zip_raw) >= 5 THEN zip_raw ELSE lpad(zip_raw, 5, '0') END AS z, lat, lng, city, state,
                         count(*) OVER (PARTITION BY zip_raw, city) AS nc, count(*) OVER (PARTITION BY zip_raw, state) AS ns
                  FROM fx_geolocation) g GROUP BY z""")(lambda c: c.geolocation)

ITEM_SPEC = ("order_id:i, order_item_id:i, product_id:i, seller_id:i, price:d, freight_value:d, "
             "product_category_name:s, product_category_name_english:s, product_weight_g:d, seller_city:s, "
             "seller_state:s, item_value:d, product_volume_cm3:d")
register("item_enrich", ITEM_SPEC, "SELECT * FROM item_enrich")(
    lambda c: facts.item_enrich(c.items, c.products, c.sellers))

# the whole order fact but its per-order money and count, then the whole item
_ORDER_ONLY = {"product_sales_value", "freight_value_total", "order_value", "item_count"}
FULL_SPEC = ", ".join(f"{n}:{k}" for n, k in parse(MASTER) if n not in _ORDER_ONLY) + ", " + ", ".join(
    f"{n}:{k}" for n, k in parse(ITEM_SPEC) if n != "order_id") + \
    ", product_length_cm:d, product_height_cm:d, product_width_cm:d"
register("orders_full", FULL_SPEC, "SELECT * FROM full_t")(lambda c: c.full)

register("first_item_category",
         "order_id:i, product_category_name_english:s, product_category_name:s",
         "SELECT * FROM first_cat")(lambda c: c.first_cat)

register("order_seller_pairs", "order_id:i, seller_id:i, seller_state:s, seller_city:s",
         "SELECT * FROM order_sellers")(lambda c: c.order_sellers)

# ---------------------------------------------------------------- KPIs

KPI_SPEC = ("total_product_sales:d, total_freight_value:d, total_order_value:d, total_orders:i, "
            "total_delivered_orders:i, total_customers:i, avg_order_value:d, avg_review_score:d, "
            "on_time_delivery_pct:d, late_delivery_pct:d, avg_delivery_days:d, repeat_customer_rate_pct:d, "
            "review_record_count:i, delivery_record_count:i, repeat_customer_base:i, repeat_customers:i")
KPI_SQL = """
SELECT k.*, CAST(k.total_order_value AS DOUBLE) / NULLIF(k.total_delivered_orders, 0) AS avg_order_value,
       r.repeat_customer_base, r.repeat_customers,
       coalesce(r.repeat_customers::DOUBLE / NULLIF(r.repeat_customer_base, 0) * 100, 0) AS repeat_customer_rate_pct
FROM (SELECT coalesce(sum(product_sales_value) FILTER (WHERE order_status = 'delivered'), 0) AS total_product_sales,
             coalesce(sum(freight_value_total) FILTER (WHERE order_status = 'delivered'), 0) AS total_freight_value,
             coalesce(sum(order_value) FILTER (WHERE order_status = 'delivered'), 0) AS total_order_value,
             count(order_id) AS total_orders,
             count(order_id) FILTER (WHERE order_status = 'delivered') AS total_delivered_orders,
             count(DISTINCT customer_unique_id) AS total_customers,
             avg(review_score) FILTER (WHERE order_status = 'delivered') AS avg_review_score,
             avg(on_time) FILTER (WHERE order_status = 'delivered') * 100 AS on_time_delivery_pct,
             avg(is_late) FILTER (WHERE order_status = 'delivered') * 100 AS late_delivery_pct,
             avg(delivery_days) FILTER (WHERE order_status = 'delivered') AS avg_delivery_days,
             count(review_score) FILTER (WHERE order_status = 'delivered') AS review_record_count,
             count(is_late) FILTER (WHERE order_status = 'delivered') AS delivery_record_count
      FROM master) k,
     (SELECT count(*) AS repeat_customer_base, count(*) FILTER (WHERE n > 1) AS repeat_customers
      FROM (SELECT customer_unique_id, count(order_id) AS n FROM delivered GROUP BY customer_unique_id)) r
"""
register("topline_kpis", KPI_SPEC, KPI_SQL)(lambda c: mart(c, "kpis"))

register("repeat_rate", "repeat_customer_base:i, repeat_customers:i, repeat_customer_rate_pct:d",
         """SELECT count(*) AS repeat_customer_base, count(*) FILTER (WHERE n > 1) AS repeat_customers,
                   coalesce(count(*) FILTER (WHERE n > 1)::DOUBLE / NULLIF(count(*), 0) * 100, 0) AS repeat_customer_rate_pct
            FROM (SELECT customer_unique_id, count(order_id) AS n FROM delivered GROUP BY customer_unique_id)""")(
    lambda c: marts.repeat_rate(c.master))

MONTHLY_SPEC = ("ym:s, order_count:i, customer_count:i, delivered_count:i, product_sales_value:d, "
                "freight_value_total:d, order_value:d, avg_review_score:d, avg_delivery_days:d, "
                "on_time_count:i, late_count:i, on_time_pct:d")
MONTHLY_CTE = """
monthly AS (
  SELECT a.ym, a.order_count, a.customer_count, d.delivered_count, d.product_sales_value, d.freight_value_total,
         d.order_value, d.avg_review_score, d.avg_delivery_days, d.on_time_count, d.late_count,
         d.on_time_count::DOUBLE / NULLIF(d.on_time_count + d.late_count, 0) * 100 AS on_time_pct
  FROM (SELECT purchase_month_label AS ym, count(order_id) AS order_count,
               count(DISTINCT customer_unique_id) AS customer_count FROM master GROUP BY 1) a
  LEFT JOIN (SELECT purchase_month_label AS ym, count(order_id) AS delivered_count,
                    coalesce(sum(product_sales_value), 0) AS product_sales_value,
                    coalesce(sum(freight_value_total), 0) AS freight_value_total,
                    coalesce(sum(order_value), 0) AS order_value, avg(review_score) AS avg_review_score,
                    avg(delivery_days) AS avg_delivery_days, coalesce(sum(on_time), 0) AS on_time_count,
                    coalesce(sum(is_late), 0) AS late_count
             FROM delivered GROUP BY 1) d ON a.ym = d.ym
  WHERE a.order_count >= %d)
""" % MONTH_MIN_ORDERS
register("monthly_trends", MONTHLY_SPEC, "SELECT * FROM monthly", MONTHLY_CTE)(
    lambda c: mart(c, "monthly"))

register("peak_month", "peak_orders_month:s, peak_order_count:i, peak_sales_month:s, peak_sales_value:d",
         """SELECT arg_min(ym, (-order_count, ym)) AS peak_orders_month, max(order_count) AS peak_order_count,
                   arg_min(ym, (-product_sales_value, ym)) AS peak_sales_month,
                   max(product_sales_value) AS peak_sales_value FROM monthly""", MONTHLY_CTE)(
    lambda c: marts.peak_month(mart(c, "monthly")))

# ---------------------------------------------------------------- marts

CAT_SPEC = ("product_category_name_english:s, product_sales_value:d, freight_value_total:d, item_count:i, "
            "order_count:i, order_value:d, avg_item_price:d, avg_order_value:d, avg_review_score:d, "
            "avg_delivery_days:d, late_count:i, on_time_count:i, avg_delay_days:d, late_pct:d, rank_by_sales:i")
CAT_SQL = """
SELECT f.*, s.avg_review_score, s.avg_delivery_days, s.late_count, s.on_time_count, s.avg_delay_days,
       s.late_count::DOUBLE / NULLIF(s.late_count + s.on_time_count, 0) * 100 AS late_pct,
       row_number() OVER (ORDER BY f.product_sales_value DESC, f.product_category_name_english) AS rank_by_sales
FROM (SELECT product_category_name_english, sum(price) AS product_sales_value, sum(freight_value) AS freight_value_total,
             count(order_item_id) AS item_count, count(DISTINCT order_id) AS order_count,
             sum(price) + sum(freight_value) AS order_value,
             CAST(sum(price) AS DOUBLE) / count(order_item_id) AS avg_item_price,
             CAST(sum(price) + sum(freight_value) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value
      FROM full_t WHERE order_status = 'delivered' AND price IS NOT NULL AND product_category_name_english IS NOT NULL GROUP BY 1) f
LEFT JOIN (SELECT fc.product_category_name_english, avg(d.review_score) AS avg_review_score,
                  avg(d.delivery_days) AS avg_delivery_days, coalesce(sum(d.is_late), 0) AS late_count,
                  coalesce(sum(d.on_time), 0) AS on_time_count, avg(d.delivery_delay_days) AS avg_delay_days
           FROM first_cat fc LEFT JOIN delivered d ON fc.order_id = d.order_id WHERE fc.product_category_name_english IS NOT NULL GROUP BY 1) s
  ON f.product_category_name_english = s.product_category_name_english
"""
register("category_performance", CAT_SPEC, CAT_SQL)(
    lambda c: mart(c, "cat_perf"))

STATE_SPEC = ("customer_state:s, order_count:i, customer_count:i, product_sales_value:d, freight_value_total:d, "
              "order_value:d, avg_order_value:d, avg_review_score:d, avg_delivery_days:d, late_count:i, "
              "on_time_count:i, avg_delay_days:d, late_pct:d")
STATE_SQL = """
SELECT a.customer_state, a.order_count, a.customer_count, d.product_sales_value, d.freight_value_total, d.order_value,
       d.avg_order_value, d.avg_review_score, d.avg_delivery_days, d.late_count, d.on_time_count, d.avg_delay_days,
       d.late_count::DOUBLE / NULLIF(d.late_count + d.on_time_count, 0) * 100 AS late_pct
FROM (SELECT customer_state, count(order_id) AS order_count, count(DISTINCT customer_unique_id) AS customer_count
      FROM master WHERE customer_state IS NOT NULL GROUP BY 1) a
LEFT JOIN (SELECT customer_state, coalesce(sum(product_sales_value), 0) AS product_sales_value,
                  coalesce(sum(freight_value_total), 0) AS freight_value_total, coalesce(sum(order_value), 0) AS order_value,
                  CAST(sum(order_value) AS DOUBLE) / NULLIF(count(order_value), 0) AS avg_order_value,
                  avg(review_score) AS avg_review_score, avg(delivery_days) AS avg_delivery_days,
                  coalesce(sum(is_late), 0) AS late_count, coalesce(sum(on_time), 0) AS on_time_count,
                  avg(delivery_delay_days) AS avg_delay_days
           FROM delivered WHERE customer_state IS NOT NULL GROUP BY 1) d ON a.customer_state IS NOT DISTINCT FROM d.customer_state
"""
register("state_performance", STATE_SPEC, STATE_SQL)(lambda c: mart(c, "state_perf"))

SELLER_SPEC = ("seller_id:i, product_sales_value:d, freight_value_total:d, item_count:i, order_count:i, "
               "seller_state:s, seller_city:s, avg_review_score:d, avg_delivery_days:d, late_count:i, "
               "on_time_count:i, late_pct:d, rank_by_sales:i")
SELLER_SQL = """
SELECT f.*, s.avg_review_score, s.avg_delivery_days, s.late_count, s.on_time_count,
       s.late_count::DOUBLE / NULLIF(s.late_count + s.on_time_count, 0) * 100 AS late_pct,
       row_number() OVER (ORDER BY f.product_sales_value DESC, f.seller_id) AS rank_by_sales
FROM (SELECT seller_id, sum(price) AS product_sales_value, sum(freight_value) AS freight_value_total,
             count(order_item_id) AS item_count, count(DISTINCT order_id) AS order_count,
             min(seller_state) AS seller_state, min(seller_city) AS seller_city
      FROM full_t WHERE order_status = 'delivered' AND seller_id IS NOT NULL GROUP BY 1) f
LEFT JOIN (SELECT os.seller_id, avg(d.review_score) AS avg_review_score, avg(d.delivery_days) AS avg_delivery_days,
                  coalesce(sum(d.is_late), 0) AS late_count, coalesce(sum(d.on_time), 0) AS on_time_count
           FROM order_sellers os LEFT JOIN delivered d ON os.order_id = d.order_id GROUP BY 1) s
  ON f.seller_id = s.seller_id
"""
register("seller_performance", SELLER_SPEC, SELLER_SQL)(
    lambda c: mart(c, "seller_perf"))

DELAY_BUCKET_SQL = """CASE WHEN {x} <= -7 THEN 'Early >7d' WHEN {x} <= -3 THEN 'Early 3-7d' WHEN {x} <= 0 THEN 'Early 0-3d'
 WHEN {x} <= 3 THEN 'Late 1-3d' WHEN {x} <= 7 THEN 'Late 4-7d' WHEN {x} <= 14 THEN 'Late 8-14d'
 WHEN {x} IS NOT NULL THEN 'Late >14d' END"""
BUCKET_DIM_CTE = """
delay_dim AS (SELECT * FROM (VALUES ('Early >7d', 1), ('Early 3-7d', 2), ('Early 0-3d', 3), ('Late 1-3d', 4),
                                    ('Late 4-7d', 5), ('Late 8-14d', 6), ('Late >14d', 7)) t(delay_bucket, bucket_ord))
"""

register("delivery_delay_dist", "delay_bucket:s, bucket_ord:i, order_count:i, pct:d",
         f"""SELECT dd.delay_bucket, dd.bucket_ord, coalesce(c.n, 0) AS order_count,
                    coalesce(c.n, 0)::DOUBLE / (SELECT count(*) FROM delivered WHERE delivery_days IS NOT NULL) * 100 AS pct
             FROM delay_dim dd LEFT JOIN (
               SELECT {DELAY_BUCKET_SQL.format(x='delivery_delay_days')} AS b, count(*) AS n
               FROM delivered WHERE delivery_days IS NOT NULL GROUP BY 1) c ON dd.delay_bucket = c.b""",
         BUCKET_DIM_CTE)(lambda c: mart(c, "delay_dist"))

register("delivery_by_state",
         "customer_state:s, order_count:i, avg_delivery_days:d, avg_delay_days:d, late_pct:d, avg_review_score:d",
         """SELECT customer_state, count(order_id) AS order_count, avg(delivery_days) AS avg_delivery_days,
                   avg(delivery_delay_days) AS avg_delay_days, avg(is_late) * 100 AS late_pct,
                   avg(review_score) AS avg_review_score FROM delivered WHERE customer_state IS NOT NULL GROUP BY 1""")(
    lambda c: marts.delivery_by_state(c.master))

register("delivery_by_category",
         "product_category_name_english:s, order_count:i, avg_delivery_days:d, avg_delay_days:d, late_pct:d, avg_review_score:d",
         """SELECT fc.product_category_name_english, count(fc.order_id) AS order_count, avg(d.delivery_days) AS avg_delivery_days,
                   avg(d.delivery_delay_days) AS avg_delay_days, avg(d.is_late) * 100 AS late_pct,
                   avg(d.review_score) AS avg_review_score
            FROM first_cat fc LEFT JOIN delivered d ON fc.order_id = d.order_id
            WHERE fc.product_category_name_english IS NOT NULL GROUP BY 1""")(
    lambda c: mart(c, "del_by_cat3"))

register("review_score_dist", "review_score:i, order_count:i, pct:d",
         """SELECT review_score, count(*) AS order_count,
                   count(*)::DOUBLE / (SELECT count(*) FROM delivered WHERE review_score IS NOT NULL) * 100 AS pct
            FROM delivered WHERE review_score IS NOT NULL GROUP BY 1""")(lambda c: marts.review_score_dist(c.master))

register("satisfaction_over_time", "ym:s, avg_review_score:d, review_count:i",
         f"""SELECT purchase_month_label AS ym, avg(review_score) AS avg_review_score, count(review_score) AS review_count
             FROM delivered WHERE review_score IS NOT NULL GROUP BY 1 HAVING count(review_score) >= {MONTH_MIN_REVIEWS}""")(
    lambda c: marts.satisfaction_over_time(c.master, MONTH_MIN_REVIEWS))

register("review_vs_delay", "delay_bucket:s, bucket_ord:i, avg_review_score:d, order_count:i",
         f"""SELECT dd.delay_bucket, dd.bucket_ord, c.avg_review_score, coalesce(c.n, 0) AS order_count
             FROM delay_dim dd LEFT JOIN (
               SELECT {DELAY_BUCKET_SQL.format(x='delivery_delay_days')} AS b, avg(review_score) AS avg_review_score,
                      count(order_id) AS n
               FROM delivered WHERE review_score IS NOT NULL AND delivery_delay_days IS NOT NULL GROUP BY 1) c
             ON dd.delay_bucket = c.b""", BUCKET_DIM_CTE)(lambda c: marts.review_vs_delay(c.spark, c.master))
