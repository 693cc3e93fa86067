"""Registered queries: delivery and satisfaction deep-dive."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import delivery as dl
from .queries_core import BUCKET_DIM_CTE, DELAY_BUCKET_SQL
from .registry import REGISTRY, register

from .params import DELIVERY_MIN_ORDERS, FIXTURE_MIN_SELLER_ORDERS
from .shared import mart

NAT_CTE = """
nat AS (SELECT avg(is_late) * 100 AS nat_late_pct, avg(delivery_days) AS nat_avg_days,
               avg(review_score) AS nat_review FROM del_valid),
seller_all AS (
  SELECT os.seller_id, count(os.order_id) AS order_count, min(os.seller_state) AS seller_state,
         min(os.seller_city) AS seller_city, avg(d.delivery_days) AS avg_delivery_days,
         quantile_cont(d.delivery_days, 0.5) AS median_delivery_days, avg(d.delivery_delay_days) AS avg_delay_days,
         coalesce(sum(d.is_late), 0) AS late_count, coalesce(sum(d.on_time), 0) AS on_time_count,
         avg(d.review_score) AS avg_review_score,
         coalesce(sum(d.is_late), 0)::DOUBLE / NULLIF(coalesce(sum(d.is_late), 0) + coalesce(sum(d.on_time), 0), 0) * 100 AS late_pct
  FROM order_sellers os LEFT JOIN del_valid d ON os.order_id = d.order_id GROUP BY 1)
"""

register("delivery_overview",
         "n_orders:i, on_time_count:i, late_count:i, avg_delivery_days:d, median_delivery_days:d, avg_delay_days:d, "
         "median_delay_days:d, on_time_pct:d, late_pct:d",
         """SELECT count(*) AS n_orders, coalesce(sum(on_time), 0) AS on_time_count, coalesce(sum(is_late), 0) AS late_count,
                   avg(delivery_days) AS avg_delivery_days, quantile_cont(delivery_days, 0.5) AS median_delivery_days,
                   avg(delivery_delay_days) AS avg_delay_days, quantile_cont(delivery_delay_days, 0.5) AS median_delay_days,
                   coalesce(sum(on_time), 0)::DOUBLE / NULLIF(count(*), 0) * 100 AS on_time_pct,
                   coalesce(sum(is_late), 0)::DOUBLE / NULLIF(count(*), 0) * 100 AS late_pct FROM del_valid""")(
    lambda c: mart(c, "del_ov"))

register("delay_bucket_counts", "delay_bucket:s, bucket_ord:i, order_count:i",
         f"""SELECT dd.delay_bucket, dd.bucket_ord, coalesce(c.n, 0) AS order_count FROM delay_dim dd LEFT JOIN (
               SELECT {DELAY_BUCKET_SQL.format(x='delivery_delay_days')} AS b, count(*) AS n FROM del_valid GROUP BY 1) c
             ON dd.delay_bucket = c.b""", BUCKET_DIM_CTE)(lambda c: mart(c, "buckets"))

register("delivery_over_time",
         "ym:s, order_count:i, on_time_count:i, late_count:i, avg_delivery_days:d, median_delivery_days:d, "
         "avg_delay_days:d, avg_review_score:d, on_time_pct:d, late_pct:d",
         f"""SELECT purchase_month_label AS ym, count(order_id) AS order_count, coalesce(sum(on_time), 0) AS on_time_count,
                    coalesce(sum(is_late), 0) AS late_count, avg(delivery_days) AS avg_delivery_days,
                    quantile_cont(delivery_days, 0.5) AS median_delivery_days, avg(delivery_delay_days) AS avg_delay_days,
                    avg(review_score) AS avg_review_score,
                    coalesce(sum(on_time), 0)::DOUBLE / NULLIF(coalesce(sum(on_time), 0) + coalesce(sum(is_late), 0), 0) * 100 AS on_time_pct,
                    coalesce(sum(is_late), 0)::DOUBLE / NULLIF(coalesce(sum(on_time), 0) + coalesce(sum(is_late), 0), 0) * 100 AS late_pct
             FROM del_valid GROUP BY 1 HAVING count(order_id) >= {DELIVERY_MIN_ORDERS}""")(
    lambda c: mart(c, "del_time"))

STATE_ENRICHED_SPEC = ("customer_state:s, order_count:i, on_time_count:i, late_count:i, avg_delivery_days:d, "
                       "median_delivery_days:d, avg_delay_days:d, avg_review_score:d, p25_delivery_days:d, "
                       "p75_delivery_days:d, on_time_pct:d, late_pct:d, low_volume:b, nat_late_pct:d, "
                       "late_vs_national:d, delivery_vs_national:d, review_vs_national:d")
STATE_ENRICHED_CTE = NAT_CTE + """,
state_enriched AS (
  SELECT s.*, s.late_pct - n.nat_late_pct AS late_vs_national, s.avg_delivery_days - n.nat_avg_days AS delivery_vs_national,
         s.avg_review_score - n.nat_review AS review_vs_national, n.nat_late_pct
  FROM (SELECT customer_state, count(order_id) AS order_count, coalesce(sum(on_time), 0) AS on_time_count,
               coalesce(sum(is_late), 0) AS late_count, avg(delivery_days) AS avg_delivery_days,
               quantile_cont(delivery_days, 0.5) AS median_delivery_days, avg(delivery_delay_days) AS avg_delay_days,
               avg(review_score) AS avg_review_score, quantile_cont(delivery_days, 0.25) AS p25_delivery_days,
               quantile_cont(delivery_days, 0.75) AS p75_delivery_days,
               coalesce(sum(on_time), 0)::DOUBLE / NULLIF(coalesce(sum(on_time), 0) + coalesce(sum(is_late), 0), 0) * 100 AS on_time_pct,
               coalesce(sum(is_late), 0)::DOUBLE / NULLIF(coalesce(sum(on_time), 0) + coalesce(sum(is_late), 0), 0) * 100 AS late_pct,
               count(order_id) < 200 AS low_volume
        FROM del_valid WHERE customer_state IS NOT NULL GROUP BY 1) s, nat n)
"""
register("delivery_by_state_enriched", STATE_ENRICHED_SPEC, "SELECT * FROM state_enriched", STATE_ENRICHED_CTE)(
    lambda c: mart(c, "del_state"))

register("high_impact_states", STATE_ENRICHED_SPEC,
         "SELECT * FROM state_enriched WHERE late_pct > nat_late_pct AND NOT low_volume", STATE_ENRICHED_CTE)(
    lambda c: dl.high_impact_states_of(mart(c, "del_state")))

CAT_ENRICHED_CTE = NAT_CTE + """,
cat_enriched AS (
  SELECT g.*, g.late_pct - n.nat_late_pct AS late_vs_national, n.nat_late_pct, g.order_count < 100 AS low_volume
  FROM (SELECT fc.product_category_name_english, count(fc.order_id) AS order_count, avg(d.delivery_days) AS avg_delivery_days,
               quantile_cont(d.delivery_days, 0.5) AS median_delivery_days, avg(d.delivery_delay_days) AS avg_delay_days,
               coalesce(sum(d.is_late), 0) AS late_count, coalesce(sum(d.on_time), 0) AS on_time_count,
               avg(d.review_score) AS avg_review_score,
               coalesce(sum(d.is_late), 0)::DOUBLE / NULLIF(coalesce(sum(d.is_late), 0) + coalesce(sum(d.on_time), 0), 0) * 100 AS late_pct
        FROM first_cat fc LEFT JOIN del_valid d ON fc.order_id = d.order_id
        WHERE fc.product_category_name_english IS NOT NULL GROUP BY 1) g, nat n)
"""
CAT_ENRICHED_SPEC = ("product_category_name_english:s, order_count:i, avg_delivery_days:d, median_delivery_days:d, "
                     "avg_delay_days:d, late_count:i, on_time_count:i, avg_review_score:d, late_pct:d, nat_late_pct:d, "
                     "late_vs_national:d, low_volume:b")
register("delivery_by_category_enriched", CAT_ENRICHED_SPEC, "SELECT * FROM cat_enriched", CAT_ENRICHED_CTE)(
    lambda c: mart(c, "del_cat"))

SELLER_DEL_SPEC = ("seller_id:i, order_count:i, seller_state:s, seller_city:s, avg_delivery_days:d, "
                   "median_delivery_days:d, avg_delay_days:d, late_count:i, on_time_count:i, avg_review_score:d, late_pct:d")
register("seller_delivery_all", SELLER_DEL_SPEC, "SELECT * FROM seller_all", NAT_CTE)(
    lambda c: dl.seller_delivery_all(c.order_sellers, c.master))

register("seller_delivery_qualified", SELLER_DEL_SPEC,
         f"SELECT * FROM seller_all WHERE order_count >= {FIXTURE_MIN_SELLER_ORDERS}", NAT_CTE)(
    lambda c: mart(c, "seller_del"))

register("seller_best_worst",
         "list:s, seller_id:i, order_count:i, late_pct:d, avg_delivery_days:d, avg_review_score:d, seller_state:s",
         """SELECT * FROM (SELECT 'top_volume' AS list, * FROM q ORDER BY order_count DESC, seller_id LIMIT 10)
             UNION ALL SELECT * FROM (SELECT 'worst_late' AS list, * FROM q ORDER BY late_pct DESC NULLS LAST, seller_id LIMIT 10)
             UNION ALL SELECT * FROM (SELECT 'best_late' AS list, * FROM q ORDER BY late_pct ASC NULLS LAST, seller_id LIMIT 10)""",
         NAT_CTE + f", q AS (SELECT * FROM seller_all WHERE order_count >= {FIXTURE_MIN_SELLER_ORDERS})")(
    lambda c: dl.seller_best_worst(mart(c, "seller_del")))

register("seller_delivery_by_state", "seller_state:s, seller_count:i, total_orders:i, avg_late_pct:d, avg_review_score:d",
         """SELECT seller_state, count(seller_id) AS seller_count, sum(order_count) AS total_orders,
                   avg(late_pct) AS avg_late_pct, avg(avg_review_score) AS avg_review_score FROM seller_all
            WHERE seller_state IS NOT NULL GROUP BY 1""",
         NAT_CTE)(lambda c: dl.seller_delivery_by_state(c.order_sellers, c.master))

STARS = ", ".join(f"avg((review_score = {k})::INT) * 100 AS pct_{k}star" for k in range(1, 6))
register("review_by_delay_detailed",
         "delay_bucket:s, bucket_ord:i, order_count:i, avg_review_score:d, pct_1star:d, pct_2star:d, pct_3star:d, "
         "pct_4star:d, pct_5star:d",
         f"""SELECT dd.delay_bucket, dd.bucket_ord, c.order_count, c.avg_review_score, c.pct_1star, c.pct_2star, c.pct_3star,
                    c.pct_4star, c.pct_5star
             FROM delay_dim dd JOIN (
               SELECT {DELAY_BUCKET_SQL.format(x='delivery_delay_days')} AS b, count(order_id) AS order_count,
                      avg(review_score) AS avg_review_score, {STARS}
               FROM del_valid WHERE review_score IS NOT NULL AND delivery_delay_days IS NOT NULL GROUP BY 1) c
             ON dd.delay_bucket = c.b""", BUCKET_DIM_CTE)(lambda c: mart(c, "rev_delay"))

register("review_by_state",
         "customer_state:s, review_count:i, avg_review_score:d, pct_1star:d, pct_5star:d, late_pct:d, review_vs_national:d",
         """SELECT s.*, s.avg_review_score - n.nr AS review_vs_national FROM (
              SELECT customer_state, count(review_score) AS review_count, avg(review_score) AS avg_review_score,
                     avg((review_score = 1)::INT) * 100 AS pct_1star, avg((review_score = 5)::INT) * 100 AS pct_5star,
                     avg(is_late) * 100 AS late_pct
              FROM del_valid WHERE review_score IS NOT NULL AND customer_state IS NOT NULL GROUP BY 1) s,
            (SELECT avg(review_score) AS nr FROM del_valid) n""")(lambda c: mart(c, "rev_state"))

register("review_by_category",
         "product_category_name_english:s, review_count:i, avg_review_score:d, pct_1star:d, pct_5star:d, late_pct:d, "
         "avg_delay_days:d, review_vs_national:d, low_volume:b",
         """SELECT s.*, s.avg_review_score - n.nr AS review_vs_national, s.review_count < 100 AS low_volume FROM (
              SELECT fc.product_category_name_english, count(d.review_score) AS review_count,
                     avg(d.review_score) AS avg_review_score, avg((d.review_score = 1)::INT) * 100 AS pct_1star,
                     avg((d.review_score = 5)::INT) * 100 AS pct_5star, avg(d.is_late) * 100 AS late_pct,
                     avg(d.delivery_delay_days) AS avg_delay_days
              FROM first_cat fc JOIN del_valid d ON fc.order_id = d.order_id
              WHERE d.review_score IS NOT NULL AND fc.product_category_name_english IS NOT NULL GROUP BY 1) s,
            (SELECT avg(review_score) AS nr FROM del_valid) n""")(lambda c: mart(c, "rev_cat"))

# the overview document as served (scalar fields + a bucket -> count map): a
# map column, so it is checked rows-only; its scalar part has the SQL oracle above
def _overview_document(c):
    """The document with its bucket counts as ordered text."""
    pairs = F.transform(F.map_entries("delay_bucket_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return dl.delivery_overview_with_buckets(c.spark, c.master).withColumn("delay_bucket_counts", F.array_join(pairs, "; "))


register("delivery_overview_document", REGISTRY["delivery_overview"].spec + ", delay_bucket_counts:s",
         f"""SELECT o.*, (SELECT string_agg(delay_bucket || '=' || order_count, '; ' ORDER BY bucket_ord)
                          FROM ({REGISTRY["delay_bucket_counts"].sql})) AS delay_bucket_counts
             FROM ({REGISTRY["delivery_overview"].sql}) o""", REGISTRY["delay_bucket_counts"].extra_ctes)(_overview_document)
