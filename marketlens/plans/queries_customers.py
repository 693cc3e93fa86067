"""Registered queries: RFM and the customer marts."""

from __future__ import annotations

import math

from ..functions import SPEND_LABELS
from ..operators import customers as cu
from ..operators import rfm as rf
from .registry import register

from .params import FIXTURE_SPEND_EDGES
from .shared import mart

RFM_CTE = """
rfm_base AS (
  SELECT customer_unique_id, max(order_purchase_timestamp) AS last_purchase_date, count(order_id) AS frequency,
         coalesce(sum(order_value), 0) AS monetary FROM delivered GROUP BY 1),
rfm_r AS (
  SELECT b.*, CAST(floor((epoch_us(r.ref) - epoch_us(b.last_purchase_date)) / 86400000000.0) AS BIGINT) AS recency_days
  FROM rfm_base b, (SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY AS ref FROM delivered) r),
rfm_edges AS (
  SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS re,
         quantile_cont(CAST(monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS me, count(*) AS n FROM rfm_r),
rfm_scored AS (
  SELECT r.*,
         CAST(6 - (1 + (e.re[1] < recency_days)::INT + (e.re[2] < recency_days)::INT + (e.re[3] < recency_days)::INT
                     + (e.re[4] < recency_days)::INT) AS INT) AS R_score,
         CAST(CASE WHEN e.n <= 1 THEN 1 ELSE greatest(1, ceil(5.0 * (row_number() OVER (ORDER BY frequency, customer_unique_id) - 1) / (e.n - 1))) END AS INT) AS F_score,
         CAST(1 + (e.me[1] < monetary)::INT + (e.me[2] < monetary)::INT + (e.me[3] < monetary)::INT
                + (e.me[4] < monetary)::INT AS INT) AS M_score
  FROM rfm_r r, rfm_edges e),
rfm AS (
  SELECT customer_unique_id, last_purchase_date, frequency, monetary, recency_days, R_score, F_score, M_score,
         R_score * 100 + F_score * 10 + M_score AS RFM_score,
         CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
              WHEN R_score >= 3 AND F_score >= 3 AND M_score >= 3 THEN 'Loyal Customers'
              WHEN R_score >= 4 AND F_score <= 2 THEN 'New Customers'
              WHEN R_score >= 3 AND F_score >= 2 AND M_score <= 2 THEN 'Potential Loyalists'
              WHEN R_score <= 2 AND F_score >= 3 AND M_score >= 3 THEN 'At Risk'
              WHEN R_score <= 2 AND F_score >= 4 AND M_score >= 4 THEN 'Cannot Lose Them'
              WHEN R_score <= 2 AND F_score <= 2 AND M_score <= 2 THEN 'Lost / Inactive'
              ELSE 'Needs Attention' END AS segment
  FROM rfm_scored),
typed AS (SELECT *, CASE WHEN frequency >= 2 THEN 'Repeat' ELSE 'One-Time' END AS customer_type FROM rfm),
home AS (
  SELECT customer_unique_id, customer_state, customer_city FROM (
    SELECT customer_unique_id, customer_state, customer_city,
           row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS rn
    FROM delivered) WHERE rn = 1)
"""

RFM_SPEC = ("customer_unique_id:i, last_purchase_date:t, frequency:i, monetary:d, recency_days:i, R_score:i, "
            "F_score:i, M_score:i, RFM_score:i, segment:s")
register("customer_rfm", RFM_SPEC, "SELECT * FROM rfm", RFM_CTE)(lambda c: c.rfm)

register("rfm_distribution", "segment:s, customer_count:i, repeat_customers:i, customer_pct:d",
         """SELECT segment, count(*) AS customer_count, count(*) FILTER (WHERE frequency > 1) AS repeat_customers,
                   count(*)::DOUBLE / (SELECT count(*) FROM rfm) * 100 AS customer_pct FROM rfm GROUP BY 1""",
         RFM_CTE)(lambda c: rf.rfm_distribution(c.rfm))


def _shares_sql(inner: str, cnt: str, rev: str) -> str:
    return f"""SELECT s.*, s.{cnt}::DOUBLE / NULLIF(sum(s.{cnt}) OVER (), 0) * 100 AS customer_pct,
                      CAST(s.{rev} AS DOUBLE) / NULLIF(CAST(sum(s.{rev}) OVER () AS DOUBLE), 0) * 100 AS revenue_pct
               FROM ({inner}) s"""


register("rfm_segment_summary",
         "segment:s, customer_count:i, total_revenue:d, avg_spend:d, avg_recency_days:d, avg_frequency:d, "
         "avg_r_score:d, avg_f_score:d, avg_m_score:d, median_spend:d, customer_pct:d, revenue_pct:d",
         _shares_sql("""SELECT segment, count(customer_unique_id) AS customer_count, sum(monetary) AS total_revenue,
                               CAST(sum(monetary) AS DOUBLE) / count(monetary) AS avg_spend,
                               avg(recency_days) AS avg_recency_days, avg(frequency) AS avg_frequency,
                               avg(R_score) AS avg_r_score, avg(F_score) AS avg_f_score, avg(M_score) AS avg_m_score,
                               quantile_cont(CAST(monetary AS DOUBLE), 0.5) AS median_spend
                        FROM rfm GROUP BY 1""", "customer_count", "total_revenue"),
         RFM_CTE)(lambda c: mart(c, "rfm_seg"))

register("repeat_vs_onetime",
         "customer_type:s, customer_count:i, total_revenue:d, avg_spend:d, avg_order_count:d, max_order_count:i, "
         "median_spend:d, avg_order_value:d, customer_pct:d, revenue_pct:d",
         _shares_sql("""SELECT t.customer_type, count(t.customer_unique_id) AS customer_count, sum(t.monetary) AS total_revenue,
                               CAST(sum(t.monetary) AS DOUBLE) / count(t.monetary) AS avg_spend,
                               avg(t.frequency) AS avg_order_count, max(t.frequency) AS max_order_count,
                               quantile_cont(CAST(t.monetary AS DOUBLE), 0.5) AS median_spend,
                               any_value(a.aov) AS avg_order_value
                        FROM typed t LEFT JOIN (
                          SELECT ty.customer_type, CAST(sum(d.order_value) AS DOUBLE) / NULLIF(count(d.order_value), 0) AS aov
                          FROM delivered d JOIN typed ty ON d.customer_unique_id = ty.customer_unique_id GROUP BY 1) a
                        ON t.customer_type = a.customer_type GROUP BY 1""", "customer_count", "total_revenue"),
         RFM_CTE)(lambda c: mart(c, "repeat"))

register("repeat_frequency_dist", "order_count:i, customer_count:i",
         """SELECT frequency AS order_count, count(*) AS customer_count FROM rfm WHERE frequency >= 2
            GROUP BY 1 ORDER BY 1 LIMIT 10""", RFM_CTE)(lambda c: cu.repeat_frequency_dist(c.rfm))

register("customer_geography",
         "customer_state:s, order_count:i, customer_uid_count:i, total_revenue:d, avg_order_value:d, "
         "avg_review_score:d, customer_pct:d, revenue_pct:d, repeat_customer_count:i, repeat_rate_pct:d",
         """SELECT g.*, coalesce(r.n, 0) AS repeat_customer_count,
                   coalesce(r.n, 0)::DOUBLE / NULLIF(g.customer_uid_count, 0) * 100 AS repeat_rate_pct
            FROM (SELECT s.*, s.customer_uid_count::DOUBLE / sum(s.customer_uid_count) OVER () * 100 AS customer_pct,
                         CAST(s.total_revenue AS DOUBLE) / CAST(sum(s.total_revenue) OVER () AS DOUBLE) * 100 AS revenue_pct
                  FROM (SELECT customer_state, count(order_id) AS order_count,
                               count(DISTINCT customer_unique_id) AS customer_uid_count,
                               coalesce(sum(order_value), 0) AS total_revenue,
                               CAST(sum(order_value) AS DOUBLE) / NULLIF(count(order_value), 0) AS avg_order_value,
                               avg(review_score) AS avg_review_score
                        FROM delivered WHERE customer_state IS NOT NULL GROUP BY 1) s) g
            LEFT JOIN (SELECT h.customer_state, count(*) AS n FROM rfm JOIN home h USING (customer_unique_id)
                       WHERE rfm.frequency >= 2 AND h.customer_state IS NOT NULL GROUP BY 1) r ON g.customer_state IS NOT DISTINCT FROM r.customer_state""",
         RFM_CTE)(lambda c: mart(c, "cust_geo"))

register("state_overcount", "state_sum:i, distinct_customers:i, overcount:i",
         """SELECT s.state_sum, d.distinct_customers, s.state_sum - d.distinct_customers AS overcount
            FROM (SELECT count(*) AS state_sum FROM (SELECT DISTINCT customer_state, customer_unique_id FROM delivered)) s,
                 (SELECT count(DISTINCT customer_unique_id) AS distinct_customers FROM delivered) d""")(
    lambda c: cu.state_overcount(c.master))

register("spend_statistics", "n:i, min:d, median:d, mean:d, p75:d, p90:d, p95:d, p99:d, max:d",
         """SELECT count(*) AS n, min(monetary) AS min, quantile_cont(CAST(monetary AS DOUBLE), 0.5) AS median,
                   CAST(sum(monetary) AS DOUBLE) / count(monetary) AS mean,
                   quantile_cont(CAST(monetary AS DOUBLE), 0.75) AS p75, quantile_cont(CAST(monetary AS DOUBLE), 0.9) AS p90,
                   quantile_cont(CAST(monetary AS DOUBLE), 0.95) AS p95, quantile_cont(CAST(monetary AS DOUBLE), 0.99) AS p99,
                   max(monetary) AS max FROM rfm""", RFM_CTE)(lambda c: mart(c, "spend_stats"))


def _spend_case() -> str:
    e, parts = FIXTURE_SPEND_EDGES, []
    for i, lab in enumerate(SPEND_LABELS):
        top = "" if math.isinf(e[i + 1]) else f" AND monetary <= {e[i + 1]}"
        parts.append(f"WHEN monetary > {e[i]}{top} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


SPEND_DIM = "spend_dim AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{lab}', {i + 1})" for i, lab in enumerate(SPEND_LABELS)) + ") t(spend_bucket, bucket_ord))"

register("customer_spending_dist",
         "spend_bucket:s, bucket_ord:i, customer_count:i, total_revenue:d, avg_spend:d, customer_pct:d, revenue_pct:d",
         f"""SELECT d.spend_bucket, d.bucket_ord, coalesce(c.customer_count, 0) AS customer_count,
                    coalesce(c.total_revenue, 0) AS total_revenue, c.avg_spend,
                    coalesce(c.customer_count, 0)::DOUBLE / t.tc * 100 AS customer_pct,
                    CAST(coalesce(c.total_revenue, 0) AS DOUBLE) / CAST(t.tr AS DOUBLE) * 100 AS revenue_pct
             FROM spend_dim d LEFT JOIN (
               SELECT {_spend_case()} AS b, count(customer_unique_id) AS customer_count, sum(monetary) AS total_revenue,
                      CAST(sum(monetary) AS DOUBLE) / count(monetary) AS avg_spend FROM rfm GROUP BY 1) c
             ON d.spend_bucket = c.b, (SELECT count(*) AS tc, sum(monetary) AS tr FROM rfm) t""",
         RFM_CTE + "," + SPEND_DIM)(lambda c: mart(c, "spend_dist"))

register("high_value_customers", "threshold:d, customer_count:i, total_revenue:d, revenue_pct:d",
         """SELECT t.threshold, count(*) FILTER (WHERE r.monetary >= t.threshold) AS customer_count,
                   coalesce(sum(r.monetary) FILTER (WHERE r.monetary >= t.threshold), 0) AS total_revenue,
                   CAST(coalesce(sum(r.monetary) FILTER (WHERE r.monetary >= t.threshold), 0) AS DOUBLE)
                     / CAST(sum(r.monetary) AS DOUBLE) * 100 AS revenue_pct
            FROM rfm r, (SELECT quantile_cont(CAST(monetary AS DOUBLE), 0.9) AS threshold FROM rfm) t
            GROUP BY t.threshold""", RFM_CTE)(lambda c: cu.high_value_customers(c.rfm))

register("segment_spend_profile", "segment:s, avg_spend:d, total_rev:d, median_spend:d, p90_spend:d",
         """SELECT segment, CAST(sum(monetary) AS DOUBLE) / count(monetary) AS avg_spend, sum(monetary) AS total_rev,
                   quantile_cont(CAST(monetary AS DOUBLE), 0.5) AS median_spend,
                   quantile_cont(CAST(monetary AS DOUBLE), 0.9) AS p90_spend FROM rfm GROUP BY 1""",
         RFM_CTE)(lambda c: mart(c, "seg_spend"))

register("customer_segment_detail",
         RFM_SPEC + ", customer_type:s, customer_state:s, customer_city:s",
         "SELECT t.*, h.customer_state, h.customer_city FROM typed t LEFT JOIN home h USING (customer_unique_id)",
         RFM_CTE)(lambda c: cu.customer_segment_detail(c.rfm, c.master))

register("top_decile_share", "n:i, k:i, threshold:d, top_sum:d, total_monetary:d, top_share_pct:d",
         """SELECT n, k, threshold, top_sum, total_monetary, top_sum / total_monetary * 100 AS top_share_pct FROM (
              SELECT count(*) AS n, CAST(floor(count(*) * 0.1) AS BIGINT) AS k,
                     min(monetary) FILTER (WHERE rk <= floor(n_all * 0.1)) AS threshold,
                     CAST(sum(monetary) FILTER (WHERE rk <= floor(n_all * 0.1)) AS DOUBLE) AS top_sum,
                     CAST(sum(monetary) AS DOUBLE) AS total_monetary
              FROM (SELECT monetary, row_number() OVER (ORDER BY monetary DESC) AS rk, count(*) OVER () AS n_all FROM rfm))""",
         RFM_CTE)(lambda c: mart(c, "top_decile"))
