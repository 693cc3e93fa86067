"""Registered queries: serving requests with fixed example parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import serve as sv
from .params import FIXTURE_PARAMS
from . import queries_delivery  # noqa: F401  the marts that are served
from .queries_insights import evidence_ctes
from .queries_ml import ML_CTE
from .shared import evidence, mart
from .registry import REGISTRY, register
from ..operators import insights as ins
from ..operators import ml

MONTHS = ("1996-01", "1997-06")
CATEGORIES = ["promo_goods", "standard_goods", "construction_large"]
STATES = ["NATION_0", "NATION_3", "NATION_7"]
SEGMENTS = ["Champions", "At Risk", "Lost / Inactive"]
EV = evidence_ctes()


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


register("serve_filters", "kind:s, value:s",
         """SELECT DISTINCT * FROM (
              SELECT 'category' AS kind, product_category_name_english AS value FROM ev_cat
              UNION ALL SELECT 'state', customer_state FROM (SELECT DISTINCT customer_state FROM master)
              UNION ALL SELECT 'segment', segment FROM ev_seg
              UNION ALL SELECT 'month_min', min(ym) FROM monthly
              UNION ALL SELECT 'month_max', max(ym) FROM monthly) WHERE value IS NOT NULL""", EV)(
    lambda c: sv.serve_filters(evidence(c)["cat_perf"], mart(c, "state_perf"), evidence(c)["rfm_seg"],
                               evidence(c)["monthly"]))

register("serve_kpis", REGISTRY["topline_kpis"].spec + ", _scope:s, _note:s",
         f"SELECT *, '{sv.KPI_SCOPE}' AS _scope, '{sv.KPI_NOTE}' AS _note FROM ev_kpis", EV)(
    lambda c: sv.serve_kpis(evidence(c)["kpis"]))

register("serve_monthly_trends", REGISTRY["monthly_trends"].spec,
         f"SELECT * FROM monthly WHERE ym >= '{MONTHS[0]}' AND ym <= '{MONTHS[1]}'", EV)(
    lambda c: sv.in_range(evidence(c)["monthly"], "ym", *MONTHS))

# One query per frame of a response: (query, operator, frame, the mart query that
# it serves, what the request keeps of it).
def _frames(build, frames) -> None:
    for query, frame, served, keep in frames:
        q = REGISTRY[served]
        register(query, q.spec, f"SELECT * FROM ({q.sql}) {keep}", q.extra_ctes)(lambda c, f=frame: build(c)[f])


BY_CATEGORY = f"WHERE product_category_name_english IN ({_in(CATEGORIES)})"
BY_STATE = f"WHERE customer_state IN ({_in(STATES)})"
BY_SEGMENT = f"WHERE segment IN ({_in(SEGMENTS)})"
BY_MONTH = f"WHERE ym >= '{MONTHS[0]}' AND ym <= '{MONTHS[1]}'"

_frames(lambda c: sv.categories_response(*[mart(c, k) for k in ("cat_perf", "del_cat", "rev_cat")], CATEGORIES, top=2), [
    ("serve_categories", "performance", "category_performance", f"{BY_CATEGORY} ORDER BY rank_by_sales LIMIT 2"),
    ("serve_categories_delivery", "delivery", "delivery_by_category_enriched", BY_CATEGORY),
    ("serve_categories_reviews", "reviews", "review_by_category", BY_CATEGORY)])
_frames(lambda c: sv.states_response(*[mart(c, k) for k in ("state_perf", "del_state", "rev_state", "cust_geo")], STATES), [
    ("serve_states_performance", "performance", "state_performance", BY_STATE),
    ("serve_states_delivery", "delivery", "delivery_by_state_enriched", BY_STATE),
    ("serve_states_reviews", "reviews", "review_by_state", BY_STATE),
    ("serve_states", "geography", "customer_geography", BY_STATE)])
_frames(lambda c: sv.customers_response(*[mart(c, k) for k in ("rfm_seg", "repeat", "cust_geo", "spend_dist", "seg_spend")], SEGMENTS), [
    ("serve_customers", "rfm_segments", "rfm_segment_summary", BY_SEGMENT),
    ("serve_customers_repeat", "repeat_onetime", "repeat_vs_onetime", ""),
    ("serve_customers_geography", "geography", "customer_geography", ""),
    ("serve_customers_spending", "spending_dist", "customer_spending_dist", ""),
    ("serve_customers_segment_spend", "segment_spend", "segment_spend_profile", BY_SEGMENT)])
_frames(lambda c: sv.delivery_response(*[mart(c, k) for k in ("del_ov", "del_time", "del_state", "del_cat", "delay_dist", "rev_delay")],
                                       STATES, CATEGORIES, *MONTHS), [
    ("serve_delivery_overview", "overview", "delivery_overview", ""),
    ("serve_delivery_time", "over_time", "delivery_over_time", BY_MONTH),
    ("serve_delivery_states", "by_state", "delivery_by_state_enriched", BY_STATE),
    ("serve_delivery_categories", "by_category", "delivery_by_category_enriched", BY_CATEGORY),
    ("serve_delivery_delays", "delay_dist", "delivery_delay_dist", ""),
    ("serve_delivery_reviews", "review_delay", "review_by_delay_detailed", "")])
_frames(lambda c: {k: mart(c, k) for k in ("review_scores", "sat_time", "rev_delay", "rev_state", "rev_cat")}, [
    ("serve_reviews_scores", "review_scores", "review_score_dist", ""),
    ("serve_reviews_over_time", "sat_time", "satisfaction_over_time", ""),
    ("serve_reviews_by_delay", "rev_delay", "review_by_delay_detailed", ""),
    ("serve_reviews_by_state", "rev_state", "review_by_state", ""),
    ("serve_reviews_by_category", "rev_cat", "review_by_category", "")])

SELLER_SERVE_SPEC = ("seller_id:i, product_sales_value:d, freight_value_total:d, item_count:i, order_count:i, "
                     "seller_state:s, seller_city:s, rank_by_sales:i, avg_delivery_days:d, median_delivery_days:d, "
                     "avg_delay_days:d, late_count:i, on_time_count:i, avg_review_score:d, late_pct:d")
_SELLER_JOIN = """SELECT p.seller_id, p.product_sales_value, p.freight_value_total, p.item_count, p.order_count, p.seller_state,
                         p.seller_city, p.rank_by_sales, d.avg_delivery_days, d.median_delivery_days, d.avg_delay_days,
                         d.late_count, d.on_time_count, d.avg_review_score, d.late_pct
                  FROM ev_seller p LEFT JOIN ev_sellerq d ON p.seller_id = d.seller_id"""
register("serve_sellers", SELLER_SERVE_SPEC,
         f"SELECT * FROM ({_SELLER_JOIN}) ORDER BY late_pct DESC NULLS LAST, seller_id LIMIT 20", EV)(
    lambda c: sv.serve_sellers(evidence(c)["seller_perf"], evidence(c)["seller_del"], "late_pct", False, 20))
register("serve_sellers_default_sort", SELLER_SERVE_SPEC,
         f"SELECT * FROM ({_SELLER_JOIN}) ORDER BY product_sales_value ASC NULLS LAST, seller_id LIMIT 5", EV)(
    lambda c: sv.serve_sellers(evidence(c)["seller_perf"], evidence(c)["seller_del"], "not_a_column", True, 5))

register("serve_sellers_total", "total_qualified_sellers:i", "SELECT count(*) AS total_qualified_sellers FROM ev_sellerq", EV)(
    lambda c: sv.sellers_response(mart(c, "seller_perf"), mart(c, "seller_del"))["total_qualified_sellers"])


def _insights(c):
    records = ins.insight_records(ins.insight_evidence(evidence(c), FIXTURE_PARAMS))
    return sv.insights_response(records, "delivery", "risk")


_DELIVERY_RISKS = f"FROM ({REGISTRY['insight_records_rules'].sql}) WHERE category = 'delivery' AND type = 'risk'"
register("serve_insights", REGISTRY["insight_records_rules"].spec, f"SELECT * {_DELIVERY_RISKS}", EV)(lambda c: _insights(c)["insights"])
register("serve_insights_total", "total:i", f"SELECT count(*) AS total {_DELIVERY_RISKS}", EV)(lambda c: _insights(c)["total"])


def _ml(c):
    m = c.models
    matrices = None
    for name, scored in (("logistic_regression", m.lr_scored), ("random_forest", m.rf_scored)):
        one = ml.confusion_matrix(scored).select(F.lit(name).alias("model"), "TN", "FP", "FN", "TP")
        matrices = one if matrices is None else matrices.unionByName(one)
    return sv.ml_response(ml.model_metrics(m), ml.feature_importance(c.spark, m), matrices, ml.lr_coefficients(c.spark, m))


register("serve_ml_metrics", REGISTRY["ml_model_metrics"].spec)(lambda c: _ml(c)["metrics"])
register("serve_ml_matrices", "model:s, TN:i, FP:i, FN:i, TP:i")(lambda c: _ml(c)["confusion_matrices"])
register("serve_ml_importance", "feature:s, importance:d")(lambda c: _ml(c)["feature_importance"])
register("serve_ml_coefficients", "feature:s, coefficient:d, abs_coefficient:d, direction:s")(lambda c: _ml(c)["coefficients"])

# what fitted models must satisfy whatever their numbers
register("ml_matrix_totals", "model:s, orders:i, late:i",
         """SELECT m AS model, count(*) AS orders, count(*) FILTER (WHERE is_late = 1) AS late
            FROM ml_test, (VALUES ('logistic_regression'), ('random_forest')) t(m) GROUP BY 1""", ML_CTE)(
    lambda c: _ml(c)["confusion_matrices"].select("model", (F.col("TN") + F.col("FP") + F.col("FN") + F.col("TP")).alias("orders"),
                                                  (F.col("FN") + F.col("TP")).alias("late")))
register("ml_band_totals", "orders:i, share_pct:d, late:i",
         "SELECT count(*) AS orders, 100.0 AS share_pct, count(*) FILTER (WHERE is_late = 1) AS late FROM ml_test", ML_CTE)(
    lambda c: ml.risk_bands(c.models.rf_scored).agg(
        F.sum("order_count").alias("orders"), F.sum("order_pct").alias("share_pct"),
        F.round(F.sum(F.col("order_count") * F.col("actual_late_pct") / 100)).alias("late")))
_LEVELS = " UNION ALL ".join(
    f"""SELECT DISTINCT '{c}_' || coalesce({c}, (SELECT {c} FROM ml_train WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
        FROM ml_train""" for c in ml.CATEGORICAL_FEATURES)
register("ml_feature_names", "feature:s",
         " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in ml.NUMERIC_FEATURES) + f" UNION ALL SELECT DISTINCT * FROM ({_LEVELS})", ML_CTE)(
    lambda c: ml.lr_coefficients(c.spark, c.models).select("feature"))
register("ml_importance_total", "features:i, total:d",
         f"SELECT {len(ml.NUMERIC_FEATURES)} + (SELECT count(*) FROM (SELECT DISTINCT * FROM ({_LEVELS}))) AS features, 1.0 AS total", ML_CTE)(
    lambda c: ml.feature_importance(c.spark, c.models).agg(F.count(F.lit(1)).alias("features"), F.sum("importance").alias("total")))

register("national_review_weighted", "national_review_weighted:d",
         """SELECT sum(avg_review_score * order_count) / NULLIF(sum(order_count), 0) AS national_review_weighted
            FROM ev_rdelay""", EV)(lambda c: sv.national_review_weighted(evidence(c)["rev_delay"]))

register("segment_shares", "segment:s, customer_count:i, total_revenue:d, customer_share_pct:d, revenue_share_pct:d",
         f"""SELECT segment, customer_count, total_revenue,
                    customer_count::DOUBLE / sum(customer_count) OVER () * 100 AS customer_share_pct,
                    CAST(total_revenue AS DOUBLE) / CAST(sum(total_revenue) OVER () AS DOUBLE) * 100 AS revenue_share_pct
             FROM ev_seg WHERE segment IN ({_in(SEGMENTS)})""", EV)(
    lambda c: sv.segment_shares(evidence(c)["rfm_seg"], SEGMENTS))

register("top_states_by_customers", "customer_state:s, customer_uid_count:i",
         "SELECT customer_state, customer_uid_count FROM ev_geo ORDER BY customer_uid_count DESC, customer_state LIMIT 20",
         EV)(lambda c: sv.top_states(evidence(c)["cust_geo"], "customer_uid_count"))
register("top_states_by_revenue", "customer_state:s, total_revenue:d",
         "SELECT customer_state, total_revenue FROM ev_geo ORDER BY total_revenue DESC, customer_state LIMIT 20",
         EV)(lambda c: sv.top_states(evidence(c)["cust_geo"], "total_revenue"))

register("late_categories_chart", "product_category_name_english:s, order_count:i, late_pct:d",
         """SELECT product_category_name_english, order_count, late_pct FROM cat_enriched WHERE order_count >= 100
            ORDER BY late_pct DESC NULLS LAST, product_category_name_english LIMIT 20""", EV)(
    lambda c: sv.late_categories_chart(evidence(c)["del_cat"]))

register("late_states_chart", "customer_state:s, order_count:i, late_pct:d, severity:s",
         """SELECT customer_state, order_count, late_pct,
                   CASE WHEN late_pct > 15 THEN 'high' WHEN late_pct > 10 THEN 'medium'
                        WHEN late_pct > (SELECT late_pct FROM ev_ov) THEN 'above_national' ELSE 'normal' END AS severity
            FROM state_enriched ORDER BY late_pct DESC NULLS LAST, customer_state LIMIT 27""", EV)(
    lambda c: sv.late_states_chart(evidence(c)["del_state"], evidence(c)["del_ov"]))

register("category_display_names", "product_category_name_english:s, display_name:s",
         """SELECT product_category_name_english,
                   array_to_string(list_transform(string_split(replace(product_category_name_english, '_', ' '), ' '),
                                                  lambda w: upper(w[1]) || w[2:]), ' ') AS display_name FROM ev_cat""", EV)(
    lambda c: sv.category_display_names(evidence(c)["cat_perf"]))

register("seller_display_ids", "seller_id:i, display_id:s",
         "SELECT seller_id, '...' || right(CAST(seller_id AS VARCHAR), 8) AS display_id FROM ev_seller", EV)(
    lambda c: sv.seller_display_ids(evidence(c)["seller_perf"]))
