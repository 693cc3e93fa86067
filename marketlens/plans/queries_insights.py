"""Registered queries: insight evidence, summary, records and validation.

The evidence marts are small; they are computed once per context and
checkpointed (reliable, lineage cut) so the many small rule plans start
from written data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import insights as ins
from ..operators import ml
from .queries_core import BUCKET_DIM_CTE, MONTHLY_CTE
from .queries_customers import RFM_CTE
from .queries_delivery import CAT_ENRICHED_CTE, STATE_ENRICHED_CTE
from .registry import REGISTRY, register

from .params import FIXTURE_PARAMS
from .shared import evidence

def _sql_of(name: str) -> str:
    return REGISTRY[name].sql


def evidence_ctes() -> str:
    cat_body = CAT_ENRICHED_CTE[CAT_ENRICHED_CTE.index("cat_enriched AS"):]
    parts = [RFM_CTE.strip(), MONTHLY_CTE.strip(), BUCKET_DIM_CTE.strip(), STATE_ENRICHED_CTE.strip(), cat_body.strip()]
    named = {"ev_kpis": "topline_kpis", "ev_seg": "rfm_segment_summary", "ev_repeat": "repeat_vs_onetime",
             "ev_geo": "customer_geography", "ev_cat": "category_performance", "ev_seller": "seller_performance",
             "ev_ov": "delivery_overview", "ev_buckets": "delay_bucket_counts", "ev_deltime": "delivery_over_time",
             "ev_sellerq": "seller_delivery_qualified", "ev_rdelay": "review_by_delay_detailed",
             "ev_rstate": "review_by_state", "ev_rcat": "review_by_category"}
    for cte, q in named.items():
        parts.append(f"{cte} AS (\n{_sql_of(q)}\n)")
    parts.append(f"ev_spend AS (SELECT s.*, t.top_share_pct FROM ({_sql_of('spend_statistics')}) s, "
                 f"({_sql_of('top_decile_share')}) t)")
    return ",\n".join(parts)


def _row(iid: str, metric: str, expr: str) -> str:
    cat, typ = ins._META[iid]
    return f"SELECT '{iid}' AS insight_id, '{cat}' AS category, '{typ}' AS type, '{metric}' AS metric, CAST(({expr}) AS DOUBLE) AS value"


def _evidence_sql(p: ins.InsightParams) -> str:
    rows = []
    ot = "(SELECT {c} FROM ev_repeat WHERE customer_type = 'One-Time')"
    rp = "(SELECT {c} FROM ev_repeat WHERE customer_type = 'Repeat')"
    for metric, tmpl, col in [("onetime_customers", ot, "customer_count"), ("onetime_customer_pct", ot, "customer_pct"),
                              ("onetime_revenue_pct", ot, "revenue_pct"), ("onetime_avg_spend", ot, "avg_spend"),
                              ("repeat_customers", rp, "customer_count"), ("repeat_customer_pct", rp, "customer_pct"),
                              ("repeat_revenue_pct", rp, "revenue_pct"), ("repeat_avg_spend", rp, "avg_spend"),
                              ("repeat_avg_order_count", rp, "avg_order_count")]:
        rows.append(_row("C1_onetime_retention_pattern", metric, tmpl.format(c=col)))
    for iid, seg in (("C2_champions_concentration", "Champions"), ("C3_at_risk_dormant", "At Risk")):
        for c in ["customer_count", "customer_pct", "total_revenue", "revenue_pct", "avg_spend", "avg_frequency",
                  "avg_recency_days"]:
            rows.append(_row(iid, c, f"SELECT {c} FROM ev_seg WHERE segment = '{seg}'"))
    rows += [
        _row("C4_geographic_concentration", "focus_state_customer_pct",
             f"SELECT customer_pct FROM ev_geo WHERE customer_state = '{p.focus_state}'"),
        _row("C4_geographic_concentration", "focus_state_revenue_pct",
             f"SELECT revenue_pct FROM ev_geo WHERE customer_state = '{p.focus_state}'"),
        _row("C4_geographic_concentration", "top3_states_revenue_pct",
             "SELECT sum(revenue_pct) FROM (SELECT revenue_pct FROM ev_geo ORDER BY order_count DESC, customer_state LIMIT 3)"),
        _row("C5_spending_skew", "p90_spend", "SELECT p90 FROM ev_spend"),
        _row("C5_spending_skew", "top_decile_revenue_pct", "SELECT top_share_pct FROM ev_spend"),
        _row("C5_spending_skew", "median_spend", "SELECT median FROM ev_spend"),
        _row("C5_spending_skew", "mean_spend", "SELECT mean FROM ev_spend"),
        _row("S1_category_concentration", "top_categories_sales",
             f"SELECT sum(product_sales_value) FROM ev_cat WHERE rank_by_sales <= {p.top_categories}"),
        _row("S1_category_concentration", "top_categories_sales_pct",
             f"SELECT CAST(sum(product_sales_value) AS DOUBLE) / CAST((SELECT total_product_sales FROM ev_kpis) AS DOUBLE) * 100 "
             f"FROM ev_cat WHERE rank_by_sales <= {p.top_categories}"),
        _row("S2_seller_concentration", "top_sellers_sales",
             f"SELECT sum(product_sales_value) FROM ev_seller WHERE rank_by_sales <= {p.top_sellers}"),
        _row("S2_seller_concentration", "top_sellers_sales_pct",
             f"SELECT CAST(sum(product_sales_value) AS DOUBLE) / CAST((SELECT total_product_sales FROM ev_kpis) AS DOUBLE) * 100 "
             f"FROM ev_seller WHERE rank_by_sales <= {p.top_sellers}"),
        _row("S2_seller_concentration", "total_sellers", "SELECT count(*) FROM ev_seller"),
        _row("S3_seasonality_and_crisis", "peak_month_orders", "SELECT max(order_count) FROM monthly"),
        _row("S3_seasonality_and_crisis", "peak_month_sales",
             "SELECT product_sales_value FROM monthly ORDER BY order_count DESC, ym LIMIT 1"),
        _row("S3_seasonality_and_crisis", "months_above_late_threshold",
             f"SELECT count(*) FILTER (WHERE late_pct > {p.crisis_late_pct}) FROM ev_deltime"),
        _row("S3_seasonality_and_crisis", "max_month_late_pct", "SELECT max(late_pct) FROM ev_deltime"),
    ]
    e7 = "(SELECT order_count FROM ev_buckets WHERE delay_bucket = 'Early >7d')"
    rows += [
        _row("D1_conservative_estimates", "early_over_7d_orders", e7),
        _row("D1_conservative_estimates", "delivered_orders", "SELECT n_orders FROM ev_ov"),
        _row("D1_conservative_estimates", "early_over_7d_pct", f"SELECT {e7}::DOUBLE / n_orders * 100 FROM ev_ov"),
        _row("D1_conservative_estimates", "on_time_pct", "SELECT on_time_pct FROM ev_ov"),
    ]
    region = ", ".join(f"'{s}'" for s in p.region_states)
    reg = f"FROM state_enriched WHERE customer_state IN ({region}) AND NOT low_volume"
    rows += [
        _row("D2_northeast_delivery_gap", "region_avg_late_pct", f"SELECT avg(late_pct) {reg}"),
        _row("D2_northeast_delivery_gap", "region_orders", f"SELECT sum(order_count) {reg}"),
        _row("D2_northeast_delivery_gap", "region_avg_delivery_days", f"SELECT avg(avg_delivery_days) {reg}"),
        _row("D2_northeast_delivery_gap", "national_late_pct", "SELECT late_pct FROM ev_ov"),
        _row("D2_northeast_delivery_gap", "national_avg_delivery_days", "SELECT avg_delivery_days FROM ev_ov"),
    ]
    for c in ["order_count", "late_pct", "late_vs_national", "avg_delivery_days"]:
        rows.append(_row("D3_rj_high_volume_risk", c,
                         f"SELECT {c} FROM state_enriched WHERE customer_state = '{p.risk_state}'"))
    above = f"late_pct > (SELECT late_pct FROM ev_ov) * {p.seller_late_factor}"
    rows += [
        _row("D4_seller_delivery_concentration", "qualified_sellers", "SELECT count(*) FROM ev_sellerq"),
        _row("D4_seller_delivery_concentration", "sellers_above_threshold",
             f"SELECT count(*) FILTER (WHERE {above}) FROM ev_sellerq"),
        _row("D4_seller_delivery_concentration", "orders_of_sellers_above",
             f"SELECT sum(order_count) FILTER (WHERE {above}) FROM ev_sellerq"),
        _row("D4_seller_delivery_concentration", "review_of_sellers_above",
             f"SELECT avg(avg_review_score) FILTER (WHERE {above}) FROM ev_sellerq"),
        _row("D4_seller_delivery_concentration", "national_review", "SELECT avg_review_score FROM ev_kpis"),
    ]
    cat, typ = ins._META["D5_category_delivery_variance"]
    rows.append(f"""SELECT * FROM (SELECT 'D5_category_delivery_variance' AS insight_id, '{cat}' AS category, '{typ}' AS type,
                       'late_pct:' || product_category_name_english AS metric, CAST(late_pct AS DOUBLE) AS value
                FROM cat_enriched WHERE late_pct > (SELECT late_pct FROM ev_ov) AND NOT low_volume
                ORDER BY late_pct DESC, product_category_name_english LIMIT {p.top_late_categories})""")
    rb = "(SELECT {c} FROM ev_rdelay WHERE delay_bucket = '{b}')"
    for metric, b, c in [("early_over_7d_review", "Early >7d", "avg_review_score"),
                         ("early_over_7d_orders", "Early >7d", "order_count"),
                         ("late_1_3d_review", "Late 1-3d", "avg_review_score"),
                         ("late_4_7d_review", "Late 4-7d", "avg_review_score"),
                         ("late_4_7d_orders", "Late 4-7d", "order_count"),
                         ("late_over_14d_review", "Late >14d", "avg_review_score")]:
        rows.append(_row("T1_delay_review_association", metric, rb.format(c=c, b=b)))
    lo_s = "SELECT {c} FROM ev_rstate ORDER BY avg_review_score, customer_state LIMIT 1"
    hi_s = "SELECT {c} FROM ev_rstate ORDER BY avg_review_score DESC, customer_state LIMIT 1"
    rows += [
        _row("T2_state_satisfaction_gap", "lowest_state_review", lo_s.format(c="avg_review_score")),
        _row("T2_state_satisfaction_gap", "lowest_state_reviews", lo_s.format(c="review_count")),
        _row("T2_state_satisfaction_gap", "lowest_state_late_pct", lo_s.format(c="late_pct")),
        _row("T2_state_satisfaction_gap", "highest_state_review", hi_s.format(c="avg_review_score")),
        _row("T2_state_satisfaction_gap", "national_review", "SELECT avg_review_score FROM ev_kpis"),
    ]
    w = f"WHERE review_count >= {p.min_category_reviews}"
    lo_c = f"SELECT {{c}} FROM ev_rcat {w} ORDER BY avg_review_score, product_category_name_english LIMIT 1"
    hi_c = f"SELECT {{c}} FROM ev_rcat {w} ORDER BY avg_review_score DESC, product_category_name_english LIMIT 1"
    rows += [
        *[_row("T3_category_satisfaction", m, f"""SELECT max({col}) FROM ev_rcat WHERE product_category_name_english IN
                  (SELECT product_category_name_english FROM ev_cat WHERE rank_by_sales = 1)""")
          for m, col in (("top_revenue_category_review", "avg_review_score"), ("top_revenue_category_reviews", "review_count"),
                         ("top_revenue_category_1star_pct", "pct_1star"))],
        _row("T3_category_satisfaction", "national_review", "SELECT avg_review_score FROM ev_kpis"),
        _row("T3_category_satisfaction", "lowest_category_review", lo_c.format(c="avg_review_score")),
        _row("T3_category_satisfaction", "lowest_category_reviews", lo_c.format(c="review_count")),
        _row("T3_category_satisfaction", "lowest_category_late_pct", lo_c.format(c="late_pct")),
        _row("T3_category_satisfaction", "lowest_category_1star_pct", lo_c.format(c="pct_1star")),
        _row("T3_category_satisfaction", "highest_category_review", hi_c.format(c="avg_review_score")),
        _row("T3_category_satisfaction", "highest_category_reviews", hi_c.format(c="review_count")),
    ]
    return "\nUNION ALL\n".join(rows)


EVIDENCE_SPEC = "insight_id:s, category:s, type:s, metric:s, value:d"
EVIDENCE_SQL = _evidence_sql(FIXTURE_PARAMS)

register("insight_evidence", EVIDENCE_SPEC, EVIDENCE_SQL, evidence_ctes())(
    lambda c: ins.insight_evidence(evidence(c), FIXTURE_PARAMS))

register("insight_summary_rules", "category:s, type:s, insights:i",
         f"SELECT category, type, count(DISTINCT insight_id) AS insights FROM ({EVIDENCE_SQL}) e GROUP BY 1, 2",
         evidence_ctes())(lambda c: ins.insight_summary(ins.insight_evidence(evidence(c), FIXTURE_PARAMS)))

register("validate_insights", "check:s, value:d, expected:d, passed:b",
         """SELECT 'C1_onetime_pct_vs_rfm' AS "check", v AS value, e AS expected, coalesce(abs(v - e) < 0.1, false) AS passed
            FROM (SELECT (SELECT customer_pct FROM ev_repeat WHERE customer_type = 'One-Time') AS v,
                         (SELECT count(*) FILTER (WHERE frequency < 2)::DOUBLE / count(*) * 100 FROM rfm) AS e)
            UNION ALL
            SELECT 'D1_on_time_pct_vs_kpi', o.on_time_pct, k.on_time_delivery_pct,
                   coalesce(abs(o.on_time_pct - k.on_time_delivery_pct) < 0.05, false) FROM ev_ov o, ev_kpis k
            UNION ALL
            SELECT 'T1_early_review_above_late_4_7d', e.a, l.a, coalesce(e.a > l.a, false)
            FROM (SELECT max(avg_review_score) AS a FROM ev_rdelay WHERE delay_bucket = 'Early >7d') e,
                 (SELECT max(avg_review_score) AS a FROM ev_rdelay WHERE delay_bucket = 'Late 4-7d') l
            UNION ALL
            SELECT 'segment_revenue_vs_kpi_order_value', s.r, k.total_order_value,
                   coalesce(abs(s.r - k.total_order_value) < 1.0, false)
            FROM (SELECT sum(total_revenue) AS r FROM ev_seg) s, ev_kpis k""",
         evidence_ctes())(lambda c: ins.validate_insights(evidence(c)))


def _all_insights(c):
    tm = c.models
    split = ml.split_summary(c.ml_dataset)
    extra = ins.ml_rules(ml.model_metrics(tm), split, ml.feature_importance(c.spark, tm), ml.lr_coefficients(c.spark, tm))
    out = ins.insight_evidence(evidence(c), FIXTURE_PARAMS)
    for e in extra:
        out = out.unionByName(e)
    return out


# including the two model insights: rows-only checks
register("insights_all", EVIDENCE_SPEC)(_all_insights)
# the rules' insights counted where they are computed; the two of the model are stated
_MODEL_INSIGHTS = ", ".join(f"('{i}', '{cat}', '{typ}')" for i, cat, typ in ins.CATALOG if i.startswith("M"))
register("insight_summary", "category:s, type:s, insights:i",
         f"""SELECT category, type, count(DISTINCT insight_id) AS insights FROM (
               SELECT insight_id, category, type FROM ({EVIDENCE_SQL}) e
               UNION ALL SELECT * FROM (VALUES {_MODEL_INSIGHTS}) t(insight_id, category, type)) GROUP BY 1, 2""",
         evidence_ctes())(lambda c: ins.insight_summary(_all_insights(c)))
RECORD_SPEC = ("insight_id:s, category:s, type:s, metric_text:s, metrics:i, fact:s, insight:s, recommendation:s, "
               "source:s, qualification:s")
register("insight_records", RECORD_SPEC)(lambda c: ins.insight_records(_all_insights(c)))


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _records_sql() -> str:
    """The records of the rules that need no model, as SQL text functions."""
    facts, texts = [], []
    for iid, (template, names) in ins.FACT_TEMPLATES.items():
        values = ", ".join(f"max(value) FILTER (WHERE metric = '{n}')" for n in names)
        facts.append(f"WHEN '{iid}' THEN printf({_text(template)}, {values})")
    for k, name in enumerate(("insight", "recommendation", "source", "qualification")):
        cases = " ".join(f"WHEN '{iid}' THEN {_text(t[k])}" for iid, t in ins.INSIGHT_TEXTS.items())
        texts.append(f"CASE insight_id {cases} END AS {name}")
    return f"""SELECT insight_id, category, type, metric_text, metrics, coalesce(fact, metric_text) AS fact, {', '.join(texts)}
               FROM (SELECT insight_id, category, type, count(*) AS metrics,
                            string_agg(metric || '=' || coalesce(printf('%.4f', value), 'n/a'), '; '
                                       ORDER BY metric || '=' || coalesce(printf('%.4f', value), 'n/a')) AS metric_text,
                            CASE insight_id {' '.join(facts)} END AS fact
                     FROM ({EVIDENCE_SQL}) GROUP BY 1, 2, 3)"""


register("insight_records_rules", RECORD_SPEC, _records_sql(), evidence_ctes())(
    lambda c: ins.insight_records(ins.insight_evidence(evidence(c), FIXTURE_PARAMS)))
register("validate_model_ranking", "check:s, value:d, expected:d, passed:b")(
    lambda c: ml.model_metrics(c.models).agg(
        F.max(F.when(F.col("model") == "logistic_regression", F.col("roc_auc"))).alias("value"),
        F.max(F.when(F.col("model") == "random_forest", F.col("roc_auc"))).alias("expected"))
    .select(F.lit("M1_lr_auc_above_rf").alias("check"), "value", "expected",
            F.coalesce(F.col("value") > F.col("expected"), F.lit(False)).alias("passed")))


# The rules of the customer and of the delivery phase, over their own marts.
def _metric(rule: str, metric: str, expr: str) -> str:
    return f"SELECT '{rule}' AS rule_id, '{metric}' AS metric, CAST(({expr}) AS DOUBLE) AS value"


def _customer_phase_sql() -> str:
    rows = [_metric("low_repeat_rate", f"{k}_{c}", f"SELECT max({c}) FROM ev_repeat WHERE customer_type = '{t}'")
            for k, t in (("onetime", "One-Time"), ("repeat", "Repeat"))
            for c in ("customer_count", "customer_pct", "revenue_pct", "avg_spend") if (k, c) != ("onetime", "revenue_pct")]
    for rule, segment, more in (("champion_revenue_concentration", "Champions", ["revenue_pct"]), ("at_risk_segment", "At Risk", [])):
        rows += [_metric(rule, c, f"SELECT max({c}) FROM ev_seg WHERE segment = '{segment}'")
                 for c in ["customer_count", "customer_pct", "total_revenue", "avg_spend", "avg_frequency", "avg_recency_days", *more]]
    rows += [_metric("geographic_concentration", f"focus_{c}", f"SELECT max({c}) FROM ev_geo WHERE customer_state = '{FIXTURE_PARAMS.focus_state}'")
             for c in ("customer_pct", "revenue_pct")]
    rows.append(_metric("geographic_concentration", "top3_revenue_pct",
                        """SELECT CAST(sum(total_revenue) AS DOUBLE) / (SELECT CAST(sum(total_revenue) AS DOUBLE) FROM ev_geo) * 100
                           FROM (SELECT total_revenue FROM ev_geo ORDER BY order_count DESC, customer_state LIMIT 3)"""))
    rows += [_metric("spending_concentration", m, f"SELECT {c} FROM ev_spend") for m, c in (
        ("p90_threshold", "p90"), ("top_decile_revenue_pct", "top_share_pct"), ("median_spend", "median"), ("mean_spend", "mean"))]
    return "\nUNION ALL\n".join(rows)


def _delivery_phase_sql() -> str:
    p = FIXTURE_PARAMS
    region = "FROM state_enriched WHERE customer_state IN (" + ", ".join(f"'{s}'" for s in p.phase_region_states) + ") AND NOT low_volume"
    above = f"FROM ev_sellerq WHERE late_pct > (SELECT late_pct FROM ev_ov) * {p.seller_late_factor}"
    rows = [
        _metric("conservative_estimates", "early_over_7d_pct",
                "SELECT coalesce((SELECT max(order_count) FROM ev_buckets WHERE delay_bucket = 'Early >7d'), 0)::DOUBLE / n_orders * 100 FROM ev_ov"),
        _metric("conservative_estimates", "on_time_pct", "SELECT on_time_pct FROM ev_ov"),
        _metric("northeast_delivery_gap", "region_late_pct", f"SELECT avg(late_pct) {region}"),
        _metric("northeast_delivery_gap", "national_late_pct", "SELECT late_pct FROM ev_ov"),
        _metric("northeast_delivery_gap", "region_days", f"SELECT avg(avg_delivery_days) {region}"),
        _metric("northeast_delivery_gap", "national_days", "SELECT avg_delivery_days FROM ev_ov"),
        _metric("northeast_delivery_gap", "region_orders", f"SELECT sum(order_count) {region}"),
        _metric("northeast_delivery_gap", "states_over_twice_national", f"SELECT count(*) {region} AND late_pct > 2 * (SELECT late_pct FROM ev_ov)"),
        _metric("seller_delivery_variance", "sellers", f"SELECT count(*) {above}"),
        _metric("seller_delivery_variance", "orders", f"SELECT coalesce(sum(order_count), 0) {above}"),
        _metric("seller_delivery_variance", "review", f"SELECT avg(avg_review_score) {above}"),
        _metric("seller_delivery_variance", "national_review", "SELECT avg(review_score) FROM del_valid"),
    ]
    rows += [_metric("delay_review_association", f"{k}_{c}", f"SELECT max({c}) FROM ev_rdelay WHERE delay_bucket = '{b}'")
             for k, b in (("early_over_7d", "Early >7d"), ("late_4_7d", "Late 4-7d"), ("late_over_14d", "Late >14d"))
             for c in ("avg_review_score", "order_count")]
    return "\nUNION ALL\n".join(rows)


register("insight_customer_mart_rules", "rule_id:s, metric:s, value:d", _customer_phase_sql(), evidence_ctes())(
    lambda c: ins.customer_phase_rules(*[evidence(c)[k] for k in ("repeat", "rfm_seg", "cust_geo", "spend")], FIXTURE_PARAMS.focus_state))
register("insight_delivery_mart_rules", "rule_id:s, metric:s, value:d", _delivery_phase_sql(), evidence_ctes())(
    lambda c: ins.delivery_phase_rules(*[evidence(c)[k] for k in ("del_ov", "buckets", "del_state", "rev_delay", "seller_del")],
                                       c.del_valid, FIXTURE_PARAMS.phase_region_states, FIXTURE_PARAMS.seller_late_factor))
