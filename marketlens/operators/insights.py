"""Insight rules: small selects over the marts, one row per evidence metric.

Output shape (long format): ``insight_id, category, type, metric, value``.
Every number is computed from the marts; regions, focus states, thresholds
and list sizes are parameters (the analysed pipeline hard-codes several of
them inside its texts). ``insight_records`` renders one text record per
insight with ``format_string`` for presentation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import attach

from ..functions import pct

RISK, OPPORTUNITY = "risk", "opportunity"

# Insight ids, categories and types.
CATALOG = [
    ("C1_onetime_retention_pattern", "customer", RISK),
    ("C2_champions_concentration", "customer", OPPORTUNITY),
    ("C3_at_risk_dormant", "customer", OPPORTUNITY),
    ("C4_geographic_concentration", "customer", OPPORTUNITY),
    ("C5_spending_skew", "customer", RISK),
    ("S1_category_concentration", "sales", OPPORTUNITY),
    ("S2_seller_concentration", "sales", RISK),
    ("S3_seasonality_and_crisis", "sales", RISK),
    ("D1_conservative_estimates", "delivery", OPPORTUNITY),
    ("D2_northeast_delivery_gap", "delivery", RISK),
    ("D3_rj_high_volume_risk", "delivery", RISK),
    ("D4_seller_delivery_concentration", "delivery", RISK),
    ("D5_category_delivery_variance", "delivery", OPPORTUNITY),
    ("T1_delay_review_association", "satisfaction", RISK),
    ("T2_state_satisfaction_gap", "satisfaction", RISK),
    ("T3_category_satisfaction", "satisfaction", RISK),
    ("M1_lr_model_performance", "ml", OPPORTUNITY),
    ("M2_predictive_features", "ml", OPPORTUNITY),
]
_META = {i: (c, t) for i, c, t in CATALOG}


@dataclass
class InsightParams:
    # Fixed values of the analysed market: its largest state, the region of D2
    # and of the delivery phase rule (which lists one state more), a risk state.
    focus_state: str = "SP"                 # C4
    region_states: list = field(default_factory=lambda: ["AL", "MA", "SE", "PI", "CE", "RN", "PB", "BA"])  # D2
    phase_region_states: list = field(
        default_factory=lambda: ["AL", "MA", "SE", "PI", "CE", "RN", "PB", "PE", "BA"])
    risk_state: str = "RJ"                  # D3
    top_categories: int = 5                 # S1
    top_sellers: int = 10                   # S2
    crisis_late_pct: float = 10.0           # S3
    seller_late_factor: float = 1.5         # D4
    top_late_categories: int = 4            # D5
    min_category_reviews: int = 200         # T3


def _emit(one_row: DataFrame, insight_id: str, metrics: dict[str, F.Column]) -> DataFrame:
    """Unpivot a one-row evidence frame into (insight, category, type, metric, value)."""
    cat, typ = _META[insight_id]
    wide = one_row.select(*[e.cast("double").alias(m) for m, e in metrics.items()])
    long = wide.unpivot([], list(metrics), "metric", "value")
    return long.select(F.lit(insight_id).alias("insight_id"), F.lit(cat).alias("category"),
                       F.lit(typ).alias("type"), "metric", "value")


def _pick(df: DataFrame, cond: F.Column, prefix: str, cols: list[str]) -> DataFrame:
    """The row matching ``cond`` (at most one by construction), columns prefixed.
    An aggregate keeps the result one row even when nothing matches."""
    return df.where(cond).agg(*[F.max(c).alias(f"{prefix}{c}") for c in cols])


def _cross(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.transform(attach(b)), frames)


def customer_rules(ev: dict, p: InsightParams) -> list[DataFrame]:
    r, seg, geo = ev["repeat"], ev["rfm_seg"], ev["cust_geo"]
    cols = ["customer_count", "customer_pct", "total_revenue", "revenue_pct", "avg_spend", "avg_order_count"]
    ot = _pick(r, F.col("customer_type") == "One-Time", "ot_", cols)
    rp = _pick(r, F.col("customer_type") == "Repeat", "rp_", cols)
    c1 = _emit(_cross(ot, rp), "C1_onetime_retention_pattern", {
        "onetime_customers": F.col("ot_customer_count"), "onetime_customer_pct": F.col("ot_customer_pct"),
        "onetime_revenue_pct": F.col("ot_revenue_pct"), "onetime_avg_spend": F.col("ot_avg_spend"),
        "repeat_customers": F.col("rp_customer_count"), "repeat_customer_pct": F.col("rp_customer_pct"),
        "repeat_revenue_pct": F.col("rp_revenue_pct"), "repeat_avg_spend": F.col("rp_avg_spend"),
        "repeat_avg_order_count": F.col("rp_avg_order_count")})
    scols = ["customer_count", "customer_pct", "total_revenue", "revenue_pct", "avg_spend", "avg_frequency",
             "avg_recency_days"]
    ch = _pick(seg, F.col("segment") == "Champions", "", scols)
    c2 = _emit(ch, "C2_champions_concentration", {c: F.col(c) for c in scols})
    ar = _pick(seg, F.col("segment") == "At Risk", "", scols)
    c3 = _emit(ar, "C3_at_risk_dormant", {c: F.col(c) for c in scols})
    focus = _pick(geo, F.col("customer_state") == p.focus_state, "f_", ["customer_pct", "revenue_pct"])
    top3 = geo.orderBy(F.col("order_count").desc(), F.col("customer_state")).limit(3) \
        .agg(F.sum("revenue_pct").alias("top3_revenue_pct"))
    c4 = _emit(focus.transform(attach(top3)), "C4_geographic_concentration", {
        "focus_state_customer_pct": F.col("f_customer_pct"), "focus_state_revenue_pct": F.col("f_revenue_pct"),
        "top3_states_revenue_pct": F.col("top3_revenue_pct")})
    c5 = _emit(ev["spend"], "C5_spending_skew", {
        "p90_spend": F.col("p90"), "top_decile_revenue_pct": F.col("top_share_pct"),
        "median_spend": F.col("median"), "mean_spend": F.col("mean")})
    return [c1, c2, c3, c4, c5]


def sales_rules(ev: dict, p: InsightParams) -> list[DataFrame]:
    kp = ev["kpis"].select("total_product_sales")
    top = ev["cat_perf"].where(F.col("rank_by_sales") <= p.top_categories) \
        .agg(F.sum("product_sales_value").alias("top_sales"))
    s1 = _emit(top.transform(attach(kp)), "S1_category_concentration", {
        "top_categories_sales": F.col("top_sales"),
        "top_categories_sales_pct": pct(F.col("top_sales"), F.col("total_product_sales"))})
    sel = ev["seller_perf"].agg(
        F.sum(F.when(F.col("rank_by_sales") <= p.top_sellers, F.col("product_sales_value"))).alias("top_sales"),
        F.count(F.lit(1)).alias("sellers"))
    s2 = _emit(sel.transform(attach(kp)), "S2_seller_concentration", {
        "top_sellers_sales": F.col("top_sales"),
        "top_sellers_sales_pct": pct(F.col("top_sales"), F.col("total_product_sales")),
        "total_sellers": F.col("sellers")})
    peak = ev["monthly"].agg(
        F.max("order_count").alias("peak_order_count"),
        F.min_by("product_sales_value", F.struct((-F.col("order_count")).alias("k"), F.col("ym"))).alias("peak_sales"))
    crisis = ev["del_time"].agg(F.count_if(F.col("late_pct") > p.crisis_late_pct).alias("crisis_months"),
                                F.max("late_pct").alias("max_month_late_pct"))
    s3 = _emit(peak.transform(attach(crisis)), "S3_seasonality_and_crisis", {
        "peak_month_orders": F.col("peak_order_count"), "peak_month_sales": F.col("peak_sales"),
        "months_above_late_threshold": F.col("crisis_months"), "max_month_late_pct": F.col("max_month_late_pct")})
    return [s1, s2, s3]


def delivery_rules(ev: dict, p: InsightParams) -> list[DataFrame]:
    ov = ev["del_ov"]
    e7 = _pick(ev["buckets"], F.col("delay_bucket") == "Early >7d", "", ["order_count"])
    d1 = _emit(ov.transform(attach(e7)), "D1_conservative_estimates", {
        "early_over_7d_orders": F.col("order_count"), "delivered_orders": F.col("n_orders"),
        "early_over_7d_pct": pct(F.col("order_count"), F.col("n_orders")), "on_time_pct": F.col("on_time_pct")})
    st = ev["del_state"]
    reg = st.where(F.col("customer_state").isin(p.region_states) & ~F.col("low_volume")).agg(
        F.avg("late_pct").alias("region_late_pct"), F.sum("order_count").alias("region_orders"),
        F.avg("avg_delivery_days").alias("region_avg_days"))
    nat = ov.select(F.col("late_pct").alias("nat_late"), F.col("avg_delivery_days").alias("nat_days"))
    d2 = _emit(reg.transform(attach(nat)), "D2_northeast_delivery_gap", {
        "region_avg_late_pct": F.col("region_late_pct"), "region_orders": F.col("region_orders"),
        "region_avg_delivery_days": F.col("region_avg_days"), "national_late_pct": F.col("nat_late"),
        "national_avg_delivery_days": F.col("nat_days")})
    fs = _pick(st, F.col("customer_state") == p.risk_state, "",
               ["order_count", "late_pct", "late_vs_national", "avg_delivery_days"])
    d3 = _emit(fs, "D3_rj_high_volume_risk", {c: F.col(c) for c in
                                              ["order_count", "late_pct", "late_vs_national", "avg_delivery_days"]})
    sd = ev["seller_del"].transform(attach(nat))
    above = F.col("late_pct") > F.col("nat_late") * p.seller_late_factor
    sg = sd.agg(F.count(F.lit(1)).alias("qualified"), F.count_if(above).alias("above"),
                F.sum(F.when(above, F.col("order_count"))).alias("above_orders"),
                F.avg(F.when(above, F.col("avg_review_score"))).alias("above_review"))
    d4 = _emit(sg.transform(attach(ev["kpis"].select("avg_review_score"))), "D4_seller_delivery_concentration", {
        "qualified_sellers": F.col("qualified"), "sellers_above_threshold": F.col("above"),
        "orders_of_sellers_above": F.col("above_orders"), "review_of_sellers_above": F.col("above_review"),
        "national_review": F.col("avg_review_score")})
    cat = ev["del_cat"].transform(attach(nat.select("nat_late"))).where(
        (F.col("late_pct") > F.col("nat_late")) & ~F.col("low_volume"))
    top = cat.orderBy(F.col("late_pct").desc(), F.col("product_category_name_english")).limit(p.top_late_categories)
    cid, (cc, ct) = "D5_category_delivery_variance", _META["D5_category_delivery_variance"]
    d5 = top.select(F.lit(cid).alias("insight_id"), F.lit(cc).alias("category"), F.lit(ct).alias("type"),
                    F.concat(F.lit("late_pct:"), F.col("product_category_name_english")).alias("metric"),
                    F.col("late_pct").cast("double").alias("value"))
    return [d1, d2, d3, d4, d5]


def satisfaction_rules(ev: dict, p: InsightParams) -> list[DataFrame]:
    rd = ev["rev_delay"]
    picks = [_pick(rd, F.col("delay_bucket") == b, f"{k}_", ["avg_review_score", "order_count"])
             for k, b in (("e7", "Early >7d"), ("l13", "Late 1-3d"), ("l47", "Late 4-7d"), ("l14", "Late >14d"))]
    t1 = _emit(_cross(*picks), "T1_delay_review_association", {
        "early_over_7d_review": F.col("e7_avg_review_score"), "early_over_7d_orders": F.col("e7_order_count"),
        "late_1_3d_review": F.col("l13_avg_review_score"), "late_4_7d_review": F.col("l47_avg_review_score"),
        "late_4_7d_orders": F.col("l47_order_count"), "late_over_14d_review": F.col("l14_avg_review_score")})

    def low_high(df: DataFrame, key: str) -> DataFrame:
        lo = F.struct(F.col("avg_review_score").alias("a"), F.col(key).alias("k"))
        hi = F.struct((-F.col("avg_review_score")).alias("a"), F.col(key).alias("k"))
        return df.agg(F.min_by("avg_review_score", lo).alias("low_review"),
                      F.min_by("review_count", lo).alias("low_n"), F.min_by("late_pct", lo).alias("low_late"),
                      F.min_by("pct_1star", lo).alias("low_1star"),
                      F.min_by("avg_review_score", hi).alias("high_review"), F.min_by("review_count", hi).alias("high_n"))
    nat = ev["kpis"].select("avg_review_score")
    t2 = _emit(low_high(ev["rev_state"], "customer_state").transform(attach(nat)), "T2_state_satisfaction_gap", {
        "lowest_state_review": F.col("low_review"), "lowest_state_reviews": F.col("low_n"),
        "lowest_state_late_pct": F.col("low_late"), "highest_state_review": F.col("high_review"),
        "national_review": F.col("avg_review_score")})
    rc = ev["rev_cat"].where(F.col("review_count") >= p.min_category_reviews)
    first = ev["cat_perf"].where(F.col("rank_by_sales") == 1).select("product_category_name_english")
    top = ev["rev_cat"].join(first, "product_category_name_english", "left_semi")
    top = _pick(top, F.lit(True), "top_", ["avg_review_score", "review_count", "pct_1star"])
    t3 = _emit(low_high(rc, "product_category_name_english").transform(attach(top)).transform(attach(nat)), "T3_category_satisfaction", {
        "top_revenue_category_review": F.col("top_avg_review_score"),
        "top_revenue_category_reviews": F.col("top_review_count"),
        "top_revenue_category_1star_pct": F.col("top_pct_1star"), "national_review": F.col("avg_review_score"),
        "lowest_category_review": F.col("low_review"), "lowest_category_reviews": F.col("low_n"),
        "lowest_category_late_pct": F.col("low_late"), "lowest_category_1star_pct": F.col("low_1star"),
        "highest_category_review": F.col("high_review"), "highest_category_reviews": F.col("high_n")})
    return [t1, t2, t3]


def ml_rules(metrics: DataFrame, split: DataFrame, importance: DataFrame, coefficients: DataFrame) -> list[DataFrame]:
    lr = metrics.where(F.col("model") == "logistic_regression")
    forest = _pick(metrics, F.col("model") == "random_forest", "forest_", ["roc_auc"])
    m1 = _emit(lr.transform(attach(split)).transform(attach(forest)), "M1_lr_model_performance", {
        "accuracy": F.col("accuracy"), "forest_roc_auc": F.col("forest_roc_auc"), "false_positives": F.col("FP"),
        "true_negatives": F.col("TN"), "train_late_pct": F.col("train_late_pct"),
        "recall": F.col("recall"), "precision": F.col("precision"), "f1": F.col("f1"), "roc_auc": F.col("roc_auc"),
        "true_positives": F.col("TP"), "false_negatives": F.col("FN"), "test_orders": F.col("test_orders"),
        "test_late_pct": F.col("test_late_pct"), "train_orders": F.col("train_orders")})
    cid, (cc, ct) = "M2_predictive_features", _META["M2_predictive_features"]
    top3 = importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(3)
    strong = coefficients.orderBy(F.col("abs_coefficient").desc(), F.col("feature")).limit(3)
    m2 = [df.select(F.lit(cid).alias("insight_id"), F.lit(cc).alias("category"), F.lit(ct).alias("type"),
                    F.concat(F.lit(f"{name}:"), F.col("feature")).alias("metric"),
                    F.col(name).cast("double").alias("value"))
          for df, name in ((top3, "importance"), (strong, "coefficient"))]
    return [m1, *m2]


def _rule(one_row: DataFrame, rule_id: str, metrics: dict[str, F.Column]) -> DataFrame:
    wide = one_row.select(*[e.cast("double").alias(m) for m, e in metrics.items()])
    return wide.unpivot([], list(metrics), "metric", "value").select(F.lit(rule_id).alias("rule_id"), "metric", "value")


def customer_phase_rules(repeat: DataFrame, segments: DataFrame, geography: DataFrame, spend: DataFrame,
                         focus_state: str) -> DataFrame:
    """The customer phase's own rules, long rows (rule_id, metric, value)."""
    by_type = _cross(*[_pick(repeat, F.col("customer_type") == t, f"{k}_", ["customer_count", "customer_pct", "revenue_pct", "avg_spend"])
                       for k, t in (("onetime", "One-Time"), ("repeat", "Repeat"))])
    rules = [_rule(by_type, "low_repeat_rate", {c: F.col(c) for c in by_type.columns if c != "onetime_revenue_pct"})]
    measures = ["customer_count", "customer_pct", "total_revenue", "avg_spend", "avg_frequency", "avg_recency_days"]
    for rule_id, segment, more in (("champion_revenue_concentration", "Champions", ["revenue_pct"]), ("at_risk_segment", "At Risk", [])):
        row = _pick(segments, F.col("segment") == segment, "", measures + more)
        rules.append(_rule(row, rule_id, {c: F.col(c) for c in row.columns}))
    focus = _pick(geography, F.col("customer_state") == focus_state, "focus_", ["customer_pct", "revenue_pct"])
    top = geography.orderBy(F.col("order_count").desc(), F.col("customer_state")).limit(3).agg(F.sum("total_revenue").alias("top3"))
    total = geography.agg(F.sum("total_revenue").alias("total"))
    rules.append(_rule(_cross(focus, top, total), "geographic_concentration", {
        "focus_customer_pct": F.col("focus_customer_pct"), "focus_revenue_pct": F.col("focus_revenue_pct"),
        "top3_revenue_pct": pct(F.col("top3"), F.col("total"))}))
    rules.append(_rule(spend, "spending_concentration", {
        "p90_threshold": F.col("p90"), "top_decile_revenue_pct": F.col("top_share_pct"), "median_spend": F.col("median"),
        "mean_spend": F.col("mean")}))
    return reduce(lambda a, b: a.unionByName(b), rules)


def delivery_phase_rules(overview: DataFrame, buckets: DataFrame, states: DataFrame, review_delay: DataFrame,
                         sellers: DataFrame, dated: DataFrame, region_states: list, late_factor: float = 1.5) -> DataFrame:
    """The delivery phase's own rules, with a region of their own. ``dated``:
    the delivered orders with a delivery date, whose mean review is the
    national one of this phase."""
    early = _pick(buckets, F.col("delay_bucket") == "Early >7d", "early_", ["order_count"])
    rules = [_rule(_cross(overview, early), "conservative_estimates", {
        "early_over_7d_pct": pct(F.coalesce("early_order_count", F.lit(0)), F.col("n_orders")), "on_time_pct": F.col("on_time_pct")})]
    nat = overview.select(F.col("late_pct").alias("national_late_pct"), F.col("avg_delivery_days").alias("national_days"))
    region = states.where(F.col("customer_state").isin(region_states) & ~F.col("low_volume")).transform(attach(nat)).agg(
        F.avg("late_pct").alias("region_late_pct"), F.avg("avg_delivery_days").alias("region_days"),
        F.sum("order_count").alias("region_orders"),
        F.count_if(F.col("late_pct") > 2 * F.col("national_late_pct")).alias("states_over_twice_national"))
    rules.append(_rule(_cross(region, nat), "northeast_delivery_gap", {
        c: F.col(c) for c in ("region_late_pct", "national_late_pct", "region_days", "national_days", "region_orders",
                              "states_over_twice_national")}))
    picks = _cross(*[_pick(review_delay, F.col("delay_bucket") == b, f"{k}_", ["avg_review_score", "order_count"])
                     for k, b in (("early_over_7d", "Early >7d"), ("late_4_7d", "Late 4-7d"), ("late_over_14d", "Late >14d"))])
    rules.append(_rule(picks, "delay_review_association", {c: F.col(c) for c in picks.columns}))
    above = sellers.transform(attach(nat)).where(F.col("late_pct") > F.col("national_late_pct") * late_factor).agg(
        F.count(F.lit(1)).alias("sellers"), F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders"),
        F.avg("avg_review_score").alias("review"))
    mean = dated.agg(F.avg("review_score").alias("national_review"))
    rules.append(_rule(_cross(above, mean), "seller_delivery_variance", {c: F.col(c) for c in ("sellers", "orders", "review", "national_review")}))
    return reduce(lambda a, b: a.unionByName(b), rules)


def insight_evidence(ev: dict, p: InsightParams | None = None) -> DataFrame:
    p = p or InsightParams()
    frames = customer_rules(ev, p) + sales_rules(ev, p) + delivery_rules(ev, p) + satisfaction_rules(ev, p)
    return reduce(lambda a, b: a.unionByName(b), frames)


def insight_summary(evidence: DataFrame) -> DataFrame:
    """Insights per category and type."""
    return evidence.groupBy("category", "type").agg(F.count_distinct("insight_id").alias("insights"))


# Fact sentences per insight: (template, metric names in placeholder order).
# Numbers always come from the evidence rows; the wording is ours.
FACT_TEMPLATES = {
    "C1_onetime_retention_pattern": ("%.1f%% of customers (%.0f) placed exactly one delivered order; %.1f%% (%.0f) "
                                     "placed two or more and bring %.1f%% of revenue.",
                                     ["onetime_customer_pct", "onetime_customers", "repeat_customer_pct",
                                      "repeat_customers", "repeat_revenue_pct"]),
    "C2_champions_concentration": ("Champions: %.0f customers (%.1f%%) generate %.1f%% of revenue, average spend %.2f.",
                                   ["customer_count", "customer_pct", "revenue_pct", "avg_spend"]),
    "C3_at_risk_dormant": ("At Risk: %.0f customers (%.1f%%), average recency %.0f days, historical spend %.2f.",
                           ["customer_count", "customer_pct", "avg_recency_days", "total_revenue"]),
    "C4_geographic_concentration": ("The focus state holds %.1f%% of customers and %.1f%% of revenue; the top 3 "
                                    "states hold %.1f%% of revenue.",
                                    ["focus_state_customer_pct", "focus_state_revenue_pct", "top3_states_revenue_pct"]),
    "C5_spending_skew": ("The top 10%% of customers by spend (>= %.0f) contribute %.1f%% of revenue; median spend "
                         "%.2f vs mean %.2f.", ["p90_spend", "top_decile_revenue_pct", "median_spend", "mean_spend"]),
    "S1_category_concentration": ("The top categories account for %.0f in product sales (%.1f%% of total).",
                                  ["top_categories_sales", "top_categories_sales_pct"]),
    "S2_seller_concentration": ("The top sellers generate %.0f (%.1f%% of product sales) out of %.0f sellers.",
                                ["top_sellers_sales", "top_sellers_sales_pct", "total_sellers"]),
    "S3_seasonality_and_crisis": ("Order volume peaked at %.0f orders (%.0f product sales); %.0f months exceeded the "
                                  "late-delivery threshold, the worst at %.1f%%.",
                                  ["peak_month_orders", "peak_month_sales", "months_above_late_threshold",
                                   "max_month_late_pct"]),
    "D1_conservative_estimates": ("%.0f of %.0f delivered orders (%.1f%%) arrived more than 7 days early; on-time "
                                  "rate %.2f%%.", ["early_over_7d_orders", "delivered_orders", "early_over_7d_pct",
                                                   "on_time_pct"]),
    "D2_northeast_delivery_gap": ("Region states with enough volume average %.1f%% late (national %.1f%%) over %.0f "
                                  "orders.", ["region_avg_late_pct", "national_late_pct", "region_orders"]),
    "D3_rj_high_volume_risk": ("The risk state has %.0f delivered orders, %.1f%% late (%+.1f pp vs national), "
                               "%.1f delivery days.", ["order_count", "late_pct", "late_vs_national",
                                                       "avg_delivery_days"]),
    "D4_seller_delivery_concentration": ("%.0f of %.0f qualified sellers are late well above the national rate; they "
                                         "handled %.0f orders, review %.3f vs national %.3f.",
                                         ["sellers_above_threshold", "qualified_sellers", "orders_of_sellers_above",
                                          "review_of_sellers_above", "national_review"]),
    "T1_delay_review_association": ("Orders more than 7 days early average %.3f stars; 4-7 days late %.3f; more than "
                                    "14 days late %.3f.", ["early_over_7d_review", "late_4_7d_review",
                                                            "late_over_14d_review"]),
    "T2_state_satisfaction_gap": ("The lowest-rated state averages %.3f stars (%.0f reviews, %.1f%% late); the "
                                  "highest %.3f.", ["lowest_state_review", "lowest_state_reviews",
                                                    "lowest_state_late_pct", "highest_state_review"]),
    "T3_category_satisfaction": ("The lowest-rated category averages %.3f stars (%.0f reviews, %.1f%% 1-star); the "
                                 "highest %.3f.", ["lowest_category_review", "lowest_category_reviews",
                                                   "lowest_category_1star_pct", "highest_category_review"]),
    "M1_lr_model_performance": ("On %.0f held-out orders the logistic model reaches recall %.4f, precision %.4f, "
                                "ROC-AUC %.4f.", ["test_orders", "recall", "precision", "roc_auc"]),
}


# Per insight: reading, recommendation, source mart, qualification. Our wording;
# numbers stand in the fact and the metrics only.
INSIGHT_TEXTS = {
    "C1_onetime_retention_pattern": ("Revenue rests on first purchases.", "Follow up after a first order and watch the repeat share.",
                                     "repeat_vs_onetime", "Delivered orders; the window may hide later purchases."),
    "C2_champions_concentration": ("A small, recent and frequent group spends most.", "Watch service levels of this group apart from the rest.",
                                   "rfm_segment_summary", "Segments are relative to this customer base."),
    "C3_at_risk_dormant": ("Formerly good customers have gone quiet.", "Run a measured win-back offer for them.",
                           "rfm_segment_summary", "Recency counts from the last delivered purchase in the data."),
    "C4_geographic_concentration": ("Demand sits in a few states.", "Weigh local supply and logistics for states that lag.",
                                    "customer_geography", "A person who moved counts in each state."),
    "C5_spending_skew": ("A minority of spenders carries much of the revenue.", "Offer a tier for the top spenders and track their churn.",
                         "spend_statistics", "Spend is the sum over delivered orders."),
    "S1_category_concentration": ("A handful of categories brings much of the sales.", "Secure stock and sellers of these categories first.",
                                  "category_performance", "Product sales without freight."),
    "S2_seller_concentration": ("Sales depend on a few sellers more than on most.", "Agree service levels with the largest sellers.",
                                "seller_performance", "Ranked by product sales of delivered orders."),
    "S3_seasonality_and_crisis": ("Peaks and weak months of delivery stand out.", "Plan capacity for peaks and review the months above the threshold.",
                                  "monthly_trends, delivery_over_time", "Months with few orders are left out."),
    "D1_conservative_estimates": ("Promised dates are cautious.", "Test tighter delivery windows.", "delivery_overview",
                                  "Whole days, rounded towards earlier."),
    "D2_northeast_delivery_gap": ("The region waits longer and more often in vain.", "Check seller and carrier coverage of its states.",
                                  "delivery_by_state_enriched", "Mean over its states with enough orders, not weighted."),
    "D3_rj_high_volume_risk": ("A large state is late more often than the nation.", "Review routes and carriers into this state.",
                               "delivery_by_state_enriched", "Compared with the national late share."),
    "D4_seller_delivery_concentration": ("Lateness clusters at some sellers.", "Set targets for the sellers above the threshold.",
                                         "seller_delivery_qualified", "Sellers with enough delivered orders only."),
    "D5_category_delivery_variance": ("Some categories are late beyond the average.", "Look at weight, size and routes of these categories.",
                                      "delivery_by_category_enriched", "An order counts for its first item's category."),
    "T1_delay_review_association": ("Scores fall as deliveries slip.", "Treat the late buckets as an early warning.",
                                    "review_by_delay_detailed", "An association, not a cause."),
    "T2_state_satisfaction_gap": ("States differ in satisfaction, and lateness goes along.", "Start with the lowest-rated state.",
                                  "review_by_state", "Latest review of each order."),
    "T3_category_satisfaction": ("One category draws the weakest reviews.", "Read its one-star reviews for delivery and product faults.",
                                 "review_by_category", "Categories with enough reviews; first item's category."),
    "M1_lr_model_performance": ("The linear model ranks risk usefully but raises many alarms.", "Use scores to order checks, not to decide.",
                                "ml_model_metrics", "Tested on later orders than it was trained on."),
    "M2_predictive_features": ("A few features carry most of the signal.", "Collect these features early and reliably.",
                               "ml_feature_importance, ml_lr_coefficients", "Importance is not a cause."),
}


def insight_records(evidence: DataFrame) -> DataFrame:
    """One presentation record per insight: a fact sentence filled from its
    metrics (a small map per insight, at most a dozen entries), the metrics
    rendered as text, a reading, a recommendation, the source mart and a
    qualification."""
    g = evidence.groupBy("insight_id", "category", "type").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("__m"),
        F.array_join(F.sort_array(F.collect_list(F.concat(
            "metric", F.lit("="), F.when(F.col("value").isNull(), "n/a").otherwise(F.format_string("%.4f", F.col("value")))))), "; ")
        .alias("metric_text"), F.count(F.lit(1)).alias("metrics"))
    fact = None
    for iid, (tmpl, names) in FACT_TEMPLATES.items():
        known = reduce(lambda a, b: a & b, [F.col("__m")[n].isNotNull() for n in names])
        text = F.when(known, F.format_string(tmpl, *[F.col("__m")[n] for n in names])).otherwise(F.col("metric_text"))
        fact = F.when(F.col("insight_id") == iid, text) if fact is None else fact.when(F.col("insight_id") == iid, text)
    fact = fact.otherwise(F.col("metric_text"))
    for k, name in enumerate(("insight", "recommendation", "source", "qualification")):
        text = F.create_map(*[F.lit(x) for iid, texts in INSIGHT_TEXTS.items() for x in (iid, texts[k])])
        g = g.withColumn(name, text[F.col("insight_id")])
    return g.withColumn("fact", fact).drop("__m")


def validate_insights(ev: dict) -> DataFrame:
    """Cross-checks of insight evidence: one-time share vs the RFM table,
    overview on-time % vs KPI, review monotonic over delay, segment revenue
    vs KPI order value."""
    from .quality import _check, union_all
    ot = ev["repeat"].where(F.col("customer_type") == "One-Time").select(F.col("customer_pct").alias("ot"))
    rf = ev["rfm"].agg(pct(F.count_if(F.col("frequency") < 2), F.count(F.lit(1))).alias("ot_rfm"))
    kp = ev["kpis"]
    rd = ev["rev_delay"]
    e7 = _pick(rd, F.col("delay_bucket") == "Early >7d", "e7_", ["avg_review_score"])
    l47 = _pick(rd, F.col("delay_bucket") == "Late 4-7d", "l47_", ["avg_review_score"])
    seg = ev["rfm_seg"].agg(F.sum("total_revenue").alias("seg_rev"))
    mono = e7.transform(attach(l47)).select(
        F.lit("T1_early_review_above_late_4_7d").alias("check"), F.col("e7_avg_review_score").cast("double").alias("value"),
        F.col("l47_avg_review_score").cast("double").alias("expected"),
        F.coalesce(F.col("e7_avg_review_score") > F.col("l47_avg_review_score"), F.lit(False)).alias("passed"))
    return union_all([
        _check(ot.transform(attach(rf)), "C1_onetime_pct_vs_rfm", F.col("ot"), F.col("ot_rfm"), 0.1),
        _check(ev["del_ov"].transform(attach(kp.select("on_time_delivery_pct"))), "D1_on_time_pct_vs_kpi",
               F.col("on_time_pct"), F.col("on_time_delivery_pct"), 0.05),
        mono,
        _check(seg.transform(attach(kp.select("total_order_value"))), "segment_revenue_vs_kpi_order_value",
               F.col("seg_rev"), F.col("total_order_value"), 1.0),
    ])
