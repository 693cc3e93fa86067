"""Marts shared by several queries (insight evidence, serving,
reconciliations): each is built once per dataset context, materialised with
a reliable checkpoint, and then read by every consumer."""

from __future__ import annotations

from ..operators.stats import attach

from ..operators import customers as cu
from ..operators import delivery as dl
from ..operators import marts as mt
from .params import DELIVERY_MIN_ORDERS, FIXTURE_MIN_SELLER_ORDERS, FIXTURE_SPEND_EDGES, MONTH_MIN_ORDERS, MONTH_MIN_REVIEWS

BUILDERS = {
    "kpis": lambda c: mt.topline_kpis(c.master),
    "monthly": lambda c: mt.monthly_trends(c.master, MONTH_MIN_ORDERS),
    "cat_perf": lambda c: mt.category_performance(c.full, c.master, c.first_cat),
    "state_perf": lambda c: mt.state_performance(c.master),
    "seller_perf": lambda c: mt.seller_performance(c.full, c.master, c.order_sellers),
    "delay_dist": lambda c: mt.delivery_delay_dist(c.spark, c.master),
    "del_by_cat3": lambda c: mt.delivery_by_category(c.first_cat, c.master),
    "del_by_state3": lambda c: mt.delivery_by_state(c.master),
    "rev_vs_delay3": lambda c: mt.review_vs_delay(c.spark, c.master),
    "rfm_seg": lambda c: cu.rfm_segment_summary(c.rfm),
    "repeat": lambda c: cu.repeat_vs_onetime(c.rfm, c.master),
    "cust_geo": lambda c: cu.customer_geography(c.master, c.rfm),
    "spend_stats": lambda c: cu.spend_statistics(c.rfm),
    "top_decile": lambda c: cu.top_decile_share(c.rfm),
    "spend_dist": lambda c: cu.customer_spending_dist(c.spark, c.rfm, FIXTURE_SPEND_EDGES),
    "seg_spend": lambda c: cu.segment_spend_profile(c.rfm),
    "del_ov": lambda c: dl.delivery_overview(c.master),
    "buckets": lambda c: dl.delay_bucket_counts(c.spark, c.master),
    "del_time": lambda c: dl.delivery_over_time(c.master, DELIVERY_MIN_ORDERS),
    "del_state": lambda c: dl.delivery_by_state_enriched(c.master),
    "del_cat": lambda c: dl.delivery_by_category_enriched(c.first_cat, c.master),
    "seller_del": lambda c: dl.seller_delivery_qualified(c.order_sellers, c.master, FIXTURE_MIN_SELLER_ORDERS),
    "rev_delay": lambda c: dl.review_by_delay_detailed(c.master),
    "rev_state": lambda c: dl.review_by_state(c.master),
    "review_scores": lambda c: mt.review_score_dist(c.master),
    "sat_time": lambda c: mt.satisfaction_over_time(c.master, MONTH_MIN_REVIEWS),
    "rev_cat": lambda c: dl.review_by_category(c.first_cat, c.master),
}

EVIDENCE_KEYS = ["kpis", "rfm_seg", "repeat", "cust_geo", "cat_perf", "monthly", "seller_perf", "del_ov",
                 "buckets", "del_state", "del_cat", "del_time", "seller_del", "rev_delay", "rev_state", "rev_cat"]


def mart(c, name: str):
    key = ("mart", name)
    if key not in c.cache:
        c.cache[key] = c._keep_eager(BUILDERS[name](c))
    return c.cache[key]


def evidence(c) -> dict:
    ev = {k: mart(c, k) for k in EVIDENCE_KEYS}
    ev["rfm"] = c.rfm
    ev["spend"] = mart(c, "spend_stats").transform(attach(mart(c, "top_decile").select("top_share_pct")))
    return ev
