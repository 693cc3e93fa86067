"""Batch pipeline: sources → facts → marts, checks, model, insights.

The facts are written as Parquet (the order-level fact partitioned by
purchase month, so monthly filters prune files) and every later phase reads
the written tables: the write is the lineage cut between phases, as the
phase files are in the analysed pipeline.

    python -m marketlens.plans.pipeline --sf-dir /root/testdata/sf0.01 --out /shared/run1
    python -m marketlens.plans.pipeline --csv-dir /data/raw --out /shared/run1
"""

from __future__ import annotations

from ..operators.stats import attach

import argparse
import json
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import customers as cu
from ..operators import delivery as dl
from ..operators import insights as ins
from ..operators import marts as mt
from ..operators import ml, quality, rfm
from ..session import get_spark
from ..sources.manifest import read_table
from ..sources.readers import load_raw_csv
from ..sources.sinks import write_json, write_marts, write_model
from .context import MarketContext
from .params import FIXTURE_MIN_SELLER_ORDERS, FIXTURE_PARAMS, FIXTURE_SPEND_EDGES, MONTH_MIN_ORDERS


def build_facts(ctx: MarketContext, out: str) -> dict[str, str]:
    """Write the order fact, then the item fact from the written order fact.
    A month's rows are rebalanced first, so a month is a few files of even
    size, not one from every task."""
    root = os.path.join(out, "facts")
    by_month = {"orders_master": "purchase_month_label"}
    paths = {}
    for name, df, attr in (("orders_master", lambda: ctx.master.hint("rebalance", "purchase_month_label"), "master"),
                           ("orders_full", lambda: ctx.full, "full")):
        paths[name], = write_marts({name: df()}, root, partition_by=by_month)
        ctx.__dict__[attr] = read_table(ctx.spark, root, name)
    return paths


def run(spark: SparkSession, out: str, sf_dir: str | None = None, csv_dir: str | None = None,
        fixture: bool = True, train_model: bool = True, csv_files: dict | None = None) -> dict[str, str]:
    """Run every phase; return the written paths by name."""
    raw = load_raw_csv(spark, csv_dir, csv_files) if csv_dir else None
    # cleaned orders and items feed the facts and the checks: kept once
    fctx = MarketContext(spark, sf_dir, raw=raw, materialize="checkpoint")
    fctx.__dict__["orders"] = fctx._keep(fctx.orders)
    written = build_facts(fctx, out)
    master, full = fctx.master, fctx.full     # later phases read the written facts
    customer_rfm = rfm.customer_rfm(master)
    write_marts({"customer_rfm": customer_rfm}, os.path.join(out, "facts"))
    customer_rfm = read_table(spark, os.path.join(out, "facts"), "customer_rfm")
    fctx.__dict__["rfm"] = customer_rfm
    first_cat, pairs = fctx.first_cat, fctx.order_sellers

    month_min = MONTH_MIN_ORDERS if fixture else 50
    seller_min = FIXTURE_MIN_SELLER_ORDERS if fixture else dl.MIN_SELLER_ORDERS
    spend_edges = FIXTURE_SPEND_EDGES if fixture else None
    marts = {
        "monthly_trends": mt.monthly_trends(master, month_min),
        "category_performance": mt.category_performance(full, master, first_cat),
        "state_performance": mt.state_performance(master),
        "seller_performance": mt.seller_performance(full, master, pairs),
        "delivery_delay_dist": mt.delivery_delay_dist(spark, master),
        "delivery_by_state": mt.delivery_by_state(master),
        "delivery_by_category": mt.delivery_by_category(first_cat, master),
        "review_score_dist": mt.review_score_dist(master),
        "satisfaction_over_time": mt.satisfaction_over_time(master),
        "review_vs_delay": mt.review_vs_delay(spark, master),
        "rfm_segment_summary": cu.rfm_segment_summary(customer_rfm),
        "repeat_vs_onetime": cu.repeat_vs_onetime(customer_rfm, master),
        "customer_geography": cu.customer_geography(master, customer_rfm),
        "customer_spending_dist": cu.customer_spending_dist(spark, customer_rfm, spend_edges),
        "segment_spend_profile": cu.segment_spend_profile(customer_rfm),
        "customer_segment_detail": cu.customer_segment_detail(customer_rfm, master),
        "delivery_over_time": dl.delivery_over_time(master),
        "delivery_by_state_enriched": dl.delivery_by_state_enriched(master),
        "delivery_by_category_enriched": dl.delivery_by_category_enriched(first_cat, master),
        "seller_delivery_qualified": dl.seller_delivery_qualified(pairs, master, seller_min),
        "seller_delivery_by_state": dl.seller_delivery_by_state(pairs, master),
        "review_by_delay_detailed": dl.review_by_delay_detailed(master),
        "review_by_state": dl.review_by_state(master),
        "review_by_category": dl.review_by_category(first_cat, master),
    }
    marts_dir = os.path.join(out, "marts")
    for p in write_marts(marts, marts_dir):
        written[os.path.basename(p)] = p
    rd = {name: read_table(spark, marts_dir, name, df.schema) for name, df in marts.items()}

    kpis = mt.topline_kpis(master)
    written["kpis"] = write_json(kpis, os.path.join(out, "json", "kpis"))
    written["delivery_overview"] = write_json(dl.delivery_overview_with_buckets(spark, master),
                                              os.path.join(out, "json", "delivery_overview"))
    kpis = spark.read.json(written["kpis"])

    checks = quality.structural_checks(fctx).unionByName(quality.reconciliations(fctx))
    written["checks"] = write_marts({"checks": checks}, os.path.join(out, "quality"))[0]

    evidence = {"kpis": kpis, "rfm": customer_rfm, "rfm_seg": rd["rfm_segment_summary"],
                "repeat": rd["repeat_vs_onetime"], "cust_geo": rd["customer_geography"],
                "spend": cu.spend_statistics(customer_rfm).transform(attach(
                    cu.top_decile_share(customer_rfm).select("top_share_pct"))),
                "cat_perf": rd["category_performance"], "monthly": rd["monthly_trends"],
                "seller_perf": rd["seller_performance"], "del_ov": dl.delivery_overview(master),
                "buckets": dl.delay_bucket_counts(spark, master), "del_state": rd["delivery_by_state_enriched"],
                "del_cat": rd["delivery_by_category_enriched"], "del_time": rd["delivery_over_time"],
                "seller_del": rd["seller_delivery_qualified"], "rev_delay": rd["review_by_delay_detailed"],
                "rev_state": rd["review_by_state"], "rev_cat": rd["review_by_category"]}
    params = FIXTURE_PARAMS if fixture else ins.InsightParams()
    evidence_df = ins.insight_evidence(evidence, params)
    if train_model:
        dataset = fctx.ml_dataset
        tm = ml.train_models(dataset)
        metrics = ml.model_metrics(tm)
        written["ml_metrics"] = write_marts({"ml_metrics": metrics}, os.path.join(out, "ml"))[0]
        written["ml_model"] = write_model(tm.rf, os.path.join(out, "ml", "model_random_forest"))
        fi, lrc = ml.feature_importance(spark, tm), ml.lr_coefficients(spark, tm)
        write_marts({"ml_feature_importance": fi, "ml_lr_coefficients": lrc,
                     "ml_risk_bands": ml.risk_bands(tm.rf_scored)}, os.path.join(out, "ml"))
        split = ml.split_summary(dataset)
        for e in ins.ml_rules(metrics, split, fi, lrc):
            evidence_df = evidence_df.unionByName(e)
    written["insights"] = write_marts({"insights": evidence_df}, os.path.join(out, "insights"))[0]
    ev = spark.read.parquet(written["insights"])
    written["insight_records"] = write_json(ins.insight_records(ev), os.path.join(out, "json", "insights"))
    if train_model:
        tm.release()
    fctx.release()
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="marketplace analytics batch pipeline")
    ap.add_argument("--out", required=True)
    ap.add_argument("--sf-dir")
    ap.add_argument("--csv-dir")
    ap.add_argument("--csv-files", help='JSON map of table -> file name, e.g. {"orders": "orders_2024.csv"}')
    ap.add_argument("--no-model", action="store_true")
    a = ap.parse_args(argv)
    spark = get_spark()
    files = json.loads(a.csv_files) if a.csv_files else None
    for name, path in run(spark, a.out, a.sf_dir, a.csv_dir, fixture=a.csv_dir is None,
                          train_model=not a.no_model, csv_files=files).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
