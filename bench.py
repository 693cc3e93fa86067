"""Benchmark: the headline queries end to end on one dataset; prints one JSON
line. ``build`` has the seconds to build each fact, each shared mart and the
models, in the order in which they depend on each other; ``queries`` those to
run each query over what is built (``noop`` sink: every row is computed,
nothing is collected). ``value`` is the sum of both, as in round 1, where the
first query that needed a fact or mart paid for it.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "orders_master", "orders_full", "customer_rfm", "topline_kpis", "monthly_trends",
    "category_performance", "state_performance", "seller_performance", "delivery_delay_dist",
    "delivery_by_state_enriched", "delivery_by_category_enriched", "seller_delivery_qualified",
    "review_by_delay_detailed", "rfm_segment_summary", "repeat_vs_onetime", "customer_geography",
    "customer_spending_dist", "top_decile_share", "reconciliations", "ml_dataset", "time_split",
    "insight_evidence", "serve_sellers", "ml_model_metrics",
]
FACTS = ["items", "master", "full", "first_cat", "order_sellers", "rfm", "ml_dataset"]
ROUND_1_TOTAL = 181.2  # seconds, sf0.1, 8 cores: the point to beat


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from marketlens.plans.context import get_context
    from marketlens.plans.registry import load_all
    from marketlens.plans.shared import BUILDERS, mart
    from marketlens.session import configure, get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    reg = load_all()
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    build: dict[str, float] = {}
    times: dict[str, float] = {}

    def timed(into: dict, name: str, run) -> None:
        t0 = time.perf_counter()
        run()
        into[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {into[name]}s", file=sys.stderr, flush=True)

    if not only:
        ctx = get_context(spark, sf_dir)
        for name in FACTS:
            timed(build, name, lambda: getattr(ctx, name))
        for name in BUILDERS:
            timed(build, f"mart:{name}", lambda: mart(ctx, name))
        timed(build, "models", lambda: ctx.models)
    for name in names:
        timed(times, name, lambda: reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save())
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = sum(times.values()) + sum(build.values())
    print(json.dumps({"metric": "headline_pipeline_total", "value": round(total, 3), "unit": "sec", "queries": times,
                      "build": build, "round_1_total": ROUND_1_TOTAL, "sf": float(sf) if sf else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
