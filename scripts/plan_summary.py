"""Summarise the physical plans of registered queries (from explain('formatted')):
exchanges, join strategies, aggregate kinds, windows, scalar subqueries and the
scan read-schemas. Writes a markdown table to stdout.

    python scripts/plan_summary.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["orders_master", "customer_rfm", "category_performance", "seller_performance", "state_performance",
           "monthly_trends", "delivery_by_state_enriched", "review_by_delay_detailed", "rfm_segment_summary",
           "top_decile_share", "customer_geography", "time_split"]
KINDS = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
         "Window", "Subquery", "Scan parquet"]


def main() -> None:
    from marketlens.plans.context import MarketContext
    from marketlens.plans.contracts import spark_project
    from marketlens.plans.registry import load_all
    from marketlens.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    ctx = MarketContext(spark, sf, materialize="none")      # whole lineage, from the parquet scans
    ctx._keep_eager = lambda df: df                          # shared marts stay lazy here
    print("| query | " + " | ".join(KINDS) + " |")
    print("|---|" + "---|" * len(KINDS))
    schemas = set()
    for n in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            spark_project(reg[n].build(ctx), reg[n].spec).explain("formatted")
        text = buf.getvalue()
        head = text.split("\n\n(")[0]                     # the operator tree only
        counts = [len(re.findall(rf"\b{re.escape(k)}\b", head)) for k in KINDS]
        counts[KINDS.index("Subquery")] = len(re.findall(r"^Subquery:", text, re.M))
        print(f"| {n} | " + " | ".join(str(c) for c in counts) + " |")
        schemas.update(re.findall(r"ReadSchema: (struct<[^\n]*>)", text))
    print("\nScan read-schemas (column pruning):\n")
    for s in sorted(schemas):
        print(f"- `{s}`")
    spark.stop()


if __name__ == "__main__":
    main()
