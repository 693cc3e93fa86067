"""Results must not depend on how the data is partitioned: the same queries
with 1 and with 64 shuffle partitions give identical rows."""

import os

import pytest

SF = "/root/testdata/sf0.001"
NAMES = ["orders_master", "payments_per_order", "reviews_latest_per_order", "customer_rfm", "category_performance",
         "seller_performance", "rfm_segment_summary", "top_decile_share", "time_split", "geolocation_by_zip"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="testdata not available")
def test_results_independent_of_shuffle_partitions(spark):
    from marketlens.plans.context import MarketContext
    from marketlens.plans.contracts import spark_project
    from marketlens.plans.registry import load_all
    reg = load_all()
    results = {}
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        ctx = MarketContext(spark, SF, materialize="none")
        results[parts] = {n: sorted(tuple(r) for r in spark_project(reg[n].build(ctx), reg[n].spec).collect())
                          for n in NAMES}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    for n in NAMES:
        assert results["1"][n] == results["64"][n], n
