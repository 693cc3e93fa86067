"""Hand-made edge cases for the cleaning, fact, mart, RFM and ML operators."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marketlens.operators import clean, delivery, facts, marts, ml, quality
from marketlens.operators.rfm import customer_rfm, segment_of

T0 = dt.datetime(2021, 3, 1, 10, 0)


def _h(h):
    return T0 + dt.timedelta(hours=h)


def test_latest_review_skips_nulls_per_column(spark):
    rows = [(1, 10, 5, "first", _h(0)), (2, 10, 3, None, _h(24)), (3, 10, None, None, _h(48)),
            (4, 11, 4, "only", _h(1))]
    df = spark.createDataFrame(rows, "review_id int, order_id int, review_score int, review_comment_message string, "
                                     "review_creation_date timestamp_ntz")
    got = {r.order_id: r for r in clean.reviews_latest_per_order(df).collect()}
    assert got[10].review_score == 3              # latest score is null: previous one
    assert got[10].review_comment_message == "first"
    assert got[10].review_id == 3 and got[10].review_event_count == 3
    assert got[11].review_score == 4


def test_dominant_payment_type_ties_to_lowest_sequential(spark):
    rows = [(1, 1, "voucher", 1, 10.0), (1, 2, "card", 3, 5.0), (1, 3, "card", 1, 1.0), (1, 4, "voucher", 2, 1.0),
            (2, 2, "boleto", 1, 7.0), (2, 1, "card", 1, 7.0)]
    df = spark.createDataFrame(rows, "order_id int, payment_sequential int, payment_type string, "
                                     "payment_installments int, payment_value double") \
        .withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)"))
    got = {r.order_id: r for r in clean.payments_per_order(df).collect()}
    assert got[1].payment_type == "voucher"      # 2 vs 2 rows: voucher seen at sequential 1
    assert got[2].payment_type == "card"         # 1 vs 1: card has sequential 1
    assert float(got[1].total_payment_value) == 17.0 and got[1].payment_installments == 3
    assert got[1].payment_methods_count == 4


def _tiny_sources(spark):
    orders = spark.createDataFrame([
        (1, 1, "delivered", _h(0), _h(1), _h(24 * 5), _h(24 * 10)),      # early
        (2, 2, "delivered", _h(0), _h(1), _h(24 * 10 + 5), _h(24 * 10)), # 5 h late: on time
        (3, 3, "delivered", _h(0), _h(1), _h(24 * 11), _h(24 * 10)),     # 24 h late
        (4, 4, "canceled", _h(0), None, None, _h(24 * 10)),
        (5, 5, "delivered", _h(0), _h(1), _h(24 * 3), _h(24 * 10)),      # no items
    ], "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp_ntz, "
       "order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
       "order_estimated_delivery_date timestamp_ntz")
    customers = spark.createDataFrame([(1, 100, "1037", "c", "SP"), (2, 100, "1037", "c", "SP"),
                                       (3, 200, "123456", "d", "RJ"), (4, 300, "9", "e", "MG"),
                                       (5, 400, "9", "e", "AC")],
                                      "customer_id int, customer_unique_id int, customer_zip_code_prefix string, "
                                      "customer_city string, customer_state string")
    items = spark.createDataFrame([(1, 1, 7, 70, 10.0, 1.0), (1, 2, 8, 70, 5.0, 1.0), (2, 1, 8, 71, 20.0, 2.0),
                                   (3, 1, 9, 71, 30.0, 3.0), (4, 1, 7, 70, 1.0, 0.0)],
                                  "order_id int, order_item_id int, product_id int, seller_id int, "
                                  "price double, freight_value double") \
        .withColumn("price", F.col("price").cast("decimal(18,2)")) \
        .withColumn("freight_value", F.col("freight_value").cast("decimal(18,2)"))
    return orders, clean.clean_customers(customers), items


def test_master_grain_and_delivery_features(spark):
    orders, customers, items = _tiny_sources(spark)
    empty_pay = spark.createDataFrame([], "order_id int, total_payment_value decimal(28,2), payment_installments int, "
                                          "payment_type string, payment_methods_count bigint")
    empty_rev = spark.createDataFrame([], "order_id int, review_score int, review_event_count bigint, "
                                          "review_comment_message string, review_creation_date timestamp_ntz")
    m = facts.orders_master(orders, customers, empty_pay, empty_rev, items)
    got = {r.order_id: r for r in m.collect()}
    assert len(got) == 5 and m.count() == 5
    assert got[1].delivery_delay_days == -5 and got[1].is_late == 0
    assert got[2].delivery_delay_days == 0 and got[2].is_late == 0
    assert got[3].delivery_delay_days == 1 and got[3].is_late == 1
    assert got[4].is_late is None and got[4].delivery_days is None and got[4].estimated_days == 10
    assert got[5].product_sales_value is None and got[5].order_value is None    # no items: null sums
    assert got[1].customer_zip_code_prefix == "01037" and got[3].customer_zip_code_prefix == "123456"
    rfm = {r.customer_unique_id: r for r in customer_rfm(m).collect()}
    assert float(rfm[400].monetary) == 0.0                                     # ... but 0 spend in RFM
    assert rfm[100].frequency == 2
    checks = {r.check: r.passed for r in quality.union_all([
        quality.check_unique_key(m, "order_id", "u"),
        quality._check(m.agg(F.count(F.lit(1)).alias("n")), "rows", F.col("n"), F.lit(5), None)]).collect()}
    assert all(checks.values())


def test_empty_bucket_kept_with_zero_and_no_delivery_group_null(spark):
    orders, customers, items = _tiny_sources(spark)
    empty_pay = spark.createDataFrame([], "order_id int, total_payment_value decimal(28,2), payment_installments int, "
                                          "payment_type string, payment_methods_count bigint")
    rev = spark.createDataFrame([(1, 5, 1, None, _h(1))], "order_id int, review_score int, review_event_count bigint, "
                                                          "review_comment_message string, review_creation_date timestamp_ntz")
    m = facts.orders_master(orders, customers, empty_pay, rev, items)
    dist = {r.delay_bucket: r.order_count for r in marts.delivery_delay_dist(spark, m).collect()}
    assert len(dist) == 7 and dist["Late >14d"] == 0 and dist["Early 3-7d"] == 1
    detailed = delivery.review_by_delay_detailed(m).collect()
    assert [r.delay_bucket for r in detailed] == ["Early 3-7d"]                  # empty buckets dropped here
    st = {r.customer_state: r for r in marts.state_performance(m).collect()}
    assert st["MG"].late_pct is None and st["MG"].order_count == 1              # no deliveries: null, no error


def test_orphans_are_counted(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    r = quality.orphan_check(child, "k", parent, "k", "x").collect()[0]
    assert (r.orphans, r.total) == (2, 3)


def _pandas_f_score(freq):
    s = pd.Series(freq)
    return pd.qcut(s.rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


def test_f_score_closed_form_matches_rank_qcut():
    for n in [5, 6, 7, 11, 23, 100, 257, 1000]:
        rng = np.random.default_rng(n)
        freq = sorted(rng.integers(1, 4, n).tolist())
        expected = _pandas_f_score(freq)
        ours = [max(1, math.ceil(5 * (r - 1) / (n - 1))) for r in range(1, n + 1)]
        assert ours == expected, n


def test_segment_rule_order(spark):
    df = spark.createDataFrame([(5, 5, 5), (3, 3, 3), (5, 1, 1), (3, 2, 1), (1, 4, 4), (1, 1, 1), (2, 5, 1)],
                               "r int, f int, m int")
    got = [x.s for x in df.select(segment_of(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()]
    assert got == ["Champions", "Loyal Customers", "New Customers", "Potential Loyalists", "At Risk",
                   "Lost / Inactive", "Needs Attention"]             # (1,4,4) is At Risk: 'Cannot Lose Them' unreachable


def test_unseen_category_encodes_to_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("zzz",)], "c string")
    model = Pipeline(stages=[StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep"),
                             OneHotEncoder(inputCol="i", outputCol="v", dropLast=True)]).fit(train)
    vecs = [r.v.toArray().tolist() for r in model.transform(test).collect()]
    assert sum(vecs[0]) == 1.0 and vecs[1] == [0.0] * len(vecs[1])


def test_metrics_and_auc_against_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(0.3 * y + rng.random(400) * 0.7, 0, 1), 2)            # ties on purpose
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    auc = ml.roc_auc(df).collect()[0].roc_auc
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(auc - brute) < 1e-12
    m = ml.classification_metrics(df).collect()[0]
    pred = (s >= 0.5).astype(int)
    tp = int(((pred == 1) & (y == 1)).sum())
    assert m.TP == tp and abs(m.recall - tp / (y == 1).sum()) < 1e-12


def test_null_dimension_keys_are_left_out(spark):
    """An order whose customer row is missing has no state: like a pandas
    groupby, the state marts leave it out instead of making a null group."""
    orders, customers, items = _tiny_sources(spark)
    customers = customers.where(F.col("customer_id") != 5)
    empty_pay = spark.createDataFrame([], "order_id int, total_payment_value decimal(28,2), payment_installments int, "
                                          "payment_type string, payment_methods_count bigint")
    empty_rev = spark.createDataFrame([], "order_id int, review_score int, review_event_count bigint, "
                                          "review_comment_message string, review_creation_date timestamp_ntz")
    m = facts.orders_master(orders, customers, empty_pay, empty_rev, items)
    states = [r.customer_state for r in marts.state_performance(m).collect()]
    assert None not in states and sorted(states) == ["MG", "RJ", "SP"]
    assert None not in [r.customer_state for r in delivery.delivery_by_state_enriched(m).collect()]
