"""Registered queries: the late-delivery model.

Dataset, split and class weights are relational and have SQL oracles. The
evaluation operators (metrics, confusion matrix, AUC, risk bands, lift) are
checked against SQL on a fixed score derived from the data (approval lag
mapped to [0, 1)); on the fitted models' scores they are rows-only checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ml
from .registry import register

ML_CTE = """
ml_items AS (
  SELECT order_id, count(order_item_id) AS order_item_count,
         CAST(coalesce(sum(freight_value), 0) AS DOUBLE) AS total_freight_value,
         avg(product_weight_g) AS avg_weight_g, avg(product_volume_cm3) AS avg_volume_cm3,
         count(DISTINCT seller_id) AS unique_sellers,
         arg_min(seller_state, order_item_id) FILTER (WHERE seller_state IS NOT NULL) AS seller_state
  FROM full_t WHERE order_status = 'delivered' GROUP BY 1),
ml_ds AS (
  SELECT d.order_id, d.order_purchase_timestamp,
         CAST(floor((epoch_us(d.order_estimated_delivery_date) - epoch_us(d.order_purchase_timestamp)) / 86400000000.0) AS BIGINT) AS days_to_estimated,
         i.total_freight_value, i.avg_weight_g, i.avg_volume_cm3, i.order_item_count, i.unique_sellers,
         CAST(d.payment_installments AS DOUBLE) AS payment_installments,
         (epoch_us(d.order_approved_at) - epoch_us(d.order_purchase_timestamp)) / 3600000000.0 AS approval_lag_hours,
         month(d.order_purchase_timestamp) AS purchase_month, isodow(d.order_purchase_timestamp) - 1 AS purchase_dayofweek,
         d.customer_state, i.seller_state, d.payment_type, d.is_late
  FROM del_valid d LEFT JOIN ml_items i ON d.order_id = i.order_id),
ml_cut AS (
  SELECT order_purchase_timestamp AS cutoff FROM (
    SELECT order_purchase_timestamp, row_number() OVER (ORDER BY order_purchase_timestamp) - 1 AS i, count(*) OVER () AS n
    FROM ml_ds) WHERE i = floor(n * 0.8)),
ml_train AS (SELECT ml_ds.* FROM ml_ds, ml_cut WHERE order_purchase_timestamp < cutoff),
ml_test AS (SELECT ml_ds.* FROM ml_ds, ml_cut WHERE order_purchase_timestamp >= cutoff),
rs AS (SELECT order_id, is_late AS label,
              coalesce(approval_lag_hours / (1 + approval_lag_hours), 0) AS score FROM ml_test),
rs_cm AS (
  SELECT count(*) FILTER (WHERE label = 0 AND score < 0.5) AS TN, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS FP,
         count(*) FILTER (WHERE label = 1 AND score < 0.5) AS FN, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS TP
  FROM rs),
rs_bands AS (
  SELECT b.*, b.order_count::DOUBLE / (SELECT count(*) FROM rs) * 100 AS order_pct,
         CASE b.risk_band WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS bucket_ord
  FROM (SELECT CASE WHEN score >= q.p66 THEN 'High' WHEN score >= q.p33 THEN 'Medium' ELSE 'Low' END AS risk_band,
               q.p33 AS p33_threshold, q.p66 AS p66_threshold, count(*) AS order_count,
               avg(label) * 100 AS actual_late_pct, avg(score) AS avg_pred_prob
        FROM rs, (SELECT quantile_cont(score, 0.33) AS p33, quantile_cont(score, 0.66) AS p66 FROM rs) q
        GROUP BY 1, 2, 3) b)
"""

DS_SPEC = ("order_id:i, order_purchase_timestamp:t, days_to_estimated:i, total_freight_value:d, avg_weight_g:d, "
           "avg_volume_cm3:d, order_item_count:i, unique_sellers:i, payment_installments:d, approval_lag_hours:d, "
           "purchase_month:i, purchase_dayofweek:i, customer_state:s, seller_state:s, payment_type:s, is_late:i")


def rule_scored(c):
    _, test, _ = c.split
    return test.select("order_id", F.col("is_late").alias("label"),
                       F.coalesce(F.col("approval_lag_hours") / (1 + F.col("approval_lag_hours")), F.lit(0.0)).alias("score"))


register("ml_item_features",
         "order_id:i, order_item_count:i, total_freight_value:d, avg_weight_g:d, avg_volume_cm3:d, unique_sellers:i, seller_state:s",
         "SELECT * FROM ml_items", ML_CTE)(lambda c: ml.ml_item_features(c.full))
register("ml_dataset", DS_SPEC, "SELECT * FROM ml_ds", ML_CTE)(lambda c: c.ml_dataset)
register("time_split", "cutoff:t, train_orders:i, test_orders:i, train_late_pct:d, test_late_pct:d",
         """SELECT c.cutoff, count(*) FILTER (WHERE d.order_purchase_timestamp < c.cutoff) AS train_orders,
                   count(*) FILTER (WHERE d.order_purchase_timestamp >= c.cutoff) AS test_orders,
                   avg(d.is_late) FILTER (WHERE d.order_purchase_timestamp < c.cutoff) * 100 AS train_late_pct,
                   avg(d.is_late) FILTER (WHERE d.order_purchase_timestamp >= c.cutoff) * 100 AS test_late_pct
            FROM ml_ds d, ml_cut c GROUP BY c.cutoff""", ML_CTE)(lambda c: ml.split_summary(c.ml_dataset))

_NUM_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median, CAST(NULL AS VARCHAR) AS mode FROM ml_train"
                              for c in ml.NUMERIC_FEATURES)
_CAT_SQL = " UNION ALL ".join(
    f"""SELECT '{c}', CAST(NULL AS DOUBLE), (SELECT {c} FROM ml_train WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
    for c in ml.CATEGORICAL_FEATURES)
register("ml_preprocess", "feature:s, median:d, mode:s", f"{_NUM_SQL} UNION ALL {_CAT_SQL}", ML_CTE)(
    lambda c: ml.imputation_values(c.split[0]))
register("class_weights", "is_late:i, class_count:i, weight:d",
         """SELECT is_late, count(*) AS class_count, (SELECT count(*) FROM ml_train) / (2.0 * count(*)) AS weight
            FROM ml_train GROUP BY 1""", ML_CTE)(lambda c: ml.class_weights(c.split[0]))
register("check_split_disjoint", "overlap:i, passed:b",
         """SELECT count(*) AS overlap, count(*) = 0 AS passed FROM ml_train WHERE order_id IN (SELECT order_id FROM ml_test)""",
         ML_CTE)(lambda c: ml.check_split_disjoint(c.split[0], c.split[1]))

METRIC_SPEC = "TN:i, FP:i, FN:i, TP:i, accuracy:d, precision:d, recall:d, fpr:d, fnr:d, f1:d"
register("ml_metrics_rule_score", METRIC_SPEC,
         """SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1 FROM (
              SELECT TN, FP, FN, TP, coalesce((TP + TN)::DOUBLE / NULLIF(TP + TN + FP + FN, 0), 0) AS accuracy,
                     coalesce(TP::DOUBLE / NULLIF(TP + FP, 0), 0) AS precision, coalesce(TP::DOUBLE / NULLIF(TP + FN, 0), 0) AS recall,
                     coalesce(FP::DOUBLE / NULLIF(FP + TN, 0), 0) AS fpr, coalesce(FN::DOUBLE / NULLIF(FN + TP, 0), 0) AS fnr
              FROM rs_cm)""", ML_CTE)(lambda c: ml.classification_metrics(rule_scored(c)))
register("ml_confusion_rule_score", "TN:i, FP:i, FN:i, TP:i", "SELECT * FROM rs_cm", ML_CTE)(
    lambda c: ml.confusion_matrix(rule_scored(c)))
register("ml_roc_auc_rule_score", "positives:i, negatives:i, roc_auc:d",
         """SELECT sum(pos) AS positives, sum(neg) AS negatives,
                   sum(pos * (below + neg / 2.0)) / NULLIF(sum(pos) * sum(neg), 0) AS roc_auc
            FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                  FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
                        FROM rs GROUP BY score))""", ML_CTE)(lambda c: ml.roc_auc(rule_scored(c)))
BAND_SPEC = ("risk_band:s, bucket_ord:i, order_count:i, order_pct:d, actual_late_pct:d, avg_pred_prob:d, "
             "p33_threshold:d, p66_threshold:d")
register("ml_risk_bands_rule_score", BAND_SPEC, "SELECT * FROM rs_bands", ML_CTE)(
    lambda c: ml.risk_bands(rule_scored(c)))
register("band_lift_rule_score", "base_late_pct:d, high_late_pct:d, lift:d",
         """SELECT b.base_late_pct, h.actual_late_pct AS high_late_pct, h.actual_late_pct / NULLIF(b.base_late_pct, 0) AS lift
            FROM (SELECT avg(label) * 100 AS base_late_pct FROM rs) b, (SELECT * FROM rs_bands WHERE risk_band = 'High') h""",
         ML_CTE)(lambda c: ml.band_lift(rule_scored(c)))
register("check_band_monotonic_rule_score", "violations:i, passed:b",
         """SELECT count(*) FILTER (WHERE actual_late_pct < prev) AS violations,
                   count(*) FILTER (WHERE actual_late_pct < prev) = 0 AS passed
            FROM (SELECT actual_late_pct, lag(actual_late_pct) OVER (ORDER BY bucket_ord) AS prev FROM rs_bands)""",
         ML_CTE)(lambda c: ml.check_band_monotonic(ml.risk_bands(rule_scored(c))))

# fitted models: rows-only checks
register("ml_model_metrics", "model:s, " + METRIC_SPEC + ", roc_auc:d")(lambda c: ml.model_metrics(c.models))
register("ml_confusion_matrix", "model:s, TN:i, FP:i, FN:i, TP:i")(
    lambda c: ml.confusion_matrix(c.models.lr_scored).withColumn("model", F.lit("logistic_regression"))
    .unionByName(ml.confusion_matrix(c.models.rf_scored).withColumn("model", F.lit("random_forest"))))
register("ml_feature_importance", "feature:s, importance:d")(lambda c: ml.feature_importance(c.spark, c.models))
register("ml_lr_coefficients", "feature:s, coefficient:d, abs_coefficient:d, direction:s")(
    lambda c: ml.lr_coefficients(c.spark, c.models))
register("ml_risk_bands", BAND_SPEC)(lambda c: ml.risk_bands(c.models.rf_scored))
