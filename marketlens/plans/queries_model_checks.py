"""Registered queries: what the fitted models must satisfy. The numbers of a fit
have no SQL twin, but its certificates do: moments and slots are recomputed by
SQL, and each verdict is expected to hold for every feature that SQL finds in
the training rows."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..operators import insights as ins
from ..operators import ml
from ..operators import model_checks as mc
from ..operators.quality import union_all
from ..operators.stats import with_scalars
from .queries_io import _scratch
from .queries_ml import ML_CTE
from .queries_serve import _ml
from .registry import register

_IMPUTED = ", ".join(
    [f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM ml_train)) AS {c}" for c in ml.NUMERIC_FEATURES]
    + [f"coalesce({c}, (SELECT {c} FROM ml_train WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS {c}" for c in ml.CATEGORICAL_FEATURES])
CHECK_CTE = ML_CTE.rstrip() + f""",
ml_imputed AS (SELECT order_id, is_late, {_IMPUTED} FROM ml_train),
ml_levels AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS level, count(*) AS train_rows FROM ml_imputed GROUP BY 2" for c in ml.CATEGORICAL_FEATURES)}),
ml_names AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature" for c in ml.NUMERIC_FEATURES)} UNION ALL SELECT feature || '_' || level FROM ml_levels)
"""

register("ml_scaler_moments", "feature:s, mean:d, deviation:d, fitted:b",
         " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS deviation, TRUE AS fitted FROM ml_imputed"
                            for c in ml.NUMERIC_FEATURES), CHECK_CTE)(lambda c: mc.scaler_moments(c.models))
register("ml_onehot_slots", "feature:s, level:s, slot:i, train_rows:i, fitted:b",
         """SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS slot, train_rows, TRUE AS fitted
            FROM ml_levels""", CHECK_CTE)(lambda c: mc.onehot_slots(c.models))

register("train_logistic", "feature:s, train_rows:i, weight_sum:d, optimal:b",
         """SELECT feature, n AS train_rows, CAST(n AS DOUBLE) AS weight_sum, TRUE AS optimal
            FROM (SELECT * FROM ml_names UNION ALL SELECT '(intercept)'), (SELECT count(*) AS n FROM ml_train)""", CHECK_CTE)(
    lambda c: mc.logistic_optimality(c.models))


def _nodes(c):
    if "forest_nodes" not in c.cache:
        c.cache["forest_nodes"] = mc.forest_nodes(c.models.rf.stages[-1], _scratch(c, "forest"))
    return c.cache["forest_nodes"]


_ZEROS = ("small_leaves", "unknown_splits", "children", "sums", "impurities", "gains", "orphans", "score_mismatches",
          "too_deep", "leaves_not_reached", "leaves_unknown", "leaf_shares", "importances")
register("train_forest", "check:s, value:i",
         """SELECT 'trees' AS "check", 200 AS value UNION ALL SELECT 'routed_rows', 200 * count(*) FROM ml_train
            UNION ALL SELECT 'scored_rows', count(*) FROM ml_train """
         + " ".join(f"UNION ALL SELECT '{z}', 0" for z in _ZEROS), CHECK_CTE)(lambda c: mc.forest_checks(c.models, _nodes(c)))
register("ml_forest_importance", "feature:s, equal:b", "SELECT feature, TRUE AS equal FROM ml_names", CHECK_CTE)(
    lambda c: mc.importance_check(c.models, _nodes(c)))


def _cross_check(c):
    """Our metrics of both models against Spark's own evaluators."""
    parts = []
    ours = ml.model_metrics(c.models)
    for name, scored in (("logistic_regression", c.models.lr_scored), ("random_forest", c.models.rf_scored)):
        p = scored.select(F.col("label").cast("double").alias("label"), F.col("pred").cast("double").alias("prediction"),
                          array_to_vector(F.array(1 - F.col("score"), "score")).alias("raw"))
        theirs = {"roc_auc": BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(p)}
        for metric, own in (("accuracy", "accuracy"), ("precisionByLabel", "precision"), ("recallByLabel", "recall"),
                            ("fMeasureByLabel", "f1"), ("falsePositiveRateByLabel", "fpr")):
            theirs[own] = MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0).evaluate(p)
        row = ours.where(F.col("model") == name)
        parts += [row.select("model", F.lit(m).alias("metric"), (F.abs(F.col(m) - F.lit(v)) < 1e-9).alias("agrees")) for m, v in theirs.items()]
    return union_all(parts)


register("ml_metrics_cross_check", "model:s, metric:s, agrees:b",
         """SELECT m AS model, k AS metric, TRUE AS agrees FROM (VALUES ('logistic_regression'), ('random_forest')) a(m),
            (VALUES ('roc_auc'), ('accuracy'), ('precision'), ('recall'), ('f1'), ('fpr')) b(k)""")(_cross_check)


def _model_rules(c):
    tm = c.models
    rules = ins.ml_rules(ml.model_metrics(tm), ml.split_summary(c.ml_dataset), ml.feature_importance(c.spark, tm), ml.lr_coefficients(c.spark, tm))
    return union_all(rules)


def _m1(c):
    """The evidence of the model's insight that the data alone settle."""
    wide = _model_rules(c).where(F.col("insight_id") == "M1_lr_model_performance").agg(*[
        F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in (
            "train_orders", "test_orders", "train_late_pct", "test_late_pct", "true_positives", "false_negatives", "false_positives", "true_negatives")])
    return wide.select("train_orders", "test_orders", "train_late_pct", "test_late_pct",
                       (F.col("true_positives") + F.col("false_negatives")).alias("late_orders"),
                       (F.col("false_positives") + F.col("true_negatives")).alias("punctual_orders"))


register("insight_M1_evidence", "train_orders:i, test_orders:i, train_late_pct:d, test_late_pct:d, late_orders:i, punctual_orders:i",
         """SELECT (SELECT count(*) FROM ml_train) AS train_orders, count(*) AS test_orders, (SELECT avg(is_late) * 100 FROM ml_train) AS train_late_pct,
                   avg(is_late) * 100 AS test_late_pct, count(*) FILTER (WHERE is_late = 1) AS late_orders,
                   count(*) FILTER (WHERE is_late = 0) AS punctual_orders FROM ml_test""", ML_CTE)(_m1)


def _m2(c):
    """Are the features that the insight names those of the largest rebuilt
    importance, and of the largest fitted coefficients?"""
    named = _model_rules(c).where(F.col("insight_id") == "M2_predictive_features").select(
        F.split("metric", ":", 2)[0].alias("kind"), F.split("metric", ":", 2)[1].alias("feature"))
    lr = c.models.lr.stages[-1]
    names = ml.feature_names(c.models.lr, c.models.lr.transform(c.models.test.limit(1)))
    sizes = c.spark.createDataFrame([(n, abs(float(v))) for n, v in zip(names, lr.coefficients.toArray())], "feature string, size double")
    rebuilt = mc.importance_check(c.models, _nodes(c)).select("feature", F.col("rebuilt").alias("size"))
    top = union_all([df.orderBy(F.col("size").desc(), "feature").limit(3).select(F.lit(kind).alias("kind"), "feature")
                     for kind, df in (("importance", rebuilt), ("coefficient", sizes))])
    return named.groupBy("kind").agg(F.count(F.lit(1)).alias("named")).join(
        named.join(top, ["kind", "feature"], "left_semi").groupBy("kind").agg(F.count(F.lit(1)).alias("largest")), "kind")


register("insight_M2_evidence", "kind:s, named:i, largest:i",
         "SELECT k AS kind, 3 AS named, 3 AS largest FROM (VALUES ('importance'), ('coefficient')) t(k)")(_m2)


def _serve_ml(c):
    """Rows of each frame of the model route, and whether they are its largest."""
    frames = _ml(c)
    full = {"feature_importance": (ml.feature_importance(c.spark, c.models), "importance"),
            "coefficients": (ml.lr_coefficients(c.spark, c.models), "abs_coefficient")}
    parts = []
    for name, df in frames.items():
        rows = df.agg(F.count(F.lit(1)).alias("rows"))
        if name in full:
            every, size = full[name]
            left = every.join(df.select("feature"), "feature", "left_anti").agg(F.max(size).alias("__left"))
            ok = with_scalars(df.agg(F.min(size).alias("__least")), left).select(
                F.coalesce(F.col("__least") >= F.col("__left"), F.lit(True)).alias("largest"))
        else:
            ok = rows.select(F.lit(True).alias("largest"))
        parts.append(with_scalars(rows, ok).select(F.lit(name).alias("frame"), "rows", "largest"))
    return union_all(parts)


register("serve_ml", "frame:s, rows:i, largest:b",
         """SELECT f AS frame, CASE WHEN f IN ('metrics', 'confusion_matrices') THEN 2 ELSE least(15, (SELECT count(*) FROM ml_names)) END AS rows,
                   TRUE AS largest FROM (VALUES ('metrics'), ('confusion_matrices'), ('feature_importance'), ('coefficients')) t(f)""",
         CHECK_CTE)(_serve_ml)
