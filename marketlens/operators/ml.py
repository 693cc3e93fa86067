"""Late-delivery classifier with ``pyspark.ml``.

Dataset: delivered orders with a known late flag, item-level features rolled
up per order, derived time features; columns known only after delivery are
never selected. Split: by time — the cutoff is the purchase timestamp at
0-based position floor(0.8 n) in time order (an exact distributed order
statistic); earlier orders train, the rest test. Preprocessing is fitted on
the training set only: numeric median imputation + standard scaling,
categorical most-frequent imputation + one-hot (unknown levels encode to all
zeros). Models: class-weighted (balanced) logistic regression and random
forest. Metrics, AUC, confusion matrix and risk bands are plain aggregates
over a (label, score) frame, so they can be checked against SQL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, storage_memory
from ..functions import floor_days, hours_between, pct, safe_div, weekday_monday0
from .marts import del_valid, is_delivered
from .stats import attach, exact_quantiles, values_at_ranks, with_range_bucket, with_scalars

# Model features and target.
NUMERIC_FEATURES = ["days_to_estimated", "total_freight_value", "avg_weight_g", "avg_volume_cm3",
                    "order_item_count", "unique_sellers", "payment_installments", "approval_lag_hours",
                    "purchase_month", "purchase_dayofweek"]
CATEGORICAL_FEATURES = ["customer_state", "seller_state", "payment_type"]
TARGET = "is_late"
SEED = 42
FIT_TASKS_A_CORE = 3      # every task of a fit sends the statistics of all nodes
FIT_ROWS = 1_000_000      # of a task at most, where the cores' share is larger
NODE_IDS_KEPT = 3         # Spark holds this many generations of them
FIT_MEMORY = 0.5          # the part of the executors' memory that tasks leave to cached rows


def ml_item_features(full: DataFrame) -> DataFrame:
    it = full.where(is_delivered())
    return it.groupBy("order_id").agg(
        F.count("order_item_id").alias("order_item_count"),
        F.coalesce(F.sum("freight_value"), F.lit(0)).cast("double").alias("total_freight_value"),
        F.avg("product_weight_g").alias("avg_weight_g"),
        F.avg("product_volume_cm3").alias("avg_volume_cm3"),
        F.count_distinct("seller_id").alias("unique_sellers"),
        F.min_by("seller_state", F.when(F.col("seller_state").isNotNull(), F.col("order_item_id"))).alias("seller_state"))


def ml_dataset(master: DataFrame, full: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    base = del_valid(master).select("order_id", "order_purchase_timestamp", "order_approved_at",
                                    "order_estimated_delivery_date", "customer_state", "payment_type",
                                    "payment_installments", TARGET)
    df = base.join(ml_item_features(full), "order_id", "left")
    return df.select(
        "order_id", "order_purchase_timestamp",
        floor_days("order_estimated_delivery_date", "order_purchase_timestamp").alias("days_to_estimated"),
        F.col("total_freight_value"), F.col("avg_weight_g"), F.col("avg_volume_cm3"),
        F.col("order_item_count"), F.col("unique_sellers"),
        F.col("payment_installments").cast("double").alias("payment_installments"),
        hours_between("order_approved_at", "order_purchase_timestamp").alias("approval_lag_hours"),
        F.month(ts).alias("purchase_month"), weekday_monday0(ts).alias("purchase_dayofweek"),
        "customer_state", "seller_state", "payment_type",
        F.col(TARGET).cast("int").alias(TARGET))


def _epoch() -> F.Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def split_cutoff(ds: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """One row: the cutoff timestamp and the dataset size."""
    micros = F.timestamp_diff("MICROSECOND", _epoch(), F.col("order_purchase_timestamp"))
    cut = values_at_ranks(ds.select(micros.alias("__us")), "__us",
                          {"__cut": lambda n: F.floor(n * F.lit(train_frac))})
    return cut.select(F.timestamp_add("MICROSECOND", F.col("__cut").cast("bigint"), _epoch()).alias("cutoff"),
                      F.col("n").alias("n_orders"))


def time_split(ds: DataFrame, train_frac: float = 0.8) -> tuple[DataFrame, DataFrame, DataFrame]:
    # the one-row cutoff feeds both sides: compute it once
    cut = split_cutoff(ds, train_frac).persist()
    cut.count()
    tagged = with_scalars(ds, cut.select("cutoff"))
    train = tagged.where(F.col("order_purchase_timestamp") < F.col("cutoff")).drop("cutoff")
    test = tagged.where(F.col("order_purchase_timestamp") >= F.col("cutoff")).drop("cutoff")
    return train, test, cut


def split_summary(ds: DataFrame, train_frac: float = 0.8) -> DataFrame:
    cut = split_cutoff(ds, train_frac)
    s = with_scalars(ds, cut.select("cutoff"))
    tr = F.col("order_purchase_timestamp") < F.col("cutoff")
    return s.groupBy("cutoff").agg(
        F.count_if(tr).alias("train_orders"), F.count_if(~tr).alias("test_orders"),
        (F.avg(F.when(tr, F.col(TARGET))) * 100).alias("train_late_pct"),
        (F.avg(F.when(~tr, F.col(TARGET))) * 100).alias("test_late_pct"))


def check_split_disjoint(train: DataFrame, test: DataFrame) -> DataFrame:
    both = train.select("order_id").join(test.select("order_id"), "order_id", "left_semi")
    return both.agg(F.count(F.lit(1)).alias("overlap")).withColumn("passed", F.col("overlap") == 0)


def class_weights(train: DataFrame) -> DataFrame:
    """'balanced' weights n / (2 n_class), one row per class."""
    counts = train.groupBy(TARGET).agg(F.count(F.lit(1)).alias("class_count"))
    tot = train.agg(F.count(F.lit(1)).alias("__n"))
    return with_scalars(counts, tot).withColumn(
        "weight", F.col("__n") / (F.lit(2.0) * F.col("class_count"))).drop("__n")


def with_weights(train: DataFrame) -> DataFrame:
    w = class_weights(train).select(TARGET, "weight")
    return train.join(F.broadcast(w), TARGET, "left")   # at most two rows


def mode_imputer(train: DataFrame, cols: list[str]) -> DataFrame:
    """One row holding each column's most frequent non-null training value
    (ties to the smallest value). All columns in one pass: the categorical
    columns are unpivoted to (column, value) and counted together."""
    long = train.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "__col", "__val").where(F.col("__val").isNotNull())
    counts = long.groupBy("__col", "__val").agg(F.count(F.lit(1)).alias("__n"))
    modes = counts.groupBy("__col").agg(
        F.min_by("__val", F.struct((-F.col("__n")).alias("k"), F.col("__val").alias("v"))).alias("__mode"))
    return modes.agg(*[F.max(F.when(F.col("__col") == c, F.col("__mode"))).alias(f"__mode_{c}") for c in cols])


def median_imputer(train: DataFrame, cols: list[str]) -> DataFrame:
    """One row holding each numeric column's exact training median."""
    long = train.select(*cols).unpivot([], cols, "__col", "__val")
    med = exact_quantiles(long, "__val", {"__median": 0.5}, keys=["__col"])
    return med.agg(*[F.max(F.when(F.col("__col") == c, F.col("__median"))).alias(f"__median_{c}") for c in cols])


def apply_medians(df: DataFrame, medians: DataFrame, cols: list[str]) -> DataFrame:
    out = with_scalars(df, medians)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__median_{c}"))).drop(f"__median_{c}")
    return out


def imputation_values(train: DataFrame) -> DataFrame:
    """What missing values become: per feature the exact training median, or
    the most frequent training value."""
    med = median_imputer(train, NUMERIC_FEATURES).unpivot([], [f"__median_{c}" for c in NUMERIC_FEATURES], "feature", "median")
    modes = mode_imputer(train, CATEGORICAL_FEATURES).unpivot([], [f"__mode_{c}" for c in CATEGORICAL_FEATURES], "feature", "mode")
    med = med.select(F.regexp_replace("feature", "^__median_", "").alias("feature"), "median", F.lit(None).cast("string").alias("mode"))
    return med.unionByName(modes.select(F.regexp_replace("feature", "^__mode_", "").alias("feature"),
                                        F.lit(None).cast("double").alias("median"), "mode"))


def apply_modes(df: DataFrame, modes: DataFrame, cols: list[str]) -> DataFrame:
    out = with_scalars(df, modes)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__mode_{c}"))).drop(f"__mode_{c}")
    return out


def preprocessing_stages() -> list:
    idx = [f"{c}__idx" for c in CATEGORICAL_FEATURES]
    ohe = [f"{c}__ohe" for c in CATEGORICAL_FEATURES]
    return [
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="__num"),
        StandardScaler(inputCol="__num", outputCol="__num_scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=CATEGORICAL_FEATURES, outputCols=idx, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        # the indexer maps unseen/null levels to its last index; dropLast removes that
        # slot, so they encode to all zeros while every known level keeps a slot
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=["__num_scaled", *ohe], outputCol="features"),
    ]


def _cast_numeric(df: DataFrame) -> DataFrame:
    for c in NUMERIC_FEATURES:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


@dataclass
class TrainedModels:
    """The split, the fitted preprocessing and both models; each model is fitted,
    and scored on the test rows, when a query first reads it."""

    train: DataFrame            # imputed
    train_features: DataFrame   # assembled, with label and weight
    test: DataFrame
    cutoff: DataFrame
    pre: PipelineModel
    estimators: dict
    lr: PipelineModel = field(default_factory=lambda: None)
    rf: PipelineModel = field(default_factory=lambda: None)
    fit_tasks: int | None = None   # at most; None: as the rows lie

    def __post_init__(self):
        for name in ("lr", "rf"):
            if self.__dict__[name] is None:
                del self.__dict__[name]   # fitted by __getattr__

    def __getattr__(self, name: str):
        if name in ("lr", "rf"):
            out = self._fitted(self.estimators[name])
        elif name in ("lr_scored", "rf_scored"):
            out = self._scored(getattr(self, name.removesuffix("_scored")))
        else:
            raise AttributeError(name)
        self.__dict__[name] = out
        return out

    def _fitted(self, estimator) -> PipelineModel:
        xtr = self.train_features
        if self.fit_tasks:
            xtr = xtr.coalesce(self.fit_tasks)
        xtr = xtr.persist()
        try:
            return PipelineModel(stages=[*self.pre.stages, estimator.fit(xtr)])
        finally:
            xtr.unpersist()

    def _scored(self, model: PipelineModel) -> DataFrame:
        xte = self.pre.transform(self.test).select("order_id", "features", TARGET)
        p = model.stages[-1].transform(xte)
        scored = p.select("order_id", F.col(TARGET).alias("label"),
                          vector_to_array(F.col("probability"))[1].alias("score"),
                          F.col("prediction").cast("int").alias("pred"))
        # reliable checkpoint in spark.checkpoint.dir: later evaluation plans
        # start from the written scores instead of the whole training lineage
        return scored.checkpoint(eager=True)

    def release(self) -> None:
        self.cutoff.unpersist()


def fit_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks of a fit. A task sends the statistics of every node of every tree,
    however few rows it has, so these follow the cores and not the layout of the
    facts; a task holds FIT_ROWS rows at most."""
    return max(FIT_TASKS_A_CORE * spark.sparkContext.defaultParallelism, math.ceil(rows / FIT_ROWS))


def keeps_node_ids(spark: SparkSession, rows: int, num_trees: int) -> bool:
    """Whether the node that every row is in, in every tree, is kept between the
    passes of the forest's fit: only where these ids, three generations of them, fit
    in memory beside the rows and their draws. Else they are many times the facts on
    disk; without them each pass walks the trees to the same nodes."""
    a_row = 4 * num_trees * (1 + NODE_IDS_KEPT) + 512
    return rows * a_row <= FIT_MEMORY * storage_memory(spark)


def train_models(ds: DataFrame, train_frac: float = 0.8, lr_c: float = 1.0, max_iter: int = 1000,
                 num_trees: int = 200, max_depth: int = 8, min_leaf: int = 20) -> TrainedModels:
    ensure_checkpoint_dir(ds.sparkSession)
    train, test, cut = time_split(_cast_numeric(ds), train_frac)
    modes = mode_imputer(train, CATEGORICAL_FEATURES)
    medians = median_imputer(train, NUMERIC_FEATURES)

    def imputed(df):
        return apply_medians(apply_modes(df, modes, CATEGORICAL_FEATURES), medians, NUMERIC_FEATURES)

    # written once each: a lost executor costs no second imputation
    train, test = imputed(with_weights(train)).checkpoint(), imputed(test).checkpoint()
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=TARGET, weightCol="weight",
                            regParam=1.0 / (lr_c * max(n, 1)), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter)
    # a larger node budget per pass: the same forest with fewer passes over the
    # training data. It is the same with and without node ids, too
    rf = RandomForestClassifier(featuresCol="features", labelCol=TARGET, weightCol="weight",
                                numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                featureSubsetStrategy="sqrt", seed=SEED, maxMemoryInMB=1024,
                                cacheNodeIds=keeps_node_ids(ds.sparkSession, n, num_trees))
    # the preprocessing is deterministic given the training set, so it is
    # fitted once and shared by both models
    pre = Pipeline(stages=preprocessing_stages()).fit(train)
    features = pre.transform(train).select("order_id", "features", TARGET, "weight")
    return TrainedModels(train, features, test, cut, pre, {"lr": lr, "rf": rf}, fit_tasks=fit_tasks(ds.sparkSession, n))


# ---------------------------------------------------------------- evaluation over (label, score)

def with_prediction(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    if "pred" in scored.columns:
        return scored
    return scored.withColumn("pred", (F.col("score") >= F.lit(threshold)).cast("int"))


def confusion_matrix(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    s = with_prediction(scored, threshold)
    y, p = F.col("label"), F.col("pred")
    return s.agg(F.count_if((y == 0) & (p == 0)).alias("TN"), F.count_if((y == 0) & (p == 1)).alias("FP"),
                 F.count_if((y == 1) & (p == 0)).alias("FN"), F.count_if((y == 1) & (p == 1)).alias("TP"))


def classification_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 on an empty denominator), FPR, FNR."""
    cm = confusion_matrix(scored, threshold)
    tp, fp, tn, fn = (F.col(c) for c in ("TP", "FP", "TN", "FN"))
    z = lambda e: F.coalesce(e, F.lit(0.0))
    out = (cm.withColumn("accuracy", z(safe_div(tp + tn, tp + tn + fp + fn)))
             .withColumn("precision", z(safe_div(tp, tp + fp)))
             .withColumn("recall", z(safe_div(tp, tp + fn)))
             .withColumn("fpr", z(safe_div(fp, fp + tn)))
             .withColumn("fnr", z(safe_div(fn, fn + tp))))
    return out.withColumn("f1", z(safe_div(2 * F.col("precision") * F.col("recall"),
                                           F.col("precision") + F.col("recall"))))


def roc_auc(scored: DataFrame, buckets: int = 256) -> DataFrame:
    """Exact ROC AUC with ties counted half: Σ_s pos_s (neg_below_s + neg_s / 2) / (P N).
    Scores are collapsed to distinct values; the running count of negatives
    is a per-bucket offset (small table) plus a running sum inside each
    order-preserving score bucket, whose boundaries are taken from the
    scores."""
    d = scored.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                    F.count_if(F.col("label") == 0).alias("neg"))
    d = with_range_bucket(d, "score", "__b", buckets)
    bt = d.groupBy("__b").agg(F.sum("neg").alias("__bn"))
    bt = bt.withColumn("__off", F.coalesce(F.sum("__bn").over(
        Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(bt.select("__b", "__off"), "__b")
    d = d.withColumn("__below", F.col("__off") + F.coalesce(F.sum("neg").over(
        Window.partitionBy("__b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return d.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
                 F.sum(F.col("pos") * (F.col("__below") + F.col("neg") / 2.0)).alias("__u")) \
            .withColumn("roc_auc", safe_div(F.col("__u"), F.col("positives") * F.col("negatives"))).drop("__u")


BAND_ORDER = {"Low": 1, "Medium": 2, "High": 3}


def risk_bands(scored: DataFrame, lo: float = 0.33, hi: float = 0.66) -> DataFrame:
    """Score tertiles of the test set: High >= p66, Medium >= p33, else Low;
    per band count, share, actual late %, mean score, thresholds."""
    q = exact_quantiles(scored, "score", {"p33_threshold": lo, "p66_threshold": hi}).select("p33_threshold", "p66_threshold")
    s = with_scalars(scored, q)
    band = (F.when(F.col("score") >= F.col("p66_threshold"), "High")
             .when(F.col("score") >= F.col("p33_threshold"), "Medium").otherwise("Low"))
    g = s.withColumn("risk_band", band).groupBy("risk_band", "p33_threshold", "p66_threshold").agg(
        F.count(F.lit(1)).alias("order_count"), (F.avg("label") * 100).alias("actual_late_pct"),
        F.avg("score").alias("avg_pred_prob"))
    tot = scored.agg(F.count(F.lit(1)).alias("__n"))
    ordm = F.create_map(*[F.lit(x) for kv in BAND_ORDER.items() for x in kv])
    return (with_scalars(g, tot).withColumn("order_pct", pct(F.col("order_count"), F.col("__n")))
            .withColumn("bucket_ord", ordm[F.col("risk_band")]).drop("__n"))


def band_lift(scored: DataFrame) -> DataFrame:
    bands = risk_bands(scored)
    base = scored.agg((F.avg("label") * 100).alias("base_late_pct"))
    high = bands.where(F.col("risk_band") == "High").select(F.col("actual_late_pct").alias("high_late_pct"))
    return base.transform(attach(high)).withColumn("lift", safe_div(F.col("high_late_pct"), F.col("base_late_pct")))


def check_band_monotonic(bands: DataFrame) -> DataFrame:
    """Late rate must not fall from one band to the next (small frame: 3 rows)."""
    w = Window.orderBy("bucket_ord")
    d = bands.withColumn("__prev", F.lag("actual_late_pct").over(w))
    return d.agg(F.count_if(F.col("actual_late_pct") < F.col("__prev")).alias("violations")) \
            .withColumn("passed", F.col("violations") == 0)


# ---------------------------------------------------------------- model introspection

def feature_names(model: PipelineModel, transformed: DataFrame) -> list[str]:
    """Expanded feature names from the assembled vector's attribute metadata."""
    meta = transformed.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    attrs = sorted([a for group in meta.values() for a in group], key=lambda a: a["idx"])
    names = []
    for a in attrs:
        nm = a["name"]
        for i, c in enumerate(NUMERIC_FEATURES):
            if nm == f"__num_scaled_{i}":
                nm = c
        for c in CATEGORICAL_FEATURES:
            nm = nm.replace(f"{c}__ohe_", f"{c}_")
        names.append(nm)
    return names


def feature_importance(spark: SparkSession, tm: TrainedModels) -> DataFrame:
    rf = tm.rf.stages[-1]
    names = feature_names(tm.rf, tm.rf.transform(tm.test.limit(1)))
    imp = rf.featureImportances.toArray().tolist()   # one value per feature: model metadata
    rows = [(names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "feature string, importance double")


def lr_coefficients(spark: SparkSession, tm: TrainedModels) -> DataFrame:
    lr = tm.lr.stages[-1]
    names = feature_names(tm.lr, tm.lr.transform(tm.test.limit(1)))
    coefs = lr.coefficients.toArray().tolist()
    rows = [(names[i] if i < len(names) else f"f{i}", float(c), abs(float(c)),
             "positive" if c > 0 else "negative") for i, c in enumerate(coefs)]
    return spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double, direction string")


def model_metrics(tm: TrainedModels) -> DataFrame:
    out = None
    for name, scored in (("logistic_regression", tm.lr_scored), ("random_forest", tm.rf_scored)):
        m = classification_metrics(scored).transform(attach(roc_auc(scored).select("roc_auc"))) \
            .withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out
