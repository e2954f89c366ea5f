"""Boosted trees (Spark ML GBT), Platt calibration, k-fold CV, attributions.

Learners are Spark ML estimators (distributed histogram splits,
treeAggregate). Fold loops are over k (small); each fold is a
distributed fit. Predictions of all folds are one long DataFrame scored
by the grouped metrics of :mod:`riskloom.operators.metrics`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators.metrics import evaluate_model
from riskloom.operators.ordered import materialize
from riskloom.operators.splits import stratified_kfold

PRESETS = ("xgboost", "lightgbm")


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def class_weight(df: DataFrame, label: str, preset: str) -> Column:
    """xgboost preset: positives weighted (1-rate)/rate; lightgbm preset: balanced n/(2 n_c)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p")).collect()[0]
    n, p = int(r["n"]), int(r["p"] or 0)
    if p == 0 or p == n:
        return F.lit(1.0)
    if preset == "xgboost":
        return F.when(F.col(label) == 1, F.lit(round((n - p) / p, 2))).otherwise(F.lit(1.0))
    return F.when(F.col(label) == 1, F.lit(n / (2.0 * p))).otherwise(F.lit(n / (2.0 * (n - p))))


def gbt(preset: str = "xgboost", n_trees: int = K.GBT_TREES, seed: int = K.SEED, validation_col: str | None = None) -> GBTClassifier:
    if preset not in PRESETS:
        raise ValueError(f"preset must be one of {PRESETS}")
    kw = dict(
        featuresCol="features",
        labelCol="label",
        weightCol="w",
        maxDepth=K.GBT_MAX_DEPTH,
        stepSize=K.GBT_STEP_SIZE,
        subsamplingRate=K.GBT_SUBSAMPLE,
        featureSubsetStrategy=K.GBT_FEATURE_SUBSET,
        minInstancesPerNode=K.GBT_MIN_LEAF,
        maxIter=n_trees,
        seed=seed,
        maxBins=64,
    )
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTClassifier(**kw)


def vector_table(df: DataFrame, features: Sequence[str], keep: Sequence[str], name: str) -> DataFrame:
    """``keep`` and the assembled features, written once: a fit reads its rows three times or more, and one
    vector is read back far cheaper than dozens of columns are scanned and assembled."""
    return materialize(assemble(df, features).select(*keep, "features"), name)


def _prep(df: DataFrame, features: Sequence[str], label: str, preset: str) -> DataFrame:
    d = df.withColumn("label", F.col(label).cast("double"))
    d = d.withColumn("w", class_weight(d, "label", preset))
    return d if "features" in d.columns else assemble(d, features)


def fit_gbt(
    df: DataFrame, features: Sequence[str], label: str = "y", preset: str = "xgboost",
    n_trees: int = K.GBT_TREES, validation_col: str | None = None,
):
    """Fit one boosted-tree model; ``validation_col`` (bool) enables early stopping. ``df`` may be a :func:`vector_table`."""
    return gbt(preset, n_trees, validation_col=validation_col).fit(_prep(df, features, label, preset))


def margin(pred: DataFrame) -> Column:
    """GBT raw margin (rawPrediction = [-m, m])."""
    return vector_to_array("rawPrediction")[1]


def p_one(pred: DataFrame) -> Column:
    return vector_to_array("probability")[1]


@dataclass
class PlattEnsemble:
    """k base models, each with a sigmoid calibrator fitted on its held-out fold;
    the calibrated PD is the average of the k calibrated probabilities."""

    models: list
    calib: list[tuple[float, float]]
    features: list[str]

    def transform(self, df: DataFrame, out: str = "pd_score") -> DataFrame:
        v = assemble(df, self.features)
        cols = []
        for i, (m, (a, b)) in enumerate(zip(self.models, self.calib)):
            v = m.transform(v).withColumn(f"_m{i}", margin(None)).drop("rawPrediction", "probability", "prediction")
            cols.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col(f"_m{i}") + F.lit(b)))))
        avg = sum(cols, F.lit(0.0)) / len(cols)
        return v.withColumn(out, avg).drop("features", *[f"_m{i}" for i in range(len(cols))])


def fold_table(df: DataFrame, features: Sequence[str], label: str, key: str, folds: int) -> DataFrame:
    """Label, fold and feature vector of every row, written once: every fit reads it several times."""
    f = stratified_kfold(df.select(key, label, *[F.col(f"`{c}`") for c in features]), key, label, folds)
    f = f.select(F.col(label).cast("double").alias("label"), *[F.col(f"`{c}`") for c in features], "fold")
    return vector_table(f, features, ["label", "fold"], "folds")


def platt_calibrate(
    df: DataFrame, features: Sequence[str], label: str = "y", key: str = "id", preset: str = "xgboost",
    n_trees: int = K.GBT_TREES, folds: int = 3,
) -> PlattEnsemble:
    """Sigmoid calibration with ``folds`` splits: fit on k-1 folds, calibrate the
    margin on the held-out fold with a 1-feature unregularised logistic model."""
    f = fold_table(df, features, label, key, folds)
    f = f.withColumn("w", class_weight(f, "label", preset))
    from riskloom.session import run_parallel

    def one(k):
        m = gbt(preset, n_trees).fit(f.where(F.col("fold") != k))
        # two numbers a row, written: the calibrator's passes don't run the trees again
        held = materialize(m.transform(f.where(F.col("fold") == k)).select(margin(None).alias("m"), "label"), "margins")
        lr = LogisticRegression(featuresCol="mv", labelCol="label", regParam=0.0, maxIter=100)
        cm = lr.fit(assemble(held, ["m"], "mv"))
        return m, (float(cm.coefficients[0]), float(cm.intercept))

    fits = run_parallel([lambda k=k: one(k) for k in range(folds)])
    return PlattEnsemble([m for m, _ in fits], [c for _, c in fits], list(features))


def predict_pd(model, df: DataFrame, features: Sequence[str], out: str = "pd_raw") -> DataFrame:
    """Uncalibrated PD of a single fitted GBT."""
    v = model.transform(assemble(df, features))
    return v.withColumn(out, p_one(v)).drop("features", "rawPrediction", "probability", "prediction")


def gbt_cv(
    df: DataFrame, features: Sequence[str], label: str = "y", key: str = "id", preset: str = "xgboost",
    k: int = K.CV_FOLDS, n_trees: int = K.GBT_TREES,
) -> DataFrame:
    """k-fold CV: one metrics row per fold plus an out-of-fold row (fold = -1)."""
    f = fold_table(df, features, label, key, k)
    f = f.withColumn("w", class_weight(f, "label", preset))
    from riskloom.session import run_parallel

    models = run_parallel([lambda i=i: gbt(preset, n_trees).fit(f.where(F.col("fold") != i)) for i in range(k)])
    preds = None
    for i, m in enumerate(models):
        p = m.transform(f.where(F.col("fold") == i)).select("fold", F.col("label").cast("int").alias("y"), p_one(None).alias("p"))
        preds = p if preds is None else preds.unionByName(p)
    preds = materialize(preds, "cv-scores")
    per_fold = evaluate_model(preds, "p", "y", ["fold"])
    oof = evaluate_model(preds, "p", "y").withColumn("fold", F.lit(-1))
    return per_fold.unionByName(oof)


# ------------------------------------------------------------- attributions
def linear_attribution(
    df: DataFrame, key: str, features: Sequence[str], coefs: dict[str, float], means: dict[str, float] | None = None
) -> DataFrame:
    """Exact contributions of a linear score: coef * (z - mean z), long form
    (key, feature, value, contribution). One projection + unpivot."""
    means = means or {f: 0.0 for f in features}
    w = df.select(
        key,
        *[F.col(f).alias(f"v_{f}") for f in features],
        *[(F.lit(coefs[f]) * (F.col(f) - F.lit(means[f]))).alias(f"c_{f}") for f in features],
    )
    arr = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"v_{f}").alias("value"), F.col(f"c_{f}").alias("contribution")) for f in features]
    )
    return w.select(key, F.explode(arr).alias("s")).select(key, "s.*")


def global_importance(contrib: DataFrame, top_n: int = 20) -> DataFrame:
    """Mean |contribution| per feature, top n (a top-k report)."""
    g = contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    return g.orderBy(F.desc("mean_abs_contribution"), "feature").limit(top_n)


def local_waterfall(contrib: DataFrame, key: str, key_value, base_value: float) -> DataFrame:
    """One row's contributions ordered by |contribution|, with the running total
    from the base value. The window runs over one row's d features."""
    from pyspark.sql import Window

    one = contrib.where(F.col(key) == key_value)
    w = Window.partitionBy(key).orderBy(F.desc(F.abs(F.col("contribution"))), "feature").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return one.select(
        key, "feature", "value", "contribution",
        F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.abs(F.col("contribution"))), "feature")).alias("step"),
        (F.lit(base_value) + F.sum("contribution").over(w)).alias("cumulative"),
    )


def dependence_table(contrib: DataFrame, feature: str) -> DataFrame:
    return contrib.where(F.col("feature") == feature).select("value", "contribution")
