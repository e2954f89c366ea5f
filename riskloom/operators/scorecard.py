"""Logistic points scorecard: fit, score, points table, score deciles.

Fitting uses Spark ML ``LogisticRegression`` (distributed treeAggregate
of gradients). Scoring and the points table are column expressions and a
join with the (small, per feature x bin) WoE table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators.ordered import materialize

FACTOR = K.SCORE_PDO / math.log(2.0)
OFFSET = K.SCORE_BASE + FACTOR * math.log(1.0)


def score_points_expr(pd_col: str = "pd_score") -> Column:
    """PD -> 300..850 points: offset - factor * ln(odds), PD clipped to [1e-6, 1-1e-6]."""
    p = F.least(F.greatest(F.col(pd_col), F.lit(K.PD_EPS)), F.lit(1 - K.PD_EPS))
    raw = F.lit(OFFSET) - F.lit(FACTOR) * F.log(p / (F.lit(1.0) - p))
    return F.least(F.greatest(raw, F.lit(K.SCORE_MIN)), F.lit(K.SCORE_MAX))


_P_SQL = f"least(greatest(pd_score, {K.PD_EPS!r}), {1 - K.PD_EPS!r})"
SCORE_SQL = (
    f"least(greatest({OFFSET!r} - {FACTOR!r} * ln({_P_SQL} / (1.0 - {_P_SQL})), {K.SCORE_MIN!r}), {K.SCORE_MAX!r})"
)


def score_points(df: DataFrame, pd_col: str = "pd_score", out: str = "score") -> DataFrame:
    return df.withColumn(out, score_points_expr(pd_col))


def score_deciles(df: DataFrame, score: str = "score", label: str = "y", q: int = 10) -> DataFrame:
    """Quantile bins of the score (ties share a bin, duplicate edges dropped):
    n, events, min/max/mean score, event rate; highest decile first."""
    from riskloom.operators.binning import quantile_edges
    from riskloom.functions.exprs import bin_right_lit

    edges = quantile_edges(df, [score], q=q).collect()
    e = [float(v) for v in (edges[0]["edges"] if edges else [])]
    d = df.where(F.col(score).isNotNull()).withColumn("decile", bin_right_lit(e, score))
    out = d.groupBy("decile").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(label).cast("long").alias("n_events"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
        F.avg(score).alias("score_mean"),
    )
    return out.withColumn("event_rate", F.col("n_events") / F.col("n_total")).orderBy(F.desc("decile"))


COUNT = "n_rows"


def counted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every distinct row of ``cols`` once, with the number of its rows; written, since fits read it many times.

    For binned features: the WoE of a few features takes at most the product
    of their bins' numbers of values, whatever the number of rows.
    """
    return materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias(COUNT)), "counted")


def fit_logit(
    df: DataFrame,
    features: Sequence[str],
    label: str = "y",
    C: float = K.REGULARIZATION_C,
    balanced: bool = True,
    max_iter: int = 1000,
    count: str | None = None,
):
    """L2 logistic regression matching ``C``-parametrised, class-balanced fitting.

    Spark minimises mean(weighted loss) + regParam/2 ||w||^2; the C form is
    sum(weighted loss) + 1/(2C) ||w||^2, so regParam = 1/(C * sum(w)).
    Balanced weights n/(2 n_class) make sum(w) = n. ``count`` names a column of
    row numbers (:func:`counted`): the loss then has that many copies of a row.
    Returns (model, intercept, {feature: coef}).
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    copies = F.lit(1) if count is None else F.col(count)
    data = df.select(*features, F.col(label).cast("double").alias("label"), copies.alias("_copies"))
    counts = {int(r["label"]): r["n"] for r in data.groupBy("label").agg(F.sum("_copies").alias("n")).collect()}
    n = sum(counts.values())
    if balanced:
        w = None
        for cls, cnt in counts.items():
            term = F.lit(n / (2.0 * cnt))
            w = F.when(F.col("label") == cls, term) if w is None else w.when(F.col("label") == cls, term)
        data = data.withColumn("w", w * F.col("_copies"))
        sum_w = float(n)
    else:
        data = data.withColumn("w", F.col("_copies").cast("double"))
        sum_w = float(n)
    vec = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(data)
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="w",
        regParam=1.0 / (C * sum_w),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,
    )
    model = lr.fit(vec)
    coefs = dict(zip(features, model.coefficients.toArray().tolist()))
    return model, float(model.intercept), coefs


def points_table(
    woe: DataFrame, coefs: dict[str, float], means: dict[str, float], stds: dict[str, float]
) -> DataFrame:
    """Per feature x bin: points = -factor * coef * (woe - mean) / (std + 1e-9), rounded to 1.

    ``woe`` is the output of ``binning.woe_table``; the coefficient table is
    tiny (one row per selected feature) and broadcast.
    """
    spark = woe.sparkSession
    rows = [(f, float(coefs[f]), float(means.get(f, 0.0)), float(stds.get(f, 1.0))) for f in coefs]
    ct = F.broadcast(spark.createDataFrame(rows, "feature string, coef double, s_mean double, s_std double"))
    j = woe.join(ct, "feature")
    pts = -F.lit(FACTOR) * F.col("coef") * (F.col("woe") - F.col("s_mean")) / (F.col("s_std") + F.lit(1e-9))
    return j.select(
        F.col("feature").alias("Feature"),
        F.col("bin").alias("Bin"),
        F.col("n_total").alias("N_Total"),
        F.round("event_rate", 4).alias("Event_Rate"),
        F.round("woe", 4).alias("WoE"),
        F.round("coef", 4).alias("Coefficient"),
        F.round(pts, 1).alias("Points"),
    )
