"""Risk tiers, tier summary, business action matrix, clustering.

Tiers and actions are column expressions (no join); summaries are one
``groupBy`` whose output has a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import constants as K


def tier_expr(pd_col: str = "pd_score") -> Column:
    """PD -> tier name over [low, high) bands; anything else is Unknown (PD=1.0 too)."""
    p = F.col(pd_col)
    out = None
    for name, lo, hi in K.RISK_TIER_THRESHOLDS:
        cond = (p >= lo) & (p < hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(K.UNKNOWN_TIER))


def tier_order_expr(tier_col: str = "risk_tier") -> Column:
    t = F.col(tier_col)
    out = None
    for i, (name, _, _) in enumerate(K.RISK_TIER_THRESHOLDS):
        out = F.when(t == name, F.lit(i)) if out is None else out.when(t == name, F.lit(i))
    return out.otherwise(F.lit(len(K.RISK_TIER_THRESHOLDS)))


def risk_tiers(df: DataFrame, pd_col: str = "pd_score") -> DataFrame:
    return df.withColumn("risk_tier", tier_expr(pd_col))


def tier_summary(df: DataFrame, pd_col: str = "pd_score", label: str = "y") -> DataFrame:
    """Per tier: n, avg PD, default rate, % of portfolio (Unknown counted in the
    denominator but not listed), in tier order."""
    t = df.select(tier_expr(pd_col).alias("risk_tier"), F.col(pd_col).alias("p"), F.col(label).alias("y"))
    g = t.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg("p").alias("avg_pd"),
        F.avg("y").alias("actual_default_rate"),
    )
    # g has at most five rows: an unpartitioned window over it is free
    g = g.withColumn(
        "pct_of_portfolio", F.col("n_customers") * 100.0 / F.sum("n_customers").over(Window.partitionBy())
    )
    g = g.where(F.col("risk_tier") != K.UNKNOWN_TIER).withColumn("tier_order", tier_order_expr())
    return g.select(
        "tier_order",
        "risk_tier",
        "n_customers",
        F.round("avg_pd", 4).alias("avg_pd"),
        F.round("actual_default_rate", 4).alias("actual_default_rate"),
        F.round("pct_of_portfolio", 4).alias("pct_of_portfolio"),
    ).orderBy("tier_order")


def action_matrix(
    df: DataFrame,
    pd_col: str = "pd_score",
    trend: Column | None = None,
    median_pd: float | None = None,
) -> DataFrame:
    """2x2 matrix: risk level (PD >= median) x trend; recommended action; n, avg PD.

    ``trend`` defaults to PAY_RATIO_MEAN - PAY_RATIO_MIN when both columns
    exist (never negative, so only Stable/Improving appears), else Unknown.
    The median is exact, computed by the distributed quantile operator.
    """
    from riskloom.operators.ordered import exact_quantiles

    if median_pd is None:
        median_pd = exact_quantiles(df, [], pd_col, [0.5]).collect()[0]["edges"][0]
    cols = set(df.columns)
    if trend is None and {"pay_ratio_mean", "pay_ratio_min"} <= cols:
        trend = F.col("pay_ratio_mean") - F.col("pay_ratio_min")
    if trend is None:
        trend_label = F.lit("Unknown")
    else:
        trend_label = F.when(trend < K.TREND_DETERIORATING, "Deteriorating").otherwise("Stable/Improving")
    risk = F.when(F.col(pd_col) >= F.lit(median_pd), "High Risk").otherwise("Low Risk")
    action = None
    for r, t, a in K.ACTIONS:
        cond = (F.col("risk_level") == r) & (F.col("trend") == t)
        action = F.when(cond, a) if action is None else action.when(cond, a)
    action = action.otherwise(K.DEFAULT_ACTION)
    t = df.select(risk.alias("risk_level"), trend_label.alias("trend"), F.col(pd_col).alias("p"))
    return t.groupBy("risk_level", "trend").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg("p").alias("avg_pd"),
        F.first(action).alias("recommended_action"),
    )


def segment_labels(df: DataFrame, cluster_col: str = "cluster", pd_col: str = "pd_score") -> DataFrame:
    """Rank clusters by mean PD -> names (Transactors ... Delinquency-Prone), else Segment_i."""
    g = df.groupBy(cluster_col).agg(F.avg(pd_col).alias("mean_pd"))
    rank = F.row_number().over(Window.partitionBy().orderBy("mean_pd", cluster_col)) - 1
    g = g.withColumn("risk_rank", rank)
    label = None
    for i, name in enumerate(K.SEGMENT_LABELS):
        cond = F.col("risk_rank") == i
        label = F.when(cond, name) if label is None else label.when(cond, name)
    label = label.otherwise(F.concat(F.lit("Segment_"), F.col(cluster_col).cast("string")))
    return g.select(cluster_col, "risk_rank", "mean_pd", label.alias("segment"))


def segment_profiles(
    df: DataFrame,
    features: Sequence[str],
    cluster_col: str = "cluster",
    pd_col: str = "pd_score",
    label: str = "y",
) -> DataFrame:
    """Per cluster: feature means, mean PD, count, default rate; ordered by mean PD."""
    aggs = [F.avg(f).alias(f) for f in features]
    aggs += [
        F.avg(pd_col).alias("pd_mean"),
        F.count(F.lit(1)).alias("pd_count"),
        F.avg(label).alias("default_rate"),
    ]
    return df.groupBy(cluster_col).agg(*aggs)


def profile_normalized(profiles: DataFrame, cols: Sequence[str], key: str = "cluster") -> DataFrame:
    """Min-max scale each profile column across clusters (epsilon 1e-9).

    ``profiles`` has one row per cluster, so the unpartitioned windows run
    over a handful of rows."""
    w = Window.partitionBy()
    return profiles.select(
        key,
        *[
            ((F.col(c) - F.min(c).over(w)) / (F.max(c).over(w) - F.min(c).over(w) + F.lit(1e-9))).alias(c)
            for c in cols
        ],
    )


# ------------------------------------------------------------------ clustering
def _std_vectors(df: DataFrame, features: Sequence[str]):
    from riskloom.operators.models import assemble
    from riskloom.operators.scaling import fit_standard

    sm = fit_standard(df, features)
    z = sm.transform(df)
    return assemble(z, features), sm


def kmeans_segments(
    df: DataFrame, features: Sequence[str], k: int = K.N_CLUSTERS, restarts: int = 10, max_iter: int = 300,
    seed: int = 42, min_features: int = 3,
):
    """K-Means on standardised features (population std), ``restarts`` starts in shared
    passes, the lowest cost kept. Returns (model, scaler, cost)."""
    from riskloom.operators.clusters import CentroidModel, shared_kmeans, vectors
    from riskloom.operators.scaling import fit_standard

    feats = [f for f in features if f in df.columns]
    if len(feats) < min_features:
        raise ValueError(f"need at least {min_features} clustering features, got {feats}")
    sm = fit_standard(df, feats)
    best = shared_kmeans(vectors(sm.transform(df), feats), [k], restarts, max_iter, seed)[k]
    return CentroidModel(best.centers), sm, best.inertia


def assign_segments(
    model, scaler, df: DataFrame, features: Sequence[str], pd_col: str = "pd_score", names: dict[int, str] | None = None
) -> DataFrame:
    """New rows -> cluster (nearest centroid), PD tier and, with the fitted ``names``
    (:func:`segment_names`), the segment name (``Unknown`` for a cluster without one).
    The features themselves keep their values."""
    from riskloom.operators.models import assemble

    raw = [f"_raw_{f}" for f in features]
    v = scaler.transform(df.withColumns({r: F.col(f) for r, f in zip(raw, features)}))
    out = model.transform(assemble(v, features)).drop("features")
    out = out.withColumns({f: F.col(r) for r, f in zip(raw, features)}).drop(*raw)
    if names is not None:
        segment = F.lit(K.UNKNOWN_TIER)
        for cluster, name in names.items():
            segment = F.when(F.col("cluster") == cluster, name).otherwise(segment)
        out = out.withColumn("segment", segment)
    return out.withColumn("risk_tier", tier_expr(pd_col))


def segment_names(df: DataFrame, cluster_col: str = "cluster", pd_col: str = "pd_score") -> dict[int, str]:
    """Cluster -> name of fitted segments (one row per cluster reaches the driver)."""
    return {r[cluster_col]: r["segment"] for r in segment_labels(df, cluster_col, pd_col).collect()}


def nearest_centroid(df: DataFrame, features: Sequence[str], centroids: list[list[float]], out: str = "cluster") -> Column:
    """argmin squared distance to fixed centroids (first index on ties), as one expression."""
    d = [
        sum(((F.col(f) - F.lit(float(c[i]))) ** 2 for i, f in enumerate(features)), F.lit(0.0))
        for c in centroids
    ]
    best = F.lit(0)
    best_d = d[0]
    for j in range(1, len(d)):
        better = d[j] < best_d
        best = F.when(better, F.lit(j)).otherwise(best)
        best_d = F.when(better, d[j]).otherwise(best_d)
    return best.alias(out)


def silhouette(model_df: DataFrame, features_col: str = "features", cluster_col: str = "cluster") -> float:
    """Mean silhouette (Spark's ClusteringEvaluator, squared Euclidean distance)."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=cluster_col, metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(model_df))


def elbow(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(2, 9), restarts: int = 10, max_iter: int = 300,
    seed: int = 42,
) -> list[tuple]:
    """(k, inertia, silhouette) of the best of ``restarts`` starts for each k: one scan per iteration for
    all of them, one for all silhouettes (squared Euclidean distance, every row)."""
    from riskloom.operators.clusters import shared_kmeans, silhouettes, vectors
    from riskloom.operators.scaling import fit_standard

    rows = vectors(fit_standard(df, features).transform(df), features)
    ks = [int(k) for k in ks]
    best = shared_kmeans(rows, ks, restarts, max_iter, seed)
    return [(k, best[k].inertia, s) for k, s in zip(ks, silhouettes(rows, [best[k] for k in ks]))]


def pca_projection(df: DataFrame, features: Sequence[str], key: str, k: int = 2):
    """First k principal components of the standardised features (Spark ML PCA on
    centred data) and the explained variance ratios."""
    from pyspark.ml.feature import PCA

    v, _ = _std_vectors(df, features)
    m = PCA(k=k, inputCol="features", outputCol="pc").fit(v)
    from pyspark.ml.functions import vector_to_array

    proj = m.transform(v).select(key, *[vector_to_array("pc")[i].alias(f"pc{i + 1}") for i in range(k)])
    return proj, [float(x) for x in m.explainedVariance.toArray()]
