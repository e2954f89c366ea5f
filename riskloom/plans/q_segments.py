"""Queries: risk tiers, tier summary, action matrix, segment labels/profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import features as fe
from riskloom.operators import segments as sg
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_features import RATIO_SQL
from riskloom.plans import sqlx as X
from riskloom.sources import fixtures as fx

TIER_CASE = (
    "CASE "
    + " ".join(f"WHEN pd_score >= {lo} AND pd_score < {hi} THEN '{n}'" for n, lo, hi in K.RISK_TIER_THRESHOLDS)
    + f" ELSE '{K.UNKNOWN_TIER}' END"
)
TIER_ORDER = (
    "CASE "
    + " ".join(f"WHEN risk_tier = '{n}' THEN {i}" for i, (n, _, _) in enumerate(K.RISK_TIER_THRESHOLDS))
    + f" ELSE {len(K.RISK_TIER_THRESHOLDS)} END"
)

SQL_TIERS = f"SELECT id, pd_score, {TIER_CASE} AS risk_tier FROM scored"

SQL_TIER_SUMMARY = f"""
SELECT {TIER_ORDER} AS tier_order, risk_tier, n_customers,
       round(avg_pd, 4) AS avg_pd, round(actual_default_rate, 4) AS actual_default_rate,
       round(n_customers * 100.0 / sum(n_customers) OVER (), 4) AS pct_of_portfolio
FROM (SELECT {TIER_CASE} AS risk_tier, count(*) AS n_customers, avg(pd_score) AS avg_pd,
             avg(y) AS actual_default_rate
      FROM scored GROUP BY 1) g
QUALIFY risk_tier <> '{K.UNKNOWN_TIER}'"""


@register("risk_tiers", with_fixtures(SQL_TIERS, "scored"), ["pd_score"])
def q_risk_tiers(spark, sf):
    return sg.risk_tiers(fx.scored(spark, sf)).select("id", "pd_score", "risk_tier")


@register(
    "tier_summary",
    with_fixtures(SQL_TIER_SUMMARY, "scored"),
    ["avg_pd", "actual_default_rate", "pct_of_portfolio"],
)
def q_tier_summary(spark, sf):
    return sg.tier_summary(fx.scored(spark, sf))


_RMEAN = X.rmean(list(RATIO_SQL.values()))
_RMIN = X.rmin(list(RATIO_SQL.values()))
_ACTION = (
    "CASE "
    + " ".join(f"WHEN risk_level = '{r}' AND trend = '{t}' THEN '{a}'" for r, t, a in K.ACTIONS)
    + f" ELSE '{K.DEFAULT_ACTION}' END"
)
SQL_ACTION = f"""
SELECT risk_level, trend, count(*) AS n_customers, avg(pd_score) AS avg_pd,
       any_value({_ACTION}) AS recommended_action
FROM (SELECT pd_score,
        CASE WHEN pd_score >= (SELECT quantile_cont(pd_score, 0.5) FROM scored) THEN 'High Risk' ELSE 'Low Risk' END AS risk_level,
        CASE WHEN {_RMEAN} - {_RMIN} < {K.TREND_DETERIORATING} THEN 'Deteriorating' ELSE 'Stable/Improving' END AS trend
      FROM scored) t
GROUP BY risk_level, trend"""


@register("action_matrix", with_fixtures(SQL_ACTION, "scored"), ["avg_pd"])
def q_action_matrix(spark, sf):
    return sg.action_matrix(fe.feat_payment(fx.scored(spark, sf)))


# clusters by market segment (a data-derived assignment) for label / profile queries
SQL_SEG_LABELS = f"""
SELECT seg AS cluster, cast(row_number() OVER (ORDER BY mean_pd, seg) - 1 AS int) AS risk_rank, mean_pd,
  CASE row_number() OVER (ORDER BY mean_pd, seg) - 1
    {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(K.SEGMENT_LABELS))}
    ELSE concat('Segment_', seg) END AS segment
FROM (SELECT seg, avg(pd_score) AS mean_pd FROM scored GROUP BY seg) g"""


@register("segment_labels", with_fixtures(SQL_SEG_LABELS, "scored"), ["mean_pd"])
def q_segment_labels(spark, sf):
    s = fx.scored(spark, sf).withColumnRenamed("seg", "cluster")
    return sg.segment_labels(s).withColumn("risk_rank", F.col("risk_rank").cast("int"))


PROFILE_FEATS = ["util_mean", "pay_ratio_mean", "max_delinquency", "balance_to_limit", "limit_bal"]
SQL_PROFILES = f"""
SELECT seg AS cluster, avg(util_mean) AS util_mean, avg(pay_ratio_mean) AS pay_ratio_mean,
       avg(max_delinquency) AS max_delinquency, avg(balance_to_limit) AS balance_to_limit,
       avg(limit_bal) AS limit_bal, avg(pd_score) AS pd_mean, count(*) AS pd_count, avg(y) AS default_rate
FROM (SELECT seg, limit_bal, pd_score, y,
        {X.rmean([X.clip(X.div(f'bill_amt{k}', 'limit_bal'), 0.0, 2.0) for k in range(1, 7)])} AS util_mean,
        {_RMEAN} AS pay_ratio_mean, greatest(pay_3, pay_4, pay_5, pay_6) AS max_delinquency,
        coalesce({X.clip(X.div('bill_amt1', 'limit_bal'), 0.0, 2.0)}, 0.0) AS balance_to_limit
      FROM scored) t
GROUP BY seg"""


def _profiles(spark, sf):
    df = fx.scored(spark, sf)
    for f in (fe.feat_utilization, fe.feat_payment, fe.feat_delinquency, fe.feat_balance):
        df = f(df)
    return sg.segment_profiles(df.withColumnRenamed("seg", "cluster"), PROFILE_FEATS)


@register(
    "segment_profiles",
    with_fixtures(SQL_PROFILES, "scored"),
    PROFILE_FEATS + ["pd_mean", "default_rate"],
)
def q_segment_profiles(spark, sf):
    return _profiles(spark, sf)


SQL_PROFILE_NORM = f"""
SELECT cluster, {', '.join(f'({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9) AS {c}' for c in PROFILE_FEATS)}
FROM ({SQL_PROFILES}) p"""


@register("profile_normalized", with_fixtures(SQL_PROFILE_NORM, "scored"), PROFILE_FEATS)
def q_profile_normalized(spark, sf):
    return sg.profile_normalized(_profiles(spark, sf), PROFILE_FEATS)


# ------------------------------------------------------------------ clustering
def _cluster_table(spark, sf):
    from riskloom.plans.q_models import modelling_table

    t = modelling_table(spark, sf)
    return t.join(fx.scored(spark, sf).select("id", "pd_score", "seg"), "id")


@register("kmeans_segments")
def q_kmeans(spark, sf):
    """k=4 on eight standardised behaviour features, 10 restarts (300 iterations), lowest cost kept;
    per cluster: size, mean PD, segment name."""
    from riskloom.plans.q_models import CLUSTER_FEATURES

    t = _cluster_table(spark, sf)
    model, scaler, cost = sg.kmeans_segments(t, CLUSTER_FEATURES)
    a = sg.assign_segments(model, scaler, t, CLUSTER_FEATURES)
    labels = sg.segment_labels(a, "cluster", "pd_score")
    sizes = a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_customers"))
    return labels.join(sizes, "cluster").withColumn("training_cost", F.lit(float(cost)))


_Z_FEATS = ["util_mean", "pay_ratio_mean", "max_delinquency", "balance_to_limit"]


def _z_sql() -> str:
    util = X.rmean([X.clip(X.div(f"bill_amt{k}", "limit_bal"), 0.0, 2.0) for k in range(1, 7)])
    raw = (f"SELECT id, seg, {util} AS util_mean, {_RMEAN} AS pay_ratio_mean, "
           "greatest(pay_3, pay_4, pay_5, pay_6) AS max_delinquency, "
           f"coalesce({X.clip(X.div('bill_amt1', 'limit_bal'), 0.0, 2.0)}, 0.0) AS balance_to_limit FROM panel")
    z = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {f}" for f in _Z_FEATS)
    return f"r AS ({raw}), z AS (SELECT id, seg, {z} FROM r WHERE util_mean IS NOT NULL)"


SQL_ASSIGN = f"""WITH {_z_sql()},
c AS (SELECT list(v ORDER BY seg) AS cents
      FROM (SELECT seg, [{', '.join(f'avg({f})' for f in _Z_FEATS)}] AS v FROM z GROUP BY seg) g),
d AS (SELECT id, list_transform((SELECT cents FROM c),
                                lambda ce: {' + '.join(f'pow({f} - ce[{i + 1}], 2)' for i, f in enumerate(_Z_FEATS))}) AS dist
      FROM z)
SELECT id, cast(list_position(dist, list_min(dist)) - 1 AS int) AS cluster FROM d"""


@register("assign_segments", with_fixtures(SQL_ASSIGN, "panel"))
def q_assign(spark, sf):
    """Nearest of fixed centroids (here: per-market-segment means of the
    standardised features), computed as one expression per row."""
    z, centroids = _fixed_centroids(spark, sf)
    return z.select("id", sg.nearest_centroid(z, _Z_FEATS, centroids).cast("int").alias("cluster"))


def _fixed_centroids(spark, sf):
    """Standardised features and the mean of each market segment."""
    from riskloom.operators.scaling import fit_standard

    df = fx.panel(spark, sf)
    for f in (fe.feat_utilization, fe.feat_payment, fe.feat_delinquency, fe.feat_balance):
        df = f(df)
    df = df.where(F.col("util_mean").isNotNull()).select("id", "seg", *_Z_FEATS)
    z = fit_standard(df, _Z_FEATS).transform(df)
    cents = z.groupBy("seg").agg(*[F.avg(f).alias(f) for f in _Z_FEATS]).orderBy("seg").collect()
    return z, [[r[f] for f in _Z_FEATS] for r in cents]


@register("silhouette")
def q_silhouette(spark, sf):
    """Mean silhouette of the 4-cluster solution (squared Euclidean, Spark's evaluator)."""
    from riskloom.operators.models import assemble
    from riskloom.plans.q_models import CLUSTER_FEATURES

    t = _cluster_table(spark, sf)
    model, scaler, _ = sg.kmeans_segments(t, CLUSTER_FEATURES)
    v = model.transform(assemble(scaler.transform(t), CLUSTER_FEATURES))
    return spark.createDataFrame([(4, sg.silhouette(v))], "k int, silhouette double")


_EUCLID = " + ".join(f"pow(a.{f} - b.{f}, 2)" for f in _Z_FEATS)
SQL_EUCLID = f"""WITH {_z_sql()},
ce AS (SELECT list(v ORDER BY seg) AS cents
       FROM (SELECT seg, [{', '.join(f'avg({f})' for f in _Z_FEATS)}] AS v FROM z GROUP BY seg) g),
zc AS (SELECT z.*, list_transform((SELECT cents FROM ce),
                                  lambda c: {' + '.join(f'pow({f} - c[{i + 1}], 2)' for i, f in enumerate(_Z_FEATS))}) AS dist FROM z),
sp AS (SELECT *, cast(list_position(dist, list_min(dist)) - 1 AS bigint) AS cluster FROM zc ORDER BY md5(cast(id AS varchar)) LIMIT 2000),
sz AS (SELECT cluster, count(*) AS n FROM sp GROUP BY cluster),
pr AS (SELECT a.id, a.cluster, b.cluster AS other, sum(sqrt({_EUCLID})) AS total FROM sp a CROSS JOIN sp b GROUP BY ALL),
av AS (SELECT p.id, p.cluster, s.n, p.cluster = p.other AS mine, CASE WHEN p.cluster = p.other THEN total / greatest(s.n - 1, 1) ELSE total / s.n END AS d
       FROM pr p JOIN sz s ON s.cluster = p.other),
ab AS (SELECT id, cluster, max(CASE WHEN mine THEN n END) AS n, max(CASE WHEN mine THEN d END) AS own, min(CASE WHEN NOT mine THEN d END) AS other
       FROM av GROUP BY id, cluster)
SELECT cast(id AS varchar) AS key, cluster, own, other, CASE WHEN n > 1 THEN (other - own) / greatest(own, other) ELSE 0.0 END AS silhouette FROM ab"""


@register("silhouette_euclidean", with_fixtures(SQL_EUCLID, "panel"), ["own", "other", "silhouette"])
def q_silhouette_euclidean(spark, sf):
    """Exact Euclidean silhouette of 2,000 sampled customers whose clusters are the nearest fixed centroids."""
    from riskloom.operators.clusters import euclidean_silhouette

    z, centroids = _fixed_centroids(spark, sf)
    z = z.withColumn("cluster", sg.nearest_centroid(z, _Z_FEATS, centroids))
    return euclidean_silhouette(z, _Z_FEATS, "id")


@register("elbow")
def q_elbow(spark, sf):
    from riskloom.plans.q_models import CLUSTER_FEATURES

    rows = sg.elbow(_cluster_table(spark, sf), CLUSTER_FEATURES, range(2, 9))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


@register("pca_projection")
def q_pca(spark, sf):
    """Two principal components per customer and the explained variance ratios."""
    from riskloom.plans.q_models import CLUSTER_FEATURES

    proj, ev = sg.pca_projection(_cluster_table(spark, sf), CLUSTER_FEATURES, "id", 2)
    return proj.withColumns({"ev1": F.lit(ev[0]), "ev2": F.lit(ev[1])})
