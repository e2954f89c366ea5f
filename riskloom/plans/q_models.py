"""Queries: boosted trees, calibration, CV, scorecard CV, attributions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.operators import scorecard as SC
from riskloom.operators import splits as SP
from riskloom.operators.features import StatementPipeline
from riskloom.operators.ordered import materialize
from riskloom.operators.scaling import fit_standard
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.session import run_parallel, wide_rows
from riskloom.sources import fixtures as fx

# FIXED VALUES: the clustering / modelling feature set of the card-statement shape
CLUSTER_FEATURES = ["util_mean", "pay_ratio_mean", "max_delinquency", "total_delinquency_score",
                    "balance_growth_rate", "months_paid_full", "stress_score", "total_pay_ratio"]
MODEL_FEATURES = CLUSTER_FEATURES + ["limit_bal", "util_max", "pay_ratio_min", "balance_to_limit",
                                     "months_paid_zero", "pay_3", "pay_4", "pay_5", "pay_6", "net_debt_accumulation"]
N_TREES = 30


def modelling_table(spark, sf):
    """Engineered, imputed statement features + split column (fit on train).

    Written once a query to the shared checkpoint folder: several fits read it."""
    wide_rows(spark)
    panel = materialize(fx.panel(spark, sf), "modelling-panel")
    s = materialize(SP.stratified_split(panel, "id", "y"), "modelling-split")
    pipe = StatementPipeline(others=("seg", "nationkey", "split")).fit(s.where(F.col("split") == "train"))
    return materialize(pipe.transform(s, ["split"]).select("id", "y", "split", *MODEL_FEATURES), "modelling")


@register("fit_gbt")
def q_fit_gbt(spark, sf):
    """Both presets trained on train (early stopping on a validation slice), scored on test."""
    t = modelling_table(spark, sf)
    tr = t.where(F.col("split") == "train")
    tr = SP.stratified_split(tr.drop("split"), "id", "y", oot=0.0, test=0.15, out="part").withColumn(
        "is_val", F.col("part") == "test"
    )
    models = run_parallel(
        [lambda p=p: MD.fit_gbt(tr, MODEL_FEATURES, "y", p, N_TREES, validation_col="is_val") for p in MD.PRESETS]
    )
    out = None
    for preset, m in zip(MD.PRESETS, models):
        p = MD.predict_pd(m, t.where(F.col("split") == "test"), MODEL_FEATURES)
        r = M.evaluate_model(p, "pd_raw", "y").withColumn("model", F.lit(preset))
        out = r if out is None else out.unionByName(r)
    return out


@register("platt_calibrate")
def q_platt(spark, sf):
    """3-fold sigmoid-calibrated ensemble vs one raw model, metrics on test."""
    t = modelling_table(spark, sf)
    tr = t.where(F.col("split") == "train")
    te = t.where(F.col("split") == "test")
    ens = MD.platt_calibrate(tr, MODEL_FEATURES, "y", "id", "xgboost", N_TREES, folds=3)
    cal = M.evaluate_model(ens.transform(te), "pd_score", "y").withColumn("model", F.lit("calibrated"))
    raw_m = MD.fit_gbt(tr, MODEL_FEATURES, "y", "xgboost", N_TREES)
    raw = M.evaluate_model(MD.predict_pd(raw_m, te, MODEL_FEATURES), "pd_raw", "y").withColumn("model", F.lit("raw"))
    return cal.unionByName(raw)


@register("predict_pd")
def q_predict_pd(spark, sf):
    """Raw and calibrated PD of every row of every split, from models fitted on train."""
    t = modelling_table(spark, sf)
    train = t.where(F.col("split") == "train")
    raw = MD.fit_gbt(train, MODEL_FEATURES, "y", "xgboost", N_TREES)
    calibrated = MD.platt_calibrate(train, MODEL_FEATURES, "y", "id", "xgboost", N_TREES, folds=3)
    scored = calibrated.transform(MD.predict_pd(raw, t, MODEL_FEATURES))
    return scored.select("id", "y", "split", "pd_raw", "pd_score")


@register("gbt_cv")
def q_gbt_cv(spark, sf):
    """5-fold CV metrics per fold and out-of-fold (fold = -1)."""
    t = modelling_table(spark, sf)
    return MD.gbt_cv(t.where(F.col("split") != "oot"), MODEL_FEATURES, "y", "id", "xgboost", k=5, n_trees=N_TREES)


@register("scorecard_cv")
def q_scorecard_cv(spark, sf):
    """5-fold AUC of the class-balanced L2 logistic model on WoE features."""
    wide_rows(spark)
    li = fx.li_risk(spark, sf)
    feats = fx.LI_FEATURES
    m = B.WoEModel.fit(li, feats, "y")
    woe = [f"WOE_{f}" for f in feats]
    folds = SP.stratified_kfold(m.transform(li, feats).select("key", "y", *woe), "key", "y", 5)
    t = SC.counted(folds, ["fold", "y", *woe])
    t = fit_standard(t, woe, SC.COUNT).transform(t)

    def one(k):
        model, b0, coefs = SC.fit_logit(t.where(F.col("fold") != k), woe, "y", count=SC.COUNT)
        z = b0 + sum(F.lit(coefs[c]) * F.col(c) for c in woe)
        auc = M.auc_gini(t.where(F.col("fold") == k).withColumn("p", z), "p", "y", count=SC.COUNT).collect()[0]["auc"]
        return (k, float(auc))

    rows = run_parallel([lambda k=k: one(k) for k in range(5)])
    mean = sum(a for _, a in rows) / len(rows)
    std = math.sqrt(sum((a - mean) ** 2 for _, a in rows) / len(rows))
    rows.append((-1, mean))
    df = spark.createDataFrame(rows, "fold int, auc double")
    return df.withColumns({"gini": 2 * F.col("auc") - 1, "auc_std": F.lit(std)})


# ------------------------------------------------------ linear attributions
FEATS = fx.LI_FEATURES
COEF = {f: c for f, c in zip(FEATS, (0.8, -0.5, 0.3, -0.2, 0.1))}


def _contrib(spark, sf):
    li = fx.li_risk(spark, sf)
    z = fit_standard(li, FEATS).transform(li.select("key", "y", *FEATS))
    return MD.linear_attribution(z, "key", FEATS, COEF)


def _contrib_sql() -> str:
    zs = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {f}" for f in FEATS)
    arms = " UNION ALL ".join(
        f"SELECT key, '{f}' AS feature, {f} AS value, {COEF[f]!r} * ({f} - 0.0) AS contribution FROM z" for f in FEATS
    )
    return f"z AS (SELECT key, y, {zs} FROM li_risk), c AS ({arms})"


@register("linear_attribution", with_fixtures(f"WITH {_contrib_sql()} SELECT * FROM c", "li_risk"), ["value", "contribution"])
def q_linear_attr(spark, sf):
    return _contrib(spark, sf)


@register(
    "global_importance",
    with_fixtures(
        f"WITH {_contrib_sql()} SELECT feature, avg(abs(contribution)) AS mean_abs_contribution FROM c "
        "GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 20",
        "li_risk",
    ),
    ["mean_abs_contribution"],
)
def q_global_importance(spark, sf):
    return MD.global_importance(_contrib(spark, sf), 20)


WATERFALL_SQL = f"""WITH {_contrib_sql()},
base AS (SELECT ln(sum(y) / cast(count(*) - sum(y) AS double)) AS b FROM li_risk),
one AS (SELECT * FROM c WHERE key = (SELECT min(key) FROM li_risk))
SELECT key, feature, value, contribution,
       row_number() OVER (ORDER BY abs(contribution) DESC, feature) AS step,
       (SELECT b FROM base) + sum(contribution) OVER (ORDER BY abs(contribution) DESC, feature
                                                     ROWS UNBOUNDED PRECEDING) AS cumulative
FROM one"""


@register("local_waterfall", with_fixtures(WATERFALL_SQL, "li_risk"), ["value", "contribution", "cumulative"])
def q_local_waterfall(spark, sf):
    """One row's contributions from the base log-odds (the row with the smallest key)."""
    li = fx.li_risk(spark, sf)
    r = li.agg(F.min("key").alias("k"), F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()[0]
    base = math.log(r["p"] / (r["n"] - r["p"]))
    return MD.local_waterfall(_contrib(spark, sf), "key", r["k"], base)


DEP_SQL = f"""WITH {_contrib_sql()},
top AS (SELECT feature FROM c GROUP BY feature ORDER BY avg(abs(contribution)) DESC, feature LIMIT 1)
SELECT value, contribution FROM c WHERE feature = (SELECT feature FROM top)"""


@register("dependence_table", with_fixtures(DEP_SQL, "li_risk"), ["value", "contribution"])
def q_dependence(spark, sf):
    c = _contrib(spark, sf)
    top = MD.global_importance(c, 1).collect()[0]["feature"]
    return MD.dependence_table(c, top)


@register("tree_attribution")
def q_tree_attribution(spark, sf):
    """Interventional tree attributions of a fitted GBT for every test row,
    against a reproducible 200-row background sample of train."""
    from riskloom.operators.explain import tree_attribution

    t = modelling_table(spark, sf)
    tr = t.where(F.col("split") == "train")
    m = MD.fit_gbt(tr, MODEL_FEATURES, "y", "xgboost", N_TREES)
    bg = SP.sample_n(tr, "id", 200)
    contrib, base = tree_attribution(t.where(F.col("split") == "test"), m, MODEL_FEATURES, "id", bg)
    return contrib.withColumn("base_value", F.lit(base))
