"""Queries: ranking / calibration metrics on the ``scored`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import metrics as M
from riskloom.operators import scorecard as SC
from riskloom.operators import splits as SP
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.sources import fixtures as fx


def cum_sql(src: str, score: str, label: str, keys: tuple[str, ...] = ()) -> str:
    """SQL text of the cumulative table (same columns as ``metrics.cumulative_table``)."""
    k = ", ".join(keys)
    kp = f"{k}, " if keys else ""
    part = f"PARTITION BY {k} " if keys else ""
    return f"""
SELECT *, sum(pos) OVER ({part}ORDER BY s ROWS UNBOUNDED PRECEDING) AS pos_cum,
          sum(neg) OVER ({part}ORDER BY s ROWS UNBOUNDED PRECEDING) AS neg_cum,
          sum(pos) OVER ({'PARTITION BY ' + k if keys else ''}) AS P,
          sum(neg) OVER ({'PARTITION BY ' + k if keys else ''}) AS N
FROM (SELECT {kp}cast({score} AS double) AS s, cast(sum({label}) AS bigint) AS pos,
             cast(sum(1 - {label}) AS bigint) AS neg
      FROM {src} WHERE {score} IS NOT NULL AND {label} IS NOT NULL GROUP BY {kp}cast({score} AS double)) c"""


AUC_SQL = "sum(pos * (neg_cum - neg / 2.0)) / (cast(max(P) AS double) * max(N))"
KS_SQL = (
    "greatest(max((P - pos_cum + pos) / cast(P AS double) - (N - neg_cum + neg) / cast(N AS double)), 0.0)"
)
AP_SQL = "sum(pos * ((P - pos_cum + pos) / cast((P - pos_cum + pos) + (N - neg_cum + neg) AS double))) / cast(max(P) AS double)"


def metric_sql(src: str, score: str, label: str, keys: tuple[str, ...], select: str) -> str:
    k = ", ".join(keys)
    grp = f" GROUP BY {k}" if keys else ""
    kp = f"{k}, " if keys else ""
    return f"SELECT {kp}{select} FROM ({cum_sql(src, score, label, keys)}) t{grp}"


EVAL_SELECT = (
    f"max(P) + max(N) AS n, max(P) / cast(max(P) + max(N) AS double) AS event_rate, {AUC_SQL} AS auc, "
    f"{KS_SQL} AS ks, {AP_SQL} AS avg_precision, "
    "sum(pos * pow(s - 1, 2) + neg * pow(s, 2)) / (max(P) + max(N)) AS brier, "
    f"2 * ({AUC_SQL}) - 1 AS gini"
)


@register(
    "auc_gini",
    with_fixtures(metric_sql("scored", "pd_score", "y", (), f"{AUC_SQL} AS auc, 2 * ({AUC_SQL}) - 1 AS gini"), "scored"),
    ["auc", "gini"],
)
def q_auc_gini(spark, sf):
    return M.auc_gini(fx.scored(spark, sf), "pd_score", "y")


@register("ks_stat", with_fixtures(metric_sql("scored", "pd_score", "y", (), f"{KS_SQL} AS ks"), "scored"), ["ks"])
def q_ks(spark, sf):
    return M.ks_stat(fx.scored(spark, sf), "pd_score", "y")


@register(
    "avg_precision",
    with_fixtures(metric_sql("scored", "pd_score", "y", (), f"{AP_SQL} AS avg_precision"), "scored"),
    ["avg_precision"],
)
def q_ap(spark, sf):
    return M.avg_precision(fx.scored(spark, sf), "pd_score", "y")


@register("brier", with_fixtures("SELECT avg(pow(pd_score - y, 2)) AS brier FROM scored", "scored"), ["brier"])
def q_brier(spark, sf):
    return M.brier(fx.scored(spark, sf), "pd_score", "y")


@register(
    "evaluate_model",
    with_fixtures(metric_sql("scored", "pd_score", "y", (), EVAL_SELECT), "scored"),
    ["event_rate", "auc", "ks", "avg_precision", "brier", "gini"],
)
def q_evaluate(spark, sf):
    return M.evaluate_model(fx.scored(spark, sf), "pd_score", "y")


SQL_KS_CURVE = f"""
SELECT s AS score, pos_cum / cast(P AS double) AS cum_events, neg_cum / cast(N AS double) AS cum_nonevents,
       abs(pos_cum / cast(P AS double) - neg_cum / cast(N AS double)) AS diff
FROM ({cum_sql('scored', 'pd_score', 'y')}) t"""


@register("ks_curve", with_fixtures(SQL_KS_CURVE, "scored"), ["score", "cum_events", "cum_nonevents", "diff"])
def q_ks_curve(spark, sf):
    return M.ks_curve(fx.scored(spark, sf), "pd_score", "y")


SQL_ROC = f"""
SELECT (N - neg_cum + neg) / cast(N AS double) AS fpr, (P - pos_cum + pos) / cast(P AS double) AS tpr,
       s AS threshold
FROM ({cum_sql('scored', 'pd_score', 'y')}) t
UNION ALL SELECT 0.0, 0.0, 'inf'::double"""


@register("roc_curve", with_fixtures(SQL_ROC, "scored"), ["fpr", "tpr"])
def q_roc(spark, sf):
    return M.roc_curve(fx.scored(spark, sf), "pd_score", "y")


_CAL_INNER = ", ".join(repr(i * (1.0 / 10)) for i in range(1, 10))
SQL_CAL = f"""
SELECT bin, count(*) AS n, avg(pd_score) AS mean_predicted, avg(y) AS fraction_positives
FROM (SELECT pd_score, y, cast(len(list_filter([{_CAL_INNER}], lambda e: e < pd_score)) AS int) AS bin FROM scored) t
GROUP BY bin"""


@register("calibration_curve", with_fixtures(SQL_CAL, "scored"), ["mean_predicted", "fraction_positives"])
def q_cal(spark, sf):
    return M.calibration_curve(fx.scored(spark, sf), "pd_score", "y")


_W = (850.0 - 300.0) / 39
SQL_HIST = f"""
WITH b AS (SELECT y, s FROM (SELECT y, {SC.SCORE_SQL} AS s FROM scored) x WHERE s >= 300.0 AND s <= 850.0),
c AS (SELECT y, cast(least(floor((s - 300.0) / {_W!r}), 38) AS int) AS bin, count(*) AS n FROM b GROUP BY 1, 2),
t AS (SELECT y, count(*) AS n_class FROM b GROUP BY y)
SELECT c.y, bin, 300.0::double + bin * {_W!r}::double AS bin_lo, n, n / (n_class * {_W!r}::double) AS density FROM c JOIN t ON c.y = t.y"""


@register("score_histogram", with_fixtures(SQL_HIST, "scored"), ["bin_lo", "density"])
def q_hist(spark, sf):
    s = fx.scored(spark, sf).withColumn("score", SC.score_points_expr("pd_score"))
    return M.score_histogram(s, "score", "y")


# two scores side by side: the fixture's PD and one of a single statement
SIMPLE_PD = "round(1 / (1 + exp(1.6 - 0.5 * greatest(pay_3, 0))), 6)"
_N_OOT = f"round({K.OOT_FRACTION} * n_y)"
SQL_MODELS = f"""
WITH cut AS (SELECT *, CASE WHEN rn <= {_N_OOT} THEN 'oot' WHEN rn <= {_N_OOT} + round({K.TEST_SIZE} * (n_y - {_N_OOT})) THEN 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(cast(id AS varchar))) AS rn,
               count(*) OVER (PARTITION BY y) AS n_y FROM scored) r),
ms AS (SELECT 'portfolio' AS model, split, y, pd_score AS p FROM cut WHERE split IS NOT NULL
       UNION ALL SELECT 'status', split, y, {SIMPLE_PD} FROM cut WHERE split IS NOT NULL)
""" + metric_sql("ms", "p", "y", ("model", "split"), EVAL_SELECT)


@register(
    "model_comparison",
    with_fixtures(SQL_MODELS, "scored"),
    ["event_rate", "auc", "ks", "avg_precision", "brier", "gini"],
)
def q_model_comparison(spark, sf):
    """Metrics of two scores on the test and the holdout split, in one pass
    (``workflow_comparison`` does the same for the fitted models)."""
    s = SP.stratified_split(fx.scored(spark, sf), "id", "y").where(F.col("split") != "train")
    scores = F.array(
        F.struct(F.lit("portfolio").alias("model"), F.col("pd_score").alias("p")),
        F.struct(F.lit("status").alias("model"), F.expr(SIMPLE_PD).alias("p")),
    )
    return M.model_comparison(s.select("split", "y", F.explode(scores).alias("m")).select("split", "y", "m.*"), "p", "y")


SQL_AUC_LI = f"SELECT {AUC_SQL} AS auc, 2 * {AUC_SQL} - 1 AS gini FROM ({cum_sql('li_risk', 'l_extendedprice', 'y')}) t"


@register("auc_gini_lineitem", with_fixtures(SQL_AUC_LI, "li_risk"), ["auc", "gini"])
def q_auc_lineitem(spark, sf):
    """AUC at volume: one nearly unique score per line item."""
    return M.auc_gini(fx.li_risk(spark, sf), "l_extendedprice", "y")
