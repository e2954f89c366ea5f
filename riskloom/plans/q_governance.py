"""Queries: PSI, PSI report, Gini stability, bias audit, shares, KPIs, score shift."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import binning as B
from riskloom.operators import governance as G
from riskloom.operators import metrics as M
from riskloom.operators import splits as SP
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_metrics import AUC_SQL, cum_sql
from riskloom.plans.q_scorecard import PCT, _dbl_list
from riskloom.sources import fixtures as fx

FEATS = fx.LI_FEATURES
PSI_FEAT = "l_extendedprice"


def psi_ctes(src: str, feats, part: str = "part") -> str:
    casts = ", ".join(f"cast({f} AS double) AS {f}" for f in feats)
    return f"""
long AS (SELECT {part} AS part, feature, x FROM (UNPIVOT (SELECT {part}, {casts} FROM {src}
           WHERE {part} IN ('expected', 'actual')) ON {', '.join(feats)} INTO NAME feature VALUE x) u
         WHERE x IS NOT NULL),
qe AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, {PCT}))) AS q FROM long
       WHERE part = 'expected' GROUP BY feature),
kk AS (SELECT feature, q, greatest(len(q) - 1, 1) AS k FROM qe),
sz AS (SELECT feature, sum(CASE WHEN part = 'expected' THEN 1 ELSE 0 END) AS n_exp,
              sum(CASE WHEN part = 'actual' THEN 1 ELSE 0 END) AS n_act FROM long GROUP BY feature),
b AS (SELECT l.feature, l.part, cast(len(list_filter(q[2:len(q) - 1], lambda z: z <= l.x)) AS int) AS bin
      FROM long l JOIN kk ON l.feature = kk.feature),
cnt AS (SELECT feature, bin, sum(CASE WHEN part = 'expected' THEN 1 ELSE 0 END) AS c_exp,
               sum(CASE WHEN part = 'actual' THEN 1 ELSE 0 END) AS c_act FROM b GROUP BY feature, bin),
spine AS (SELECT feature, cast(unnest(range(0, k)) AS int) AS bin FROM kk),
tt AS (SELECT s.feature, s.bin, cast(coalesce(c_exp, 0) AS bigint) AS c_exp, cast(coalesce(c_act, 0) AS bigint) AS c_act,
              n_exp, n_act
       FROM spine s LEFT JOIN cnt c ON s.feature = c.feature AND s.bin = c.bin JOIN sz ON s.feature = sz.feature),
pp AS (SELECT feature, bin, c_exp, c_act,
              CASE WHEN c_exp > 0 THEN c_exp / cast(n_exp AS double) ELSE {K.PSI_PCT_FLOOR!r} END AS exp_pct,
              CASE WHEN c_act > 0 THEN c_act / cast(n_act AS double) ELSE {K.PSI_PCT_FLOOR!r} END AS act_pct
       FROM tt),
psi_t AS (SELECT *, (act_pct - exp_pct) * ln(act_pct / exp_pct) AS psi_bin FROM pp)"""


S, Mo, H = K.PSI_STATUS
STATUS_SQL = f"CASE WHEN psi < {K.PSI_STABLE} THEN '{S}' WHEN psi < {K.PSI_MODERATE} THEN '{Mo}' ELSE '{H}' END"


@register(
    "psi",
    with_fixtures("WITH " + psi_ctes("li_risk", [PSI_FEAT]) + " SELECT * FROM psi_t", "li_risk"),
    ["exp_pct", "act_pct", "psi_bin"],
)
def q_psi(spark, sf):
    """Single-feature PSI with its bin detail."""
    return B.psi_table(fx.li_risk(spark, sf), [PSI_FEAT], "part")


REPORT_SQL = (
    "WITH " + psi_ctes("li_risk", FEATS)
    + f", r AS (SELECT feature, round(sum(psi_bin), 5) AS psi, count(*) AS n_bins FROM psi_t GROUP BY feature)"
    + f" SELECT feature, psi, {STATUS_SQL} AS status, n_bins FROM r"
)


@register("psi_report", with_fixtures(REPORT_SQL, "li_risk"), ["psi"])
def q_psi_report(spark, sf):
    return B.psi_report(fx.li_risk(spark, sf), FEATS, "part")


COUNTS_SQL = (
    "WITH " + psi_ctes("li_risk", FEATS)
    + ", r AS (SELECT feature, round(sum(psi_bin), 5) AS psi FROM psi_t GROUP BY feature),"
    + f" s AS (SELECT psi, {STATUS_SQL} AS status FROM r)"
    + f" SELECT count_if(status = '{S}') AS n_stable, count_if(status = '{Mo}') AS n_moderate,"
    + f" count_if(status = '{H}') AS n_high, max(psi) AS max_psi FROM s"
)


@register("psi_status_counts", with_fixtures(COUNTS_SQL, "li_risk"), ["max_psi"])
def q_psi_counts(spark, sf):
    return G.psi_status_counts(B.psi_report(fx.li_risk(spark, sf), FEATS, "part"))


def gini_sql(src: str, period_expr: str, extra_cte: str = "") -> str:
    return f"""
WITH {extra_cte} per AS (SELECT {period_expr} AS period, pd_score, y FROM {src}),
a AS (SELECT period, max(P) + max(N) AS n_customers, max(P) AS pp, max(N) AS nn, {AUC_SQL} AS auc_raw
      FROM ({cum_sql('per', 'pd_score', 'y', ('period',))}) t GROUP BY period),
k AS (SELECT period, n_customers, round(pp / cast(n_customers AS double), 4) AS event_rate,
             round(2 * auc_raw - 1, 4) AS gini, round(auc_raw, 4) AS auc
      FROM a WHERE n_customers >= {K.GINI_MIN_PERIOD_ROWS} AND pp > 0 AND nn > 0),
d AS (SELECT *, gini - first_value(gini) OVER (ORDER BY period) AS gini_delta_from_baseline FROM k)
SELECT *, CASE WHEN gini_delta_from_baseline < {-K.GINI_DEGRADATION_ALERT} THEN 'ALERT'
               WHEN gini_delta_from_baseline < {-K.GINI_DEGRADATION_ALERT / 2} THEN 'WATCH' ELSE 'OK' END AS alert
FROM d"""


_Q5 = _dbl_list(B.qcut_probs(K.N_PERIODS))
GINI_CHUNK_SQL = gini_sql(
    "scored",
    "cast(len(list_filter((SELECT q FROM e)[2:len((SELECT q FROM e)) - 1], lambda z: z < cast(id AS double))) AS int)",
    f"e AS (SELECT list_sort(list_distinct(quantile_cont(cast(id AS double), {_Q5}))) AS q FROM scored),",
)


@register("gini_stability", with_fixtures(GINI_CHUNK_SQL, "scored"), ["gini_delta_from_baseline"])
def q_gini_stability(spark, sf):
    """Five equal-count periods of the customer key (no time column)."""
    return G.gini_stability(fx.scored(spark, sf), "pd_score", "y", order_col="id")


GINI_TIME_SQL = gini_sql("(SELECT period AS p, score AS pd_score, y FROM events_period) ev", "p")


@register("gini_stability_time", with_fixtures(GINI_TIME_SQL, "events_period"), ["gini_delta_from_baseline"])
def q_gini_stability_time(spark, sf):
    """Weekly periods of the events stream (time column given)."""
    return G.gini_stability(fx.events_period(spark, sf), "score", "y", time_col="period")


GROUPS = ("seg", "nationkey")


def bias_sql(src: str, score: str, groups) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS group_col, cast({c} AS varchar) AS group_val, {score} AS s0, y FROM {src}" for c in groups)
    return f"""
WITH ov AS (SELECT max(P) + max(N) AS n, {AUC_SQL} AS auc, max(P) / cast(max(P) + max(N) AS double) AS event_rate
            FROM ({cum_sql(src, score, 'y')}) t),
lg AS ({long}),
a AS (SELECT group_col, group_val, max(P) + max(N) AS n, max(P) AS pp, max(N) AS nn, {AUC_SQL} AS auc_raw
      FROM ({cum_sql('lg', 's0', 'y', ('group_col', 'group_val'))}) t GROUP BY group_col, group_val)
SELECT 'OVERALL' AS group_col, 'All' AS group_val, n, auc, 2 * auc - 1 AS gini, event_rate, 0.0::double AS auc_delta FROM ov
UNION ALL
SELECT group_col, group_val, n, round(auc_raw, 4), round(2 * auc_raw - 1, 4), round(pp / cast(n AS double), 4),
       round(auc_raw - (SELECT auc FROM ov), 4)
FROM a WHERE n >= {K.BIAS_MIN_GROUP} AND pp > 0 AND nn > 0"""


BIAS_SQL = bias_sql("scored", "pd_score", GROUPS)


@register("bias_audit", with_fixtures(BIAS_SQL, "scored"), ["auc", "gini", "event_rate", "auc_delta"])
def q_bias_audit(spark, sf):
    return G.bias_audit(fx.scored(spark, sf), "pd_score", "y", GROUPS)


LI_GROUPS = ("ship_year", "part")


@register(
    "bias_audit_lineitem",
    with_fixtures(bias_sql("li_risk", "l_extendedprice", LI_GROUPS), "li_risk"),
    ["auc", "gini", "event_rate", "auc_delta"],
)
def q_bias_audit_lineitem(spark, sf):
    """The audit at volume: one nearly unique score per line item."""
    return G.bias_audit(fx.li_risk(spark, sf), "l_extendedprice", "y", LI_GROUPS)


lo, hi = K.BIAS_SHARE_BANDS
SHARES_SQL = (
    BIAS_SQL.replace("\nSELECT 'OVERALL'", ", ba AS (SELECT 'OVERALL'", 1)
    + f""")
SELECT group_col, group_val, n, n / cast(sum(n) OVER (PARTITION BY group_col) AS double) AS share, auc_delta,
       max(abs(auc_delta)) OVER (PARTITION BY group_col) AS max_abs_delta,
       CASE WHEN abs(auc_delta) > {hi} THEN 'red' WHEN abs(auc_delta) > {lo} THEN 'amber' ELSE 'green' END AS band
FROM ba WHERE group_col <> 'OVERALL'"""
)


@register("bias_shares", with_fixtures(SHARES_SQL, "scored"), ["share", "auc_delta", "max_abs_delta"])
def q_bias_shares(spark, sf):
    return G.bias_shares(G.bias_audit(fx.scored(spark, sf), "pd_score", "y", GROUPS))


SCORE_SHIFT_SQL = (
    "WITH sp AS (SELECT pd_score, CASE split WHEN 'test' THEN 'expected' WHEN 'oot' THEN 'actual' END AS part FROM ("
    + f"""SELECT pd_score, CASE WHEN rn <= round({K.OOT_FRACTION} * n_y) THEN 'oot'
                    WHEN rn <= round({K.OOT_FRACTION} * n_y) + round({K.TEST_SIZE} * (n_y - round({K.OOT_FRACTION} * n_y))) THEN 'test'
                    ELSE 'train' END AS split
      FROM (SELECT pd_score, row_number() OVER (PARTITION BY y ORDER BY md5(cast(id AS varchar))) AS rn,
                   count(*) OVER (PARTITION BY y) AS n_y FROM scored) r) s),"""
    + psi_ctes("sp", ["pd_score"])
    + f", r AS (SELECT feature, round(sum(psi_bin), 5) AS psi, count(*) AS n_bins FROM psi_t GROUP BY feature)"
    + f" SELECT feature, psi, {STATUS_SQL} AS status, n_bins FROM r"
)


def _scored_parts(spark, sf):
    s = SP.stratified_split(fx.scored(spark, sf), "id", "y")
    return s.withColumn(
        "part", F.when(F.col("split") == "test", "expected").when(F.col("split") == "oot", "actual")
    )


@register("score_shift", with_fixtures(SCORE_SHIFT_SQL, "scored"), ["psi"])
def q_score_shift(spark, sf):
    """PSI of the PD between the test split (expected) and the holdout (actual)."""
    return G.score_shift(_scored_parts(spark, sf), "pd_score", "part")


KPI_FEATS = ["limit_bal", "bill_amt1", "pay_amt1"]
KPI_SQL = (
    f"""
WITH cut AS (SELECT pd_score, y, {', '.join(KPI_FEATS)}, CASE WHEN rn <= round({K.OOT_FRACTION} * n_y) THEN 'oot'
                    WHEN rn <= round({K.OOT_FRACTION} * n_y) + round({K.TEST_SIZE} * (n_y - round({K.OOT_FRACTION} * n_y))) THEN 'test'
                    ELSE 'train' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(cast(id AS varchar))) AS rn,
                   count(*) OVER (PARTITION BY y) AS n_y FROM scored) r),
sp AS (SELECT *, CASE split WHEN 'test' THEN 'expected' WHEN 'oot' THEN 'actual' END AS part FROM cut),
m AS (SELECT split, {AUC_SQL} AS auc,
             greatest(max((P - pos_cum + pos) / cast(P AS double) - (N - neg_cum + neg) / cast(N AS double)), 0.0) AS ks
      FROM ({cum_sql('sp', 'pd_score', 'y', ('split',))}) t GROUP BY split),
k AS (SELECT max(CASE WHEN split = 'test' THEN auc END) AS auc_test, max(CASE WHEN split = 'test' THEN ks END) AS ks_test,
             max(CASE WHEN split = 'oot' THEN auc END) AS auc_oot FROM m),
{psi_ctes('sp', KPI_FEATS)},
j AS (SELECT *, (SELECT max(psi) FROM (SELECT round(sum(psi_bin), 5) AS psi FROM psi_t GROUP BY feature) f) AS max_psi,
             (SELECT min(gini) FROM ({GINI_CHUNK_SQL}) g) AS min_gini,
             (SELECT max(abs(auc_delta)) FROM ({BIAS_SQL}) b) AS max_bias FROM k)
SELECT auc_test, 2 * auc_test - 1 AS gini_test, ks_test, auc_oot, auc_oot - auc_test AS auc_delta, max_psi, min_gini, max_bias,
       auc_test > 0.75 AS auc_ok, 2 * auc_test - 1 > 0.5 AS gini_ok, ks_test > 0.3 AS ks_ok,
       abs(auc_oot - auc_test) < 0.03 AS oot_ok, max_psi < {K.PSI_STABLE} AS psi_ok,
       min_gini >= {K.MIN_ACCEPTABLE_GINI} AS min_gini_ok, max_bias < {K.BIAS_AUC_DELTA_FLAG} AS bias_ok
FROM j"""
)


@register(
    "kpi_summary",
    with_fixtures(KPI_SQL, "scored"),
    ["auc_test", "gini_test", "ks_test", "auc_oot", "auc_delta", "max_psi", "min_gini", "max_bias"],
)
def q_kpi(spark, sf):
    """Headline KPIs with their pass rules (test vs holdout of the scored portfolio)."""
    s = _scored_parts(spark, sf)
    held = s.where(F.col("split").isin("test", "oot"))
    return G.kpi_summary(
        M.evaluate_model(held, "pd_score", "y", ["split"]),
        B.psi_report(s, KPI_FEATS, "part"),
        G.gini_stability(s, "pd_score", "y", order_col="id"),
        G.bias_audit(s, "pd_score", "y", GROUPS),
    )
