"""Queries: variance, correlation matrix, target correlation, pruning, VIF."""

from __future__ import annotations

from riskloom.functions import constants as K
from riskloom.operators import features as fe
from riskloom.operators import selection as SL
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_sources import FEATS as FE_COLS
from riskloom.plans.q_sources import RAW_KEEP, statement_sql
from riskloom.sources import fixtures as fx

FEATS = fx.LI_FEATURES


def _unpivot_sql(feats) -> str:
    casts = ", ".join(f"cast({f} AS double) AS {f}" for f in feats)
    return f"(UNPIVOT (SELECT {casts} FROM li_risk) ON {', '.join(feats)} INTO NAME feature VALUE x)"


SQL_NZV = f"""SELECT feature, var_samp(x) AS variance, coalesce(var_samp(x) < 1e-6, false) AS dropped
FROM {_unpivot_sql(FEATS)} u GROUP BY feature"""


@register("near_zero_variance", with_fixtures(SQL_NZV, "li_risk"), ["variance"])
def q_nzv(spark, sf):
    return SL.near_zero_variance(fx.li_risk(spark, sf), FEATS)


SQL_CORR = " UNION ALL ".join(
    f"SELECT '{FEATS[i]}' AS f1, '{FEATS[j]}' AS f2, abs(corr({FEATS[i]}, {FEATS[j]})) AS r FROM li_risk"
    for i in range(len(FEATS)) for j in range(i + 1, len(FEATS))
)


@register("corr_matrix", with_fixtures(SQL_CORR, "li_risk"), ["r"])
def q_corr(spark, sf):
    return SL.corr_matrix(fx.li_risk(spark, sf), FEATS)


SQL_TCORR = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, abs(corr({f}, y)) AS target_corr FROM li_risk" for f in FEATS
)


@register("target_corr", with_fixtures(SQL_TCORR, "li_risk"), ["target_corr"])
def q_tcorr(spark, sf):
    return SL.target_corr(fx.li_risk(spark, sf), FEATS, "y")


def _statement(spark, sf):
    df = fe.statement_features(fx.panel(spark, sf))
    feats = [c for c in df.columns if c not in ("id", "seg", "nationkey", "y")]
    return df, feats


# column order of the engineered statement features
STATEMENT = ["limit_bal", *[c for k in range(1, 7) for c in (f"bill_amt{k}", f"pay_amt{k}", f"pay_{k}") if c in RAW_KEEP], *FE_COLS[len(RAW_KEEP):]]


def _prune_sql(feats=STATEMENT, threshold: float = K.CORR_THRESHOLD) -> str:
    """The pairs above the threshold, settled one by one in column order."""
    pairs = ", ".join(
        f"{{'i': {i}, 'j': {j}, 'r': abs(corr({a}, {b}))}}" for j, b in enumerate(feats) for i, a in enumerate(feats[:j])
    )
    gains = ", ".join(f"coalesce(abs(corr({f}, y)), 0.0)" for f in feats)
    return f"""WITH RECURSIVE fe AS ({statement_sql()}),
cr AS (SELECT [{pairs}] AS pairs, [{gains}] AS gain FROM fe),
pr AS (SELECT unnest(pairs) AS p FROM cr),
hi AS (SELECT row_number() OVER (ORDER BY p.j, p.i) AS n, p.i AS i, p.j AS j FROM pr WHERE p.r > {threshold} AND NOT isnan(p.r)),
walk AS (
    SELECT 0::BIGINT AS n, []::BIGINT[] AS gone
    UNION ALL
    SELECT hi.n, CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gone
        ELSE list_append(gone, CASE WHEN gain[j + 1] >= gain[i + 1] THEN i ELSE j END) END
    FROM walk JOIN hi ON hi.n = walk.n + 1 CROSS JOIN cr
)
SELECT {feats!r}[unnest(gone) + 1] AS feature FROM (SELECT gone FROM walk ORDER BY n DESC LIMIT 1) w"""


@register("corr_prune", with_fixtures(_prune_sql(), "panel"))
def q_corr_prune(spark, sf):
    """Greedy |r| > 0.85 pruning over the engineered statement features."""
    df, feats = _statement(spark, sf)
    dropped = SL.corr_prune(df, feats, "y")
    return spark.createDataFrame([(f,) for f in dropped], "feature string")


@register("vif")
def q_vif(spark, sf):
    """Iterative VIF pruning (> 10) after correlation pruning."""
    df, feats = _statement(spark, sf)
    dropped = SL.corr_prune(df, feats, "y")
    cols = [f for f in feats if f not in dropped]
    out = SL.vif_prune(df, cols)
    return spark.createDataFrame([(f, float(v)) for f, v in out], "feature string, vif double")


@register("drop_report")
def q_drop_report(spark, sf):
    df, feats = _statement(spark, sf)
    return SL.CollinearityScreen().fit(df, feats, "y").report(spark)


# VIF of three features, closed form (adjugate of the 3x3 uncentred Gram matrix)
V3 = ["l_quantity", "l_extendedprice", "l_tax"]


def _vif3_sql() -> str:
    a, b, c = V3
    g = {}
    for i, x in enumerate(V3):
        for j, y in enumerate(V3):
            g[(i, j)] = f"g{min(i, j)}{max(i, j)}"
    sums = ", ".join(
        f"sum(cast({V3[i]} AS double) * cast({V3[j]} AS double)) AS g{i}{j}" for i in range(3) for j in range(i, 3)
    )
    det = "(g00*(g11*g22 - g12*g12) - g01*(g01*g22 - g12*g02) + g02*(g01*g12 - g11*g02))"
    cof = ["(g11*g22 - g12*g12)", "(g00*g22 - g02*g02)", "(g00*g11 - g01*g01)"]
    diag = ["g00", "g11", "g22"]
    rows = " UNION ALL ".join(
        f"SELECT '{V3[i]}' AS feature, {diag[i]} * {cof[i]} / {det} AS vif FROM s" for i in range(3)
    )
    return f"WITH s AS (SELECT {sums} FROM li_risk) {rows}"


@register("vif_table", with_fixtures(_vif3_sql(), "li_risk"), ["vif"])
def q_vif_table(spark, sf):
    return SL.vif_table(fx.li_risk(spark, sf), V3)
