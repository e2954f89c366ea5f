"""Queries: model card, governance text, and the report-serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators import governance as G
from riskloom.operators import metrics as M
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_governance import BIAS_SQL, GROUPS
from riskloom.plans.q_metrics import EVAL_SELECT, metric_sql
from riskloom.plans.q_scorecard import IV_SQL, woe_ctes
from riskloom.plans.q_segments import SQL_TIER_SUMMARY
from riskloom.sources import fixtures as fx
from riskloom.sources import io

LIMITATIONS = [
    "Static model: refit when PSI exceeds the review threshold",
    "Gini stability periods are equal-count chunks when no time column is given",
]


def _card(spark, sf):
    """Card of the model that the workflow fits."""
    from riskloom.plans.q_workflow import workflow

    return workflow(spark, sf).card("credit_default_pd", "1.0.0", LIMITATIONS)


@register("model_card")
def q_model_card(spark, sf):
    return _card(spark, sf)


@register("governance_rows")
def q_governance_rows(spark, sf):
    return G.governance_rows(_card(spark, sf))


@register("write_model_card")
def q_write_model_card(spark, sf):
    card = _card(spark, sf)
    path = io.scratch_path(spark, "model-card")
    io.write_model_card(card, path)
    return spark.read.schema(card.schema).json(path)


@register("write_text_report")
def q_write_text_report(spark, sf):
    rows = G.governance_rows(_card(spark, sf)).select("line_no", F.col("text").alias("value"))
    path = io.scratch_path(spark, "governance-txt")
    io.write_text_report(rows, path)
    return spark.read.text(path)


# ------------------------------------------------------------ report serving
SQL_FILTER = "SELECT * FROM (" + BIAS_SQL.replace("WITH ov AS", "WITH ov AS", 1) + ") b WHERE group_col <> 'OVERALL'"


@register("report_filter", with_fixtures(SQL_FILTER, "scored"), ["auc", "gini", "event_rate", "auc_delta"])
def q_report_filter(spark, sf):
    """Subgroup rows of the bias report (the page filter)."""
    return G.bias_audit(fx.scored(spark, sf), "pd_score", "y", GROUPS).where(F.col("group_col") != "OVERALL")


SQL_TOPN = (
    "WITH " + woe_ctes() + IV_SQL.replace("\nSELECT", ", ivt AS (SELECT", 1)
    + ") SELECT feature, iv FROM ivt ORDER BY iv DESC, feature LIMIT 3"
)


@register("report_topn", with_fixtures(SQL_TOPN, "li_risk"), ["iv"])
def q_report_topn(spark, sf):
    """Top-n features by IV (a top-k report)."""
    iv = B.iv_table(B.woe_table(fx.li_risk(spark, sf), fx.LI_FEATURES, "y"), fx.LI_FEATURES)
    return iv.select("feature", "iv").orderBy(F.desc("iv"), "feature").limit(3)


SQL_DISTINCT = "SELECT DISTINCT group_col FROM (" + BIAS_SQL + ") b"


@register("report_distinct", with_fixtures(SQL_DISTINCT, "scored"))
def q_report_distinct(spark, sf):
    return G.bias_audit(fx.scored(spark, sf), "pd_score", "y", GROUPS).select("group_col").distinct()


SQL_SHARE = (
    "SELECT risk_tier, n_customers, n_customers / cast(sum(n_customers) OVER () AS double) AS share FROM ("
    + SQL_TIER_SUMMARY + ") t"
)


@register("report_share", with_fixtures(SQL_SHARE, "scored"), ["share"])
def q_report_share(spark, sf):
    """Share of the listed portfolio per tier (ratio to the total over a 4-row table)."""
    from pyspark.sql import Window

    from riskloom.operators import segments as sg

    t = sg.tier_summary(fx.scored(spark, sf))
    return t.select("risk_tier", "n_customers", (F.col("n_customers") / F.sum("n_customers").over(Window.partitionBy())).alias("share"))


SQL_MELT = (
    "SELECT seg, metric, value FROM (UNPIVOT (SELECT seg, auc, gini, ks FROM ("
    + metric_sql("scored", "pd_score", "y", ("seg",), EVAL_SELECT)
    + ") m) ON auc, gini, ks INTO NAME metric VALUE value) u"
)


@register("report_melt", with_fixtures(SQL_MELT, "scored"), ["value"])
def q_report_melt(spark, sf):
    """Metrics to long form (seg, metric, value) for grouped bars."""
    m = M.evaluate_model(fx.scored(spark, sf), "pd_score", "y", ["seg"]).select("seg", "auc", "gini", "ks")
    return m.unpivot(["seg"], ["auc", "gini", "ks"], "metric", "value")
