"""Queries: reports kept by run, model and split, their filters and exports, and drift over a stream of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import binning as B
from riskloom.operators import governance as G
from riskloom.operators import segments as sg
from riskloom.operators import splits as SP
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_governance import FEATS, GROUPS, REPORT_SQL, bias_sql
from riskloom.plans.q_scorecard import SC
from riskloom.plans.q_segments import SQL_TIER_SUMMARY, TIER_CASE
from riskloom.sources import fixtures as fx
from riskloom.sources import io
from riskloom.sources.reports import ReportStore
from riskloom.streaming import drift, monitor

N_OOT = f"round({K.OOT_FRACTION} * n_y)"
SPLIT_SQL = f"""
SELECT *, -limit_bal AS limit_score, CASE WHEN rn <= {N_OOT} THEN 'oot' WHEN rn <= {N_OOT} + round({K.TEST_SIZE} * (n_y - {N_OOT})) THEN 'test'
          ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(cast(id AS varchar))) AS rn, count(*) OVER (PARTITION BY y) AS n_y FROM scored) r"""
MODELS = {"pd": "pd_score", "limit": "limit_score"}


def _store(spark, sf) -> ReportStore:
    """Bias reports of two models on two splits, each written twice; the second copy replaces the first."""
    store = ReportStore(spark, io.scratch_path(spark, "reports"))
    s = SP.stratified_split(fx.scored(spark, sf).withColumn("limit_score", -F.col("limit_bal")), "id", "y")
    for model, score in MODELS.items():
        for split in ("test", "oot"):
            rows = G.bias_audit(s.where(F.col("split") == split), score, "y", GROUPS, min_group=20)
            for _ in range(2):
                store.write("bias", rows, "r1", model, split)
    return store


BIAS_DBL = ["auc", "gini", "event_rate", "auc_delta"]
LIMIT_OOT = bias_sql("(SELECT * FROM parts WHERE split = 'oot')", "limit_score", GROUPS).replace(f"n >= {K.BIAS_MIN_GROUP}", "n >= 20")


def _store_sql(sql: str) -> str:
    return with_fixtures(sql, "scored", extra={"parts": SPLIT_SQL})


@register(
    "report_store_split", _store_sql(f"SELECT 'r1' AS run, 'limit' AS model, 'oot' AS split, * FROM ({LIMIT_OOT}) b"), BIAS_DBL
)
def q_store_split(spark, sf):
    """One model and split of the stored bias reports: only its folder is read."""
    return _store(spark, sf).read("bias", model="limit", split="oot")


@register(
    "report_store_group",
    _store_sql(f"SELECT 'r1' AS run, 'limit' AS model, 'oot' AS split, * FROM ({LIMIT_OOT}) b WHERE group_col = 'seg'"), BIAS_DBL,
)
def q_store_group(spark, sf):
    return _store(spark, sf).read("bias", run="r1", model="limit", split="oot", group_cols=["seg"])


@register(
    "report_store_parts",
    "SELECT m.model, s.split FROM (SELECT unnest(['pd', 'limit']) AS model) m CROSS JOIN (SELECT unnest(['test', 'oot']) AS split) s",
)
def q_store_parts(spark, sf):
    """Which models and splits the store holds."""
    return _store(spark, sf).read("bias").select("model", "split").distinct()


PSI_FEATURES = ["l_quantity", "l_tax"]
PSI_FILTER_SQL = f"SELECT 'r1' AS run, 'pd' AS model, 'oot' AS split, * FROM ({REPORT_SQL}) p WHERE feature IN ({', '.join(map(repr, PSI_FEATURES))})"


@register("report_store_feature", with_fixtures(PSI_FILTER_SQL, "li_risk"), ["psi"])
def q_store_feature(spark, sf):
    """The feature filter: rows of two features of the stored PSI report."""
    store = ReportStore(spark, io.scratch_path(spark, "reports"))
    store.write("psi", B.psi_report(fx.li_risk(spark, sf), FEATS, "part"), "r1", "pd", "oot")
    return store.read("psi", features=PSI_FEATURES)


TIER_DBL = ["avg_pd", "actual_default_rate", "pct_of_portfolio"]
STORED_TIERS = f"SELECT *, 'r1' AS run, 'pd' AS model, 'all' AS split FROM ({SQL_TIER_SUMMARY}) t"


def _exported(spark, sf, fmt: str):
    store = ReportStore(spark, io.scratch_path(spark, "reports"))
    store.write("tiers", sg.tier_summary(fx.scored(spark, sf)), "r1", "pd", "all")
    return store.export("tiers", io.scratch_path(spark, f"tiers-{fmt}"), fmt, run="r1")


for _fmt in ("csv", "json"):

    def _q(spark, sf, fmt=_fmt):
        return _exported(spark, sf, fmt)

    _q.__doc__ = f"A stored report exported as {_fmt.upper()} and read back."
    register(f"export_report_{_fmt}", with_fixtures(STORED_TIERS, "scored"), TIER_DBL)(_q)


@register("export_report_text", with_fixtures(f"SELECT risk_tier || ' | ' || n_customers AS value FROM ({SQL_TIER_SUMMARY}) t", "scored"))
def q_export_text(spark, sf):
    """A stored report as lines of text: tier and number of customers of each line."""
    cells = F.split(F.col("value"), r" \| ")
    return _exported(spark, sf, "text").select(F.concat_ws(" | ", F.get(cells, F.lit(1)), F.get(cells, F.lit(2))).alias("value"))


# ------------------------------------------------------------ streams
@register("stream_psi_report", with_fixtures(REPORT_SQL, "li_risk"), ["psi"])
def q_stream_psi(spark, sf):
    """PSI of files that arrive one by one against the fitted reference: counts are the stream's state."""
    li = fx.li_risk(spark, sf)
    path = io.scratch_path(spark, "arrivals")
    li.where("part = 'actual'").select(*FEATS).repartition(3).write.parquet(path)
    reference = drift.fit_reference(li.where("part = 'expected'"), FEATS)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    return drift.run(stream, reference, io.scratch_path(spark, "drift-counts"), io.scratch_path(spark, "drift-checkpoint"))


@register("stream_scores", with_fixtures(f"SELECT id, pd_score, {TIER_CASE} AS risk_tier, {SC.SCORE_SQL} AS score FROM scored", "scored"), ["pd_score", "score"])
def q_stream_scores(spark, sf):
    """Points and tier of customers that arrive as files."""
    source, out = io.scratch_path(spark, "customers"), io.scratch_path(spark, "scores")
    fx.scored(spark, sf).select("id", "pd_score").repartition(3).write.parquet(source)
    stream = spark.readStream.schema("id long, pd_score double").option("maxFilesPerTrigger", 1).parquet(source)
    monitor.write_scored_stream(stream, out, io.scratch_path(spark, "scores-checkpoint"), available_now=True).awaitTermination()
    return spark.read.schema("id long, pd_score double, risk_tier string, score double").parquet(out)
