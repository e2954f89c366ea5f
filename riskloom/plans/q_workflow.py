"""Queries: the whole workflow, from load to governance, on a fitted model's PD."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators.features import pipeline_for
from riskloom.operators.segments import tier_summary
from riskloom.operators.workflow import CreditWorkflow
from riskloom.plans.catalog import register
from riskloom.plans.q_models import CLUSTER_FEATURES, N_TREES
from riskloom.plans.q_sources import FIXTURE_MIN_ROWS
from riskloom.sources import io


_FITTED: dict[tuple[str, str], CreditWorkflow] = {}


def workflow(spark, sf) -> CreditWorkflow:
    """Card statements: load under the contract, split, engineer, select, fit, score.

    Fitted once per session and state of the input files: all reports come from one model."""
    inputs = [f"{sf}/customer.parquet", f"{sf}/orders.parquet"]
    key = (spark.sparkContext.applicationId, io.fingerprint(spark, inputs, sf))
    if key not in _FITTED:
        spec = io.dataset_spec("uci")
        clean = io.load_dataset(spark, "uci", sf, FIXTURE_MIN_ROWS)
        _FITTED.clear()
        _FITTED[key] = CreditWorkflow(pipeline_for("uci"), spec.group_cols, N_TREES).fit(clean)
    return _FITTED[key]


@register("workflow_scores")
def q_scores(spark, sf):
    """PD of the scorecard, of the raw and of the calibrated trees for every row of every split."""
    return workflow(spark, sf).scored


@register("workflow_comparison")
def q_comparison(spark, sf):
    return workflow(spark, sf).comparison()


@register("workflow_tiers")
def q_tiers(spark, sf):
    return tier_summary(workflow(spark, sf).scored)


@register("workflow_segments")
def q_segments(spark, sf):
    return workflow(spark, sf).segments(CLUSTER_FEATURES)


@register("workflow_kpis")
def q_kpis(spark, sf):
    return workflow(spark, sf).kpis()


@register("workflow_drift")
def q_drift(spark, sf):
    """PSI of the selected features and of the score, in one report."""
    w = workflow(spark, sf)
    return w.psi().withColumn("kind", F.lit("feature")).unionByName(w.score_shift().withColumn("kind", F.lit("score")))
