"""The workflow on fitted PDs, contracts at load, feature pipelines of all datasets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators import cleaning as C
from riskloom.operators import explain as XP
from riskloom.operators import governance as G
from riskloom.operators import segments as SG
from riskloom.operators.features import pipeline_for
from riskloom.operators.workflow import PD_COLS, CreditWorkflow
from riskloom.sources import io

from conftest import SF01, SF001


@pytest.fixture(scope="module")
def fitted(spark) -> CreditWorkflow:
    """Fitted on a planted target: low limits default, one label in ten is flipped
    (the customers' own target is random with respect to their features)."""
    clean = io.load_dataset(spark, "uci", SF01)
    planted = (F.col("LIMIT_BAL") < 200_000) != (F.col("ID") % 10 == 0)
    clean = clean.withColumn("default_payment_next_month", planted.cast("int"))
    return CreditWorkflow(pipeline_for("uci"), io.dataset_spec("uci").group_cols, n_trees=10).fit(clean)


def test_every_row_gets_every_pd(spark, fitted):
    clean = io.load_dataset(spark, "uci", SF01)
    assert fitted.scored.select("id").distinct().count() == fitted.scored.count() == clean.count()
    for c in PD_COLS.values():
        assert fitted.scored.where(F.col(c).isNull() | ~F.col(c).between(0, 1)).count() == 0


def test_comparison_covers_models_and_splits(fitted):
    rows = fitted.comparison().collect()
    assert {(r["model"], r["split"]) for r in rows} == {(m, s) for m in PD_COLS for s in ("test", "oot")}
    assert all(abs(r["gini"] - (2 * r["auc"] - 1)) < 1e-9 for r in rows)
    auc = {(r["model"], r["split"]): r["auc"] for r in rows}
    assert all(a > 0.8 for (m, _), a in auc.items() if m != "scorecard")
    # so strong a feature has a suspicious information value: the scorecard leaves it out by rule
    assert "LIMIT_BAL" not in fitted.card_features and fitted.card_features
    assert fitted.importance().first()["feature"] == "LIMIT_BAL"


def test_card_and_kpis_come_from_the_same_model(fitted):
    kpi = fitted.kpis().first()
    card = fitted.card("m", "1", ["x"]).first()
    assert kpi["auc_test"] == pytest.approx(card["performance"]["auc_test"])
    assert kpi["min_gini"] == pytest.approx(card["stability"]["min_gini"])
    assert {r["feature"] for r in card["top_features"]} <= set(fitted.screen.selected)
    assert card["groups_tested"] and card["cross_validation"]["folds"] == 5
    sections = {r["section"] for r in G.governance_rows(fitted.card("m", "1", ["x"])).collect()}
    assert {"architecture", "cross_validation", "monitoring_plan", "fairness_details"} <= sections


def test_scorecard_fits_its_bins_once(spark, monkeypatch):
    rows = [(i, float(i % 23), float(i * 7 % 31), int(i * i % 5 == 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    fits, fit_bins = [], B.fit_bins
    monkeypatch.setattr(B, "fit_bins", lambda *args: fits.append(args) or fit_bins(*args))
    w = CreditWorkflow(pipeline_for("uci"))
    w.screen.selected = ["a", "b"]
    scored = w._fit_scorecard(df, df)
    assert len(fits) == 1 and scored.where(F.col("pd_scorecard").between(0, 1)).count() == 600
    model, table = B.WoEModel.fit_table(df, ["a", "b"])
    assert model.woe == B.WoEModel.fit(df, ["a", "b"]).woe
    assert sorted(table.collect()) == sorted(B.woe_table(df, ["a", "b"]).collect())


def test_contract_stops_bad_tables(spark):
    with pytest.raises(ValueError, match="min_rows"):
        io.load_dataset(spark, "uci", SF001)
    df = spark.createDataFrame([(1, 0), (2, 2)], "ID int, y int")
    with pytest.raises(ValueError, match="target_binary"):
        C.enforce_contract(df, "y", min_rows=1)
    with pytest.raises(ValueError, match="target_present"):
        C.enforce_contract(df, "z", min_rows=1)
    assert C.enforce_contract(df.where("y = 0"), "y", min_rows=1).count() == 1


def test_pipeline_state_comes_from_train_only(spark):
    clean = io.load_dataset(spark, "gmc", SF001, 100)
    pipe = pipeline_for("gmc").fit(clean.where(F.col("ID") % 2 == 0))
    limit = pipe.max_weighted
    out = pipe.transform(clean)
    assert pipe.max_weighted == limit and out.count() == clean.count()
    with pytest.raises(RuntimeError):
        pipeline_for("homecredit").transform(clean)
    with pytest.raises(ValueError):
        pipeline_for("other")


def test_audit_group_survives_one_hot_and_unknown_groups_raise(spark):
    clean = io.load_dataset(spark, "homecredit", SF001, 100)
    assert {"CODE_GENDER", "CODE_GENDER_M"} <= set(clean.columns)
    with pytest.raises(ValueError, match="no such group"):
        G.bias_audit(clean, "AMT_CREDIT", "TARGET", ["CODE_GENDER", "absent"])


def test_segments_have_names_and_tiers(spark):
    rows = [(i, float(i % 4 * 10 + i % 3 * 0.1), float(i % 4), float(i % 4) * 2, (i % 4 + 1) / 10.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, pd_score double")
    model, scaler, _ = SG.kmeans_segments(df, ["a", "b", "c"], restarts=2)
    names = SG.segment_names(SG.assign_segments(model, scaler, df, ["a", "b", "c"]))
    out = SG.assign_segments(model, scaler, df, ["a", "b", "c"], names=names)
    assert len(names) == 4 and {r["segment"] for r in out.select("segment").distinct().collect()} == set(names.values())
    assert out.where("a <> cast(id % 4 * 10 + id % 3 * 0.1 as double) and abs(a - (id % 4 * 10 + id % 3 * 0.1)) > 1e-9").count() == 0
    inertia = [r[1] for r in SG.elbow(df, ["a", "b", "c"], range(2, 5), restarts=3)]
    assert inertia == sorted(inertia, reverse=True)


def test_attributions_of_more_than_64_features_add_up():
    """A chain of splits over features 0, 40 and 99, one of them twice."""
    tree = {
        "feat": np.array([99, 40, 0, -1, -1, 99, -1, -1, -1]), "thr": np.array([0.5, 0.5, 0.5, 0, 0, 0.2, 0, 0, 0]),
        "left": np.array([1, 3, 8, -1, -1, 6, -1, -1, -1]), "right": np.array([2, 5, 4, -1, -1, 7, -1, -1, -1]),
        "val": np.array([0, 0, 0, 1.0, -2.0, 0, 3.0, 5.0, -1.0]), "w": 1.0,
    }
    rng = np.random.default_rng(3)
    x, bg = rng.random((20, 100)), rng.random((15, 100))
    phi = XP.shap_values([tree], x, [XP.leaf_patterns(tree, bg)])
    assert np.allclose(phi.sum(axis=1), XP.margin([tree], x) - XP.margin([tree], bg).mean())
    assert not phi[:, [i for i in range(100) if i not in (0, 40, 99)]].any()
