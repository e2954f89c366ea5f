"""The whole credit workflow on one cleaned dataset.

split -> features -> collinearity screen -> scorecard and boosted trees ->
one written table with every model's PD -> comparison, tiers, segments,
monitoring, KPIs and the model card, all from those fitted PDs.

Rows pass through four written tables (split, features, model input,
scores); everything fitted is bounded by features x bins, trees x nodes or
groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import binning as B
from riskloom.operators import governance as G
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.operators import scorecard as SC
from riskloom.operators import segments as SG
from riskloom.operators import splits as SP
from riskloom.operators.features import FeaturePipeline
from riskloom.operators.ordered import materialize
from riskloom.operators.scaling import fit_standard
from riskloom.operators.selection import CollinearityScreen
from riskloom.session import run_parallel

# model name -> its PD column in the scored table; the last one serves governance
PD_COLS = {"scorecard": "pd_scorecard", "lightgbm": "pd_lightgbm", "xgboost": "pd_score"}
GROUP = "group_"


class CreditWorkflow:
    """Fit on the train split; ``scored`` holds id, y, split, audit groups and all PDs of every row."""

    def __init__(self, pipeline: FeaturePipeline, group_cols: Sequence[str] = (), n_trees: int = K.GBT_TREES):
        self.pipeline, self.n_trees = pipeline, n_trees
        self.groups = [GROUP + c for c in group_cols]
        self.screen = CollinearityScreen()
        self.card_features: list[str] = []

    def fit(self, clean: DataFrame) -> "CreditWorkflow":
        p = self.pipeline
        split = SP.stratified_split(clean, p.key, p.label)
        split = materialize(split.withColumns({g: F.col(g.removeprefix(GROUP)).cast("string") for g in self.groups}), "wf-split")
        carried = ["split", *self.groups]
        p.others = (*p.others, *carried)
        p.fit(split.where(F.col("split") == "train"))
        table = p.transform(split, carried).withColumnsRenamed({p.key: "id", p.label: "y"})
        self.table = materialize(table, "wf-features")
        train = self.part("train")
        self.screen.fit(train, p.features)
        scored = self._fit_trees(train, self._fit_scorecard(train, self.table))
        self.scored = materialize(scored.select("id", "y", *carried, *PD_COLS.values()), "wf-scored")
        return self

    def part(self, name: str) -> DataFrame:
        return self.table.where(F.col("split") == name)

    def _fit_scorecard(self, train: DataFrame, df: DataFrame) -> DataFrame:
        """Logistic model on the standardised WoE of the features with enough information value."""
        feats = self.screen.selected
        bins, table = B.WoEModel.fit_table(train, feats, "y")
        self.iv = B.iv_table(table, feats)
        chosen = [r["feature"] for r in B.iv_select(self.iv).select("feature").collect()]
        self.card_features = [f for f in feats if f in chosen] or list(feats)
        woe = [f"WOE_{f}" for f in self.card_features]
        train_woe = materialize(bins.transform(train, self.card_features).select("y", *woe), "wf-woe")
        scale = fit_standard(train_woe, woe)
        self.logit, intercept, coefs = SC.fit_logit(scale.transform(train_woe), woe, "y")
        z = sum((F.lit(coefs[c]) * F.col(f"`{c}`") for c in woe), F.lit(intercept))
        scored = scale.transform(bins.transform(df, self.card_features))
        return scored.withColumn(PD_COLS["scorecard"], 1 / (1 + F.exp(-z))).drop(*woe)

    def _fit_trees(self, train: DataFrame, df: DataFrame) -> DataFrame:
        """Both presets with early stopping; the first one is calibrated by folds."""
        feats = self.screen.selected
        early = SP.stratified_split(train.select("id", "y", *feats), "id", "y", oot=0.0, test=K.EARLY_STOP_FRACTION, out="part")
        early = MD.vector_table(early.withColumn("is_val", F.col("part") == "test"), feats, ["y", "is_val"], "wf-early")
        self.xgboost, lightgbm, calibrated = run_parallel([
            lambda: MD.fit_gbt(early, feats, "y", "xgboost", self.n_trees, "is_val"),
            lambda: MD.fit_gbt(early, feats, "y", "lightgbm", self.n_trees, "is_val"),
            lambda: MD.platt_calibrate(train, feats, "y", "id", "xgboost", self.n_trees),
        ])
        return MD.predict_pd(lightgbm, calibrated.transform(df, PD_COLS["xgboost"]), feats, PD_COLS["lightgbm"])

    # ------------------------------------------------------------- reports
    def comparison(self) -> DataFrame:
        """One metrics row per model and held-out split."""
        held = self.scored.where(F.col("split").isin("test", "oot"))
        scores = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("p")) for m, c in PD_COLS.items()]))
        return M.model_comparison(held.select("split", "y", scores.alias("s")).select("split", "y", "s.*"), "p", "y")

    def psi(self) -> DataFrame:
        """Drift of the selected features between train and holdout."""
        part = F.when(F.col("split") == "train", "expected").when(F.col("split") == "oot", "actual")
        return B.psi_report(self.table.withColumn("part", part), self.screen.selected, "part")

    def score_shift(self) -> DataFrame:
        part = F.when(F.col("split") == "test", "expected").when(F.col("split") == "oot", "actual")
        return G.score_shift(self.scored.withColumn("part", part), "pd_score", "part")

    def stability(self) -> DataFrame:
        return G.gini_stability(self.scored, "pd_score", "y", order_col="id")

    def bias(self) -> DataFrame:
        return G.bias_audit(self.scored, "pd_score", "y", self.groups)

    def kpis(self) -> DataFrame:
        return G.kpi_summary(
            self.comparison().where(F.col("model") == "xgboost"), self.psi(), self.stability(), self.bias()
        )

    def segments(self, features: Sequence[str]) -> DataFrame:
        """Cluster, segment name, PD and tier of every row."""
        t = self.table.join(self.scored.select("id", "pd_score"), "id")
        t = materialize(t.select("id", *features, "pd_score"), "wf-segments")
        model, scaler, _ = SG.kmeans_segments(t, features)
        names = SG.segment_names(SG.assign_segments(model, scaler, t, features))
        out = SG.assign_segments(model, scaler, t, features, names=names)
        return out.select("id", "cluster", "segment", "pd_score", "risk_tier")

    def importance(self) -> DataFrame:
        """``(feature, importance)`` of the boosted trees, largest first."""
        values = self.xgboost.featureImportances.toArray().tolist()
        rows = sorted(zip(self.screen.selected, values), key=lambda r: (-r[1], r[0]))
        return self.table.sparkSession.createDataFrame(rows, "feature string, importance double")

    def cross_validation(self, folds: int = K.CV_FOLDS) -> dict:
        feats = self.screen.selected
        rows = MD.gbt_cv(self.part("train"), feats, "y", "id", "xgboost", folds, self.n_trees).collect()
        gini = [r["gini"] for r in rows if r["fold"] >= 0]
        mean = sum(gini) / len(gini)
        oof = next(r["gini"] for r in rows if r["fold"] < 0)
        return {"folds": folds, "oof_gini": oof, "mean_gini": mean, "std_gini": (sum((g - mean) ** 2 for g in gini) / folds) ** 0.5}

    def card(self, name: str, version: str, limitations: list[str]) -> DataFrame:
        """Model card of the calibrated trees."""
        ev = {r["split"]: r for r in M.evaluate_model(self.scored, "pd_score", "y", ["split"]).collect()}
        data = {f"n_{k}": ev[k]["n"] for k in ("train", "test", "oot")}
        data |= {"event_rate": ev["train"]["event_rate"], "n_features": len(self.screen.selected)}
        perf = {f"{m}_{k}": ev[k][m] for k in ("test", "oot") for m in ("auc", "gini", "ks", "brier")}
        arch = {"type": "gradient boosted trees, sigmoid calibration (3 folds)", "baseline": "WoE logistic scorecard",
                "trees": str(self.n_trees), "depth": str(K.GBT_MAX_DEPTH), "step": str(K.GBT_STEP_SIZE)}
        return G.model_card(
            self.table.sparkSession, name, version, data, perf, self.stability(), self.bias(),
            self.score_shift().first()["psi"], self.importance().limit(10), limitations, arch, self.cross_validation(),
        )
