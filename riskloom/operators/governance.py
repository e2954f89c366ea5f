"""Monitoring: Gini stability by period, subgroup bias audit, score shift, KPIs.

Per-period and per-subgroup AUCs come from one sort by score for all groups
(``subgroups.subgroup_auc``), never a loop over groups or a copy per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.functions.exprs import bin_right_lit
from riskloom.operators.binning import psi_report, quantile_edges
from riskloom.operators.ordered import materialize
from riskloom.operators.subgroups import OVERALL, subgroup_auc


def period_column(df: DataFrame, order_col: str, n_periods: int = K.N_PERIODS) -> DataFrame:
    """Equal-count periods 0..n-1 of ``order_col`` (exact quantile bins,
    right-closed, duplicate edges dropped) when no time column exists."""
    e = quantile_edges(df, [order_col], q=n_periods).collect()
    edges = [float(v) for v in (e[0]["edges"] if e else [])]
    return df.withColumn("period", bin_right_lit(edges, F.col(order_col).cast("double")))


def gini_stability(
    df: DataFrame,
    score: str,
    label: str = "y",
    time_col: str | None = None,
    order_col: str = "id",
    n_periods: int = K.N_PERIODS,
) -> DataFrame:
    """Per period: n, event rate, Gini, AUC (rounded 4); periods with < 50 rows
    or one class skipped; delta from the first kept period; ALERT/WATCH/OK."""
    if time_col is None:
        df = materialize(df.select(order_col, score, label), "gini-input")
        df = period_column(df, order_col, n_periods)
        time_col = "period"
    kind = df.schema[time_col].dataType
    g = subgroup_auc(df, score, label, [time_col]).where(F.col("group_col") == time_col)
    g = g.withColumn("n_customers", F.col("n_pos") + F.col("n_neg"))
    g = g.where((F.col("n_customers") >= K.GINI_MIN_PERIOD_ROWS) & F.col("auc").isNotNull())
    g = g.select(
        F.col("group_val").cast(kind).alias("period"),
        "n_customers",
        F.round(F.col("n_pos") / F.col("n_customers"), 4).alias("event_rate"),
        F.round(2 * F.col("auc") - 1, 4).alias("gini"),
        F.round("auc", 4).alias("auc"),
    )
    # one row per period: an unpartitioned window over a handful of rows
    w = Window.partitionBy().orderBy("period").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = g.withColumn("gini_delta_from_baseline", F.col("gini") - F.first("gini").over(w))
    d = F.col("gini_delta_from_baseline")
    alert = (
        F.when(d < -K.GINI_DEGRADATION_ALERT, "ALERT")
        .when(d < -K.GINI_DEGRADATION_ALERT / 2, "WATCH")
        .otherwise("OK")
    )
    return g.withColumn("alert", alert).orderBy("period")


def bias_audit(
    df: DataFrame,
    score: str,
    label: str = "y",
    group_cols: Sequence[str] = ("seg", "nationkey"),
    min_group: int = K.BIAS_MIN_GROUP,
) -> DataFrame:
    """Overall row + one row per (column, value) with n >= 100 and two classes:
    n, AUC, Gini, event rate, AUC delta (rounded 4; the overall row unrounded).

    All groups share one sort by score; no row is copied per group column.
    """
    unknown = [c for c in group_cols if c not in df.columns]
    if unknown:
        raise ValueError(f"no such group columns: {unknown}")
    # a row per group value; a group is a value of a column in use
    g = materialize(subgroup_auc(df, score, label, group_cols), "subgroups")
    g = g.withColumns({"n": F.col("n_pos") + F.col("n_neg"), "event_rate": F.col("n_pos") / (F.col("n_pos") + F.col("n_neg"))})
    whole = F.col("group_col") == OVERALL[0]
    everyone = g.where(whole).first()
    cols = ["group_col", "group_val", "n", "auc", "gini", "event_rate", "auc_delta"]
    if everyone is None:  # no row has a score and a label
        kinds = "group_col string, group_val string, n long, auc double, gini double, event_rate double, auc_delta double"
        return df.sparkSession.createDataFrame([(*OVERALL, None, None, None, None, 0.0)], kinds)
    overall = g.where(whole).withColumns({"gini": 2 * F.col("auc") - 1, "auc_delta": F.lit(0.0)})
    sub = g.where(~whole & (F.col("n") >= min_group) & F.col("auc").isNotNull())
    sub = sub.withColumns({
        "gini": F.round(2 * F.col("auc") - 1, 4),
        "event_rate": F.round("event_rate", 4),
        "auc_delta": F.round(F.col("auc") - F.lit(everyone["auc"]), 4),
        "auc": F.round("auc", 4),
    })
    return overall.select(cols).unionByName(sub.select(cols))


def bias_shares(audit: DataFrame) -> DataFrame:
    """Population share per value within its column and the colour band of |delta|."""
    sub = audit.where(F.col("group_col") != "OVERALL")
    w = Window.partitionBy("group_col")
    lo, hi = K.BIAS_SHARE_BANDS
    ad = F.abs("auc_delta")
    return sub.select(
        "group_col",
        "group_val",
        "n",
        (F.col("n") / F.sum("n").over(w)).alias("share"),
        "auc_delta",
        F.max(ad).over(w).alias("max_abs_delta"),
        F.when(ad > hi, "red").when(ad > lo, "amber").otherwise("green").alias("band"),
    )


def score_shift(df: DataFrame, score: str, part_col: str = "part", **kw) -> DataFrame:
    """PSI of the score between the expected and actual parts."""
    return psi_report(df, [score], part_col, **kw)


def psi_status_counts(report: DataFrame) -> DataFrame:
    s, m, h = K.PSI_STATUS
    return report.agg(
        F.count_if(F.col("status") == s).alias("n_stable"),
        F.count_if(F.col("status") == m).alias("n_moderate"),
        F.count_if(F.col("status") == h).alias("n_high"),
        F.max("psi").alias("max_psi"),
    )


def kpi_summary(metrics: DataFrame, psi: DataFrame, stability: DataFrame, bias: DataFrame) -> DataFrame:
    """One row of headline KPIs with their pass rules.

    ``metrics`` has one row per split (test, oot) of the governed model; the
    other inputs are its PSI report, Gini per period and bias audit. All are
    reports of a few rows; each becomes one row and those are put side by side.
    """
    def of(split: str, metric: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(metric)))

    one = metrics.agg(of("test", "auc").alias("auc_test"), of("test", "ks").alias("ks_test"), of("oot", "auc").alias("auc_oot"))
    rows = [
        one,
        psi.agg(F.max("psi").alias("max_psi")),
        stability.agg(F.min("gini").alias("min_gini")),
        bias.agg(F.max(F.abs("auc_delta")).alias("max_bias")),
    ]
    # one row each, folded into one by an aggregation: no join
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    out = out.agg(*[F.max(c).alias(c) for c in out.columns])
    out = out.withColumns({"gini_test": 2 * F.col("auc_test") - 1, "auc_delta": F.col("auc_oot") - F.col("auc_test")})
    return out.select(
        "auc_test", "gini_test", "ks_test", "auc_oot", "auc_delta", "max_psi", "min_gini", "max_bias",
        (F.col("auc_test") > 0.75).alias("auc_ok"),
        (F.col("gini_test") > 0.5).alias("gini_ok"),
        (F.col("ks_test") > 0.3).alias("ks_ok"),
        (F.abs("auc_delta") < 0.03).alias("oot_ok"),
        (F.col("max_psi") < K.PSI_STABLE).alias("psi_ok"),
        (F.col("min_gini") >= K.MIN_ACCEPTABLE_GINI).alias("min_gini_ok"),
        (F.col("max_bias") < K.BIAS_AUC_DELTA_FLAG).alias("bias_ok"),
    )


# What a deployed model is watched for, and how often.
MONITORING_PLAN = {
    "score_psi": f"monthly, model review above {K.PSI_MODERATE}",
    "feature_psi": f"monthly, top features above {K.PSI_STABLE}",
    "gini": f"quarterly, alert when it falls by more than {K.GINI_DEGRADATION_ALERT} from the baseline",
    "bias_audit": "every six months, gaps between subgroups",
    "rebuild": f"Gini below {K.MIN_ACCEPTABLE_GINI} or a large shift of the score",
}


# ------------------------------------------------------------------ model card
def model_card(
    spark,
    name: str,
    version: str,
    data: dict,
    performance: dict,
    stability: DataFrame,
    bias: DataFrame,
    psi_score: float | None,
    top_features: DataFrame,
    limitations: list[str],
    architecture: dict[str, str],
    cross_validation: dict,
) -> DataFrame:
    """One-row nested document: overview, data, architecture, performance,
    cross-validation, stability, fairness (with the audit rows), monitoring and
    its plan, top features, limitations.

    Inputs are Spark results; the scalars that enter the card are small
    aggregates (min/max of a per-period table, max |delta|, top-n list).
    """
    st = stability.agg(F.min("gini").alias("mn"), F.max("gini").alias("mx"), F.count(F.lit(1)).alias("n")).collect()[0]
    audit = bias.select("group_col", "group_val", "n", "auc", "gini", "event_rate", "auc_delta").collect()
    mx_bias = max((abs(r["auc_delta"]) for r in audit if r["group_col"] != "OVERALL"), default=None)
    feats = [(r[0], float(r[1])) for r in top_features.collect()]
    min_gini = st["mn"]
    row = {
        "overview": {"model_name": name, "version": version},
        "data": {k: (None if v is None else float(v)) for k, v in data.items()},
        "architecture": architecture,
        "performance": {k: (None if v is None else float(v)) for k, v in performance.items()},
        "cross_validation": {k: float(v) for k, v in cross_validation.items()},
        "stability": {
            "periods": int(st["n"]),
            "min_gini": None if min_gini is None else float(min_gini),
            "max_gini": None if st["mx"] is None else float(st["mx"]),
            "status": "STABLE" if (min_gini is not None and min_gini >= K.MIN_ACCEPTABLE_GINI) else "DEGRADED",
        },
        "fairness": {
            "max_abs_auc_delta": None if mx_bias is None else float(mx_bias),
            "status": "PASS" if (mx_bias is not None and mx_bias <= K.BIAS_AUC_DELTA_FLAG) else "REVIEW",
        },
        "groups_tested": sorted({r["group_col"] for r in audit} - {"OVERALL"}),
        "fairness_details": [r.asDict() for r in audit],
        "monitoring": {
            "score_psi": psi_score,
            "psi_stable_below": K.PSI_STABLE,
            "psi_review_above": K.PSI_MODERATE,
        },
        "monitoring_plan": MONITORING_PLAN,
        "top_features": [{"feature": f, "importance": v} for f, v in feats],
        "limitations": list(limitations),
    }
    schema = (
        "overview struct<model_name:string,version:string>, "
        f"data struct<{','.join(f'{k}:double' for k in data)}>, "
        f"architecture struct<{','.join(f'{k}:string' for k in architecture)}>, "
        f"performance struct<{','.join(f'{k}:double' for k in performance)}>, "
        f"cross_validation struct<{','.join(f'{k}:double' for k in cross_validation)}>, "
        "stability struct<periods:long,min_gini:double,max_gini:double,status:string>, "
        "fairness struct<max_abs_auc_delta:double,status:string>, "
        "groups_tested array<string>, fairness_details array<struct<group_col:string,group_val:string,n:long,"
        "auc:double,gini:double,event_rate:double,auc_delta:double>>, "
        "monitoring struct<score_psi:double,psi_stable_below:double,psi_review_above:double>, "
        f"monitoring_plan struct<{','.join(f'{k}:string' for k in MONITORING_PLAN)}>, "
        "top_features array<struct<feature:string,importance:double>>, limitations array<string>"
    )
    return spark.createDataFrame([row], schema)


def governance_rows(card: DataFrame) -> DataFrame:
    """Flatten the card into ordered (line_no, section, key, value) text rows."""
    parts = []
    for f in card.schema.fields:
        t = f.dataType
        if t.typeName() == "struct":
            for sub in t.fields:
                parts.append(F.struct(F.lit(f.name).alias("section"), F.lit(sub.name).alias("key"),
                                      F.col(f"{f.name}.{sub.name}").cast("string").alias("value")))
        else:
            parts.append(F.struct(F.lit(f.name).alias("section"), F.lit(f.name).alias("key"),
                                  F.to_json(F.col(f.name)).alias("value")))
    rows = card.select(F.posexplode(F.array(*parts)).alias("line_no", "r")).select("line_no", "r.*")
    return rows.withColumn(
        "text", F.concat_ws(" | ", F.upper(F.regexp_replace("section", "_", " ")), F.initcap(F.regexp_replace("key", "_", " ")),
                            F.coalesce(F.col("value"), F.lit("")))
    )
