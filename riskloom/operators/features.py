"""Row-wise feature engineering for the three borrower shapes.

Every function here is a single projection (``withColumns``): no shuffle,
one codegen stage. The card-statement features read the panel's column
names (``limit_bal``, ``bill_amt1..6``, ``pay_amt1..6``, ``pay_1..6``,
newest first); names can be overridden through :class:`StatementCols`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.functions.exprs import (
    clip,
    row_count_if,
    row_max,
    row_mean,
    row_min,
    row_prod,
    row_std,
    row_sum,
    safe_div,
)


@dataclass(frozen=True)
class StatementCols:
    limit: str = "limit_bal"
    bill: tuple = tuple(f"bill_amt{k}" for k in range(1, 7))
    paid: tuple = tuple(f"pay_amt{k}" for k in range(1, 7))
    status: tuple = tuple(f"pay_{k}" for k in range(1, 7))
    age: str = "age"
    excluded_status: tuple = field(default=("pay_1", "pay_2"))


S = StatementCols()
# the same columns under the canonical names of the cleaned table
CANONICAL = StatementCols(
    limit="LIMIT_BAL",
    bill=tuple(f"BILL_AMT{k}" for k in range(1, 7)),
    paid=tuple(f"PAY_AMT{k}" for k in range(1, 7)),
    status=tuple(f"PAY_{k}" for k in range(1, 7)),
    age="AGE",
    excluded_status=("PAY_1", "PAY_2"),
)


# ---------------------------------------------------------------- statements
def feat_utilization(df: DataFrame, s: StatementCols = S) -> DataFrame:
    lo, hi = K.UTILIZATION_CLIP
    util = {f"util_{i}": clip(safe_div(b, s.limit), lo, hi) for i, b in enumerate(s.bill, 1)}
    df = df.withColumns(util)
    u = list(util)
    return df.withColumns(
        {
            "util_mean": row_mean(u),
            "util_max": row_max(u),
            "util_std": row_std(u),
            "util_latest": F.col("util_1"),
            "util_trend": F.col("util_1") - F.col("util_6"),
        }
    )


def feat_payment(df: DataFrame, s: StatementCols = S) -> DataFrame:
    lo, hi = K.PAYMENT_RATIO_CLIP
    ratio = {
        f"pay_ratio_{i}": F.coalesce(clip(safe_div(p, b), lo, hi), F.lit(0.0))
        for i, (p, b) in enumerate(zip(s.paid, s.bill), 1)
    }
    df = df.withColumns(ratio)
    r = list(ratio)
    return df.withColumns(
        {
            "pay_ratio_mean": row_mean(r),
            "pay_ratio_min": row_min(r),
            "pay_ratio_std": row_std(r),
            "months_paid_full": row_count_if([F.col(x) >= 1.0 for x in r]),
            "months_paid_zero": row_count_if([F.col(x) == 0 for x in s.paid]),
            "total_pay_ratio": F.coalesce(clip(safe_div(row_sum(s.paid), row_sum(s.bill)), 0.0, 5.0), F.lit(0.0)),
        }
    )


def feat_delinquency(df: DataFrame, s: StatementCols = S) -> DataFrame:
    """Delinquency from the older four statuses only (the newest two lag)."""
    safe = [x for x in s.status if x not in s.excluded_status]
    return df.withColumns(
        {
            "max_delinquency": row_max(safe),
            "total_delinquency_score": row_sum([clip(x, 0.0, None) for x in safe]),
            "delinquency_trend": F.col(safe[0]) - F.col(safe[-1]),
            "chronic_delinquent": (row_count_if([F.col(x) > 0 for x in safe]) >= 3).cast("int"),
        }
    )


def feat_balance(df: DataFrame, s: StatementCols = S) -> DataFrame:
    b = [F.col(x) for x in s.bill]
    df = df.withColumns(
        {
            "balance_change_1m": b[0] - b[1],
            "balance_change_3m": b[0] - b[2],
            "balance_change_6m": b[0] - b[5],
        }
    )
    return df.withColumns(
        {
            "balance_growth_rate": F.coalesce(clip(safe_div("balance_change_6m", s.limit), -2.0, 2.0), F.lit(0.0)),
            "balance_to_limit": F.coalesce(clip(safe_div(s.bill[0], s.limit), 0.0, 2.0), F.lit(0.0)),
            "net_debt_accumulation": row_sum(s.bill) - row_sum(s.paid),
        }
    )


def feat_velocity(df: DataFrame, s: StatementCols = S) -> DataFrame:
    p = [F.col(x) for x in s.paid]
    b = [F.col(x) for x in s.bill]
    out = {
        "pay_amt_velocity": p[0] - p[1],
        "pay_amt_accel": (p[0] - p[1]) - (p[1] - p[2]),
        "bill_amt_velocity": b[0] - b[1],
        "avg_monthly_payment": row_mean(s.paid),
        "std_monthly_payment": row_std(s.paid),
    }
    if "util_1" in df.columns:
        out["util_velocity"] = F.col("util_1") - F.col("util_2")
    return df.withColumns(out)


def feat_interactions(df: DataFrame, s: StatementCols = S) -> DataFrame:
    out = {
        "util_x_delinquency": F.col("util_mean") * clip("max_delinquency", 0.0, None),
        "stress_score": (F.lit(1.0) - clip("pay_ratio_mean", 0.0, 1.0)) * F.col("util_mean"),
    }
    if s.age in df.columns:
        out["age_limit_ratio"] = F.col(s.age) / (F.col(s.limit) / 10_000 + 1)
    avg_bill = row_mean(s.bill)
    out["limit_to_avg_bill"] = F.coalesce(clip(safe_div(s.limit, avg_bill), 0.0, 20.0), F.lit(10.0))
    return df.withColumns(out)


def statement_features(df: DataFrame, s: StatementCols = S) -> DataFrame:
    """All card-statement features in order; the two newest statuses dropped."""
    for f in (feat_utilization, feat_payment, feat_delinquency, feat_balance, feat_velocity, feat_interactions):
        df = f(df, s)
    return df.drop(*[x for x in s.excluded_status if x in df.columns])


# ---------------------------------------------------------------- borrowers
B_UTIL = "RevolvingUtilizationOfUnsecuredLines"
B_30 = "NumberOfTime30-59DaysPastDueNotWorse"
B_60 = "NumberOfTime60-89DaysPastDueNotWorse"
B_90 = "NumberOfTimes90DaysLate"
B_DEBT = "DebtRatio"
B_INC = "MonthlyIncome"
B_OPEN = "NumberOfOpenCreditLinesAndLoans"
B_RE = "NumberRealEstateLoansOrLines"
B_DEP = "NumberOfDependents"


def feat_gmc_delinquency(df: DataFrame) -> DataFrame:
    d30, d60, d90 = F.col(f"`{B_30}`"), F.col(f"`{B_60}`"), F.col(f"`{B_90}`")
    total = d30 + d60 + d90
    return df.withColumns(
        {
            "TOTAL_DELINQUENCIES": total,
            "WEIGHTED_DELINQUENCY": d30 * 1 + d60 * 2 + d90 * 3,
            "EVER_90_LATE": (d90 > 0).cast("int"),
            "EVER_LATE": (total > 0).cast("int"),
            "CHRONIC_LATE": (total >= 5).cast("int"),
            "SEVERE_DELINQUENCY_RATIO": F.coalesce(safe_div(d90, total), F.lit(0.0)),
        }
    )


def feat_gmc_debt(df: DataFrame) -> DataFrame:
    inc = F.col(B_INC)
    obligation = clip(F.col(B_DEBT) * inc, 0.0, 1e6)
    df = df.withColumns({"DEBT_RATIO": clip(B_DEBT, 0.0, 5.0), "MONTHLY_DEBT_OBLIGATION": obligation})
    return df.withColumns(
        {
            "RESIDUAL_INCOME": clip(inc - F.col("MONTHLY_DEBT_OBLIGATION"), -1e5, 1e6),
            "LOG_INCOME": F.log1p(F.coalesce(inc, F.lit(0.0))),
            "DEBT_PER_DEPENDENT": clip(safe_div("MONTHLY_DEBT_OBLIGATION", F.col(B_DEP) + 1), 0.0, 1e5),
        }
    )


def feat_gmc_credit(df: DataFrame) -> DataFrame:
    open_, re_ = F.col(B_OPEN), F.col(B_RE)
    util = F.col(B_UTIL)
    df = df.withColumn("TOTAL_CREDIT_LINES", open_ + re_)
    return df.withColumns(
        {
            "RE_SHARE_OF_CREDIT": F.coalesce(safe_div(re_, "TOTAL_CREDIT_LINES"), F.lit(0.0)),
            "UTIL_PER_CREDIT_LINE": safe_div(util, open_ + 1),
            "HIGH_UTILIZATION": (util > 0.75).cast("int"),
            "OVER_LIMIT": (util > 1.0).cast("int"),
        }
    )


# FIXED VALUES: right-closed age edges; buckets 0..5, outside -> 2
AGE_EDGES = (0, 25, 35, 45, 55, 65, 100)
AGE_OUTSIDE_BUCKET = 2


def feat_gmc_lifestage(df: DataFrame) -> DataFrame:
    age = F.col("age")
    bucket = None
    for i in range(len(AGE_EDGES) - 1):
        cond = (age > AGE_EDGES[i]) & (age <= AGE_EDGES[i + 1])
        bucket = F.when(cond, F.lit(i)) if bucket is None else bucket.when(cond, F.lit(i))
    bucket = bucket.otherwise(F.lit(AGE_OUTSIDE_BUCKET))
    deps = F.col(B_DEP)
    return df.withColumns(
        {
            "AGE_BUCKET": bucket.cast("double"),
            "INCOME_PER_DEPENDENT": clip(safe_div(B_INC, deps + 1), 0.0, 1e5),
            "YOUNG_HIGH_DEBT": ((age < 35) & (F.col(B_DEBT) > 0.5)).cast("int"),
            "SENIOR_DEPENDENTS": F.coalesce((age > 50) & (deps > 2), F.lit(False)).cast("int"),
        }
    )


def fit_gmc_stress(df: DataFrame) -> float:
    """Fitted state of the stress index: max WEIGHTED_DELINQUENCY on train."""
    if "WEIGHTED_DELINQUENCY" not in df.columns:
        df = feat_gmc_delinquency(df)
    v = df.agg(F.max("WEIGHTED_DELINQUENCY")).collect()[0][0]
    return 1.0 if v is None else float(v)


def feat_gmc_stress(df: DataFrame, max_weighted: float | None = None) -> DataFrame:
    """Stress index; ``max_weighted`` comes from :func:`fit_gmc_stress` on train."""
    if "WEIGHTED_DELINQUENCY" not in df.columns:
        df = feat_gmc_delinquency(df)
    if "DEBT_RATIO" not in df.columns:
        df = df.withColumn("DEBT_RATIO", clip(B_DEBT, 0.0, 5.0))
    if max_weighted is None:
        max_weighted = fit_gmc_stress(df)
    util = F.col(B_UTIL)
    return df.withColumns(
        {
            "UTIL_X_DELINQUENCY": util * F.col("TOTAL_DELINQUENCIES"),
            "DEBT_X_DELINQUENCY": F.col("DEBT_RATIO") * F.col("WEIGHTED_DELINQUENCY"),
            "STRESS_SCORE": clip(util, 0.0, 1.0) * 0.4
            + (F.col("WEIGHTED_DELINQUENCY") / F.lit(float(max_weighted) + 1e-6)) * 0.4
            + clip("DEBT_RATIO", 0.0, 1.0) * 0.2,
        }
    )


def borrower_features(df: DataFrame, max_weighted: float | None = None) -> DataFrame:
    df = feat_gmc_delinquency(df)
    df = feat_gmc_debt(df)
    df = feat_gmc_credit(df)
    df = feat_gmc_lifestage(df)
    return feat_gmc_stress(df, max_weighted)


# ---------------------------------------------------------------- applications
def feat_hc_ratios(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    out = {}
    inc = "AMT_INCOME_TOTAL"
    if "AMT_CREDIT" in cols:
        out["CREDIT_TO_INCOME"] = F.coalesce(clip(safe_div("AMT_CREDIT", inc), 0.0, 20.0), F.lit(0.0))
    if "AMT_ANNUITY" in cols:
        out["ANNUITY_TO_INCOME"] = F.coalesce(clip(safe_div("AMT_ANNUITY", inc), 0.0, 1.0), F.lit(0.0))
    if {"AMT_GOODS_PRICE", "AMT_CREDIT"} <= cols:
        out["GOODS_TO_CREDIT"] = F.coalesce(clip(safe_div("AMT_GOODS_PRICE", "AMT_CREDIT"), 0.0, 2.0), F.lit(1.0))
    if {"AMT_ANNUITY", "AMT_CREDIT"} <= cols:
        out["ANNUITY_TO_CREDIT"] = F.coalesce(clip(safe_div("AMT_ANNUITY", "AMT_CREDIT"), 0.0, 0.2), F.lit(0.0))
    return df.withColumns(out) if out else df


def feat_hc_age_employment(df: DataFrame) -> DataFrame:
    """Day counts are positive after cleaning (``abs_by_prefix``)."""
    cols = set(df.columns)
    if "DAYS_BIRTH" in cols:
        age = (F.col("DAYS_BIRTH") / 365.25).cast("int")
        df = df.withColumns(
            {"AGE_YEARS": age, "YOUNG_BORROWER": (age < 28).cast("int"), "SENIOR_BORROWER": (age > 60).cast("int")}
        )
    if "DAYS_EMPLOYED" in cols:
        emp = clip(F.col("DAYS_EMPLOYED") / 365.25, 0.0, 40.0)
        df = df.withColumns(
            {"EMPLOY_YEARS": emp, "SHORT_EMPLOYMENT": F.coalesce(emp < 1, F.lit(False)).cast("int")}
        )
    if {"DAYS_EMPLOYED", "DAYS_BIRTH"} <= cols:
        df = df.withColumn(
            "EMPLOY_TO_AGE_RATIO", clip(safe_div("DAYS_EMPLOYED", F.col("DAYS_BIRTH") + 1), 0.0, 1.0)
        )
    return df


def feat_hc_ext_scores(df: DataFrame) -> DataFrame:
    ext = [c for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3") if c in df.columns]
    if not ext:
        return df
    return df.withColumns(
        {
            "EXT_SOURCE_MEAN": row_mean(ext),
            "EXT_SOURCE_MIN": row_min(ext),
            "EXT_SOURCE_PRODUCT": row_prod(ext),
            "EXT_SOURCE_COUNT": sum((F.col(x).isNotNull().cast("int") for x in ext), F.lit(0)),
        }
    )


def feat_hc_bureau(df: DataFrame) -> DataFrame:
    bureau = [c for c in df.columns if c.startswith("AMT_REQ_CREDIT_BUREAU")]
    if not bureau:
        return df
    year = [c for c in bureau if "YEAR" in c]
    df = df.withColumns(
        {
            "TOTAL_ENQUIRIES_1Y": row_sum(year) if year else F.lit(0.0),
            "TOTAL_ENQUIRIES_ALL": row_sum(bureau),
        }
    )
    return df.withColumn("RECENT_ENQUIRY", (F.col("TOTAL_ENQUIRIES_1Y") > 3).cast("int"))


def feat_hc_interactions(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    out = {}
    ext = F.lit(1.0) - F.coalesce(F.col("EXT_SOURCE_MEAN"), F.lit(0.5)) if "EXT_SOURCE_MEAN" in cols else None
    if ext is not None and "CREDIT_TO_INCOME" in cols:
        out["BUREAU_X_CREDIT_RATIO"] = ext * F.col("CREDIT_TO_INCOME")
    if ext is not None and "ANNUITY_TO_INCOME" in cols:
        out["STRESS_SCORE"] = clip("ANNUITY_TO_INCOME", 0.0, 1.0) * 0.5 + ext * 0.5
    return df.withColumns(out) if out else df


def application_features(df: DataFrame) -> DataFrame:
    for f in (feat_hc_ratios, feat_hc_age_employment, feat_hc_ext_scores, feat_hc_bureau, feat_hc_interactions):
        df = f(df)
    return df


class FeaturePipeline:
    """Feature stages of one borrower shape with state fitted on the training rows.

    ``fit`` builds the features, keeps what the stages need from train (if
    anything) and the medians that fill NULL/inf; ``transform`` applies the
    same stages and the stored state to any split. The state is a small dict
    of literals: no shuffle. ``others`` (audit groups, segments) are no features.
    """

    def __init__(self, key: str, label: str, others: Sequence[str] = ()):
        self.key, self.label, self.others = key, label, tuple(others)
        self.imputer = None
        self.features: list[str] = []

    def _learn(self, train: DataFrame) -> None:
        """State of the stages beyond the medians."""

    def _build(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def fit(self, train: DataFrame) -> "FeaturePipeline":
        from riskloom.operators.cleaning import InfMedianImputer

        self._learn(train)
        f = self._build(train)
        self.features = [c for c in f.columns if c not in (self.key, self.label, *self.others)]
        self.imputer = InfMedianImputer.fit(f, self.features)
        return self

    def transform(self, df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        """Key, label, ``extra`` columns and the filled features."""
        if self.imputer is None:
            raise RuntimeError("pipeline is not fitted")
        f = self._build(df)
        keep = [c for c in (self.key, self.label) if c in f.columns]
        return self.imputer.transform(f, self.features).select(*keep, *extra, *[F.col(f"`{c}`") for c in self.features])


class StatementPipeline(FeaturePipeline):
    """Card statements."""

    def __init__(self, s: StatementCols = S, key: str = "id", label: str = "y", others: Sequence[str] = ("seg", "nationkey")):
        super().__init__(key, label, others)
        self.s = s

    def _build(self, df: DataFrame) -> DataFrame:
        return statement_features(df, self.s)


class BorrowerPipeline(FeaturePipeline):
    """Borrower table; the largest weighted delinquency of train scales the stress index."""

    max_weighted: float | None = None

    def _learn(self, train: DataFrame) -> None:
        self.max_weighted = fit_gmc_stress(train)

    def _build(self, df: DataFrame) -> DataFrame:
        return borrower_features(df, self.max_weighted)


class ApplicationPipeline(FeaturePipeline):
    """Loan applications."""

    def _build(self, df: DataFrame) -> DataFrame:
        return application_features(df)


def pipeline_for(name: str) -> FeaturePipeline:
    """The unfitted pipeline of a registered dataset, over its cleaned columns."""
    if name == "uci":
        return StatementPipeline(CANONICAL, "ID", "default_payment_next_month", ())
    if name == "gmc":
        return BorrowerPipeline("ID", "SeriousDlqin2yrs")
    if name == "homecredit":
        return ApplicationPipeline("ID", "TARGET", ("CODE_GENDER",))
    raise ValueError(f"Unknown dataset {name!r}")
