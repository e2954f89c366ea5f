"""Queries: row-wise feature engineering (no shuffle beyond the fixture)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import features as fe
from riskloom.plans import sqlx as X
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.sources import fixtures as fx

BILL = [f"bill_amt{k}" for k in range(1, 7)]
PAID = [f"pay_amt{k}" for k in range(1, 7)]
UTIL = [f"util_{k}" for k in range(1, 7)]
RATIO = [f"pay_ratio_{k}" for k in range(1, 7)]
SAFE = ["pay_3", "pay_4", "pay_5", "pay_6"]

# ------------------------------------------------------------------ SQL text
UTIL_SQL = {f"util_{k}": X.clip(X.div(f"bill_amt{k}", "limit_bal"), 0.0, 2.0) for k in range(1, 7)}
RATIO_SQL = {
    f"pay_ratio_{k}": f"coalesce({X.clip(X.div(f'pay_amt{k}', f'bill_amt{k}'), 0.0, 5.0)}, 0.0)" for k in range(1, 7)
}


def _sel(d: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in d.items())


UTIL_COLS = ["util_mean", "util_max", "util_std", "util_latest", "util_trend"]
SQL_UTIL = f"""
SELECT id, {', '.join(UTIL)}, {X.rmean(UTIL)} AS util_mean, {X.rmax(UTIL)} AS util_max,
       {X.rstd(UTIL)} AS util_std, util_1 AS util_latest, util_1 - util_6 AS util_trend
FROM (SELECT id, {_sel(UTIL_SQL)} FROM panel) t"""

SQL_PAYMENT = f"""
SELECT id, {', '.join(RATIO)}, {X.rmean(RATIO)} AS pay_ratio_mean, {X.rmin(RATIO)} AS pay_ratio_min,
       {X.rstd(RATIO)} AS pay_ratio_std,
       {X.count_if([f'{r} >= 1.0' for r in RATIO])} AS months_paid_full,
       {X.count_if([f'{p} = 0' for p in PAID])} AS months_paid_zero,
       coalesce({X.clip(X.div(X.rsum(PAID), X.rsum(BILL)), 0.0, 5.0)}, 0.0) AS total_pay_ratio
FROM (SELECT id, {', '.join(PAID)}, {', '.join(BILL)}, {_sel(RATIO_SQL)} FROM panel) t"""

SQL_DELINQ = f"""
SELECT id, {X.rmax(SAFE)} AS max_delinquency,
       {X.rsum([X.clip(s, 0.0, None) for s in SAFE])} AS total_delinquency_score,
       pay_3 - pay_6 AS delinquency_trend,
       cast({X.count_if([f'{s} > 0' for s in SAFE])} >= 3 AS int) AS chronic_delinquent
FROM panel"""

SQL_BALANCE = f"""
SELECT id, bill_amt1 - bill_amt2 AS balance_change_1m, bill_amt1 - bill_amt3 AS balance_change_3m,
       bill_amt1 - bill_amt6 AS balance_change_6m,
       coalesce({X.clip(X.div('bill_amt1 - bill_amt6', 'limit_bal'), -2.0, 2.0)}, 0.0) AS balance_growth_rate,
       coalesce({X.clip(X.div('bill_amt1', 'limit_bal'), 0.0, 2.0)}, 0.0) AS balance_to_limit,
       {X.rsum(BILL)} - {X.rsum(PAID)} AS net_debt_accumulation
FROM panel"""

SQL_VELOCITY = f"""
SELECT id, pay_amt1 - pay_amt2 AS pay_amt_velocity,
       (pay_amt1 - pay_amt2) - (pay_amt2 - pay_amt3) AS pay_amt_accel,
       bill_amt1 - bill_amt2 AS bill_amt_velocity,
       {X.rmean(PAID)} AS avg_monthly_payment, {X.rstd(PAID)} AS std_monthly_payment,
       {UTIL_SQL['util_1']} - {UTIL_SQL['util_2']} AS util_velocity
FROM panel"""

SQL_INTER = f"""
SELECT id, util_mean * {X.clip('max_delinquency', 0.0, None)} AS util_x_delinquency,
       (1.0 - {X.clip('pay_ratio_mean', 0.0, 1.0)}) * util_mean AS stress_score,
       coalesce({X.clip(X.div('limit_bal', X.rmean(BILL)), 0.0, 20.0)}, 10.0) AS limit_to_avg_bill
FROM (SELECT id, limit_bal, {', '.join(BILL)},
             {X.rmean(list(UTIL_SQL.values()))} AS util_mean,
             {X.rmax(SAFE)} AS max_delinquency,
             {X.rmean(list(RATIO_SQL.values()))} AS pay_ratio_mean
      FROM panel) t"""


@register("feat_utilization", with_fixtures(SQL_UTIL, "panel"), UTIL + UTIL_COLS)
def q_feat_utilization(spark, sf):
    return fe.feat_utilization(fx.panel(spark, sf)).select("id", *UTIL, *UTIL_COLS)


PAY_COLS = ["pay_ratio_mean", "pay_ratio_min", "pay_ratio_std", "total_pay_ratio"]


@register("feat_payment", with_fixtures(SQL_PAYMENT, "panel"), RATIO + PAY_COLS)
def q_feat_payment(spark, sf):
    return fe.feat_payment(fx.panel(spark, sf)).select(
        "id", *RATIO, "pay_ratio_mean", "pay_ratio_min", "pay_ratio_std", "months_paid_full",
        "months_paid_zero", "total_pay_ratio",
    )


@register("feat_delinquency", with_fixtures(SQL_DELINQ, "panel"), ["total_delinquency_score"])
def q_feat_delinquency(spark, sf):
    return fe.feat_delinquency(fx.panel(spark, sf)).select(
        "id", "max_delinquency", "total_delinquency_score", "delinquency_trend", "chronic_delinquent"
    )


BAL = ["balance_change_1m", "balance_change_3m", "balance_change_6m", "balance_growth_rate",
       "balance_to_limit", "net_debt_accumulation"]


@register("feat_balance", with_fixtures(SQL_BALANCE, "panel"), BAL)
def q_feat_balance(spark, sf):
    return fe.feat_balance(fx.panel(spark, sf)).select("id", *BAL)


VEL = ["pay_amt_velocity", "pay_amt_accel", "bill_amt_velocity", "avg_monthly_payment",
       "std_monthly_payment", "util_velocity"]


@register("feat_velocity", with_fixtures(SQL_VELOCITY, "panel"), VEL)
def q_feat_velocity(spark, sf):
    return fe.feat_velocity(fe.feat_utilization(fx.panel(spark, sf))).select("id", *VEL)


INTER = ["util_x_delinquency", "stress_score", "limit_to_avg_bill"]


@register("feat_interactions", with_fixtures(SQL_INTER, "panel"), INTER)
def q_feat_interactions(spark, sf):
    df = fx.panel(spark, sf)
    for f in (fe.feat_utilization, fe.feat_payment, fe.feat_delinquency):
        df = f(df)
    return fe.feat_interactions(df).select("id", *INTER)


# ------------------------------------------------------------- borrower shape
def _borrowers_sql() -> str:
    late = [f"greatest(pay_{k}, 0)" for k in range(1, 7)]
    return f"""
SELECT id AS ID,
  least(coalesce({X.div('bill_amt1', 'limit_bal')}, 0.0), 3.0) AS RevolvingUtilizationOfUnsecuredLines,
  cast(20 + id % 60 AS int) AS age,
  cast({late[2]} + {late[3]} AS int) AS "NumberOfTime30-59DaysPastDueNotWorse",
  cast({late[1]} AS int) AS "NumberOfTime60-89DaysPastDueNotWorse",
  cast({late[0]} AS int) AS NumberOfTimes90DaysLate,
  bill_amt1 / (limit_bal / 10 + 1) AS DebtRatio,
  CASE WHEN id % 7 <> 0 THEN limit_bal / 10 END AS MonthlyIncome,
  cast(pay_1 + 2 + id % 5 AS int) AS NumberOfOpenCreditLinesAndLoans,
  cast(id % 3 AS int) AS NumberRealEstateLoansOrLines,
  CASE WHEN id % 17 <> 0 THEN cast(id % 4 AS double) END AS NumberOfDependents,
  y AS SeriousDlqin2yrs
FROM panel"""


BORROWERS_SQL = _borrowers_sql()
B30, B60, B90 = '"NumberOfTime30-59DaysPastDueNotWorse"', '"NumberOfTime60-89DaysPastDueNotWorse"', "NumberOfTimes90DaysLate"

SQL_GMC_DELINQ = f"""
SELECT ID, {B30} + {B60} + {B90} AS TOTAL_DELINQUENCIES,
  {B30} * 1 + {B60} * 2 + {B90} * 3 AS WEIGHTED_DELINQUENCY,
  cast({B90} > 0 AS int) AS EVER_90_LATE,
  cast({B30} + {B60} + {B90} > 0 AS int) AS EVER_LATE,
  cast({B30} + {B60} + {B90} >= 5 AS int) AS CHRONIC_LATE,
  coalesce({X.div(B90, f'{B30} + {B60} + {B90}')}, 0.0) AS SEVERE_DELINQUENCY_RATIO
FROM borrowers"""

_OBL = X.clip("DebtRatio * MonthlyIncome", 0.0, 1e6)
SQL_GMC_DEBT = f"""
SELECT ID, {X.clip('DebtRatio', 0.0, 5.0)} AS DEBT_RATIO, {_OBL} AS MONTHLY_DEBT_OBLIGATION,
  {X.clip(f'MonthlyIncome - {_OBL}', -1e5, 1e6)} AS RESIDUAL_INCOME,
  ln(1 + coalesce(MonthlyIncome, 0.0)) AS LOG_INCOME,
  {X.clip(X.div(_OBL, 'NumberOfDependents + 1'), 0.0, 1e5)} AS DEBT_PER_DEPENDENT
FROM borrowers"""

SQL_GMC_CREDIT = f"""
SELECT ID, NumberOfOpenCreditLinesAndLoans + NumberRealEstateLoansOrLines AS TOTAL_CREDIT_LINES,
  coalesce({X.div('NumberRealEstateLoansOrLines', 'NumberOfOpenCreditLinesAndLoans + NumberRealEstateLoansOrLines')}, 0.0) AS RE_SHARE_OF_CREDIT,
  {X.div('RevolvingUtilizationOfUnsecuredLines', 'NumberOfOpenCreditLinesAndLoans + 1')} AS UTIL_PER_CREDIT_LINE,
  cast(RevolvingUtilizationOfUnsecuredLines > 0.75 AS int) AS HIGH_UTILIZATION,
  cast(RevolvingUtilizationOfUnsecuredLines > 1.0 AS int) AS OVER_LIMIT
FROM borrowers"""

_AGE_CASE = " ".join(
    f"WHEN age > {fe.AGE_EDGES[i]} AND age <= {fe.AGE_EDGES[i + 1]} THEN {i}" for i in range(len(fe.AGE_EDGES) - 1)
)
SQL_GMC_LIFE = f"""
SELECT ID, cast(CASE {_AGE_CASE} ELSE {fe.AGE_OUTSIDE_BUCKET} END AS double) AS AGE_BUCKET,
  {X.clip(X.div('MonthlyIncome', 'NumberOfDependents + 1'), 0.0, 1e5)} AS INCOME_PER_DEPENDENT,
  cast(age < 35 AND DebtRatio > 0.5 AS int) AS YOUNG_HIGH_DEBT,
  cast(coalesce(age > 50 AND NumberOfDependents > 2, false) AS int) AS SENIOR_DEPENDENTS
FROM borrowers"""

_WD = f"({B30} * 1 + {B60} * 2 + {B90} * 3)"
_DR = X.clip("DebtRatio", 0.0, 5.0)
SQL_GMC_STRESS = f"""
SELECT ID, RevolvingUtilizationOfUnsecuredLines * ({B30} + {B60} + {B90}) AS UTIL_X_DELINQUENCY,
  {_DR} * {_WD} AS DEBT_X_DELINQUENCY,
  {X.clip('RevolvingUtilizationOfUnsecuredLines', 0.0, 1.0)} * 0.4
    + ({_WD} / (cast((SELECT max({_WD}) FROM borrowers) AS double) + 1e-6)) * 0.4
    + {X.clip(_DR, 0.0, 1.0)} * 0.2 AS STRESS_SCORE
FROM borrowers"""


def _b(sql):
    return with_fixtures(sql, "panel", extra={"borrowers": BORROWERS_SQL})


@register("feat_gmc_delinquency", _b(SQL_GMC_DELINQ), ["SEVERE_DELINQUENCY_RATIO"])
def q_gmc_delinq(spark, sf):
    return fe.feat_gmc_delinquency(fx.borrowers(spark, sf)).select(
        "ID", "TOTAL_DELINQUENCIES", "WEIGHTED_DELINQUENCY", "EVER_90_LATE", "EVER_LATE", "CHRONIC_LATE",
        "SEVERE_DELINQUENCY_RATIO",
    )


GMC_DEBT = ["DEBT_RATIO", "MONTHLY_DEBT_OBLIGATION", "RESIDUAL_INCOME", "LOG_INCOME", "DEBT_PER_DEPENDENT"]


@register("feat_gmc_debt", _b(SQL_GMC_DEBT), GMC_DEBT)
def q_gmc_debt(spark, sf):
    return fe.feat_gmc_debt(fx.borrowers(spark, sf)).select("ID", *GMC_DEBT)


@register("feat_gmc_credit", _b(SQL_GMC_CREDIT), ["RE_SHARE_OF_CREDIT", "UTIL_PER_CREDIT_LINE"])
def q_gmc_credit(spark, sf):
    return fe.feat_gmc_credit(fx.borrowers(spark, sf)).select(
        "ID", "TOTAL_CREDIT_LINES", "RE_SHARE_OF_CREDIT", "UTIL_PER_CREDIT_LINE", "HIGH_UTILIZATION", "OVER_LIMIT"
    )


@register("feat_gmc_lifestage", _b(SQL_GMC_LIFE), ["AGE_BUCKET", "INCOME_PER_DEPENDENT"])
def q_gmc_life(spark, sf):
    return fe.feat_gmc_lifestage(fx.borrowers(spark, sf)).select(
        "ID", "AGE_BUCKET", "INCOME_PER_DEPENDENT", "YOUNG_HIGH_DEBT", "SENIOR_DEPENDENTS"
    )


@register("feat_gmc_stress", _b(SQL_GMC_STRESS), ["UTIL_X_DELINQUENCY", "DEBT_X_DELINQUENCY", "STRESS_SCORE"])
def q_gmc_stress(spark, sf):
    b = fx.borrowers(spark, sf)
    wd_max = fe.fit_gmc_stress(b)
    return fe.feat_gmc_stress(b, wd_max).select("ID", "UTIL_X_DELINQUENCY", "DEBT_X_DELINQUENCY", "STRESS_SCORE")


# ---------------------------------------------------------- application shape
def _apps_sql() -> str:
    ext = ", ".join(
        f"CASE WHEN id % 13 <> {j} THEN cast((id * {j}) % 97 AS double) / 97.0 END AS EXT_SOURCE_{j}" for j in (1, 2, 3)
    )
    return f"""
SELECT id AS SK_ID_CURR, y AS TARGET, limit_bal / 10 + 1000 AS AMT_INCOME_TOTAL,
  bill_amt1 + 500 AS AMT_CREDIT, pay_amt1 / 12 + 10 AS AMT_ANNUITY,
  CASE WHEN id % 5 <> 0 THEN bill_amt1 * 0.9 + 400 END AS AMT_GOODS_PRICE,
  cast(-(7300 + id % 15000) AS int) AS DAYS_BIRTH,
  cast(CASE WHEN id % 11 = 0 THEN 365243 ELSE -(id % 4000) END AS int) AS DAYS_EMPLOYED,
  cast(-(id % 9000) AS int) AS DAYS_REGISTRATION, cast(-(id % 5000) AS int) AS DAYS_ID_PUBLISH,
  cast(id % 4 + 1 AS double) AS CNT_FAM_MEMBERS, {ext},
  cast(id % 3 AS double) AS AMT_REQ_CREDIT_BUREAU_MON, cast(id % 5 AS double) AS AMT_REQ_CREDIT_BUREAU_QRT,
  cast(id % 7 AS double) AS AMT_REQ_CREDIT_BUREAU_YEAR,
  seg AS NAME_CONTRACT_TYPE, CASE WHEN id % 2 = 0 THEN 'M' ELSE 'F' END AS CODE_GENDER
FROM panel"""


APPS_SQL = _apps_sql()


def _a(sql):
    return with_fixtures(sql, "panel", extra={"apps": APPS_SQL})


SQL_HC_RATIOS = f"""
SELECT SK_ID_CURR,
  coalesce({X.clip(X.div('AMT_CREDIT', 'AMT_INCOME_TOTAL'), 0.0, 20.0)}, 0.0) AS CREDIT_TO_INCOME,
  coalesce({X.clip(X.div('AMT_ANNUITY', 'AMT_INCOME_TOTAL'), 0.0, 1.0)}, 0.0) AS ANNUITY_TO_INCOME,
  coalesce({X.clip(X.div('AMT_GOODS_PRICE', 'AMT_CREDIT'), 0.0, 2.0)}, 1.0) AS GOODS_TO_CREDIT,
  coalesce({X.clip(X.div('AMT_ANNUITY', 'AMT_CREDIT'), 0.0, 0.2)}, 0.0) AS ANNUITY_TO_CREDIT
FROM apps"""
HC_RATIOS = ["CREDIT_TO_INCOME", "ANNUITY_TO_INCOME", "GOODS_TO_CREDIT", "ANNUITY_TO_CREDIT"]


@register("feat_hc_ratios", _a(SQL_HC_RATIOS), HC_RATIOS)
def q_hc_ratios(spark, sf):
    return fe.feat_hc_ratios(fx.applications(spark, sf)).select("SK_ID_CURR", *HC_RATIOS)


_EMP = X.clip("DAYS_EMPLOYED / 365.25", 0.0, 40.0)
SQL_HC_AGE = f"""
SELECT SK_ID_CURR, cast(trunc(DAYS_BIRTH / 365.25) AS int) AS AGE_YEARS,
  cast(trunc(DAYS_BIRTH / 365.25) < 28 AS int) AS YOUNG_BORROWER,
  cast(trunc(DAYS_BIRTH / 365.25) > 60 AS int) AS SENIOR_BORROWER,
  {_EMP} AS EMPLOY_YEARS, cast(coalesce({_EMP} < 1, false) AS int) AS SHORT_EMPLOYMENT,
  {X.clip(X.div('DAYS_EMPLOYED', 'DAYS_BIRTH + 1'), 0.0, 1.0)} AS EMPLOY_TO_AGE_RATIO
FROM (SELECT SK_ID_CURR, abs(DAYS_BIRTH) AS DAYS_BIRTH, abs(DAYS_EMPLOYED) AS DAYS_EMPLOYED FROM apps) a"""


@register("feat_hc_age_employment", _a(SQL_HC_AGE), ["EMPLOY_YEARS", "EMPLOY_TO_AGE_RATIO"])
def q_hc_age(spark, sf):
    a = fx.applications(spark, sf).select(
        "SK_ID_CURR", F.abs("DAYS_BIRTH").alias("DAYS_BIRTH"), F.abs("DAYS_EMPLOYED").alias("DAYS_EMPLOYED")
    )
    return fe.feat_hc_age_employment(a).select(
        "SK_ID_CURR", "AGE_YEARS", "YOUNG_BORROWER", "SENIOR_BORROWER", "EMPLOY_YEARS", "SHORT_EMPLOYMENT",
        "EMPLOY_TO_AGE_RATIO",
    )


EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
SQL_HC_EXT = f"""
SELECT SK_ID_CURR, {X.rmean(EXT)} AS EXT_SOURCE_MEAN, {X.rmin(EXT)} AS EXT_SOURCE_MIN,
  {X.rprod(EXT)} AS EXT_SOURCE_PRODUCT, {X.nn(EXT)} AS EXT_SOURCE_COUNT
FROM apps"""


@register("feat_hc_ext_scores", _a(SQL_HC_EXT), ["EXT_SOURCE_MEAN", "EXT_SOURCE_MIN", "EXT_SOURCE_PRODUCT"])
def q_hc_ext(spark, sf):
    return fe.feat_hc_ext_scores(fx.applications(spark, sf)).select(
        "SK_ID_CURR", "EXT_SOURCE_MEAN", "EXT_SOURCE_MIN", "EXT_SOURCE_PRODUCT", "EXT_SOURCE_COUNT"
    )


BUREAU = ["AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR"]
SQL_HC_BUREAU = f"""
SELECT SK_ID_CURR, {X.rsum(BUREAU[2:])} AS TOTAL_ENQUIRIES_1Y, {X.rsum(BUREAU)} AS TOTAL_ENQUIRIES_ALL,
  cast({X.rsum(BUREAU[2:])} > 3 AS int) AS RECENT_ENQUIRY
FROM apps"""


@register("feat_hc_bureau", _a(SQL_HC_BUREAU), ["TOTAL_ENQUIRIES_1Y", "TOTAL_ENQUIRIES_ALL"])
def q_hc_bureau(spark, sf):
    return fe.feat_hc_bureau(fx.applications(spark, sf)).select(
        "SK_ID_CURR", "TOTAL_ENQUIRIES_1Y", "TOTAL_ENQUIRIES_ALL", "RECENT_ENQUIRY"
    )


_EXTM = f"(1.0 - coalesce({X.rmean(EXT)}, 0.5))"
SQL_HC_INTER = f"""
SELECT SK_ID_CURR,
  {_EXTM} * coalesce({X.clip(X.div('AMT_CREDIT', 'AMT_INCOME_TOTAL'), 0.0, 20.0)}, 0.0) AS BUREAU_X_CREDIT_RATIO,
  {X.clip(f"coalesce({X.clip(X.div('AMT_ANNUITY', 'AMT_INCOME_TOTAL'), 0.0, 1.0)}, 0.0)", 0.0, 1.0)} * 0.5
    + {_EXTM} * 0.5 AS STRESS_SCORE
FROM apps"""


@register("feat_hc_interactions", _a(SQL_HC_INTER), ["BUREAU_X_CREDIT_RATIO", "STRESS_SCORE"])
def q_hc_inter(spark, sf):
    a = fe.feat_hc_ext_scores(fe.feat_hc_ratios(fx.applications(spark, sf)))
    return fe.feat_hc_interactions(a).select("SK_ID_CURR", "BUREAU_X_CREDIT_RATIO", "STRESS_SCORE")
