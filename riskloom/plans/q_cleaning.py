"""Queries: cleaning, validation, profiling, feature selection helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import cleaning as C
from riskloom.operators import features as fe
from riskloom.plans import sqlx as X
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_features import APPS_SQL, BORROWERS_SQL, UTIL_SQL
from riskloom.sources import fixtures as fx

RAW_COLS = ["Unnamed: 0"] + [f"X{i}" for i in range(1, 24)] + ["Y"]
CANON = ["Unnamed: 0"] + [C.GENERIC_NAMES[f"X{i}"] for i in range(1, 24)] + [C.GENERIC_NAMES["Y"]]
SQL_RENAME = "SELECT " + ", ".join(
    f'"{r}" AS "{c}"' for r, c in zip(RAW_COLS, CANON)
) + " FROM uci_raw"


def _canon(spark, sf):
    return C.rename_canonical(fx.uci_raw(spark, sf))


@register("rename_canonical", with_fixtures(SQL_RENAME, "uci_raw"), ["LIMIT_BAL"] + [f"BILL_AMT{k}" for k in range(1, 7)] + [f"PAY_AMT{k}" for k in range(1, 7)])
def q_rename(spark, sf):
    return _canon(spark, sf)


SQL_ENSURE_ID = 'SELECT "Unnamed: 0", row_number() OVER (ORDER BY "Unnamed: 0") AS ID FROM uci_raw'


@register("ensure_id", with_fixtures(SQL_ENSURE_ID, "uci_raw"))
def q_ensure_id(spark, sf):
    return C.ensure_id(_canon(spark, sf), ["Unnamed: 0"]).select("Unnamed: 0", "ID")


SQL_RECODE = """SELECT "Unnamed: 0", cast(CASE WHEN X3 IN (0, 5, 6) THEN 4 ELSE X3 END AS int) AS EDUCATION,
  cast(CASE WHEN X4 = 0 THEN 3 ELSE X4 END AS int) AS MARRIAGE FROM uci_raw"""


@register("recode_values", with_fixtures(SQL_RECODE, "uci_raw"))
def q_recode(spark, sf):
    return C.recode_values(_canon(spark, sf)).select("Unnamed: 0", "EDUCATION", "MARRIAGE")


SQL_DROP_ART = "SELECT " + ", ".join(f'"{c}"' for c in CANON[1:]) + ' FROM (' + SQL_RENAME + ") t"


@register("drop_artifacts", with_fixtures(SQL_DROP_ART, "uci_raw"), ["LIMIT_BAL"])
def q_drop_artifacts(spark, sf):
    return C.drop_artifacts(_canon(spark, sf))


SQL_CAST_T = 'SELECT "Unnamed: 0", try_cast(Y AS int) AS default_payment_next_month FROM uci_raw'


@register("cast_target", with_fixtures(SQL_CAST_T, "uci_raw"))
def q_cast_target(spark, sf):
    return C.cast_target(_canon(spark, sf), "default_payment_next_month").select(
        "Unnamed: 0", "default_payment_next_month"
    )


SQL_DROP_NULL = "SELECT doc_id, quality, toxic FROM docs_q WHERE quality IS NOT NULL OR toxic IS NOT NULL"


@register("drop_all_null_rows", with_fixtures(SQL_DROP_NULL, "docs_q"))
def q_drop_null(spark, sf):
    d = fx.docs_q(spark, sf).select("doc_id", "quality", "toxic")
    return C.drop_all_null_rows(d, ["quality", "toxic"])


SQL_CLIP = f"""SELECT ID, {X.clip('RevolvingUtilizationOfUnsecuredLines', 0.0, 1.5)} AS RevolvingUtilizationOfUnsecuredLines,
  {X.clip('DebtRatio', 0.0, 10.0)} AS DebtRatio FROM borrowers"""
_B = {"borrowers": BORROWERS_SQL}


@register("clip_outliers", with_fixtures(SQL_CLIP, "panel", extra=_B), ["RevolvingUtilizationOfUnsecuredLines", "DebtRatio"])
def q_clip(spark, sf):
    out, _ = C.clip_outliers(
        fx.borrowers(spark, sf), {"RevolvingUtilizationOfUnsecuredLines": (0.0, 1.5), "DebtRatio": (0.0, 10.0)}
    )
    return out.select("ID", "RevolvingUtilizationOfUnsecuredLines", "DebtRatio")


SQL_CLIP_COUNTS = """SELECT count_if(RevolvingUtilizationOfUnsecuredLines > 1.5) AS n_util_clipped,
  count_if(DebtRatio > 10.0) AS n_debt_clipped FROM borrowers"""


@register("clip_outlier_counts", with_fixtures(SQL_CLIP_COUNTS, "panel", extra=_B))
def q_clip_counts(spark, sf):
    b = fx.borrowers(spark, sf)
    return b.agg(
        F.count_if(F.col("RevolvingUtilizationOfUnsecuredLines") > 1.5).alias("n_util_clipped"),
        F.count_if(F.col("DebtRatio") > 10.0).alias("n_debt_clipped"),
    )


SQL_Z2M = """SELECT id, coalesce(nullif(pay_amt1, 0), (SELECT quantile_cont(nullif(pay_amt1, 0), 0.5) FROM panel)) AS pay_amt1
FROM panel"""


@register("zero_to_median", with_fixtures(SQL_Z2M, "panel"), ["pay_amt1"])
def q_zero_to_median(spark, sf):
    return C.zero_to_median(fx.panel(spark, sf).select("id", "pay_amt1"), "pay_amt1")


SQL_IMP_MED = """SELECT ID, coalesce(MonthlyIncome, (SELECT quantile_cont(MonthlyIncome, 0.5) FROM borrowers)) AS MonthlyIncome
FROM borrowers"""


@register("impute_median", with_fixtures(SQL_IMP_MED, "panel", extra=_B), ["MonthlyIncome"])
def q_impute_median(spark, sf):
    return C.impute_median(fx.borrowers(spark, sf).select("ID", "MonthlyIncome"), ["MonthlyIncome"])


SQL_IMP_CONST = "SELECT ID, coalesce(NumberOfDependents, 0.0) AS NumberOfDependents FROM borrowers"


@register("impute_const", with_fixtures(SQL_IMP_CONST, "panel", extra=_B))
def q_impute_const(spark, sf):
    return C.impute_const(fx.borrowers(spark, sf).select("ID", "NumberOfDependents"), {"NumberOfDependents": 0.0})


DAYS = ["DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH"]
SQL_ABS = "SELECT SK_ID_CURR, " + ", ".join(f"abs({d}) AS {d}" for d in DAYS) + " FROM apps"
_A = {"apps": APPS_SQL}


@register("abs_by_prefix", with_fixtures(SQL_ABS, "panel", extra=_A))
def q_abs(spark, sf):
    return C.abs_by_prefix(fx.applications(spark, sf).select("SK_ID_CURR", *DAYS), "DAYS_")


SQL_SENT = """WITH a AS (SELECT SK_ID_CURR, abs(DAYS_EMPLOYED) AS d FROM apps)
SELECT SK_ID_CURR, coalesce(CASE WHEN d = 365243 THEN NULL ELSE cast(d AS double) END,
  (SELECT quantile_cont(CASE WHEN d = 365243 THEN NULL ELSE cast(d AS double) END, 0.5) FROM a)) AS DAYS_EMPLOYED,
  cast(d = 365243 AS int) AS DAYS_EMPLOYED_PENSIONER FROM a"""


@register("sentinel_flag", with_fixtures(SQL_SENT, "panel", extra=_A), ["DAYS_EMPLOYED"])
def q_sentinel(spark, sf):
    a = C.abs_by_prefix(fx.applications(spark, sf).select("SK_ID_CURR", "DAYS_EMPLOYED"), "DAYS_")
    return C.sentinel_flag(a, "DAYS_EMPLOYED")


# vocabulary fitted from the data; the oracle states the resulting levels
_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SQL_ONEHOT = (
    "SELECT SK_ID_CURR, "
    + ", ".join(f"cast(NAME_CONTRACT_TYPE = '{s}' AS int) AS NAME_CONTRACT_TYPE_{s}" for s in _SEGS[1:])
    + ", cast(CODE_GENDER = 'M' AS int) AS CODE_GENDER_M FROM apps"
)


@register("one_hot_low_card", with_fixtures(SQL_ONEHOT, "panel", extra=_A))
def q_one_hot(spark, sf):
    a = fx.applications(spark, sf).select("SK_ID_CURR", "NAME_CONTRACT_TYPE", "CODE_GENDER")
    return C.one_hot_low_card(a)


UTIL = [f"util_{k}" for k in range(1, 7)]
SQL_INF_MED = (
    "WITH u AS (SELECT id, " + ", ".join(f"{v} AS {k}" for k, v in UTIL_SQL.items()) + " FROM panel) SELECT id, "
    + ", ".join(f"coalesce({u}, (SELECT coalesce(quantile_cont({u}, 0.5), 0.0) FROM u)) AS {u}" for u in UTIL)
    + " FROM u"
)


@register("inf_to_fitted_median", with_fixtures(SQL_INF_MED, "panel"), UTIL)
def q_inf_median(spark, sf):
    u = fe.feat_utilization(fx.panel(spark, sf)).select("id", *UTIL)
    return C.InfMedianImputer.fit(u, UTIL).transform(u, UTIL)


B_COLS = ["ID", "RevolvingUtilizationOfUnsecuredLines", "age", "NumberOfTime30-59DaysPastDueNotWorse",
          "NumberOfTime60-89DaysPastDueNotWorse", "NumberOfTimes90DaysLate", "DebtRatio", "MonthlyIncome",
          "NumberOfOpenCreditLinesAndLoans", "NumberRealEstateLoansOrLines", "NumberOfDependents", "SeriousDlqin2yrs"]
SQL_VALIDATE = (
    "SELECT 'min_rows' AS \"check\", '*' AS \"column\", cast(count(*) AS double) AS value, count(*) >= 1000 AS ok FROM borrowers"
    " UNION ALL SELECT 'target_present', 'SeriousDlqin2yrs', 1.0::double, true"
    " UNION ALL SELECT 'target_binary', 'SeriousDlqin2yrs', cast(count_if(SeriousDlqin2yrs NOT IN (0, 1)) AS double),"
    " count_if(SeriousDlqin2yrs NOT IN (0, 1)) = 0 FROM borrowers"
    + "".join(
        f" UNION ALL SELECT 'null_rate', '{c}', avg(cast(\"{c}\" IS NULL AS double)), avg(cast(\"{c}\" IS NULL AS double)) <= 0.3 FROM borrowers"
        for c in B_COLS
    )
)


@register("validate_contract", with_fixtures(SQL_VALIDATE, "panel", extra=_B), ["value"])
def q_validate(spark, sf):
    return C.validate_contract(fx.borrowers(spark, sf), "SeriousDlqin2yrs")


SQL_PROFILE = (
    "SELECT count(*) AS n_rows, 12 AS n_columns, cast(sum(SeriousDlqin2yrs) AS bigint) AS n_events, "
    "avg(SeriousDlqin2yrs) AS event_rate, cast(" + " + ".join(f'count_if("{c}" IS NULL)' for c in B_COLS)
    + " AS bigint) AS total_nulls FROM borrowers"
)


@register("profile_summary", with_fixtures(SQL_PROFILE, "panel", extra=_B), ["event_rate"])
def q_profile(spark, sf):
    return C.profile_summary(fx.borrowers(spark, sf), "SeriousDlqin2yrs")


SQL_SELECT_F = 'SELECT * EXCLUDE ("Unnamed: 0", default_payment_next_month) FROM (' + SQL_RENAME + ") t"


@register("select_features", with_fixtures(SQL_SELECT_F, "uci_raw"), ["LIMIT_BAL"])
def q_select_features(spark, sf):
    return C.select_features(_canon(spark, sf), "Unnamed: 0", "default_payment_next_month")


def _feature_catalog(spark, sf):
    """Feature names present in the engineered table (columns with at least one value)."""
    df = fe.statement_features(fx.panel(spark, sf))
    names = [c for c in df.columns if c not in ("id", "seg", "nationkey", "y")]
    return C.present_features(df, names).select(F.upper("feature").alias("feature"))


def _groups_sql() -> str:
    arms = []
    for g, frags, exact in C.FEATURE_GROUPS:
        conds = [f"contains(feature, '{fr}')" for fr in frags] + ([f"feature IN ({', '.join(repr(e) for e in exact)})"] if exact else [])
        arms.append(f"SELECT '{g}' AS \"group\", feature FROM cat WHERE {' OR '.join(conds)}")
    return " UNION ALL ".join(arms)


def _catalog_sql() -> str:
    # the engineered columns that carry at least one non-NULL value
    from riskloom.plans.q_features import BAL, INTER, PAY_COLS, RATIO, UTIL as U, UTIL_COLS, VEL

    names = U + UTIL_COLS + RATIO + PAY_COLS + ["months_paid_full", "months_paid_zero", "max_delinquency",
            "total_delinquency_score", "delinquency_trend", "chronic_delinquent"] + BAL + VEL + INTER
    names += ["limit_bal", "pay_3", "pay_4", "pay_5", "pay_6"] + [f"bill_amt{k}" for k in range(1, 7)] + [f"pay_amt{k}" for k in range(1, 7)]
    return " UNION ALL ".join(f"SELECT '{n.upper()}' AS feature" for n in names)


SQL_GROUPS = f"WITH cat AS ({_catalog_sql()}) {_groups_sql()}"


@register("feature_groups", SQL_GROUPS)
def q_feature_groups(spark, sf):
    return C.feature_groups(_feature_catalog(spark, sf))
