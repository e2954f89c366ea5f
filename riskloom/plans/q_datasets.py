"""Queries: loading, feature pipelines and feature groups of the three datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import cleaning as C
from riskloom.operators import features as fe
from riskloom.operators import splits as SP
from riskloom.plans import q_features as Q
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_sources import FIXTURE_MIN_ROWS, SQL_UCI_CLEAN
from riskloom.plans.sqlx import clip
from riskloom.sources import io

# ------------------------------------------------------------- cleaned tables
B_COUNTS = [fe.B_30, fe.B_60, fe.B_90, fe.B_OPEN, fe.B_RE]
GMC_RAW = [fe.B_UTIL, "age", *B_COUNTS, fe.B_DEBT, fe.B_INC, fe.B_DEP]


def _median(col: str, src: str) -> str:
    return f"(SELECT quantile_cont({col}, 0.5) FROM {src})"


GMC_CLEAN = f"""
SELECT ID, {clip(fe.B_UTIL, 0.0, 1.5)} AS {fe.B_UTIL},
  cast(CASE WHEN age = 0 THEN (SELECT quantile_cont(age, 0.5) FROM borrowers_raw WHERE age <> 0) ELSE age END AS int) AS age,
  {', '.join(f'"{c}"' for c in B_COUNTS)}, {clip(fe.B_DEBT, 0.0, 10.0)} AS {fe.B_DEBT},
  coalesce({fe.B_INC}, {_median(fe.B_INC, 'borrowers_raw')}) AS {fe.B_INC}, coalesce({fe.B_DEP}, 0.0) AS {fe.B_DEP},
  SeriousDlqin2yrs
FROM borrowers_raw"""

HC_LEVELS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # after the first level, in order
HC_PLAIN = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "CNT_FAM_MEMBERS", *Q.BUREAU]
HC_FILLED = ["AMT_GOODS_PRICE", *Q.EXT]
HC_DAYS = ["DAYS_BIRTH", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH"]
HC_DUMMIES = [f"NAME_CONTRACT_TYPE_{v}" for v in HC_LEVELS] + ["CODE_GENDER_M"]
HC_RAW = HC_PLAIN + HC_FILLED + HC_DAYS + ["DAYS_EMPLOYED", "DAYS_EMPLOYED_PENSIONER"] + HC_DUMMIES
_WORKED = "CASE WHEN abs(DAYS_EMPLOYED) <> 365243 THEN cast(abs(DAYS_EMPLOYED) AS double) END"
HC_CLEAN = f"""
SELECT SK_ID_CURR, TARGET, CODE_GENDER, {', '.join(HC_PLAIN)},
  {', '.join(f"coalesce({c}, {_median(c, 'apps_raw')}) AS {c}" for c in HC_FILLED)},
  {', '.join(f'abs({c}) AS {c}' for c in HC_DAYS)},
  coalesce({_WORKED}, {_median(_WORKED, 'apps_raw')}) AS DAYS_EMPLOYED,
  cast(abs(DAYS_EMPLOYED) = 365243 AS int) AS DAYS_EMPLOYED_PENSIONER,
  {', '.join(f"cast(NAME_CONTRACT_TYPE = '{v}' AS int) AS NAME_CONTRACT_TYPE_{v}" for v in HC_LEVELS)},
  cast(CODE_GENDER = 'M' AS int) AS CODE_GENDER_M
FROM apps_raw"""


def _gmc(sql: str) -> str:
    return with_fixtures(sql, "panel", extra={"borrowers_raw": Q.BORROWERS_SQL, "borrowers": GMC_CLEAN})


def _hc(sql: str) -> str:
    return with_fixtures(sql, "panel", extra={"apps_raw": Q.APPS_SQL, "apps": HC_CLEAN})


@register("load_dataset_gmc", _gmc("SELECT * FROM borrowers"), [fe.B_UTIL, fe.B_DEBT, fe.B_INC, fe.B_DEP])
def q_load_gmc(spark, sf):
    """Borrower table: registry -> cleaning chain -> contract."""
    return io.load_dataset(spark, "gmc", sf, FIXTURE_MIN_ROWS)


@register("load_dataset_homecredit", _hc("SELECT SK_ID_CURR AS ID, * EXCLUDE (SK_ID_CURR) FROM apps"), [*HC_PLAIN, *HC_FILLED, "DAYS_EMPLOYED"])
def q_load_hc(spark, sf):
    """Loan applications: registry -> cleaning chain -> contract; the audit group stays."""
    return io.load_dataset(spark, "homecredit", sf, FIXTURE_MIN_ROWS)


# ---------------------------------------------------------- feature pipelines
def pipeline_sql(table: str, key: str, label: str, parts: list[str], raw: list[str], made: list[str], more: str = "") -> str:
    """Features of all rows of ``table``, filled with the medians of its train split (0 where train has no NULL)."""
    raw_cols = ", ".join(f'c."{c}"' for c in raw)
    joins = " ".join(f"JOIN ({p}) t{i} USING ({key})" for i, p in enumerate(parts))
    fill = ", ".join(
        f'coalesce(cast("{c}" AS double), (SELECT CASE WHEN count_if("{c}" IS NULL) > 0 '
        f'THEN coalesce(quantile_cont("{c}", 0.5), 0.0) ELSE 0.0 END FROM tr)) AS "{c}"'
        for c in raw + made
    )
    n_oot = f"round({K.OOT_FRACTION} * n_y)"
    return f"""WITH sp AS (SELECT {key}, rn > {n_oot} + round({K.TEST_SIZE} * (n_y - {n_oot})) AS train
  FROM (SELECT {key}, row_number() OVER (PARTITION BY {label} ORDER BY md5(cast({key} AS varchar))) AS rn,
               count(*) OVER (PARTITION BY {label}) AS n_y FROM {table}) r),
fe AS (SELECT c.{key}, c.{label}, {raw_cols}, {', '.join(c for c in made if c not in more)}{more} FROM {table} c {joins}),
tr AS (SELECT fe.* FROM fe JOIN sp USING ({key}) WHERE train)
SELECT {key} AS ID, {label}, {fill} FROM fe"""


UCI_RAW = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", *[f"PAY_{k}" for k in range(3, 7)],
           *[f"BILL_AMT{k}" for k in range(1, 7)], *[f"PAY_AMT{k}" for k in range(1, 7)]]
UCI_MADE = (Q.UTIL + Q.UTIL_COLS + Q.RATIO + ["pay_ratio_mean", "pay_ratio_min", "pay_ratio_std", "months_paid_full",
            "months_paid_zero", "total_pay_ratio", "max_delinquency", "total_delinquency_score", "delinquency_trend",
            "chronic_delinquent"] + Q.BAL + Q.VEL + Q.INTER)
UCI_MADE = [c for c in UCI_MADE if c != "age_limit_ratio"] + ["age_limit_ratio"]
GMC_MADE = ["TOTAL_DELINQUENCIES", "WEIGHTED_DELINQUENCY", "EVER_90_LATE", "EVER_LATE", "CHRONIC_LATE", "SEVERE_DELINQUENCY_RATIO",
            *Q.GMC_DEBT, "TOTAL_CREDIT_LINES", "RE_SHARE_OF_CREDIT", "UTIL_PER_CREDIT_LINE", "HIGH_UTILIZATION", "OVER_LIMIT",
            "AGE_BUCKET", "INCOME_PER_DEPENDENT", "YOUNG_HIGH_DEBT", "SENIOR_DEPENDENTS",
            "UTIL_X_DELINQUENCY", "DEBT_X_DELINQUENCY", "STRESS_SCORE"]
HC_MADE = [*Q.HC_RATIOS, "AGE_YEARS", "YOUNG_BORROWER", "SENIOR_BORROWER", "EMPLOY_YEARS", "SHORT_EMPLOYMENT", "EMPLOY_TO_AGE_RATIO",
           "EXT_SOURCE_MEAN", "EXT_SOURCE_MIN", "EXT_SOURCE_PRODUCT", "EXT_SOURCE_COUNT",
           "TOTAL_ENQUIRIES_1Y", "TOTAL_ENQUIRIES_ALL", "RECENT_ENQUIRY", "BUREAU_X_CREDIT_RATIO", "STRESS_SCORE"]

_STRESS_TRAIN = Q.SQL_GMC_STRESS.replace("FROM borrowers) AS double)", "FROM borrowers JOIN sp USING (ID) WHERE train) AS double)")
UCI_SQL = with_fixtures(
    pipeline_sql(
        "clean", "ID", "default_payment_next_month",
        [
            f"SELECT k.ID, p.* EXCLUDE (id) FROM ({part}) p JOIN keys k ON p.id = k.row_id"
            for part in (Q.SQL_UTIL, Q.SQL_PAYMENT, Q.SQL_DELINQ, Q.SQL_BALANCE, Q.SQL_VELOCITY, Q.SQL_INTER)
        ],
        UCI_RAW, UCI_MADE,
        ", c.AGE / (c.LIMIT_BAL / 10000 + 1) AS age_limit_ratio",
    ),
    "uci_raw",
    extra={"clean": SQL_UCI_CLEAN, "keys": "SELECT id AS row_id, row_number() OVER (ORDER BY id) AS ID FROM panel"},
)
GMC_SQL = _gmc(
    pipeline_sql(
        "borrowers", "ID", "SeriousDlqin2yrs",
        [Q.SQL_GMC_DELINQ, Q.SQL_GMC_DEBT, Q.SQL_GMC_CREDIT, Q.SQL_GMC_LIFE, _STRESS_TRAIN], GMC_RAW, GMC_MADE,
    )
)
HC_SQL = _hc(
    pipeline_sql(
        "apps", "SK_ID_CURR", "TARGET",
        [Q.SQL_HC_RATIOS, Q.SQL_HC_AGE, Q.SQL_HC_EXT, Q.SQL_HC_BUREAU, Q.SQL_HC_INTER], HC_RAW, HC_MADE,
    )
)


def _pipeline(spark, sf, name: str):
    clean = io.load_dataset(spark, name, sf, FIXTURE_MIN_ROWS)
    pipe = fe.pipeline_for(name)
    train = SP.stratified_split(clean, pipe.key, pipe.label).where(F.col("split") == "train").drop("split")
    return pipe.fit(train), clean


@register("feature_pipeline_uci", UCI_SQL, UCI_RAW + UCI_MADE)
def q_pipeline_uci(spark, sf):
    """Cleaned card statements with age and the other raw columns, fitted on train."""
    pipe, clean = _pipeline(spark, sf, "uci")
    return pipe.transform(clean)


@register("feature_pipeline_gmc", GMC_SQL, GMC_RAW + GMC_MADE)
def q_pipeline_gmc(spark, sf):
    pipe, clean = _pipeline(spark, sf, "gmc")
    return pipe.transform(clean)


@register("feature_pipeline_homecredit", HC_SQL, HC_RAW + HC_MADE)
def q_pipeline_hc(spark, sf):
    pipe, clean = _pipeline(spark, sf, "homecredit")
    return pipe.transform(clean)


# ------------------------------------------------------------- feature groups
def groups_sql(features_sql: str, names: list[str], groups) -> str:
    """Groups of the columns of ``features_sql`` that have a value, by case-sensitive fragments."""
    arms = []
    for g, fragments, exact in groups:
        tests = [f"contains(feature, '{x}')" for x in fragments] + [f"feature = '{x}'" for x in exact]
        arms.append(f"SELECT '{g}' AS \"group\", feature FROM cat WHERE {' OR '.join(tests)}")
    counts = ", ".join(f'count("{c}") AS "{c}"' for c in names)
    cols = ", ".join(f'"{c}"' for c in names)
    return (
        f"WITH cat AS (SELECT feature FROM (UNPIVOT (SELECT {counts} FROM ({features_sql}) f) "
        f"ON {cols} INTO NAME feature VALUE n) u WHERE n > 0) " + " UNION ALL ".join(arms)
    )


@register("feature_groups_gmc", groups_sql(GMC_SQL, GMC_RAW + GMC_MADE, C.BORROWER_GROUPS))
def q_groups_gmc(spark, sf):
    pipe, clean = _pipeline(spark, sf, "gmc")
    return C.feature_groups(C.present_features(pipe.transform(clean), pipe.features), C.BORROWER_GROUPS, any_case=False)


@register("feature_groups_homecredit", groups_sql(HC_SQL, HC_RAW + HC_MADE, C.APPLICATION_GROUPS))
def q_groups_hc(spark, sf):
    pipe, clean = _pipeline(spark, sf, "homecredit")
    return C.feature_groups(C.present_features(pipe.transform(clean), pipe.features), C.APPLICATION_GROUPS, any_case=False)
