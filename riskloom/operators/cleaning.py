"""Cleaning, validation and profiling of borrower tables.

All steps are projections or single aggregations. Fitted statistics
(medians, vocabularies) are computed by one distributed aggregation,
collected (one scalar per column) and applied as literals, so transforms
never shuffle.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import clip, nan_to_null
from riskloom.operators.binning import unpivot_features
from riskloom.operators.ordered import group_stats, materialize, prefix_sums, task_rows
from riskloom.operators.quantiles import quantiles

log = logging.getLogger(__name__)

# FIXED VALUES: generic column names of one distribution of the card-statement
# data, mapped to the canonical names (X1..X23, Y), then alias renames.
GENERIC_NAMES = {
    "X1": "LIMIT_BAL", "X2": "SEX", "X3": "EDUCATION", "X4": "MARRIAGE", "X5": "AGE",
    "X6": "PAY_1", "X7": "PAY_2", "X8": "PAY_3", "X9": "PAY_4", "X10": "PAY_5", "X11": "PAY_6",
    "X12": "BILL_AMT1", "X13": "BILL_AMT2", "X14": "BILL_AMT3", "X15": "BILL_AMT4", "X16": "BILL_AMT5",
    "X17": "BILL_AMT6", "X18": "PAY_AMT1", "X19": "PAY_AMT2", "X20": "PAY_AMT3", "X21": "PAY_AMT4",
    "X22": "PAY_AMT5", "X23": "PAY_AMT6", "Y": "default_payment_next_month",
}
ALIASES = {
    "default.payment.next.month": "default_payment_next_month",
    "default payment next month": "default_payment_next_month",
    "PAY_0": "PAY_1",
}
ARTIFACT_COLUMNS = ("Unnamed: 0", "index")
EDUCATION_RECODE = {0: 4, 5: 4, 6: 4}
MARRIAGE_RECODE = {0: 3}


def rename_canonical(df: DataFrame, id_alias: str | None = None) -> DataFrame:
    """Trim names; map the generic X1..X23/Y names when X1 and Y exist and there
    are at most 25 columns; apply alias renames; optionally rename ``id_alias`` to ID."""
    df = df.toDF(*[str(c).strip() for c in df.columns])
    cols = set(df.columns)
    mapping = {}
    if "X1" in cols and "Y" in cols and len(cols) <= 25:
        mapping.update({k: v for k, v in GENERIC_NAMES.items() if k in cols})
    mapping.update({k: v for k, v in ALIASES.items() if k in cols})
    if id_alias and id_alias in cols:
        mapping[id_alias] = "ID"
    return df.withColumnsRenamed(mapping) if mapping else df


def ensure_id(df: DataFrame, order: Sequence[str], id_col: str = "ID") -> DataFrame:
    """Add a dense 1..n ``ID`` in the stated order when absent.

    The rank comes from the bucketed prefix sum (no single-task global
    window); ``order[0]`` must be numeric. The rows are written first, since
    they are read for the cuts, the bucket totals and the ranks, and every
    core gets its own value ranges.
    """
    if id_col in df.columns:
        return df
    d = materialize(df.withColumn("_one", F.lit(1)), "unnumbered")
    groups = group_stats(d, [])
    r = prefix_sums(d, [], list(order), ["_one"], groups=groups, bucket_rows=task_rows(d, groups.total))
    return r.withColumnRenamed("_one_cum", id_col).drop("_one")


def recode_values(df: DataFrame, mapping: dict[str, dict] | None = None) -> DataFrame:
    """Replace undocumented codes (EDUCATION 0/5/6 -> 4, MARRIAGE 0 -> 3)."""
    mapping = mapping or {"EDUCATION": EDUCATION_RECODE, "MARRIAGE": MARRIAGE_RECODE}
    out = {}
    for col, m in mapping.items():
        if col not in df.columns:
            continue
        e = F.col(col)
        expr = None
        for src, dst in m.items():
            expr = F.when(e == src, F.lit(dst)) if expr is None else expr.when(e == src, F.lit(dst))
        out[col] = expr.otherwise(e).cast(df.schema[col].dataType)
    return df.withColumns(out) if out else df


def drop_artifacts(df: DataFrame, names: Sequence[str] = ARTIFACT_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def cast_target(df: DataFrame, target: str) -> DataFrame:
    """Target -> int; NULL stays NULL, text that is no number fails the job."""
    value = F.col(target).try_cast("int")
    bad = F.concat(F.lit(f"target {target} is not a number: "), F.col(target).cast("string"))
    return df.withColumn(target, F.when(F.col(target).isNotNull() & value.isNull(), F.raise_error(bad)).otherwise(value))


def drop_all_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="all", subset=list(subset) if subset else None)


def clip_outliers(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> tuple[DataFrame, dict[str, int]]:
    """Clip to [lo, hi] (NULL kept). Also returns the count above ``hi`` per column
    (one aggregation)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`") > hi).alias(c) for c, (_, hi) in bounds.items()]).collect()[0]
    out = df.withColumns({c: clip(F.col(f"`{c}`"), lo, hi) for c, (lo, hi) in bounds.items()})
    return out, {c: int(counts[c]) for c in bounds}


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of many columns together; values are counted, never shuffled."""
    if not cols:
        return {}
    got = quantiles(unpivot_features(df, cols), "feature", "x", [0.5])
    return {c: got.get(c, [None])[0] for c in cols}


def zero_to_median(df: DataFrame, col: str) -> DataFrame:
    """0 is an error code: 0 -> NULL -> median of the remaining values."""
    z = df.withColumn(col, F.when(F.col(col) == 0, F.lit(None)).otherwise(F.col(col)))
    m = medians(z, [col])[col]
    return z.withColumn(col, F.coalesce(F.col(col), F.lit(m).cast(df.schema[col].dataType)))


def impute_median(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill NULL with the column median; by default every numeric column that has NULLs."""
    if cols is None:
        num = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long", "short")]
        nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in num]).collect()[0] if num else {}
        cols = [c for c in num if nulls[c] > 0]
    m = medians(df, list(cols))
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`"), F.lit(m[c]).cast(df.schema[c].dataType)) for c in cols if m[c] is not None}
    )


def impute_const(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.na.fill(values)


def abs_by_prefix(df: DataFrame, prefix: str = "DAYS_") -> DataFrame:
    return df.withColumns({c: F.abs(F.col(c)) for c in df.columns if c.startswith(prefix)})


def sentinel_flag(df: DataFrame, col: str = "DAYS_EMPLOYED", sentinel: int = 365243) -> DataFrame:
    """Flag the sentinel, turn it into NULL, then fill with the median."""
    d = df.withColumns(
        {
            f"{col}_PENSIONER": F.coalesce((F.col(col) == sentinel).cast("int"), F.lit(0)),
            col: F.when(F.col(col) == sentinel, F.lit(None)).otherwise(F.col(col)).cast("double"),
        }
    )
    m = medians(d, [col])[col]
    return d.withColumn(col, F.coalesce(F.col(col), F.lit(m)))


def fit_one_hot(df: DataFrame, max_levels: int = 10) -> dict[str, list[str]]:
    """Vocabulary of string columns with <= max_levels distinct values (sorted).

    One aggregation of ``count_distinct`` per column chooses the columns;
    the chosen vocabularies have at most ``max_levels`` values each.
    """
    strs = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    if not strs:
        return {}
    # HyperLogLog screen (bounded state per column), then an exact distinct
    # set only for the candidates, whose size the screen bounds.
    nd = df.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in strs]).collect()[0]
    cand = [c for c in strs if nd[c] <= 2 * max_levels]
    if not cand:
        return {}
    v = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cand]).collect()[0]
    return {c: list(v[c]) for c in cand if len(v[c]) <= max_levels}


def one_hot_low_card(
    df: DataFrame, vocab: dict[str, list[str]] | None = None, drop_first: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """0/1 dummies ``<col>_<value>`` from a fitted vocabulary; first level dropped;
    the source string column is removed unless ``keep`` names it (audit groups)."""
    vocab = fit_one_hot(df) if vocab is None else vocab
    out = {}
    for c, levels in vocab.items():
        for v in levels[1:] if drop_first else levels:
            out[f"{c}_{v}"] = F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
    return df.withColumns(out).drop(*[c for c in vocab if c not in keep])


class InfMedianImputer:
    """+/-inf -> NULL; fit stores the medians of columns that had NULLs;
    transform fills with the stored median, else 0.0."""

    def __init__(self, medians_: dict[str, float]):
        self.medians = medians_

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]):
        clean = df.select(*[nan_to_null(F.col(f"`{c}`")).alias(c) for c in cols])
        nulls = clean.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols]).collect()[0]
        with_nulls = [c for c in cols if nulls[c] > 0]
        return cls({k: v for k, v in medians(clean, with_nulls).items() if v is not None})

    def transform(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        return df.withColumns(
            {c: F.coalesce(nan_to_null(F.col(f"`{c}`")), F.lit(float(self.medians.get(c, 0.0)))) for c in cols}
        )


def validate_contract(
    df: DataFrame, target: str, min_rows: int = 1000, max_null_rate: float = 0.30
) -> DataFrame:
    """One aggregation -> long (check, column, value, ok) rows: row count, target
    present, target values within {0,1}, null rate per column (warn above 30 %)."""
    has_t = target in df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    if has_t:
        aggs.append(F.count_if(~F.col(target).isin(0, 1)).alias("_bad"))
    aggs += [F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"_null_{i}") for i, c in enumerate(df.columns)]
    r = df.agg(*aggs)
    checks = [
        F.struct(F.lit("min_rows").alias("check"), F.lit("*").alias("column"),
                 F.col("_n").cast("double").alias("value"), (F.col("_n") >= min_rows).alias("ok")),
        F.struct(F.lit("target_present").alias("check"), F.lit(target).alias("column"),
                 F.lit(1.0 if has_t else 0.0).alias("value"), F.lit(has_t).alias("ok")),
    ]
    if has_t:
        checks.append(F.struct(F.lit("target_binary").alias("check"), F.lit(target).alias("column"),
                               F.col("_bad").cast("double").alias("value"), (F.col("_bad") == 0).alias("ok")))
    for i, c in enumerate(df.columns):
        checks.append(F.struct(F.lit("null_rate").alias("check"), F.lit(c).alias("column"),
                               F.col(f"_null_{i}").alias("value"), (F.col(f"_null_{i}") <= max_null_rate).alias("ok")))
    return r.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def enforce_contract(df: DataFrame, target: str, min_rows: int = 1000, max_null_rate: float = 0.30) -> DataFrame:
    """``df`` itself; raises when it is too small, has no target or a target
    outside {0, 1}, and warns about columns with many NULLs (one aggregation)."""
    failed = [r for r in validate_contract(df, target, min_rows, max_null_rate).collect() if not r["ok"]]
    broken = [f"{r['check']} of {r['column']}: {r['value']}" for r in failed if r["check"] != "null_rate"]
    if broken:
        raise ValueError("data contract broken: " + "; ".join(broken))
    for r in failed:
        log.warning("column %s is NULL in %.1f %% of rows", r["column"], 100 * r["value"])
    return df


def profile_summary(df: DataFrame, target: str) -> DataFrame:
    """rows, columns, events, event rate, total NULL cells (one aggregation)."""
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.sum(target).cast("long").alias("n_events"),
        F.avg(target).alias("event_rate"),
        nulls.cast("long").alias("total_nulls"),
    )


def select_features(df: DataFrame, id_col: str, target: str, keep: Sequence[str] | None = None) -> DataFrame:
    cols = [c for c in df.columns if c not in (id_col, target)] if keep is None else list(keep)
    return df.select(*[F.col(f"`{c}`") for c in cols])


# FIXED VALUES: feature groups of the three borrower shapes: name fragments,
# then whole names (a feature can be in several groups)
FEATURE_GROUPS = (
    ("Utilization", ("UTIL",), ()),
    ("Payment", ("PAY_RATIO", "MONTHS_PAID", "TOTAL_PAY"), ()),
    ("Delinquency", ("DELINQUENT", "DELINQUENCY"), ()),
    ("Balance", ("BALANCE", "DEBT"), ()),
    ("Velocity", ("VELOCITY", "ACCEL"), ()),
    ("Interaction", ("STRESS", "X_", "LIMIT_TO"), ()),
    ("Raw", (), ("LIMIT_BAL", "AGE", "SEX", "EDUCATION", "MARRIAGE", "PAY_3", "PAY_4", "PAY_5", "PAY_6")),
)
BORROWER_GROUPS = (
    ("Delinquency", ("DELINQUENT", "DELINQUENCY", "LATE"), ()),
    ("Debt Burden", ("DEBT", "INCOME", "RESIDUAL"), ()),
    ("Credit Lines", ("CREDIT", "UTIL", "LIMIT"), ()),
    ("Life Stage", ("AGE", "DEPENDENT", "YOUNG", "SENIOR"), ()),
    ("Interaction", ("STRESS", "X_"), ()),
    ("Raw", (), ("RevolvingUtilizationOfUnsecuredLines", "age", "DebtRatio", "MonthlyIncome",
                 "NumberOfOpenCreditLinesAndLoans", "NumberRealEstateLoansOrLines", "NumberOfDependents")),
)
APPLICATION_GROUPS = (
    ("Credit Ratios", ("RATIO", "CREDIT_TO"), ()),
    ("Age/Employment", ("AGE", "EMPLOY", "YOUNG", "SENIOR"), ()),
    ("External Scores", ("EXT_SOURCE",), ()),
    ("Enquiries", ("ENQUIR",), ()),
    ("Interaction", ("STRESS", "X_"), ()),
    ("Raw", (), ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "DAYS_EMPLOYED", "CNT_FAM_MEMBERS")),
)


def feature_groups(features: DataFrame, groups=FEATURE_GROUPS, name_col: str = "feature", any_case: bool = True) -> DataFrame:
    """(group, feature) rows from a catalog table of feature names. ``any_case``
    compares upper-cased names; the other two shapes mix cases on purpose."""
    f = F.upper(F.col(name_col)) if any_case else F.col(name_col)
    arms = []
    for g, fragments, names in groups:
        hit = F.lit(False) if not names else f.isin(*names)
        for part in fragments:
            hit = hit | f.contains(part)
        arms.append(F.when(hit, F.lit(g)))
    return features.select(F.explode(F.array_compact(F.array(*arms))).alias("group"), F.col(name_col).alias("feature"))


def present_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature)``: the named columns with at least one value (one aggregation)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)])
    found = F.array(*[F.when(F.col(f"n{i}") > 0, F.lit(c)) for i, c in enumerate(names)])
    return counts.select(F.explode(F.array_compact(found)).alias("feature"))
