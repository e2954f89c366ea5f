"""Queries: dataset registry, scans, caches, joins of X and y, report sinks, pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import features as fe
from riskloom.operators import segments as sg
from riskloom.operators import splits as SP
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_cleaning import CANON, SQL_RENAME
from riskloom.plans.q_features import (
    BAL, INTER, RATIO, SQL_BALANCE, SQL_DELINQ, SQL_INTER, SQL_PAYMENT, SQL_UTIL, SQL_VELOCITY, UTIL,
    UTIL_COLS, VEL,
)
from riskloom.functions import constants as K
from riskloom.plans.q_segments import SQL_TIER_SUMMARY
from riskloom.sources import fixtures as fx
from riskloom.sources import io

# the smallest test tables hold 150 customers; real tables keep the default of 1,000 rows
FIXTURE_MIN_ROWS = 100

SQL_UCI_CLEAN = (
    "SELECT row_number() OVER (ORDER BY \"Unnamed: 0\") AS ID, "
    + ", ".join(
        "cast(CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS int) AS EDUCATION" if c == "EDUCATION"
        else "cast(CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END AS int) AS MARRIAGE" if c == "MARRIAGE"
        else "try_cast(default_payment_next_month AS int) AS default_payment_next_month" if c == "default_payment_next_month"
        else f'"{c}"'
        for c in CANON[1:]
    )
    + f" FROM ({SQL_RENAME}) r"
)


@register("load_dataset", with_fixtures(SQL_UCI_CLEAN, "uci_raw"), ["LIMIT_BAL"])
def q_load_dataset(spark, sf):
    """Registry lookup -> raw card-statement table -> cleaning chain."""
    return io.load_dataset(spark, "uci", sf, FIXTURE_MIN_ROWS)


SQL_SCAN = 'SELECT * EXCLUDE ("Unnamed: 0") FROM uci_raw'


@register("scan_csv", with_fixtures(SQL_SCAN, "uci_raw"), ["X1"])
def q_scan_csv(spark, sf):
    """Write the raw table as header CSV (derived data), scan it back with an explicit
    schema, drop the unnamed index column."""
    raw = fx.uci_raw(spark, sf)
    path = io.scratch_path(spark, "uci-csv")
    raw.write.mode("overwrite").option("header", True).csv(path)
    return io.scan_csv(spark, path, schema=raw.schema)


@register("cached_clean", with_fixtures(SQL_UCI_CLEAN, "uci_raw"), ["LIMIT_BAL"])
def q_cached_clean(spark, sf):
    """First call cleans and writes the parquet cache of these inputs; later calls read it."""
    root = io.scratch_path(spark, "uci-clean")
    inputs = [f"{sf}/customer.parquet", f"{sf}/orders.parquet"]
    for _ in range(2):
        out = io.cached_clean(spark, root, inputs, "uci-1", lambda: io.load_dataset(spark, "uci", sf, FIXTURE_MIN_ROWS))
    return out


SQL_XY = "SELECT * FROM (" + SQL_UCI_CLEAN + ") t"


@register("assemble_xy", with_fixtures(SQL_XY, "uci_raw"), ["LIMIT_BAL"])
def q_assemble_xy(spark, sf):
    clean = io.load_dataset(spark, "uci", sf, FIXTURE_MIN_ROWS)
    x = clean.drop("default_payment_next_month")
    y = clean.select("ID", "default_payment_next_month")
    return io.assemble_xy(x, y, "ID")


# ---------------------------------------------------------------- pipeline
RAW_KEEP = ["limit_bal"] + [f"bill_amt{k}" for k in range(1, 7)] + [f"pay_amt{k}" for k in range(1, 7)] + [
    "pay_3", "pay_4", "pay_5", "pay_6"]
FEATS = (
    RAW_KEEP + UTIL + UTIL_COLS + RATIO + ["pay_ratio_mean", "pay_ratio_min", "pay_ratio_std", "months_paid_full",
    "months_paid_zero", "total_pay_ratio", "max_delinquency", "total_delinquency_score", "delinquency_trend",
    "chronic_delinquent"] + BAL + VEL + INTER
)


def statement_sql() -> str:
    """All engineered statement features of the panel, as they are before any fill."""
    parts = [SQL_UTIL, SQL_PAYMENT, SQL_DELINQ, SQL_BALANCE, SQL_VELOCITY, SQL_INTER]
    joins = " ".join(f"JOIN ({p}) t{i} USING (id)" for i, p in enumerate(parts))
    return f"SELECT p.id, p.y, {', '.join('p.' + c for c in RAW_KEEP)}, {', '.join(c for c in FEATS if c not in RAW_KEEP)} FROM panel p {joins}"


def _pipeline_sql() -> str:
    split = f"""SELECT id, CASE WHEN rn <= round({K.OOT_FRACTION} * n_y) THEN 'oot'
        WHEN rn <= round({K.OOT_FRACTION} * n_y) + round({K.TEST_SIZE} * (n_y - round({K.OOT_FRACTION} * n_y))) THEN 'test'
        ELSE 'train' END AS split
      FROM (SELECT id, row_number() OVER (PARTITION BY y ORDER BY md5(cast(id AS varchar))) AS rn,
                   count(*) OVER (PARTITION BY y) AS n_y FROM panel) r"""
    fill = ", ".join(
        f"coalesce(cast({c} AS double), (SELECT CASE WHEN count_if({c} IS NULL) > 0 THEN coalesce(quantile_cont({c}, 0.5), 0.0) ELSE 0.0 END FROM tr)) AS {c}"
        for c in FEATS
    )
    return f"""WITH fe AS ({statement_sql()}),
sp AS ({split}),
tr AS (SELECT fe.* FROM fe JOIN sp ON fe.id = sp.id WHERE split = 'train')
SELECT id, y, {fill} FROM fe"""


@register("feature_pipeline", with_fixtures(_pipeline_sql(), "panel"), FEATS)
def q_feature_pipeline(spark, sf):
    """Fit on the train split (medians for NULL/inf), transform every row."""
    p = fx.panel(spark, sf)
    train = SP.stratified_split(p, "id", "y").where(F.col("split") == "train").drop("split")
    pipe = fe.StatementPipeline().fit(train)
    return pipe.transform(p)


# ---------------------------------------------------------------- sinks
TIER_DBL = ["avg_pd", "actual_default_rate", "pct_of_portfolio"]


@register("write_report_csv", with_fixtures(SQL_TIER_SUMMARY, "scored"), TIER_DBL)
def q_write_report_csv(spark, sf):
    """Tier summary written as a one-file header CSV, read back with its schema."""
    t = sg.tier_summary(fx.scored(spark, sf))
    path = io.scratch_path(spark, "tier-summary")
    io.write_report_csv(t, path)
    return io.read_report(spark, path, t.schema, "csv")


@register("read_report", with_fixtures(SQL_TIER_SUMMARY, "scored"), TIER_DBL)
def q_read_report(spark, sf):
    """A missing report gives an empty table of the expected schema; an existing one is read."""
    t = sg.tier_summary(fx.scored(spark, sf))
    missing = io.read_report(spark, io.scratch_path(spark, "absent"), t.schema, "csv")
    path = io.scratch_path(spark, "tiers")
    io.write_report_csv(t, path)
    return missing.unionByName(io.read_report(spark, path, t.schema, "csv"))

