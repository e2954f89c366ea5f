"""Queries: the three dataset shapes loaded by path from CSV and Parquet folders, and their rejected records.

The folders are written first from the given tables: CSV lines and text
columns, in which some records have a value of the wrong type or a field too
few. Loading sees nothing but the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import features as fe
from riskloom.plans import q_datasets as D
from riskloom.plans import q_features as Q
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.plans.q_sources import FIXTURE_MIN_ROWS, SQL_UCI_CLEAN
from riskloom.sources import fixtures as fx
from riskloom.sources import io
from riskloom.sources.files import ingest

# shape -> (raw table, key, column with wrong values)
SHAPES = {
    "uci": (fx.uci_raw, "Unnamed: 0", "X12"),
    "gmc": (fx.borrowers, "ID", "DebtRatio"),
    "homecredit": (fx.applications, "SK_ID_CURR", "AMT_CREDIT"),
}
WRONG, SHORT = (41, 7), (43, 5)  # key % a = b


def _is(key: str, rule: tuple[int, int]):
    return F.col(f"`{key}`") % rule[0] == rule[1]


def write_folder(spark: SparkSession, sf: str, name: str, fmt: str) -> str:
    """A folder in which some records are faulty; missing values are texts."""
    builder, key, col = SHAPES[name]
    raw = builder(spark, sf)
    text = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in raw.columns}
    text[col] = F.when(_is(key, WRONG), "about 12k").otherwise(text[col])
    path = io.scratch_path(spark, f"{name}-{fmt}")
    if fmt == "parquet":
        raw.select(*[v.alias(c) for c, v in text.items()]).write.parquet(path)
        return path
    line = F.concat_ws(",", *list(text.values())[:-1])
    line = F.when(_is(key, SHORT), line).otherwise(F.concat(line, F.lit(","), list(text.values())[-1]))
    # one column of whole lines: its header is the header of all columns
    raw.select(line.alias(",".join(raw.columns))).write.option("header", True).option("sep", "\x01").csv(path)
    return path


def _load(name: str, fmt: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return io.load_dataset(spark, name, min_rows=FIXTURE_MIN_ROWS, path=write_folder(spark, sf, name, fmt), fmt=fmt, max_rejected=0.1)

    q.__doc__ = f"The {name} shape from a {fmt.upper()} folder: declared types, quarantine, cleaning, contract."
    return q


def _good(table: str, key: str, fmt: str) -> str:
    short = f' AND "{key}" % {SHORT[0]} <> {SHORT[1]}' if fmt == "csv" else ""
    return f'SELECT * FROM {table} WHERE "{key}" % {WRONG[0]} <> {WRONG[1]}{short}'


def _from_good(sql: str, table: str, key: str, fmt: str, base: str, extra: dict[str, str]) -> str:
    good = {**extra, "good": _good(table, key, fmt)}
    return with_fixtures(sql.replace(table, "good"), base, extra=good)


HC_SQL = "SELECT SK_ID_CURR AS ID, * EXCLUDE (SK_ID_CURR) FROM (" + D.HC_CLEAN + ") c"
for _fmt in ("csv", "parquet"):
    register(f"load_{_fmt}_uci", _from_good(SQL_UCI_CLEAN, "uci_raw", "Unnamed: 0", _fmt, "uci_raw", {}), ["LIMIT_BAL"])(_load("uci", _fmt))
    register(
        f"load_{_fmt}_gmc", _from_good(D.GMC_CLEAN, "borrowers_raw", "ID", _fmt, "panel", {"borrowers_raw": Q.BORROWERS_SQL}),
        [fe.B_UTIL, fe.B_DEBT, fe.B_INC, fe.B_DEP],
    )(_load("gmc", _fmt))
    register(
        f"load_{_fmt}_homecredit", _from_good(HC_SQL, "apps_raw", "SK_ID_CURR", _fmt, "panel", {"apps_raw": Q.APPS_SQL}),
        [*D.HC_PLAIN, *D.HC_FILLED, "DAYS_EMPLOYED"],
    )(_load("homecredit", _fmt))


def _rejected_sql() -> str:
    arms = []
    for name, (_, _, col) in SHAPES.items():
        for fmt in ("csv", "parquet"):
            short = f"id % {SHORT[0]} = {SHORT[1]}" if fmt == "csv" else "false"
            reason = f"CASE WHEN {short} THEN 'fields' WHEN id % {WRONG[0]} = {WRONG[1]} THEN 'type of {col}' ELSE 'kept' END"
            arms.append(f"SELECT '{name}' AS dataset, '{fmt}' AS format, {reason} AS reason FROM panel")
    return f"SELECT dataset, format, reason, count(*) AS n FROM ({' UNION ALL '.join(arms)}) r GROUP BY ALL"


@register("rejected_records", with_fixtures(_rejected_sql(), "panel"))
def q_rejected_records(spark, sf):
    """Records per dataset, format and reason in the quarantine tables, and those kept."""
    out = None
    for name in SHAPES:
        for fmt in ("csv", "parquet"):
            n = ingest(spark, name, write_folder(spark, sf, name, fmt), fmt).counts().where("n > 0")
            n = n.select(F.lit(name).alias("dataset"), F.lit(fmt).alias("format"), "reason", "n")
            out = n if out is None else out.unionByName(n)
    return out
