"""Loading borrower tables from CSV or Parquet folders.

A registry declares the columns of every dataset shape. One pass reads the
files as text (CSV) or as they are (Parquet), converts each declared column,
and writes two Parquet tables at once: records that fit, and a quarantine
table of those that don't, each with its file, its text and the reason. The
contract counts them and refuses a load with too many rejected records.

The records are written before anything else reads them: a CSV scan that is
pruned to some columns doesn't see faults in the others, a written table
does, and later passes read typed columns.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.operators.cleaning import ALIASES, GENERIC_NAMES

log = logging.getLogger(__name__)

# FIXED VALUES: texts that stand for a missing value in CSV distributions of the datasets.
MISSING = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None")
INDEX_NAMES = ("_c0", "Unnamed: 0", "index")


def _types(**by_type: str) -> dict[str, str]:
    return {name: kind for kind, names in by_type.items() for name in names.split()}


# FIXED VALUES: declared columns and types of the three shapes
COLUMNS: dict[str, dict[str, str]] = {
    "uci": _types(
        bigint="ID",
        double="LIMIT_BAL BILL_AMT1 BILL_AMT2 BILL_AMT3 BILL_AMT4 BILL_AMT5 BILL_AMT6 "
        "PAY_AMT1 PAY_AMT2 PAY_AMT3 PAY_AMT4 PAY_AMT5 PAY_AMT6",
        int="SEX EDUCATION MARRIAGE AGE PAY_1 PAY_2 PAY_3 PAY_4 PAY_5 PAY_6 default_payment_next_month",
    ),
    "gmc": _types(
        bigint="ID",
        double="RevolvingUtilizationOfUnsecuredLines DebtRatio MonthlyIncome NumberOfDependents",
        int="age NumberOfTime30-59DaysPastDueNotWorse NumberOfTime60-89DaysPastDueNotWorse NumberOfTimes90DaysLate "
        "NumberOfOpenCreditLinesAndLoans NumberRealEstateLoansOrLines SeriousDlqin2yrs",
    ),
    "homecredit": _types(
        bigint="SK_ID_CURR",
        double="AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE CNT_FAM_MEMBERS EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 "
        "AMT_REQ_CREDIT_BUREAU_MON AMT_REQ_CREDIT_BUREAU_QRT AMT_REQ_CREDIT_BUREAU_YEAR",
        int="TARGET DAYS_BIRTH DAYS_EMPLOYED DAYS_REGISTRATION DAYS_ID_PUBLISH",
        string="NAME_CONTRACT_TYPE CODE_GENDER",
    ),
}
OPTIONAL = {"uci": {"ID"}, "gmc": {"ID"}, "homecredit": set()}


@dataclass(frozen=True)
class Ingest:
    """``records``: rows that fit, in the columns of the files; ``rejected``: file, record, reason."""

    records: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """(reason, n): rejected records per reason, and ``kept``."""
        kept = self.records.agg(F.lit("kept").alias("reason"), F.count("*").alias("n"))
        return self.rejected.groupBy("reason").agg(F.count("*").alias("n")).unionByName(kept)


def canonical(columns: list[str]) -> dict[str, str]:
    """File column -> declared name (generic X1..X23, Y and alias names included)."""
    trimmed = {c: c.strip() for c in columns}
    generic = GENERIC_NAMES if {"X1", "Y"} <= set(trimmed.values()) else {}
    return {c: generic.get(t, ALIASES.get(t, t)) for c, t in trimmed.items()}


def declared_types(name: str, columns: list[str]) -> dict[str, str]:
    """Type per file column; columns that nobody declared stay text. Missing declared columns raise."""
    if name not in COLUMNS:
        raise ValueError(f"Unknown dataset {name!r}; choose from {sorted(COLUMNS)}")
    want, known = COLUMNS[name], canonical(columns)
    lost = set(want) - OPTIONAL[name] - set(known.values())
    if lost:
        raise ValueError(f"{name}: the files lack {sorted(lost)}")
    extra = [c for c, k in known.items() if k not in want and c.strip() not in INDEX_NAMES]
    if extra:
        log.warning("%s: columns %s are not declared and stay text", name, extra)
    return {c: want.get(k, "bigint" if c.strip() in INDEX_NAMES else "string") for c, k in known.items()}


def _raw(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The files' columns with ``_file`` and ``_record`` (the text of a CSV line with too few or too many fields)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.lit(None).cast("string").alias("_record"))
    if fmt != "csv":
        raise ValueError(f"Unknown format {fmt!r}; choose csv or parquet")
    names = spark.read.option("header", True).csv(path).columns  # reads one line
    schema = StructType([StructField(n, StringType()) for n in [*names, "_record"]])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", "_record").option("columnPruning", False)
    if "_c0" not in names:  # a header cell without a name can't be compared
        reader = reader.option("enforceSchema", False)
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file"))


def _present(x: Column, have: str) -> Column:
    """The column with texts that stand for a missing value as null."""
    return F.when(~F.trim(x).isin(*MISSING), F.trim(x)) if have == "string" else x


def _value(x: Column, want: str) -> Column:
    """The value in its declared type, null where it can't be converted."""
    if want == "string":
        return x.cast("string")
    if want == "bigint":
        return x.try_cast(want)
    if want == "int":  # 3.0 is a whole number, 3.5 is none
        real = x.try_cast("double")
        return F.when(real % 1 == 0, real.try_cast("int"))
    return x.try_cast(want)


def ingest(spark: SparkSession, name: str, path: str, fmt: str = "csv", dest: str | None = None) -> Ingest:
    """Read a folder of one dataset into a table of records and a quarantine table under ``dest``."""
    from riskloom.sources.io import scratch_path

    raw = _raw(spark, path, fmt)
    kinds = declared_types(name, [c for c in raw.columns if c not in ("_file", "_record")])
    have = {c: raw.schema[c].dataType.simpleString() for c in kinds}
    given = raw.select("_file", "_record", *[_present(F.col(f"`{c}`"), have[c]).alias(f"_x{i}") for i, c in enumerate(kinds)])
    rows = given.select("*", *[_value(F.col(f"_x{i}"), want).alias(c) for i, (c, want) in enumerate(kinds.items())])
    faults = [F.when(F.col("_record").isNotNull(), F.lit("fields"))]
    faults += [
        F.when(F.col(f"_x{i}").isNotNull() & F.col(f"`{c}`").isNull(), F.lit(f"type of {c}")) for i, c in enumerate(kinds)
    ]
    rows = rows.withColumn("_reason", F.coalesce(*faults))
    whole = F.to_json(F.struct(*[F.col(f"_x{i}").cast("string").alias(c) for i, c in enumerate(kinds)]))
    rows = rows.withColumn("_text", F.when(F.col("_reason").isNotNull(), F.coalesce("_record", whole)))
    rows = rows.select(*[F.col(f"`{c}`") for c in kinds], "_file", "_reason", "_text")
    dest = dest or scratch_path(spark, f"{name}-ingest")
    rows.withColumn("_kept", F.col("_reason").isNull()).write.partitionBy("_kept").parquet(dest)
    table = spark.read.schema(StructType([*rows.schema.fields, StructField("_kept", StringType())])).parquet(dest)
    fit, unfit = table.where("_kept = 'true'"), table.where("_kept = 'false'")
    return Ingest(
        fit.select(*[F.col(f"`{c}`") for c in kinds]),
        unfit.select(F.col("_file").alias("file"), F.col("_text").alias("record"), F.col("_reason").alias("reason")),
    )


def enforce_share(got: Ingest, max_rejected: float) -> None:
    """Raise when more than ``max_rejected`` of all records were rejected."""
    n = {r["reason"]: r["n"] for r in got.counts().collect()}
    bad = sum(n.values()) - n["kept"]
    if bad > max_rejected * max(bad + n["kept"], 1):
        raise ValueError(f"{bad} of {bad + n['kept']} records rejected: {dict(sorted(n.items()))}")
    if bad:
        log.warning("%d of %d records rejected", bad, bad + n["kept"])
