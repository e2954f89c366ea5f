"""Reports of many runs, models and splits in one store.

A report is a small table; a store keeps every run's copy under
``<root>/<report>/run=../model=../split=..``. Writing a part again replaces
that part alone, so a repeated run leaves one copy. Reading with a run, model
or split lists and opens only the folders asked for; feature and group
filters reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.sources.io import path_exists, read_report, write_model_card, write_report_csv, write_text_report

PARTS = ("run", "model", "split")
# Columns of the reports that a store knows, so that a missing one reads as an empty table.
SCHEMAS = {
    "bias": "group_col string, group_val string, n long, auc double, gini double, event_rate double, auc_delta double",
    "psi": "feature string, psi double, status string, n_bins long",
    "iv": "feature string, iv double, n_bins long, flag string",
    "stability": "period int, n_customers long, event_rate double, gini double, auc double, gini_delta_from_baseline double, alert string",
    "tiers": "tier_order int, risk_tier string, n_customers long, avg_pd double, actual_default_rate double, pct_of_portfolio double",
}


class ReportStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, report: str) -> str:
        if report not in SCHEMAS:
            raise ValueError(f"Unknown report {report!r}; choose from {sorted(SCHEMAS)}")
        return f"{self.root}/{report}"

    def schema(self, report: str) -> StructType:
        parts = ", ".join(f"{p} string" for p in PARTS)
        return StructType.fromDDL(f"{SCHEMAS[report]}, {parts}")

    def write(self, report: str, df: DataFrame, run: str, model: str, split: str) -> None:
        """Put one report (a few rows: one file) in its place."""
        want = StructType.fromDDL(SCHEMAS[report])
        cols = [F.col(f.name).cast(f.dataType) for f in want]
        part = df.select(*cols, F.lit(run).alias("run"), F.lit(model).alias("model"), F.lit(split).alias("split")).coalesce(1)
        out = part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS)
        out.parquet(self._path(report))

    def read(
        self,
        report: str,
        run: str | None = None,
        model: str | None = None,
        split: str | None = None,
        features: Sequence[str] | None = None,
        group_cols: Sequence[str] | None = None,
    ) -> DataFrame:
        """Rows of a report; a report that was never written is an empty table of its columns."""
        path, schema = self._path(report), self.schema(report)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(path)
        for column, value in zip(PARTS, (run, model, split)):
            if value is not None:
                df = df.where(F.col(column) == value)
        for column, values in (("feature", features), ("group_col", group_cols)):
            if values is not None:
                df = df.where(F.col(column).isin(*values))
        return df

    def top(self, report: str, by: str, n: int, **where) -> DataFrame:
        """The n rows with the largest ``by`` (ties by the first column)."""
        df = self.read(report, **where)
        return df.orderBy(F.desc_nulls_last(by), df.columns[0]).limit(n)

    def distinct(self, report: str, column: str, **where) -> DataFrame:
        """Values of a column; of run, model or split without opening a file's rows of other columns."""
        return self.read(report, **where).select(column).distinct()

    def export(self, report: str, path: str, fmt: str = "csv", **where) -> DataFrame:
        """Write the selected rows as one CSV, JSON or text file and return what a reader finds there."""
        df = self.read(report, **where)
        if fmt == "csv":
            write_report_csv(df, path)
        elif fmt == "json":
            write_model_card(df, path)
        elif fmt == "text":
            cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
            write_text_report(df.select(F.concat_ws(" | ", *cells).alias("value"), F.col(df.columns[0]).alias("line_no")), path)
        else:
            raise ValueError(f"Unknown format {fmt!r}; choose csv, json or text")
        return read_report(self.spark, path, df.schema, fmt)
