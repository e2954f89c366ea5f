"""Dataset registry, scans, caches and report sinks.

Inputs are paths (no downloaders). Reports are small aggregates: they are
written with a single output file for convenience.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    target: str
    id_col: str
    builder: Callable[[SparkSession, str], DataFrame]
    clean: Callable[[DataFrame], DataFrame]
    group_cols: tuple[str, ...] = field(default=())


def _specs() -> dict[str, DatasetSpec]:
    from riskloom.operators import cleaning as C
    from riskloom.sources import fixtures as fx

    def clean_uci(df):
        df = C.rename_canonical(df)
        df = C.ensure_id(df, ["Unnamed: 0"])
        df = C.recode_values(df)
        df = C.drop_artifacts(df)
        df = C.cast_target(df, "default_payment_next_month")
        return C.drop_all_null_rows(df)

    def clean_gmc(df):
        df, _ = C.clip_outliers(df, {"RevolvingUtilizationOfUnsecuredLines": (0.0, 1.5), "DebtRatio": (0.0, 10.0)})
        df = C.zero_to_median(df, "age")
        df = C.impute_median(df, ["MonthlyIncome"])
        df = C.impute_const(df, {"NumberOfDependents": 0.0})
        return C.cast_target(df, "SeriousDlqin2yrs")

    def clean_hc(df):
        df = C.rename_canonical(df, id_alias="SK_ID_CURR")
        df = C.abs_by_prefix(df, "DAYS_")
        df = C.sentinel_flag(df, "DAYS_EMPLOYED")
        df = C.one_hot_low_card(df, keep=("CODE_GENDER",))
        df = C.impute_median(df)
        return C.cast_target(df, "TARGET")

    return {
        "uci": DatasetSpec("uci", "default_payment_next_month", "ID", fx.uci_raw, clean_uci, ("SEX", "EDUCATION", "MARRIAGE")),
        "gmc": DatasetSpec("gmc", "SeriousDlqin2yrs", "ID", fx.borrowers, clean_gmc, ()),
        "homecredit": DatasetSpec("homecredit", "TARGET", "ID", fx.applications, clean_hc, ("CODE_GENDER",)),
    }


def dataset_spec(name: str) -> DatasetSpec:
    specs = _specs()
    if name not in specs:
        raise ValueError(f"Unknown dataset {name!r}; choose from {sorted(specs)}")
    return specs[name]


def load_dataset(
    spark: SparkSession,
    name: str,
    sf_dir: str | None = None,
    min_rows: int = 1000,
    *,
    path: str | None = None,
    fmt: str = "csv",
    max_rejected: float = 0.05,
) -> DataFrame:
    """name -> spec -> raw table -> clean table that meets its contract
    (:func:`cleaning.enforce_contract`). Unknown names raise.

    With ``path`` the raw table is a folder of CSV or Parquet files
    (:mod:`riskloom.sources.files`); more than ``max_rejected`` of its records
    in quarantine raise. Without, it is derived from the tables in ``sf_dir``.
    The clean table is written once: the contract and whatever is fitted on it
    read it many times.
    """
    from riskloom.operators.cleaning import enforce_contract
    from riskloom.operators.ordered import materialize
    from riskloom.session import wide_rows
    from riskloom.sources.files import enforce_share, ingest

    s = dataset_spec(name)
    wide_rows(spark)
    if path is None:
        raw = s.builder(spark, sf_dir)
    else:
        got = ingest(spark, name, path, fmt)
        enforce_share(got, max_rejected)
        raw = got.records
    return enforce_contract(materialize(s.clean(raw), f"clean-{name}"), s.target, min_rows)


def scan_csv(spark: SparkSession, path: str, schema: StructType | None = None, drop_index: bool = True) -> DataFrame:
    """Header CSV scan; an explicit schema avoids an inference pass over the data.
    A leading unnamed index column (``_c0`` / empty header) is dropped."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    if drop_index:
        df = df.drop(*[c for c in df.columns if c in ("_c0", "", "Unnamed: 0")])
    return df


def write_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def fingerprint(spark: SparkSession, inputs: Sequence[str], version: str) -> str:
    """Key of a cleaned table: names, lengths and modification times of its input files, and the cleaning's version."""
    seen = [version]
    for path in sorted(inputs):
        fs, at = _hadoop(spark, path)
        files = fs.listFiles(at, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        seen += [path, *sorted(found)]
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()[:32]


def cached_clean(spark: SparkSession, root: str, inputs: Sequence[str], version: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The cleaned table of these input files, built once per state of the files and cleaning version.

    The table is written under a name of its own. Only when that is complete,
    a marker named by the fingerprint is created and names the folder: an
    interrupted write leaves no marker and is never read, a changed input has
    another fingerprint, and of two writers the first marker counts.
    """
    marker = f"{root}/{fingerprint(spark, inputs, version)}.marker"
    if not path_exists(spark, marker):
        folder = f"{root}/data-{uuid.uuid4().hex}"
        make().write.parquet(folder)
        fs, at = _hadoop(spark, marker)
        try:
            out = fs.create(at, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
        else:
            out.write(bytearray(folder.encode()))
            out.close()
    return spark.read.parquet(spark.read.text(marker, wholetext=True).first()[0])


def assemble_xy(x: DataFrame, y: DataFrame, key: str = "ID") -> DataFrame:
    """Features and target side by side: an inner equi-join on the row key."""
    return x.join(y, key, "inner")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under this application's scratch folder (shared storage)."""
    from riskloom.session import scratch_root

    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_report_csv(df: DataFrame, path: str) -> None:
    """Report tables are small aggregates: one CSV file with a header."""
    write_csv(df, path, single_file=True)


def read_report(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """Read a report; a missing path gives an empty table of the same schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        return spark.read.option("header", True).schema(schema).csv(path)
    return spark.read.schema(schema).json(path) if fmt == "json" else spark.read.text(path)


def write_model_card(card: DataFrame, path: str) -> None:
    """One-row nested struct DataFrame -> JSON (one file)."""
    card.coalesce(1).write.mode("overwrite").json(path)


def write_text_report(lines: DataFrame, path: str, order_col: str = "line_no", text_col: str = "value") -> None:
    """Ordered text lines (section/key/value flattened) -> one text file."""
    lines.coalesce(1).sortWithinPartitions(order_col).select(text_col).write.mode("overwrite").text(path)

