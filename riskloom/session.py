"""Session helpers.

On a cluster the session already exists and carries the shared
``spark.checkpoint.dir``; we only fill settings that are unset (tests,
local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_spark(master: str | None = None, app: str = "riskloom") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("RISKLOOM_MASTER", "local[8]"))
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    Set by the cluster; only when it is unset (local tests) do we pick a
    scratch folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


# HotSpot never compiles a method beyond this many bytes of bytecode.
JIT_METHOD_BYTES = "8000"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def wide_rows(spark: SparkSession) -> None:
    """Keep projections and aggregates over dozens of columns in compiled code.

    Whole-stage code of such a stage is one method that the JVM only ever
    interprets; beyond HotSpot's limit Spark then generates its smaller
    functions instead. A limit that the session states is left alone.
    """
    if spark.sparkContext.getConf().get(_METHOD_LIMIT) is None:
        spark.conf.set(_METHOD_LIMIT, JIT_METHOD_BYTES)


def scratch_root(spark: SparkSession) -> str:
    """Per-application folder for intermediate tables, under the shared checkpoint dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/riskloom-scratch/{spark.sparkContext.applicationId}"


def cleanup_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables (call at the end of a job)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def run_parallel(fns, max_workers: int = 4) -> list:
    """Submit independent Spark jobs (model fits for folds, restarts, k values)
    from driver threads so their stages overlap; results keep input order.
    Same idea as the ``parallelism`` parameter of Spark ML's tuning classes."""
    from concurrent.futures import ThreadPoolExecutor

    fns = list(fns)
    if len(fns) <= 1 or max_workers <= 1:
        return [f() for f in fns]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(fns))) as ex:
        return list(ex.map(lambda f: f(), fns))
