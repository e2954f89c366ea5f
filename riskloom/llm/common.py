"""Helpers shared by the operators: scratch tables, Arrow columns, publishing files."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_root

# Rows in one Arrow batch: whole texts can be long, so batches stay short.
BATCH_ROWS = 1000
# Spark then removes the shuffle files of a query as soon as it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Stands for a null id where ids are ordered or compared: larger than every id.
NO_ID = 2**63 - 1


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches short, whatever the session's own (row-based) setting is."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


class Workspace:
    """Tables under the shared checkpoint folder that live as long as an operator needs them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back: cuts the lineage, survives lost executors, leaves no shuffle files."""
        path = self.path(name)
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove a saved table that no later step reads."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a folder URI (file:, hdfs:, s3:, gs:) and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def publish(folder: str, name: str, data: bytes) -> None:
    """Write a file under a name of this attempt, then move it to its own name.

    Every attempt of a task writes the same bytes, so whichever move comes
    last changes nothing and readers never see a half-written file.
    """
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    attempt = f"{path}/_{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        out.write(data)
    fs.move(attempt, f"{path}/{name}")


def fetch(folder: str, name: str) -> bytes:
    fs, path = filesystem(folder)
    with fs.open_input_file(f"{path}/{name}") as f:
        return f.read()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column by name; with repeated names the first."""
    return batch.column(batch.schema.get_all_field_indices(name)[0])


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows in them (null: empty)."""
    if col.null_count:
        col = pc.fill_null(col, "")
    if pa.types.is_large_string(col.type):
        offsets = np.frombuffer(col.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(col.buffers()[1], np.int32).astype(np.int64)
    offsets = offsets[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids(col: pa.Array) -> np.ndarray:
    """A long column with nulls as NO_ID."""
    return pc.fill_null(col.cast(pa.int64()), NO_ID).to_numpy(zero_copy_only=False)


def id_or_null(name: str):
    """Column expression: NO_ID back to null."""
    return F.when(F.col(name) != F.lit(NO_ID), F.col(name))


def lists_of(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
