"""Drift of a stream: population stability of arriving rows against a fitted reference.

The reference keeps bin edges and the expected side's counts (features x bins
numbers). The stream's state is the count of arrived rows per (feature, bin):
counts merge, so the report after any number of files is the report over
their union, and state never grows with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators.binning import Bins


class Reference(NamedTuple):
    edges: Bins
    counts: dict[tuple[str, int], int]


def fit_reference(expected: DataFrame, features: Sequence[str], n_bins: int = 10) -> Reference:
    """Percentile edges of the expected rows and how many fall into each bin."""
    edges = B.psi_edges(expected, features, n_bins)
    rows = B.binned_rows(expected, edges, []).groupBy("feature", "bin").agg(F.count("*").alias("n")).collect()
    return Reference(edges, {(r["feature"], r["bin"]): r["n"] for r in rows})


def arrived(stream: DataFrame, reference: Reference) -> DataFrame:
    """(feature, bin, c_act) of the rows of a static or streaming table."""
    return B.binned_rows(stream, reference.edges, []).groupBy("feature", "bin").agg(F.count("*").alias("c_act"))


def report(spark, reference: Reference, counts: DataFrame) -> DataFrame:
    """The PSI report of arrived counts."""
    expected = spark.createDataFrame([(*k, n) for k, n in reference.counts.items()], "feature string, bin int, c_exp long")
    both = counts.join(F.broadcast(expected), ["feature", "bin"], "full").na.fill({"c_exp": 0, "c_act": 0})
    return B.psi_summary(B.psi_rows(both, reference.edges), list(reference.edges))


def run(stream: DataFrame, reference: Reference, counts_path: str, checkpoint: str) -> DataFrame:
    """Take in all files that are there, keep the counts under ``counts_path``, and return the report.

    Every micro-batch writes all counts anew under its own number (features x
    bins rows), so a batch that is run again after a failure changes nothing;
    with the same checkpoint a later call goes on from the kept state.
    """
    spark = stream.sparkSession

    def keep(counts: DataFrame, batch: int) -> None:
        counts.coalesce(1).write.mode("overwrite").parquet(f"{counts_path}/batch={batch}")

    query = arrived(stream, reference).writeStream.outputMode("complete").foreachBatch(keep)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.schema("feature string, bin int, c_act long, batch long").parquet(counts_path)
    last = kept.agg(F.max("batch")).first()[0]
    return report(spark, reference, kept.where(F.col("batch") == last).drop("batch"))
