"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Quality classifier (rejected documents go), line dedup (repeated lines go),
n-gram Jaccard join (one document of each group stays), benchmark
decontamination (documents that hold a benchmark item go), best-fit packing
(its rows are the result).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from riskloom.llm.common import Workspace
from riskloom.llm.queries import read, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, stats=("__lines", "__dropped")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_copies(docs, k=5, num=4, den=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), "dropped", end_id=1, capacity=4096)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# A trained score, similarity search and a packing plan have no SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; every stage's table lies under the shared checkpoint folder."""
    ws = Workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
