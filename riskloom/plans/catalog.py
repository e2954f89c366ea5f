"""Registry of named queries: Spark DataFrame builder + DuckDB oracle text.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables. ``doubles`` lists the floating columns that both sides
round to six decimals before comparison (the two engines sum floats in
different orders).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.sqlx import round_cols


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.doubles:
            df = df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), 6) for c in self.doubles})
        return df

    def oracle(self) -> str | None:
        return None if self.sql is None else round_cols(self.sql, self.doubles)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(doubles))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # import side effect: each module registers its queries
    from riskloom.plans import (  # noqa: F401
        q_cleaning,
        q_datasets,
        q_features,
        q_files,
        q_governance,
        q_metrics,
        q_models,
        q_reports,
        q_scorecard,
        q_segments,
        q_selection,
        q_sources,
        q_splits,
        q_store,
        q_workflow,
    )

    return REGISTRY
