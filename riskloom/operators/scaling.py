"""Z-score standardisation with the population standard deviation.

Spark ML's ``StandardScaler`` divides by the sample std; the workflow's
scaler uses the population one, so the moments come from one ``agg``
(mergeable partial aggregates, no shuffle of rows) and are applied as
literal expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class StandardModel:
    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c, m in self.means.items():
            s = self.stds[c]
            scale = s if s and s > 0 else 1.0  # a constant column maps to 0
            out[f"{c}{suffix}"] = (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(scale)
        return df.withColumns(out)


def fit_standard(df: DataFrame, cols: Sequence[str], count: str | None = None) -> StandardModel:
    """``count`` names a column that says how many rows a row stands for."""
    if count is not None:
        return _fit_counted(df, cols, F.col(count).cast("double"))
    aggs = []
    for c in cols:
        aggs += [F.avg(f"`{c}`").alias(f"m_{c}"), F.stddev_pop(f"`{c}`").alias(f"s_{c}")]
    r = df.agg(*aggs).collect()[0]
    return StandardModel({c: r[f"m_{c}"] for c in cols}, {c: r[f"s_{c}"] for c in cols})


def _fit_counted(df: DataFrame, cols: Sequence[str], n: Column) -> StandardModel:
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    rows = {c: F.sum(F.when(v.isNotNull(), n)) for c, v in x.items()}
    r = df.agg(*[F.try_divide(F.sum(n * v), rows[c]).alias(f"m_{c}") for c, v in x.items()]).first()
    means = {c: r[f"m_{c}"] for c in cols}
    r = df.agg(*[F.sqrt(F.try_divide(F.sum(n * F.pow(v - F.lit(means[c]), 2)), rows[c])).alias(f"s_{c}") for c, v in x.items()]).first()
    return StandardModel(means, {c: r[f"s_{c}"] for c in cols})
