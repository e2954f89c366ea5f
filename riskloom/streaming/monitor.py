"""Scoring a stream with the batch operators.

The workflow itself is batch (monthly monitoring). Tier assignment and
points are pure column expressions, so they apply unchanged to each
micro-batch of a Structured Streaming query; drift keeps its counts as state
(:mod:`riskloom.streaming.drift`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.operators.scorecard import score_points_expr
from riskloom.operators.segments import tier_expr


def score_columns(df: DataFrame, pd_col: str = "pd_score") -> DataFrame:
    """Add ``risk_tier`` and ``score`` (works on a static or a streaming DataFrame)."""
    return df.withColumns({"risk_tier": tier_expr(pd_col), "score": score_points_expr(pd_col)})


def write_scored_stream(stream: DataFrame, path: str, checkpoint: str, pd_col: str = "pd_score", available_now: bool = False):
    """Append scored rows of a streaming source to parquet (exactly-once via the checkpoint).

    ``available_now`` takes in what has arrived and ends; otherwise the query goes on.
    """
    writer = (
        score_columns(stream, pd_col)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
