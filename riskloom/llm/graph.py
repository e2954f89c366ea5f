"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Workspace


def _large_star(e: DataFrame, ws: Workspace) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ws.save(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(e: DataFrame, ws: Workspace) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    least = ws.save(e.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, ws: Workspace, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node that has an edge; comp is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014):
    every round is a few joins and groupings with map-side minima. Minima are
    written before they are joined: both sides of a join are then plain
    shuffles, so adaptive execution can split a hub's partition.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, seen = ws.save(e, "edges"), None
    while True:
        n, mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if n == 0 or (n, mark) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
            )
        seen = (n, mark)
        wide = ws.save(_large_star(e, ws).distinct(), "wide")
        new = ws.save(_small_star(wide, ws).distinct(), "edges")
        ws.drop(e)
        ws.drop(wide)
        e = new
