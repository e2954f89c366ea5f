"""Interventional tree attributions for Spark GBT models.

For one reference row r, the contribution of feature i to f(x) - f(r) is
the Shapley value of the game v(S) = f(x_S, r_rest). For a tree it is
exact: a leaf's path asks one condition of each of its m features. Where x
and r both meet a feature's condition it isn't involved; where only x does it
must be in S (set A), where only r does it must not (set B), and where neither
does the leaf is out of reach. A leaf of value v that is in reach adds
  v * (|A|-1)! |B|! / (|A|+|B|)!   to each feature of A and
 -v * |A|! (|B|-1)! / (|A|+|B|)!   to each feature of B.
Averaging over a background sample gives the interventional values;
they add up to f(x) - mean f(background) (tested).

So a leaf sees of a row, and of a reference, only m bits. The background of
a leaf is a table of the bit patterns that occur in it with their counts, and
what a row gets from a leaf depends on the row's pattern alone: it is worked
out once per pattern, for all 2**m patterns beforehand where m is small. A
row then costs its conditions and one look-up a leaf, not the references.

Spark runs it: the pattern tables (trees x leaves) ship to the tasks with the
function, and ``mapInPandas`` explains every input row, batch by batch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def export_trees(model) -> list[dict]:
    """Tree tables of a fitted GBTClassificationModel: per tree arrays of
    feature, threshold, left, right, leaf value; plus the tree weight."""
    from pyspark.sql import SparkSession

    from riskloom.sources.io import scratch_path

    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "gbt-model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("thr"),
    ).collect()
    weights = list(model.treeWeights)
    trees: dict[int, list] = {}
    for r in nodes:
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for t in sorted(trees):
        rows = sorted(trees[t], key=lambda r: r["id"])
        n = max(r["id"] for r in rows) + 1
        feat = np.full(n, -1, dtype=np.int64)
        thr = np.zeros(n)
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        val = np.zeros(n)
        for r in rows:
            i = r["id"]
            left[i], right[i], val[i] = r["left"], r["right"], r["prediction"]
            if r["left"] >= 0:
                feat[i] = r["feature"]
                thr[i] = r["thr"][0]
        out.append({"feat": feat, "thr": thr, "left": left, "right": right, "val": val, "w": float(weights[t])})
    return out

def _tree_predict(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf value for each row of x (rows x d). Spark goes left when x <= threshold."""
    node = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = tree["left"][node] >= 0
        if not inner.any():
            return tree["val"][node]
        f = tree["feat"][node[inner]]
        go_left = x[np.nonzero(inner)[0], f] <= tree["thr"][node[inner]]
        node[inner] = np.where(go_left, tree["left"][node[inner]], tree["right"][node[inner]])

def margin(trees: list[dict], x: np.ndarray) -> np.ndarray:
    return sum(t["w"] * _tree_predict(t, x) for t in trees)

# Leaves with at most this many features have all their patterns worked out beforehand.
TABLE_BITS = 8
MAX_DEPTH = 30  # of a Spark tree
_FACTORIAL = np.array([math.factorial(k) for k in range(MAX_DEPTH + 2)], dtype=float)


class Leaf(NamedTuple):
    """``path``: per distinct feature its (inner node, goes left) conditions; ``patterns``/``shares``: bits that the
    background meets and how often; ``table``: contributions per pattern of a row, if worked out."""

    value: float
    features: np.ndarray
    path: list[list[tuple[int, bool]]]
    patterns: np.ndarray
    shares: np.ndarray
    table: np.ndarray | None


def _bits_met(path: list[list[tuple[int, bool]]], left: np.ndarray) -> np.ndarray:
    """Per row the bits of the features whose conditions it meets; ``left`` (rows x nodes): goes left at a node."""
    out = np.zeros(len(left), np.int64)
    for bit, conditions in enumerate(path):
        met = np.ones(len(left), bool)
        for node, goes_left in conditions:
            met &= left[:, node] == goes_left
        out |= met.astype(np.int64) << bit
    return out


def _shares(value: float, m: int, rows: np.ndarray, patterns: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Contributions (row patterns x m features) of a leaf against the background's patterns."""
    full = (1 << m) - 1
    x, r = rows[:, None], patterns[None, :]
    in_, out = x & ~r, r & ~x
    a, b = np.bitwise_count(in_).astype(np.int64), np.bitwise_count(out).astype(np.int64)
    weight = np.where((x | r) == full, value * shares / _FACTORIAL[a + b], 0.0)
    gain = np.where(a > 0, _FACTORIAL[np.maximum(a - 1, 0)] * _FACTORIAL[b], 0.0) * weight
    loss = np.where(b > 0, _FACTORIAL[a] * _FACTORIAL[np.maximum(b - 1, 0)], 0.0) * weight
    bits = range(m)
    return np.stack([(gain * (in_ >> j & 1) - loss * (out >> j & 1)).sum(1) for j in bits], 1) if m else np.zeros((len(rows), 0))


def _left(tree: dict, x: np.ndarray) -> np.ndarray:
    return x[:, np.maximum(tree["feat"], 0)] <= tree["thr"]


def leaf_patterns(tree: dict, bg: np.ndarray) -> list[Leaf]:
    """The leaves of a tree with the background's patterns."""
    left, out = _left(tree, bg), []
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, path = stack.pop()
        if tree["left"][node] >= 0:
            f = int(tree["feat"][node])
            for goes_left, child in ((True, tree["left"][node]), (False, tree["right"][node])):
                stack.append((int(child), path | {f: [*path.get(f, []), (node, goes_left)]}))
            continue
        conditions, m = list(path.values()), len(path)
        patterns, counts = np.unique(_bits_met(conditions, left), return_counts=True)
        value, shares = float(tree["w"] * tree["val"][node]), counts / len(bg)
        table = _shares(value, m, np.arange(1 << m), patterns, shares) if m <= TABLE_BITS else None
        out.append(Leaf(value, np.array(list(path), np.int64), conditions, patterns, shares, table))
    return out


def shap_values(trees: list[dict], x: np.ndarray, leaves: list[list[Leaf]]) -> np.ndarray:
    """Interventional values (rows x d) on the margin scale; ``leaves`` per tree from :func:`leaf_patterns`."""
    phi = np.zeros(x.shape)
    for tree, held in zip(trees, leaves):
        left = _left(tree, x)
        for leaf in held:
            met = _bits_met(leaf.path, left)
            table = leaf.table
            if table is None:
                seen, met = np.unique(met, return_inverse=True)
                table = _shares(leaf.value, len(leaf.path), seen, leaf.patterns, leaf.shares)
            phi[:, leaf.features] += table[met]
    return phi


def tree_attribution(
    df: DataFrame, model, features: Sequence[str], key: str, background: DataFrame
) -> tuple[DataFrame, float]:
    """Long table (key, feature, value, contribution) for every row of ``df`` and
    the base value mean f(background). ``background`` must be a bounded sample
    (e.g. ``splits.sample_n(.., 200)``); it ships to every task."""
    trees = export_trees(model)
    feats = list(features)
    bg = np.array([[float(r[f]) if r[f] is not None else np.nan for f in feats] for r in background.select(*feats).collect()])
    base = float(margin(trees, bg).mean())
    leaves = [leaf_patterns(t, bg) for t in trees]

    def explain(it):
        import pandas as pd

        for pdf in it:
            if pdf.empty:
                continue
            x = pdf[feats].to_numpy(dtype=float)
            phi = shap_values(trees, x, leaves)
            n, d = phi.shape
            yield pd.DataFrame(
                {
                    key: np.repeat(pdf[key].to_numpy(), d),
                    "feature": np.tile(np.array(feats, dtype=object), n),
                    "value": x.ravel(),
                    "contribution": phi.ravel(),
                }
            )

    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, feature string, value double, contribution double"
    rows = df.select(key, *[F.col(f).cast("double").alias(f) for f in feats])
    return rows.mapInPandas(explain, schema), base
