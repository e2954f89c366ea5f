import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import explain as XP
from riskloom.operators import models as MD
from riskloom.operators import splits as SP


def test_tree_attribution_additivity(spark):
    rng = np.random.default_rng(21)
    n = 400
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(scale=0.5, size=n) > 0).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int")
    feats = ["a", "b", "c", "d"]
    m = MD.gbt("xgboost", n_trees=5).setMinInstancesPerNode(5).fit(MD._prep(df, feats, "y", "xgboost"))
    bg = SP.sample_n(df, "id", 30)
    contrib, base = XP.tree_attribution(df.where(F.col("id") < 40), m, feats, "id", bg)
    phi = contrib.groupBy("id").agg(F.sum("contribution").alias("s")).toPandas().set_index("id")["s"]
    trees = XP.export_trees(m)
    xm = df.where(F.col("id") < 40).orderBy("id").select(*feats).toPandas().to_numpy()
    margins = XP.margin(trees, xm)
    # sum of contributions + base = model margin (the raw prediction of Spark)
    assert np.allclose(phi.sort_index().to_numpy() + base, margins, atol=1e-9)
    spark_margin = [r[0] for r in MD.predict_pd(m, df.where(F.col("id") < 40).orderBy("id"), feats)
                    .select(F.log(F.col("pd_raw") / (1 - F.col("pd_raw"))) / 2).collect()]
    assert np.allclose(margins, spark_margin, atol=1e-6)


def random_tree(rng, depth, d):
    """A complete tree in which features recur on a path."""
    inner, n = 2**depth - 1, 2 ** (depth + 1) - 1
    feat = np.full(n, -1)
    feat[:inner] = rng.integers(0, d, inner)
    left, right = np.full(n, -1), np.full(n, -1)
    left[:inner], right[:inner] = 2 * np.arange(inner) + 1, 2 * np.arange(inner) + 2
    return {"feat": feat, "thr": rng.normal(size=n), "left": left, "right": right, "val": rng.normal(size=n), "w": float(rng.random())}


def by_subsets(trees, x, bg):
    """Shapley values of v(S) = mean over references of f(x_S, r_rest), over all subsets."""
    d = x.shape[1]
    out = np.zeros(x.shape)
    for i, row in enumerate(x):
        v = {}
        for size in range(d + 1):
            for s in combinations(range(d), size):
                mixed = bg.copy()
                mixed[:, list(s)] = row[list(s)]
                v[s] = XP.margin(trees, mixed).mean()
        for j in range(d):
            for s in v:
                if j not in s:
                    w = math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d)
                    out[i, j] += w * (v[tuple(sorted((*s, j)))] - v[s])
    return out


@pytest.mark.parametrize("table_bits", [8, 2])
def test_pattern_tables_equal_all_subsets(monkeypatch, table_bits):
    """Also where patterns are worked out per batch; NaN goes right everywhere."""
    monkeypatch.setattr(XP, "TABLE_BITS", table_bits)
    rng = np.random.default_rng(6)
    trees = [random_tree(rng, k, 5) for k in (0, 1, 3, 5)]
    x, bg = rng.normal(size=(12, 5)), rng.normal(size=(9, 5))
    x[3, 2] = bg[1, 0] = np.nan
    got = XP.shap_values(trees, x, [XP.leaf_patterns(t, bg) for t in trees])
    assert np.allclose(got, by_subsets(trees, x, bg), atol=1e-12)


def test_deep_paths_with_many_features():
    rng = np.random.default_rng(7)
    depth, d = 20, 40
    n = 2 * depth + 1  # a chain: every inner node has a leaf on its left
    tree = {"feat": np.full(n, -1), "thr": rng.normal(size=n), "left": np.full(n, -1), "right": np.full(n, -1), "val": rng.normal(size=n), "w": 1.0}
    for k in range(depth):
        tree["feat"][2 * k], tree["left"][2 * k], tree["right"][2 * k] = rng.integers(0, d), 2 * k + 1, 2 * k + 2
    x, bg = rng.normal(size=(50, d)), rng.normal(size=(30, d))
    phi = XP.shap_values([tree], x, [XP.leaf_patterns(tree, bg)])
    assert np.allclose(phi.sum(1) + XP.margin([tree], bg).mean(), XP.margin([tree], x))
