"""Values at ranks: equal to NumPy on hard shapes, and no row-sized shuffle or written table."""

import math

import numpy as np
import pytest

from riskloom.operators import binning as B
from riskloom.operators import quantiles as Q
from riskloom.operators import splits as S
from riskloom.session import scratch_root
from riskloom.sources import fixtures as fx

from conftest import SF001

SHAPES = {
    "normal": lambda r: r.normal(size=5000),
    "heavy_tail": lambda r: np.exp(r.normal(scale=12, size=5000)),
    "hot_value": lambda r: np.where(r.random(5000) < 0.7, 3.0, r.normal(size=5000)),
    "wide": lambda r: r.choice([-1.7e308, 1.7e308, 0.0, 1e-300], size=5000),
    "constant": lambda r: np.full(5000, 2.5),
    "one": lambda r: np.array([4.0]),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_quantiles_equal_numpy(spark, shape, monkeypatch):
    monkeypatch.setattr(Q, "FIRST_BINS", 16)
    monkeypatch.setattr(Q, "NEXT_BINS", 4)
    monkeypatch.setattr(Q, "LEAF_ROWS", 20)
    x = SHAPES[shape](np.random.default_rng(3))
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("a", None), ("none", None)], "f string, x double")
    probs = [0, 0.1, 0.25, 0.5, 0.9, 0.999, 1]
    got = Q.quantiles(df, "f", "x", probs)
    assert set(got) == {"a"}
    s = np.sort(x)
    for p, v in zip(probs, got["a"]):
        at = (len(s) - 1) * p
        lo, hi = s[math.floor(at)], s[math.ceil(at)]
        assert v == (lo if lo == hi or at == math.floor(at) else lo + (hi - lo) * (at - math.floor(at)))


def test_infinite_and_nan_values_keep_their_places(spark):
    x = [float("-inf"), 1.0, 2.0, 3.0, float("inf"), float("nan")]
    df = spark.createDataFrame([(None, v) for v in x], "f string, x double")
    got = Q.quantiles(df, "f", "x", [0, 0.2, 0.4, 0.6, 0.8, 1])[None]
    assert got[:5] == x[:5] and math.isnan(got[5])


def test_empty_table(spark):
    assert Q.quantiles(spark.createDataFrame([], "f string, x double"), "f", "x", [0.5]) == {}


def test_split_equals_ranked_split(spark):
    df = spark.range(3000).selectExpr("id AS key", "CASE WHEN id % 7 = 0 THEN NULL ELSE cast(id % 3 = 0 AS int) END AS y")
    n = {r["y"]: r["n"] for r in df.groupBy("y").count().withColumnRenamed("count", "n").collect()}
    ranked = {r["key"]: r for r in S.hash_rank(df, "key", "y").collect()}
    got = S.stratified_split(df, "key", "y", oot=0.1, test=0.25).collect()
    assert len(got) == 3000
    for r in got:
        oot = math.floor(0.1 * n[r["y"]] + 0.5)  # SQL's round: halves go up
        test = oot + math.floor(0.25 * (n[r["y"]] - oot) + 0.5)
        rank = ranked[r["key"]]["_rank"]
        assert r["split"] == ("oot" if rank <= oot else "test" if rank <= test else "train")


@pytest.mark.parametrize("name", ["woe_table", "psi_report", "quantile_bins", "stratified_split"])
def test_values_are_neither_written_nor_shuffled(spark, name, tmp_path):
    import __spark_entry__ as E

    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    before = fs.getContentSummary(root).getLength() if fs.exists(root) else 0
    df = E.queries()[name](spark, SF001)
    df.collect()
    assert (fs.getContentSummary(root).getLength() if fs.exists(root) else 0) == before
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ", x#" not in " ".join(line for line in plan.splitlines() if "hashpartitioning" in line)
    if name == "stratified_split":
        assert "hashpartitioning" not in plan and "Sort " not in plan


def test_feature_without_expected_values_is_reported(spark):
    df = spark.createDataFrame([("expected", 1.0, None), ("actual", 1.0, 2.0)], "part string, x double, z double")
    r = {row["feature"]: row for row in B.psi_report(df, ["x", "z"]).collect()}
    assert r["z"]["n_bins"] == 0 and r["z"]["psi"] is None and r["z"]["status"] is None
    assert r["x"]["psi"] == 0.0


def test_li_risk_edges_match_numpy(spark):
    df = fx.li_risk(spark, SF001)
    x = np.array([r[0] for r in df.where("l_extendedprice IS NOT NULL").select("l_extendedprice").collect()], dtype=float)
    e = B.quantile_edges(df, ["l_extendedprice"], q=10).collect()[0]["edges"]
    assert np.allclose(e, np.quantile(x, B.qcut_probs(10)), rtol=1e-15)
