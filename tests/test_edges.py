"""Edge frames: +-inf, constant/two-valued features, small and one-class groups,
short periods, zero denominators, fit on train / transform elsewhere."""

import math

from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators import cleaning as C
from riskloom.operators import features as fe
from riskloom.operators import governance as G


def test_inf_to_fitted_median(spark):
    rows = [(1.0, 5.0), (float("inf"), 6.0), (3.0, None), (float("-inf"), 8.0), (5.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    m = C.InfMedianImputer.fit(df, ["a", "b"])
    assert m.medians == {"a": 3.0, "b": 7.0}
    new = spark.createDataFrame([(float("inf"), None)], "a double, b double")
    r = m.transform(new, ["a", "b"]).collect()[0]
    assert r["a"] == 3.0 and r["b"] == 7.0
    # a column without NULLs in train falls back to 0.0
    m2 = C.InfMedianImputer.fit(spark.createDataFrame([(1.0,), (2.0,)], "a double"), ["a"])
    assert m2.transform(spark.createDataFrame([(None,)], "a double"), ["a"]).collect()[0]["a"] == 0.0


def test_constant_and_two_valued_features(spark):
    rows = [(7.0, float(i % 2), i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "c double, t double, yb boolean").withColumn("y", F.col("yb").cast("int"))
    w = {(r["feature"], r["bin"]): r for r in B.woe_table(df, ["c", "t"], "y").collect()}
    assert sorted(k for k in w if k[0] == "c") == [("c", 0)]  # one value -> one bin
    assert sorted(k for k in w if k[0] == "t") == [("t", 0), ("t", 1)]
    assert w[("c", 0)]["iv"] == 0.0
    import numpy as np

    e = {r["feature"]: r["edges"] for r in B.quantile_edges(df, ["c", "t"]).collect()}
    t = np.array([float(i % 2) for i in range(60)])
    ref = sorted(set(np.quantile(t, B.qcut_probs(10)).tolist()))
    assert e["c"] == [7.0] and np.allclose(e["t"], ref)


def test_ties_across_qcut_edge(spark):
    # 30 copies of 5.0 straddle several quantile edges: all land in one right-closed bin
    rows = [(float(v), v % 2) for v in range(20)] + [(5.0, 1)] * 30
    df = spark.createDataFrame(rows, "x double, y int")
    w = B.woe_table(df, ["x"], "y").collect()
    fives = [r for r in w if r["bin_lo"] <= 5.0 <= r["bin_hi"]]
    assert len(fives) == 1 and fives[0]["n_total"] >= 31


def test_bias_audit_drops_small_and_one_class_groups(spark):
    rows = [(i / 300.0, i % 2, "big") for i in range(300)]
    rows += [(0.5, i % 2, "small") for i in range(50)]        # < 100 rows
    rows += [(i / 200.0, 1, "oneclass") for i in range(200)]  # one class
    df = spark.createDataFrame(rows, "p double, y int, g string")
    vals = {r["group_val"] for r in G.bias_audit(df, "p", "y", ["g"]).collect()}
    assert vals == {"All", "big"}


def test_gini_stability_skips_short_period(spark):
    rows = [(1, float(i % 7), i % 2) for i in range(200)] + [(2, float(i), i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "wk int, s double, y int")
    g = G.gini_stability(df, "s", "y", time_col="wk").collect()
    assert [r["period"] for r in g] == [1]


def test_zero_denominators_give_null_then_fill(spark):
    df = spark.createDataFrame(
        [(0.0,) + (100.0,) * 6 + (0.0,) * 6 + (0,) * 6], "limit_bal double, " + ", ".join(
            [f"bill_amt{k} double" for k in range(1, 7)] + [f"pay_amt{k} double" for k in range(1, 7)]
            + [f"pay_{k} int" for k in range(1, 7)]))
    r = fe.statement_features(df).collect()[0]
    assert r["util_1"] is None and r["util_mean"] is None       # limit 0
    assert r["balance_to_limit"] == 0.0 and r["balance_growth_rate"] == 0.0
    assert r["pay_ratio_1"] == 0.0 and r["months_paid_zero"] == 6
    assert math.isclose(r["limit_to_avg_bill"], 0.0)


def test_pipeline_fit_on_train_transform_elsewhere(spark):
    cols = "id long, y int, limit_bal double, " + ", ".join(
        [f"bill_amt{k} double" for k in range(1, 7)] + [f"pay_amt{k} double" for k in range(1, 7)]
        + [f"pay_{k} int" for k in range(1, 7)])
    train = spark.createDataFrame(
        [(i, i % 2, 0.0 if i == 0 else 1000.0 + i) + (float(100 * i),) * 6 + (10.0,) * 6 + (0,) * 6 for i in range(10)], cols)
    pipe = fe.StatementPipeline().fit(train)
    assert "util_mean" in pipe.imputer.medians  # NULL in train (limit 0) -> stored median
    test = spark.createDataFrame([(99, 1, 0.0) + (5.0,) * 6 + (1.0,) * 6 + (1,) * 6], cols)
    out = pipe.transform(test).collect()[0]
    assert out["util_mean"] == pipe.imputer.medians["util_mean"]
    assert "pay_1" not in pipe.features and "pay_2" not in pipe.features
