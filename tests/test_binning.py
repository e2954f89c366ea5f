import math

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import binning as B


def test_woe_pct_sums_and_iv_nonnegative(spark):
    rng = np.random.default_rng(5)
    rows = [(float(x), int(y), float(z)) for x, y, z in zip(rng.normal(size=2000), rng.integers(0, 2, 2000), rng.integers(0, 4, 2000))]
    df = spark.createDataFrame(rows, "x double, y int, z double")
    w = B.woe_table(df, ["x", "z"], "y").toPandas()
    for f, g in w.groupby("feature"):
        assert math.isclose(g["n_events"].sum() / g["n_events"].sum(), 1.0)
        assert math.isclose((g["n_events"] / g["n_events"].sum()).sum(), 1.0)
        assert (g["iv"] >= -1e-15).all()
    assert set(w[w.feature == "z"]["kind"]) == {"value"}  # 4 values -> one bin each
    assert w[w.feature == "x"]["bin"].nunique() == 10


def test_one_class_feature_skipped_with_iv_zero(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(30)], "x double, y int")
    w = B.woe_table(df, ["x"], "y")
    assert w.count() == 0
    iv = B.iv_table(w, ["x"]).collect()[0]
    assert iv["iv"] == 0.0 and iv["n_bins"] == 0 and iv["flag"] == "DROP (low IV)"


def test_empty_bin_floor(spark):
    # all events in the top values -> lower bins have no events -> floored pct
    rows = [(float(i), 1 if i >= 90 else 0) for i in range(100)]
    w = B.woe_table(spark.createDataFrame(rows, "x double, y int"), ["x"], "y").orderBy("bin").collect()
    assert w[0]["pct_events"] == 1e-9 and w[0]["woe"] < -10


def test_psi_identity_and_binary(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=1000)
    rows = [("expected", float(v), int(b)) for v, b in zip(x, rng.random(1000) < 0.07)]
    rows += [("actual", float(v), int(b)) for v, b in zip(x, rng.random(1000) < 0.07)]
    df = spark.createDataFrame(rows, "part string, x double, b int")
    r = {row["feature"]: row["psi"] for row in B.psi_report(df, ["x", "b"]).collect()}
    assert r["x"] == 0.0  # same sample on both sides
    assert r["b"] == 0.0  # rare binary -> one bin after edge dedup


def test_psi_nonnegative_on_shift(spark):
    rng = np.random.default_rng(2)
    rows = [("expected", float(v)) for v in rng.normal(size=800)] + [("actual", float(v)) for v in rng.normal(0.5, 1, 800)]
    df = spark.createDataFrame(rows, "part string, x double")
    t = B.psi_table(df, ["x"]).toPandas()
    assert (t["psi_bin"] >= 0).all() and t["psi_bin"].sum() > 0.1
    assert math.isclose(t["exp_pct"].sum(), 1.0, rel_tol=1e-9)


def test_woe_transform_unseen_and_null(spark):
    df = spark.createDataFrame([(float(i % 5), i % 2) for i in range(100)], "x double, y int")
    m = B.WoEModel.fit(df, ["x"], "y")
    new = spark.createDataFrame([(2.0,), (None,), (42.0,)], "x double")
    out = [r[0] for r in m.transform(new, ["x"]).select("WOE_x").collect()]
    assert out[1] == 0.0  # NULL -> neutral
    assert out[2] == 0.0  # a value never seen in a one-bin-per-value feature -> its own bin index, unseen -> 0
    _ = F


def test_string_categories(spark):
    rows = [(c, i % 3, int(i % 3 == 0 or c == "b")) for i, c in enumerate(["a"] * 40 + ["b"] * 30 + ["c"] * 20 + [None] * 5)]
    df = spark.createDataFrame(rows, "c string, z int, y int")
    w = {(r["feature"], r["label"]): r for r in B.labelled_woe_table(df, ["c", "z"], "y").collect()}
    assert {k for k in w if k[0] == "c"} == {("c", v) for v in "abc"} and w["c", "b"]["n_nonevents"] == 0
    assert w["c", "a"]["kind"] == "category" and w["c", "a"]["bin_lo"] is None and w["z", "1"]["kind"] == "value"
    a = sum(y for c, _, y in rows if c == "a")
    total = sum(y for c, _, y in rows if c)
    assert w["c", "a"]["woe"] == math.log((a / total) / ((40 - a) / (90 - total)))
    m = B.WoEModel.fit(df, ["c"], "y")
    out = m.transform(spark.createDataFrame([("a",), ("zz",), (None,), ("",)], "c string")).select("WOE_c").collect()
    assert out[0][0] == w["c", "a"]["woe"] and [r[0] for r in out[1:]] == [0.0, 0.0, 0.0]


def test_many_categories_share_a_bin(spark):
    rows = [(f"v{k:02d}", (k + j) % 2) for k in range(30) for j in range(3 + (k == 7) * 5)]
    df = spark.createDataFrame(rows, "c string, y int")
    edges, _ = B.fit_bins(df, ["c"], "y", n_bins=4)
    assert edges["c"] == ("top", ["v00", "v01", "v07"])  # the largest, then ties by text
    w = {r["label"]: r["n_total"] for r in B.labelled_woe_table(df, ["c"], "y", n_bins=4).collect()}
    assert w == {"v00": 3, "v01": 3, "v07": 8, B.OTHERS: len(rows) - 14}
    m = B.WoEModel.fit(df, ["c"], "y", n_bins=4)
    got = m.transform(spark.createDataFrame([("never",), ("v20",), (None,)], "c string")).collect()
    assert got[0]["WOE_c"] == got[1]["WOE_c"] == m.woe["c"][3]
    assert got[2]["WOE_c"] == 0.0


def test_approximate_distinct_count_does_not_decide(spark):
    """Features near the limit get value bins by their exact count."""
    for n in (9, 10, 11, 12, 40, 41):
        df = spark.createDataFrame([(float(i % n), i % 2) for i in range(40 * n)], "x double, y int")
        kind, edges = B.fit_bins(df, ["x"], "y")[0]["x"]
        assert (kind == "value") == (n <= 10) and (kind != "value" or len(edges) == n)


def test_empty_category_column(spark):
    df = spark.createDataFrame([(None, 0), (None, 1)], "c string, y int")
    assert B.woe_table(df, ["c"], "y").count() == 0
    assert B.WoEModel.fit(df, ["c"], "y").transform(df, ["c"]).first()["WOE_c"] == 0.0
