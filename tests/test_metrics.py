import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics as M


def brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def brute_ks(s, y):
    P, N = sum(y), len(y) - sum(y)
    best = 0.0
    for t in sorted(set(s)):
        tp = sum(1 for a, b in zip(s, y) if a >= t and b == 1)
        fp = sum(1 for a, b in zip(s, y) if a >= t and b == 0)
        best = max(best, tp / P - fp / N)
    return best


def brute_ap(s, y):
    P = sum(y)
    ap = 0.0
    for t in sorted(set(s), reverse=True):
        pos_t = sum(1 for a, b in zip(s, y) if a == t and b == 1)
        tp = sum(1 for a, b in zip(s, y) if a >= t and b == 1)
        k = sum(1 for a in s if a >= t)
        ap += pos_t / P * tp / k
    return ap


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.normal(size=400) + 0.6 * y, 1)  # rounding creates ties
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int"), list(s), list(y)


def test_auc_ks_ap_against_brute_force(scores):
    df, s, y = scores
    r = M.evaluate_model(df, "s", "y").collect()[0]
    assert abs(r["auc"] - brute_auc(s, y)) < 1e-12
    assert abs(r["ks"] - brute_ks(s, y)) < 1e-12
    assert abs(r["avg_precision"] - brute_ap(s, y)) < 1e-12
    assert abs(r["gini"] - (2 * r["auc"] - 1)) < 1e-15


def test_auc_metamorphic(scores):
    df, s, y = scores
    a = M.auc_gini(df, "s", "y").collect()[0]["auc"]
    neg = M.auc_gini(df.withColumn("s", -F.col("s")), "s", "y").collect()[0]["auc"]
    mono = M.auc_gini(df.withColumn("s", F.exp(F.col("s")) * 3 + 1), "s", "y").collect()[0]["auc"]
    assert abs(a + neg - 1) < 1e-12 and abs(a - mono) < 1e-12


def test_grouped_auc_same_at_1_and_8_partitions(spark, scores):
    df, s, y = scores
    g = df.withColumn("k", (F.col("s") > 0).cast("int"))
    a = sorted(tuple(r) for r in M.auc_gini(g.repartition(1), "s", "y", ["k"]).collect())
    b = sorted(tuple(r) for r in M.auc_gini(g.repartition(8), "s", "y", ["k"]).collect())
    assert a == b


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert M.auc_gini(df, "s", "y").collect()[0]["auc"] is None


def test_brier_and_calibration(spark):
    df = spark.createDataFrame([(0.0, 0), (0.1, 0), (0.15, 1), (1.0, 1)], "s double, y int")
    assert abs(M.brier(df, "s", "y").collect()[0]["brier"] - (0 + 0.01 + 0.7225 + 0) / 4) < 1e-12
    bins = {r["bin"]: r["n"] for r in M.calibration_curve(df, "s", "y").collect()}
    assert bins == {0: 2, 1: 1, 9: 1}  # 0.1 is right-closed into bin 0
