import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import governance as G
from riskloom.operators.subgroups import _Vector, subgroup_auc


def plain(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    if not pos or not neg:
        return len(pos), len(neg), None
    key = lambda s: (math.isnan(s), 0 if math.isnan(s) else s)
    wins = sum((key(p) > key(n)) + 0.5 * (key(p) == key(n)) for p in pos for n in neg)
    return len(pos), len(neg), wins / len(pos) / len(neg)


@pytest.mark.parametrize("digits, batch", [(1, 10_000), (1, 3), (6, 7)])
def test_matches_all_pairs(spark, digits, batch):
    """Ties within and across batches, null group values, NaN scores, rows left out."""
    rng = np.random.default_rng(digits + batch)
    rows = [
        (float(s) if s < 1.5 else float("nan"), int(y), str(a) if a else None, int(b))
        for s, y, a, b in zip(rng.normal(size=700).round(digits), rng.integers(0, 2, 700), rng.integers(0, 3, 700), rng.integers(0, 40, 700))
    ]
    rows += [(None, 1, "1", 2), (0.5, None, "1", 2), (0.3, 1, "only", 77)]
    df = spark.createDataFrame(rows, "sc double, t int, a string, b int").repartition(5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        got = {(r[0], r[1]): tuple(r)[2:] for r in subgroup_auc(df, "sc", "t", ["a", "b"]).collect()}
    finally:
        spark.conf.set(key, old)
    used = [r for r in rows if r[0] is not None and r[1] is not None]
    want = {("OVERALL", "All"): plain([r[:2] for r in used])}
    for c, i in (("a", 2), ("b", 3)):
        for v in {r[i] for r in used}:
            want[c, None if v is None else str(v)] = plain([r[:2] for r in used if r[i] == v])
    assert set(got) == set(want)
    for k, (p, n, auc) in want.items():
        assert got[k][:2] == (p, n) and (got[k][2] is None if auc is None else math.isclose(got[k][2], auc, rel_tol=1e-12))


def test_a_hot_score_and_a_hot_group(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3)).alias("s"), (F.col("id") % 2).alias("y"),
        F.when(F.col("id") % 5 == 0, F.col("id") % 7).alias("g"),
    )
    rows = df.toPandas()
    got = {(r[0], r[1]): r[4] for r in subgroup_auc(df, "s", "y", ["g"]).collect()}
    order = rows["s"].rank()
    for v, part in [("All", rows), *((str(int(v)), rows[rows.g == v]) for v in range(7))]:
        rank, p = (order if v == "All" else part["s"].rank()), part["y"].sum()
        want = (rank[part["y"] == 1].sum() - p * (p + 1) / 2) / (p * (len(part) - p))
        assert math.isclose(got["OVERALL" if v == "All" else "g", v], want, rel_tol=1e-12)


def test_rows_are_not_copied_per_group_column(spark):
    df = spark.range(100).selectExpr("rand() AS s", "id % 2 AS y", "id % 3 AS a", "id % 4 AS b", "id % 5 AS c")
    plan = subgroup_auc(df, "s", "y", ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan and "Union" not in plan and plan.count("rangepartitioning") == 1


def test_no_rows(spark):
    df = spark.createDataFrame([], "s double, y int, g string")
    assert subgroup_auc(df, "s", "y", ["g"]).collect() == []
    assert [tuple(r) for r in G.bias_audit(df, "s", "y", ["g"]).collect()] == [("OVERALL", "All", None, None, None, None, 0.0)]
    assert G.gini_stability(df.withColumn("t", F.lit(1)), "s", "y", time_col="t").collect() == []


def test_sums_beyond_32_bits():
    v = _Vector()
    code, run = v.encode(__import__("pyarrow").array(["x", "x"])), np.array([0, 1])
    v.add(code, run, np.array([0, 4 * 10**9]), np.array([4 * 10**9, 0]))
    assert v.num[0] == 1.6e19
