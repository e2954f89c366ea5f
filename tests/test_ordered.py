import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators.ordered import exact_quantiles, group_stats, prefix_sums


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    rows = [(int(g), float(v), int(w)) for g, v, w in zip(rng.integers(0, 3, 3000), rng.normal(size=3000).round(2), rng.integers(1, 4, 3000))]
    return spark.createDataFrame(rows, "g int, v double, w int")


def test_bucketed_prefix_equals_plain_window(spark, data):
    coll = data.groupBy("g", "v").agg(F.sum("w").alias("w"))
    plain = prefix_sums(coll, ["g"], ["v"], ["w"], bucket_rows=10**9)
    buck = prefix_sums(coll, ["g"], ["v"], ["w"], bucket_rows=50)  # forces ~20 buckets per group
    a = sorted(tuple(r) for r in plain.select("g", "v", "w_cum").collect())
    b = sorted(tuple(r) for r in buck.select("g", "v", "w_cum").collect())
    assert a == b
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ref = sorted(tuple(r) for r in coll.select("g", "v", F.sum("w").over(w).alias("c")).collect())
    assert a == ref


def test_bucketed_prefix_without_keys(spark, data):
    coll = data.groupBy("v").agg(F.sum("w").alias("w"))
    a = sorted(tuple(r) for r in prefix_sums(coll, [], ["v"], ["w"], bucket_rows=10**9).select("v", "w_cum").collect())
    b = sorted(tuple(r) for r in prefix_sums(coll, [], ["v"], ["w"], bucket_rows=40).select("v", "w_cum").collect())
    assert a == b


@pytest.mark.parametrize("bucket_rows", [10**9, 60])
def test_exact_quantiles_match_numpy(spark, data, bucket_rows):
    probs = [i / 10 for i in range(11)]
    got = {r["g"]: r["edges"] for r in exact_quantiles(data, ["g"], "v", probs, bucket_rows=bucket_rows).collect()}
    pdf = data.toPandas()
    for g, sub in pdf.groupby("g"):
        ref = np.percentile(sub["v"].to_numpy(), [p * 100 for p in probs])
        assert np.allclose(got[g], ref, atol=1e-12)


def test_weighted_quantiles_equal_expanded(spark, data):
    probs = [0.1, 0.5, 0.9]
    coll = data.groupBy("v").agg(F.sum("w").alias("n"))
    a = exact_quantiles(coll, [], "v", probs, weight="n").collect()[0]["edges"]
    expanded = np.repeat(data.toPandas()["v"].to_numpy(), data.toPandas()["w"].to_numpy())
    assert np.allclose(a, np.percentile(expanded, [10, 50, 90]))


def test_group_stats(spark, data):
    g = group_stats(data, ["g"], top=F.max("v"))
    rows = {r["g"]: r for r in g.table.collect()}
    assert sum(r["_rows"] for r in rows.values()) == g.total == 3000
    assert g.n_groups == len(rows) == 3 and g.max_rows == max(r["_rows"] for r in rows.values())
    assert max(r["top"] for r in rows.values()) == data.agg(F.max("v")).first()[0]


def test_equal_width_parallel_path_equals_plain(spark, data, monkeypatch):
    from riskloom.operators import ordered as O

    coll = data.groupBy("g", "v").agg(F.sum("w").alias("w"))
    groups = O.group_stats(coll, ["g"], _min=F.min("v"), _max=F.max("v"))
    plain = sorted(tuple(r) for r in O.prefix_sums(coll, ["g"], ["v"], ["w"], groups=groups).select("g", "v", "w_cum").collect())
    monkeypatch.setattr(O, "PARALLEL_MIN_ROWS", 1)
    par = sorted(tuple(r) for r in O.prefix_sums(coll, ["g"], ["v"], ["w"], groups=groups).select("g", "v", "w_cum").collect())
    assert plain == par


def test_two_million_groups(spark):
    """Keyed sums and quantiles keep nothing per group on the driver."""
    df = spark.range(0, 4_000_000, 1, 8).select((F.col("id") % 2_000_000).alias("g"), F.floor(F.col("id") / 2_000_000).alias("v"), F.lit(1).alias("w"))
    out = prefix_sums(df, ["g"], ["v"], ["w"]).agg(F.count("*").alias("n"), F.sum("w_cum").alias("s"), F.max("w_cum").alias("m")).first()
    assert tuple(out) == (4_000_000, 6_000_000, 2)
    q = exact_quantiles(df, ["g"], "v", [0.5]).agg(F.count("*").alias("n"), F.min(F.get("edges", F.lit(0))).alias("a"), F.max(F.get("edges", F.lit(0))).alias("b"))
    assert tuple(q.first()) == (2_000_000, 0.5, 0.5)


@pytest.mark.parametrize("bucket_rows", [10**9, 40])
def test_one_large_group_among_small_and_null_ones(spark, bucket_rows):
    rows = [(1, float(i % 700), 1) for i in range(700)] + [(g, float(i), 2) for g in (None, *range(2, 30)) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, v double, w int")
    got = sorted(((r["g"] is None, r["g"], r["v"], r["w_cum"]) for r in prefix_sums(df, ["g"], ["v"], ["w"], bucket_rows=bucket_rows).collect()), key=repr)
    want = [(False, 1, float(i), i + 1) for i in range(700)]
    want += [(g is None, g, float(i), 2 * (i + 1)) for g in (None, *range(2, 30)) for i in range(3)]
    assert got == sorted(want, key=repr)
    q = {r["g"]: r["edges"] for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0], bucket_rows=bucket_rows).collect()}
    assert q[1] == [0.0, 349.5, 699.0] and q[None] == q[29] == [0.0, 1.0, 2.0] and len(q) == 30


def test_quantiles_of_infinite_and_nan_values(spark):
    inf = float("inf")
    vals = [-inf, 1.0, 2.0, 3.0, inf, float("nan")]
    df = spark.createDataFrame([(0, v) for v in vals] + [(1, None), (2, 5.0)], "g int, v double")
    q = {r["g"]: r["edges"] for r in exact_quantiles(df, ["g"], "v", [0.0, 0.4, 0.8]).collect()}
    assert q == {0: [-inf, 2.0, inf], 2: [5.0, 5.0, 5.0]}
