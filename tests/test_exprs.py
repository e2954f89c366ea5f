import math

from pyspark.sql import functions as F

from riskloom.functions import exprs as X


def test_safe_div_and_clip_keep_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0), (None, 1.0)], "a double, b double")
    r = df.select(X.safe_div("a", "b").alias("q"), X.clip(X.safe_div("a", "b"), 0.0, 1.5).alias("c")).collect()
    assert r[0]["q"] is None and r[0]["c"] is None
    assert r[1]["q"] == 2.0 and r[1]["c"] == 1.5
    assert r[2]["q"] is None and r[2]["c"] is None


def test_row_stats_skip_null(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, None, None)], "a double, b double, c double")
    r = df.select(
        X.row_mean(["a", "b", "c"]).alias("m"), X.row_std(["a", "b", "c"]).alias("s"),
        X.row_sum(["a", "b", "c"]).alias("t"), X.row_prod(["a", "b", "c"]).alias("p"),
    ).collect()
    assert r[0]["m"] == 2.0 and math.isclose(r[0]["s"], math.sqrt(2.0))
    assert r[1]["m"] is None and r[1]["s"] is None and r[1]["t"] == 0.0 and r[1]["p"] == 1.0
    assert r[2]["s"] is None  # one value: sample std undefined


def test_bins_edges_and_ties(spark):
    edges = [0.0, 1.0, 2.0, 3.0]
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 9.0)], "x double")
    arr = F.array(*[F.lit(e) for e in edges])
    r = df.select(
        "x", X.bin_right(arr, "x", 4).alias("r"), X.bin_left(arr, "x", 4).alias("l"),
        X.bin_right_lit(edges, "x").alias("rl"), X.bin_left_lit(edges, "x").alias("ll"),
    ).collect()
    got = {row["x"]: (row["r"], row["l"]) for row in r}
    # right-closed (qcut): a value on an edge stays in the lower bin
    assert got[1.0][0] == 0 and got[1.5][0] == 1 and got[3.0][0] == 2 and got[-1.0][0] == 0
    # left-closed (histogram): a value on an edge goes to the upper bin
    assert got[1.0][1] == 1 and got[0.0][1] == 0 and got[9.0][1] == 2
    assert all(row["r"] == row["rl"] and row["l"] == row["ll"] for row in r)


def test_single_edge_gives_one_bin(spark):
    df = spark.createDataFrame([(5.0,), (7.0,)], "x double")
    arr = F.array(F.lit(5.0))
    assert {r[0] for r in df.select(X.bin_right(arr, "x", 4)).collect()} == {0}
