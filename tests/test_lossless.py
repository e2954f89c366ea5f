"""Rows that a size switch or a join on NULL keys could lose; large counts; constant columns; unseen values."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import cleaning as C
from riskloom.operators import selection as SL
from riskloom.operators.metrics import _auc_expr
from riskloom.operators.ordered import prefix_sums
from riskloom.operators.splits import stratified_kfold, stratified_split
from riskloom.sources.io import cached_clean


@pytest.mark.parametrize("keys", [["g"], []])
def test_bucketed_path_keeps_null_keys_null_and_nan_values(spark, keys):
    vals = [None, float("nan"), *[float(i % 50) / 3 for i in range(50)]]
    rows = [(g, v, 1) for g in ([None, 1, 2] if keys else [0]) for v in vals]
    df = spark.createDataFrame(rows, "g int, v double, w int")
    a, b = (sorted(map(repr, prefix_sums(df, keys, ["v"], ["w"], bucket_rows=n).select("g", "v", "w_cum").collect())) for n in (10**9, 2))
    assert a == b and len(a) == len(rows)


def test_more_buckets_than_a_level_holds(spark, monkeypatch):
    from riskloom.operators import ordered as O

    monkeypatch.setattr(O, "LEVEL_BUCKETS", 4)
    df = spark.range(400).select(F.lit(1).alias("g"), F.col("id").alias("v"), F.lit(1).alias("w"))
    out = prefix_sums(df, ["g"], ["v"], ["w"], bucket_rows=5).collect()
    assert sorted((r["v"], r["w_cum"]) for r in out) == [(i, i + 1) for i in range(400)]


def test_splits_keep_rows_without_label(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(100)], "id int, y int")
    assert stratified_split(df, "id").count() == 100
    assert stratified_kfold(df, "id").count() == 100


def test_auc_of_billions_does_not_overflow(spark):
    n = 4_000_000_000
    t = spark.createDataFrame([(0.2, 0, n, 0, n, n, n), (0.8, n, 0, n, n, n, n)], "s double, pos long, neg long, pos_cum long, neg_cum long, P long, N long")
    assert t.agg(_auc_expr().alias("a")).first()["a"] == 1.0


def test_correlation_with_offset_and_constant_column(spark):
    df = spark.range(1000).select(
        (F.lit(1e9) + F.sin("id")).alias("a"), (F.lit(1e9) + F.sin("id") + 0.1 * F.cos(F.col("id") * 7)).alias("b"), F.lit(5.0).alias("k"), (F.col("id") % 2).alias("y")
    )
    r = {(x["f1"], x["f2"]): x["r"] for x in SL.corr_matrix(df, ["a", "b", "k"]).collect()}
    assert 0.98 < r["a", "b"] < 1 and r["a", "k"] is None
    assert {x["feature"]: x["target_corr"] for x in SL.target_corr(df, ["a", "k"]).collect()}["k"] is None


def test_null_category_and_day_count_give_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 365243.0)], "c string, DAYS_EMPLOYED double")
    assert [r["c_b"] for r in C.one_hot_low_card(df).orderBy("DAYS_EMPLOYED").collect()] == [1, 0, 0]
    assert sorted(r["DAYS_EMPLOYED_PENSIONER"] for r in C.sentinel_flag(df).collect()) == [0, 0, 1]


def test_bad_target_text_fails(spark):
    df = spark.createDataFrame([("1",), ("x",)], "t string")
    with pytest.raises(Exception, match="not a number"):
        C.cast_target(df, "t").collect()


def test_damaged_cache_is_not_overwritten(spark, tmp_path):
    source, root = str(tmp_path / "src"), tmp_path / "cache"
    spark.range(3).write.parquet(source)
    cached_clean(spark, str(root), [source], "1", lambda: spark.range(3))
    parts = [f for f in next(root.glob("data-*")).iterdir() if f.suffix == ".parquet"]
    for f in parts:
        f.write_bytes(b"damaged")
    with pytest.raises(Exception):
        cached_clean(spark, str(root), [source], "1", lambda: spark.range(3)).collect()
    assert all(f.read_bytes() == b"damaged" for f in parts)
