"""Steps of the workflow that must be spread over all cores, and fits over counted rows."""

import hashlib
import math
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.operators import scorecard as SC
from riskloom.operators import splits as SP
from riskloom.operators.cleaning import ensure_id
from riskloom.operators.scaling import fit_standard
from riskloom.sources import io


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_are_ranked_by_value_ranges(spark):
    df = spark.range(30_000).select((F.col("id") * 7 - 1000).alias("k"), (F.col("id") % 3).alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 9)], "k long, v long"))
    out = ensure_id(df, ["k"])
    assert "hashpartitioning(_bucket" in plan(out)  # not all rows in one window task
    rows = out.orderBy("ID").collect()
    assert [r["ID"] for r in rows] == list(range(1, 30_002))
    assert rows[0]["k"] is None and [r["k"] for r in rows[1:]] == [i * 7 - 1000 for i in range(30_000)]


def test_clean_table_and_folds_are_written_once(spark):
    clean = io.load_dataset(spark, "uci", SF001, 100)
    assert "Window" not in plan(clean) and "Exchange" not in plan(clean)
    f = MD.fold_table(clean, ["AGE", "LIMIT_BAL"], "default_payment_next_month", "ID", 5)
    assert "Window" not in plan(f) and "Exchange" not in plan(f)
    want = SP.stratified_kfold(clean, "ID", "default_payment_next_month", 5).groupBy("fold").count().collect()
    assert sorted(f.groupBy("fold").count().collect()) == sorted(want)


def test_ranks_are_exact_in_ranges_of_the_hash(spark):
    df = spark.range(25_000).select("id", F.when(F.col("id") % 10 > 0, F.lit(0)).when(F.col("id") % 20 > 0, F.lit(1)).alias("y"))
    out = SP.hash_rank(df, "id", "y")
    assert "hashpartitioning(y" in plan(out) and "_bucket" in plan(out)
    got = {}
    for r in out.collect():
        got.setdefault(r["y"], []).append((r["_rank"], r["_h"], r["_n"]))
    assert sum(map(len, got.values())) == 25_000
    for rows in got.values():
        assert [r[0] for r in sorted(rows)] == list(range(1, len(rows) + 1)) and {r[2] for r in rows} == {len(rows)}
        assert [r[1] for r in sorted(rows)] == sorted(r[1] for r in rows)


def test_fit_over_counted_rows_is_the_fit_over_all_rows(spark):
    rnd = random.Random(1)
    rows = [(a, b, int(rnd.random() < 1 / (1 + math.exp(1 - a + b)))) for a, b in ((rnd.randrange(4), rnd.randrange(3)) for _ in range(4000))]
    df = spark.createDataFrame([(float(a), float(b), y) for a, b, y in rows], "a double, b double, y int")
    few = SC.counted(df, ["a", "b", "y"])
    assert few.count() <= 24 and few.agg(F.sum(SC.COUNT)).first()[0] == 4000
    plain, short = fit_standard(df, ["a", "b"]), fit_standard(few, ["a", "b"], SC.COUNT)
    for c in ("a", "b"):
        assert short.means[c] == pytest.approx(plain.means[c]) and short.stds[c] == pytest.approx(plain.stds[c])
    _, b0, w = SC.fit_logit(df, ["a", "b"])
    _, b1, v = SC.fit_logit(few, ["a", "b"], count=SC.COUNT)
    assert b1 == pytest.approx(b0, abs=1e-5) and [v["a"], v["b"]] == pytest.approx([w["a"], w["b"]], abs=1e-5)
    p = F.col("a") - F.col("b")
    want = M.auc_gini(df.withColumn("p", p), "p", "y").first()["auc"]
    assert M.auc_gini(few.withColumn("p", p), "p", "y", count=SC.COUNT).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_woe_chain_takes_the_bins_of_the_fit(spark):
    rows = [(float(i), float(i % 3), "abc"[i % 3], int(i * 7 % 5 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "q double, v double, t string, y int")
    m = B.WoEModel.fit(df, ["q", "v", "t"])
    odd = spark.createDataFrame([(float("nan"), 7.0, "z"), (None, None, None), (-5.0, 0.5, "a"), (1e9, 2.0, "c")], "q double, v double, t string")
    for r in m.transform(df.select("q", "v", "t").unionByName(odd)).withColumn("bin", m.bin_expr("q")).collect():
        q = 0.0 if r["q"] is None else m.woe["q"].get(r["bin"], 0.0)
        v = m.woe["v"].get(int(r["v"]), 0.0) if r["v"] in (0.0, 1.0, 2.0) else 0.0
        t = m.woe["t"].get("abc".index(r["t"]), 0.0) if r["t"] in ("a", "b", "c") else 0.0
        assert (r["WOE_q"], r["WOE_v"], r["WOE_t"]) == (q, v, t)


def test_fits_read_written_vectors(spark):
    """One assembled vector a row is written; fits from it are the fits from the columns."""
    rnd = random.Random(3)
    rows = [(i, float(i % 17), rnd.random(), float(i % 5), int(rnd.random() < (i % 17) / 17)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int").coalesce(1)
    feats = ["a", "b", "c"]
    f = MD.fold_table(df, feats, "y", "id", 3)
    assert f.columns == ["label", "fold", "features"] and "UDF" not in plan(f)
    early = MD.vector_table(df, feats, ["y"], "vectors")
    assert early.columns == ["y", "features"] and "UDF" not in plan(early)
    one, two = MD.fit_gbt(df, feats, n_trees=3), MD.fit_gbt(early.coalesce(1), feats, n_trees=3)
    assert two.featureImportances.toArray().tolist() == pytest.approx(one.featureImportances.toArray().tolist())


def test_folds_sort_short_rows(spark):
    """Hashes are divided by their first digits and sorted as they are: no number conversion a row, no second hash column."""
    df = spark.range(40_000).select("id", (F.col("id") % 2).cast("int").alias("y"))
    out = SP.stratified_kfold(df, "id", "y", 5)
    assert "conv(" not in plan(out) and "hashpartitioning(_bucket" in plan(out)
    hashed = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(40_000))
    want = {}
    for y in (0, 1):
        want |= {i: r % 5 for r, i in enumerate(i for _, i in hashed if i % 2 == y)}
    assert {r["id"]: r["fold"] for r in out.collect()} == want


def test_few_values_are_read_from_the_first_histogram(spark, monkeypatch):
    """No pass looks at the values one by one unless a bin holds several; later passes read only the features left."""
    rows = [(float(i % 4) if i % 9 else None, float(i * i), 1e300 if i == 0 else float(i % 3), int(i % 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "few double, many double, close double, y int")
    seen = []
    plain = B.unpivot_features
    monkeypatch.setattr(B, "unpivot_features", lambda d, features, extra=(): seen.append(list(features)) or plain(d, features, extra))
    edges, _ = B.fit_bins(df, ["few", "many", "close"])
    assert edges["few"] == ("value", [0.0, 1.0, 2.0, 3.0]) and edges["close"] == ("value", [0.0, 1.0, 2.0, 1e300])
    want = [i * i for i in range(3000)]
    assert edges["many"][0] == "quantile" and edges["many"][1][::10] == [want[0], want[-1]]
    assert ["close"] in seen and seen.count(["few", "many", "close"]) == 1 and not any("few" in s for s in seen[1:])
