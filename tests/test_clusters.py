import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from riskloom.operators import clusters as CL
from riskloom.operators import segments as SG


def blobs(spark, n=1500, d=3, k=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(k, d)).repeat(n // k, 0) * 6 + rng.normal(size=(n // k * k, d))
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, " + ", ".join(f"f{i} double" for i in range(d)))


F3 = ["f0", "f1", "f2"]


def test_no_worse_than_the_best_of_sparks_starts(spark):
    df = blobs(spark)
    rows = CL.vectors(df, F3)
    best = CL.shared_kmeans(rows, [2, 3, 4], restarts=4)
    from riskloom.operators.models import assemble

    v = assemble(df, F3)
    for k, s in best.items():
        spark_cost = min(KMeans(k=k, seed=42 + r, maxIter=300).fit(v).summary.trainingCost for r in range(4))
        assert s.inertia <= spark_cost * (1 + 1e-6) and s.n.sum() == 1500
    again = CL.shared_kmeans(CL.vectors(df.repartition(7), F3), [4], restarts=4)[4]
    assert again.inertia == pytest.approx(best[4].inertia, rel=1e-9)  # the same whatever the partitions


def test_one_pass_per_iteration_for_all_solutions(spark, monkeypatch):
    calls, plain = [], CL._advance
    monkeypatch.setattr(CL, "_advance", lambda rows, d, sets: calls.append(len(sets)) or plain(rows, d, sets))
    rows = CL.vectors(blobs(spark), F3)
    CL.shared_kmeans(rows, range(2, 6), restarts=5, max_iter=12)
    assert calls[0] == calls[-1] == 20 and len(calls) <= 13 and sorted(calls[:-1], reverse=True) == calls[:-1]


def test_silhouettes_equal_sparks_evaluator(spark):
    from riskloom.operators.models import assemble

    df = blobs(spark, 600)
    rows = CL.vectors(df, F3)
    best = CL.shared_kmeans(rows, [1, 3, 4], restarts=2)
    got = CL.silhouettes(rows, [best[k] for k in (1, 3, 4)])
    assert got[0] is None
    for k, s in zip((3, 4), got[1:]):
        clustered = CL.CentroidModel(best[k].centers).transform(assemble(df, F3))
        assert s == pytest.approx(SG.silhouette(clustered), rel=1e-9)


def test_euclidean_silhouette_matches_all_pairs(spark):
    df = blobs(spark, 240).withColumn("cluster", F.when(F.col("id") == 7, 9).otherwise(F.col("id") % 3))
    got = {int(r["key"]): r for r in CL.euclidean_silhouette(df, F3, "id").collect()}
    x = np.array([[r[f] for f in F3] for r in df.orderBy("id").collect()])
    c = np.array([9 if i == 7 else i % 3 for i in range(240)])
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(240):
        means = {k: far[i, (c == k) & (np.arange(240) != i)].mean() for k in set(c) if (c == k).sum() > (k == c[i])}
        own = means.pop(c[i], None)
        want = 0.0 if own is None else (min(means.values()) - own) / max(own, min(means.values()))
        assert got[i]["silhouette"] == pytest.approx(want, abs=1e-12)
    assert CL.euclidean_silhouette(df, F3, "id", n=50).count() == 50
    one = df.withColumn("cluster", F.lit(1))
    assert {(r["silhouette"], r["other"]) for r in CL.euclidean_silhouette(one, F3, "id").collect()} == {(0.0, None)}
    assert CL.euclidean_silhouette(df.limit(0), F3, "id").count() == 0


def test_rows_without_a_value_and_equal_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 0.0)], "a double, b double")
    best = CL.shared_kmeans(CL.vectors(df, ["a", "b"]), [1, 3], restarts=2)
    assert best[1].n.tolist() == [2.0] and best[3].inertia == 0.0 and best[3].n.sum() == 2
    with pytest.raises(ValueError, match="no row"):
        CL.shared_kmeans(CL.vectors(df.where("b < 0"), ["a", "b"]), [2])


def test_elbow_and_segments(spark):
    df = blobs(spark)
    rows = SG.elbow(df, F3, range(2, 6), restarts=3)
    assert [r[0] for r in rows] == [2, 3, 4, 5] and all(a[1] > b[1] for a, b in zip(rows, rows[1:]))
    assert max(rows, key=lambda r: r[2])[0] in (3, 4)
    model, scaler, cost = SG.kmeans_segments(df.withColumn("pd_score", F.lit(0.1)), F3, k=4, restarts=3)
    out = SG.assign_segments(model, scaler, df.withColumn("pd_score", F.lit(0.1)), F3)
    assert out.select("cluster").distinct().count() == 4 and cost == pytest.approx(rows[2][1], rel=1e-6)
