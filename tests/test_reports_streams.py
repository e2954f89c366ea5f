import pytest
from pyspark.sql import functions as F

from riskloom.operators import binning as B
from riskloom.sources.reports import ReportStore
from riskloom.streaming import drift, monitor

PSI = "feature string, psi double, status string, n_bins long"


def psi(spark, *rows):
    return spark.createDataFrame([(f, v, "STABLE", 3) for f, v in rows], PSI)


def test_parts_are_replaced_and_others_stay(spark, tmp_path):
    s = ReportStore(spark, str(tmp_path))
    s.write("psi", psi(spark, ("a", 0.1), ("b", 0.2)), "r1", "m", "test")
    s.write("psi", psi(spark, ("a", 0.3)), "r1", "m", "oot")
    s.write("psi", psi(spark, ("a", 0.5), ("c", 0.4)), "r1", "m", "test")
    assert sorted((r["feature"], r["psi"]) for r in s.read("psi", split="test").collect()) == [("a", 0.5), ("c", 0.4)]
    assert s.read("psi").count() == 3
    assert [(r["feature"], r["psi"]) for r in s.top("psi", "psi", 2, run="r1").collect()] == [("a", 0.5), ("c", 0.4)]
    assert sorted(r[0] for r in s.distinct("psi", "split").collect()) == ["oot", "test"]
    assert s.read("psi", features=["a"]).count() == 2 and s.read("psi", features=[]).count() == 0


def test_only_the_parts_asked_for_are_read(spark, tmp_path):
    s = ReportStore(spark, str(tmp_path))
    for split in ("test", "oot"):
        s.write("psi", psi(spark, ("a", 0.1)), "r1", "m", split)
    plan = s.read("psi", model="m", split="oot", features=["a"])._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "model" in filters and "split" in filters and "feature" not in filters and "In(feature" in plan.replace("EqualTo(feature", "In(feature")


def test_a_report_that_was_never_written_is_empty(spark, tmp_path):
    s = ReportStore(spark, str(tmp_path))
    got = s.read("bias", split="test")
    assert got.count() == 0 and got.columns[-3:] == ["run", "model", "split"]
    with pytest.raises(ValueError, match="Unknown report"):
        s.read("other")
    with pytest.raises(ValueError, match="Unknown format"):
        s.export("bias", str(tmp_path / "x"), "xls")


@pytest.mark.parametrize("fmt", ["csv", "json", "text"])
def test_exports_read_back(spark, tmp_path, fmt):
    s = ReportStore(spark, str(tmp_path / "store"))
    s.write("psi", psi(spark, ("a, with comma", 0.25), ("b", None)), "r1", "m", "test")
    got = s.export("psi", str(tmp_path / fmt), fmt)
    if fmt == "text":
        assert sorted(r[0] for r in got.collect()) == ["a, with comma | 0.25 | STABLE | 3 | r1 | m | test", "b |  | STABLE | 3 | r1 | m | test"]
    else:
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, s.read("psi").collect()))


def frames(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 9 != 0, F.sin("id") + F.when(F.col("id") % 2 == 0, 0.4).otherwise(0.0)).alias("x"), (F.col("id") % 4).cast("double").alias("z"),
        F.when(F.col("id") % 2 == 0, "actual").otherwise("expected").alias("part"),
    )
    return df, df.where("part = 'actual'").drop("part"), df.where("part = 'expected'").drop("part")


def test_drift_of_a_stream_equals_the_batch_report(spark, tmp_path):
    df, actual, expected = frames(spark)
    reference = drift.fit_reference(expected, ["x", "z"])
    source, counts, mark = (str(tmp_path / n) for n in ("in", "counts", "mark"))
    halves = actual.randomSplit([0.5, 0.5], 3)
    stream = lambda: spark.readStream.schema(actual.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def same(got, want):
        return sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    halves[0].repartition(3).write.parquet(source)
    part = expected.withColumn("part", F.lit("expected")).unionByName(halves[0].withColumn("part", F.lit("actual")))
    assert same(drift.run(stream(), reference, counts, mark), B.psi_report(part, ["x", "z"]))
    halves[1].repartition(2).write.mode("append").parquet(source)
    assert same(drift.run(stream(), reference, counts, mark), B.psi_report(df, ["x", "z"]))  # only the new files are read
    assert same(drift.run(stream(), reference, counts, mark), B.psi_report(df, ["x", "z"]))  # nothing new


def test_drift_of_nothing_and_of_values_outside(spark, tmp_path):
    _, actual, expected = frames(spark)
    reference = drift.fit_reference(expected, ["x", "z"])
    far = spark.createDataFrame([(1e9, -5.0), (None, None)], "x double, z double")
    counts = drift.arrived(far, reference)
    assert sorted((r["feature"], r["c_act"]) for r in counts.collect()) == [("x", 1), ("z", 1)]
    rows = drift.report(spark, reference, counts.limit(0)).collect()
    assert {r["feature"] for r in rows} == {"x", "z"} and all(r["psi"] > 1 for r in rows)


def test_scored_stream_takes_each_file_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.createDataFrame([(i, i / 10) for i in range(10)], "id long, pd_score double").write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("id long, pd_score double").parquet(source)
        monitor.write_scored_stream(stream, out, mark, available_now=True).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 10
    want = monitor.score_columns(spark.read.parquet(source))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
