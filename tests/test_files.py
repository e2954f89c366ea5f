"""Loading by path: declared types, quarantine, contract, and the cache of cleaned tables."""

import os

import pytest

from riskloom.sources import files, io

NAMES = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
         *[f"BILL_AMT{k}" for k in range(1, 7)], *[f"PAY_AMT{k}" for k in range(1, 7)], "default.payment.next.month"]


def line(i, **changed):
    row = {n: str(i + k) for k, n in enumerate(NAMES)} | {"SEX": "1", "EDUCATION": "2.0", "MARRIAGE": "NA", "default.payment.next.month": str(i % 2)}
    row |= changed
    return ",".join([str(i), *[row[n] for n in NAMES]])


def folder(tmp_path, parts, header="ID," + ",".join(NAMES)):
    at = tmp_path / "in"
    at.mkdir()
    for k, lines in enumerate(parts):
        (at / f"part-{k}.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(at)


def test_csv_folder_is_typed_and_quarantined(spark, tmp_path):
    good = [line(i) for i in range(1, 8)] + [line(8, LIMIT_BAL="1e3", AGE=" 30 ", PAY_3="")]
    bad = [line(20, AGE="old"), line(21, SEX="1.5"), line(22) + ",1", "23,4", '"24', line(25, PAY_AMT6="1,5")]
    got = files.ingest(spark, "uci", folder(tmp_path, [good[:4] + bad[:2], good[4:] + bad[2:]]))
    rows = {r["ID"]: r for r in got.records.collect()}
    assert sorted(rows) == list(range(1, 9))
    assert rows[8]["LIMIT_BAL"] == 1000.0 and rows[8]["AGE"] == 30 and rows[8]["PAY_3"] is None
    assert rows[1]["EDUCATION"] == 2 and rows[1]["MARRIAGE"] is None
    assert dict(got.records.dtypes)["PAY_0"] == "int" and dict(got.records.dtypes)["BILL_AMT1"] == "double"
    reasons = {r["reason"]: r["n"] for r in got.counts().collect()}
    assert reasons == {"kept": 8, "fields": 4, "type of AGE": 1, "type of SEX": 1}
    rejected = got.rejected.collect()
    assert all(r["file"].endswith(".csv") and r["record"] for r in rejected)
    assert {r["record"] for r in rejected if r["reason"] == "fields"} >= {"23,4", bad[2]}


def test_a_pruned_read_sees_the_same_records(spark, tmp_path):
    got = files.ingest(spark, "uci", folder(tmp_path, [[line(1), line(2, PAY_AMT6="x")]]))
    assert [r["ID"] for r in got.records.select("ID").collect()] == [1]
    assert got.records.count() == 1


def test_load_by_path_cleans_and_enforces_the_contract(spark, tmp_path):
    path = folder(tmp_path, [[line(i) for i in range(1, 60)] + [line(99, AGE="?")]])
    df = io.load_dataset(spark, "uci", min_rows=50, path=path)
    assert df.count() == 59 and "PAY_1" in df.columns and dict(df.dtypes)["default_payment_next_month"] == "int"
    with pytest.raises(ValueError, match="1 of 60 records rejected.*type of AGE"):
        io.load_dataset(spark, "uci", min_rows=50, path=path, max_rejected=0.01)
    with pytest.raises(ValueError, match="min_rows"):
        io.load_dataset(spark, "uci", min_rows=1000, path=path)


def test_generic_names_and_an_index_without_a_name(spark, tmp_path):
    header = "," + ",".join([*[f"X{k}" for k in range(1, 24)], "Y"])
    got = files.ingest(spark, "uci", folder(tmp_path, [[line(3, MARRIAGE="1")]], header))
    row = got.records.first()
    assert row["_c0"] == 3 and row["X1"] == 3.0 and dict(got.records.dtypes)["X5"] == "int"


def test_files_that_disagree_or_lack_columns_raise(spark, tmp_path):
    path = folder(tmp_path, [[line(1)]])
    (tmp_path / "in" / "part-9.csv").write_text("ID," + ",".join(reversed(NAMES)) + "\n" + line(2) + "\n")
    with pytest.raises(Exception, match="header|schema"):
        files.ingest(spark, "uci", path).records.collect()
    with pytest.raises(ValueError, match="lack.*AGE"):
        files.declared_types("uci", [n for n in NAMES if n != "AGE"])
    with pytest.raises(ValueError, match="Unknown dataset"):
        files.declared_types("other", NAMES)
    with pytest.raises(ValueError, match="Unknown format"):
        files.ingest(spark, "uci", path, "orc")


def test_parquet_types_are_converted(spark, tmp_path):
    path = str(tmp_path / "pq")
    cols = ["ID", *NAMES]
    rows = [tuple(line(i).split(",")) for i in range(1, 5)] + [tuple(line(9, LIMIT_BAL="much").split(","))]
    spark.createDataFrame(rows, cols).write.parquet(path)
    got = files.ingest(spark, "uci", path, "parquet")
    assert got.records.count() == 4 and got.rejected.first()["reason"] == "type of LIMIT_BAL"
    assert '"LIMIT_BAL":"much"' in got.rejected.first()["record"]


def test_no_records(spark, tmp_path):
    got = files.ingest(spark, "uci", folder(tmp_path, [[]]))
    assert got.records.count() == 0 and got.rejected.count() == 0
    files.enforce_share(got, 0.0)


def test_cache_follows_inputs_and_version(spark, tmp_path):
    source, root = str(tmp_path / "src"), str(tmp_path / "cache")
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(source)

    spark.range(3).write.parquet(source)
    for _ in range(2):
        assert io.cached_clean(spark, root, [source], "1", make).count() == 3
    assert len(made) == 1
    spark.range(5).write.mode("append").parquet(source)
    assert io.cached_clean(spark, root, [source], "1", make).count() == 8
    io.cached_clean(spark, root, [source], "2", make)
    assert len(made) == 3


def test_interrupted_write_is_never_read(spark, tmp_path):
    source, root = str(tmp_path / "src"), str(tmp_path / "cache")
    spark.range(3).write.parquet(source)

    def breaks():
        return spark.range(2).selectExpr("id", "raise_error('stopped') AS x")

    with pytest.raises(Exception, match="stopped"):
        io.cached_clean(spark, root, [source], "1", breaks)
    assert not [f for f in os.listdir(root) if f.endswith(".marker")]
    assert io.cached_clean(spark, root, [source], "1", lambda: spark.range(4)).count() == 4
