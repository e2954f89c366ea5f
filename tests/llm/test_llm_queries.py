"""Registered corpus queries: SQL parity on the smallest tables, and the pipeline stage by stage."""

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E
import corpus_pipeline as P
from riskloom.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_parity(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    cols = [d[0] for d in want.description]
    got = E.queries()[name](spark, SF001)
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(want.fetchall())


def test_every_operator_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
    assert "pipeline" in names and [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        left = docs.count()
        assert left == n if name == "line_dedup" else 0 < left <= n
        n = left
    labels = spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 0").select("doc_id")
    assert docs.join(labels, "doc_id", "left_semi").count() <= 0.1 * labels.count()
    packed = P.STAGES[-1][1](spark, docs, SF001)
    assert packed.select("doc_id").distinct().count() == n
