"""The ``opN_*`` queries: thin calls of the operators with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, html_text, jaccard_join, langid, line_dedup, minhash, nn_descent, packing, prefix_trie, quality, repeats, structure_repair, token_store
from riskloom.llm.oracles import ORACLES  # noqa: F401


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer(name: str) -> str:
    """A public tokenizer's file, read on the driver and shipped to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_files(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), "leads", end_id=2)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), "dropped", end_id=1, capacity=4096)


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(read(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(read(spark, sf_dir, "documents"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_pairs(read(spark, sf_dir, "documents"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair(structure_repair.damage(read(spark, sf_dir, "conversations")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(read(spark, sf_dir, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_decontamination, op3_best_fit_packing, op4_quality_gam, op5_language_ecoc, op6_html_text,
        op7_repeated_passages, op8_nn_descent, op9_line_dedup, op10_jaccard_join, op11_minhash, op12_structure_repair, op13_prefix_trie,
    )
}
