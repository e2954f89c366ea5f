"""Groups over many blocks in the Jaccard join: all links by brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from riskloom.llm import jaccard_join as J
from riskloom.llm.common import Workspace


def text(seed, n, rng=None):
    rng = rng or random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def shingles(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(docs, k, num, den):
    sets = [shingles(w, k) for w in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(docs))]


def families():
    """Near copies, a chain that drifts away from its start, families that share a long part but don't link, strangers."""
    rng = random.Random(2)
    base, docs = text(1, 120), []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append(w)
    chain = text(3, 100)
    for step in range(25):
        chain = list(chain)
        chain[(4 * step) % 100] = f"c{step}"
        docs.append(chain)
    for family in range(6):
        own = text(50 + family, 30)
        docs += [base[:90] + own[:-1] + [f"f{family}{k}"] for k in range(8)]
    docs += [text(200 + k, 60) for k in range(40)]
    order = list(range(len(docs)))
    rng.shuffle(order)
    return [docs[i] for i in order]


@pytest.mark.parametrize("block, k, num, den", [(256, 5, 4, 5), (5, 3, 9, 10), (3, 5, 4, 5)])
def test_components_by_brute_force_over_small_blocks(spark, monkeypatch, block, k, num, den):
    monkeypatch.setattr(J, "BLOCK", block)
    docs = families()
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(df, k, num, den).collect()}
    assert [got[i] for i in range(len(docs))] == brute(docs, k, num, den)


def test_hot_null_id_of_copies(spark):
    rows = [(None, "a b c d e f g")] * 3000 + [(1, "a b c d e f g"), (2, "a b c d e f h i j k"), (None, "q r s")]
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10)
    assert got.groupBy("component_id").agg(F.count("*").alias("n")).where("component_id = 1").first()["n"] == 3001


def files(spark):
    """Bytes of the shuffle files that the driver's block manager holds."""
    it = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    found = 0
    while it.hasNext():
        found += it.next().length()
    return found


def test_texts_outside_candidate_components_are_not_shuffled(spark, tmp_path):
    docs = [text(900 + i, 400) for i in range(300)]
    docs.append([*docs[0][:-1], "x"])
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").write.parquet(path)
    df = spark.read.parquet(path)
    reps = J.signatures(df, "doc_id", "text", 3, 9, 10).withColumn("rid", F.col("id"))
    cand = spark.createDataFrame([(0, 0), (300, 0)], "node long, comp long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where tables are large
    try:
        before = files(spark)
        links = J.verify(df, reps, cand, 3, 9, 10, "doc_id", "text").collect()
        written = files(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {(r["a"], r["b"]) for r in links} == {(0, 300)}
    assert written < sum(len(" ".join(w)) for w in docs) / 8


@pytest.mark.parametrize("size", [64, 1 << 12])
def test_components_where_the_id_filter_lets_others_through(spark, monkeypatch, size):
    monkeypatch.setattr(J, "_FILTER_BITS", size)
    docs = families()
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(df, 5, 4, 5).collect()}
    assert [got[i] for i in range(len(docs))] == brute(docs, 5, 4, 5)


def test_saved_tables_leave_no_shuffle_files(spark):
    ws, key = Workspace(spark, "shuffles"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    stated = spark.conf.get(key, None)
    before = files(spark)
    rows = spark.range(400_000).select(F.xxhash64("id").alias("a"))
    saved = ws.save(rows.groupBy("a").agg(F.count("*").alias("n")), "counted")
    until = time.time() + 20
    while files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert files(spark) <= before
    assert spark.conf.get(key, None) == stated
    assert saved.count() == 400_000


def test_long_strangers_with_common_tokens_are_no_candidates(spark):
    rng = random.Random(5)
    docs = [[f"v{rng.randrange(75)}" for _ in range(2500)] for _ in range(60)]
    docs.append([*docs[0][:-1], "x"])
    ws = Workspace(spark, "strangers")
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(4)
    reps = ws.save(J.signatures(df, "doc_id", "text", 3, 9, 10).withColumn("rid", F.col("id")), "classes")
    found = J.candidates(ws.save(J.prefixes(reps, 9, 10, ws), "prefixes"), reps, 9, 10, ws).collect()
    assert {(r["a"], r["b"]) for r in found} == {(0, 60)}
