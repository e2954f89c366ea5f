"""Embedding near-duplicates by NN-descent.

1. Equal vectors collapse to one class with a multiplicity.
2. A neighbour graph starts from random-hyperplane cells: vectors of one cell
   (cut into blocks where a cell is large) are compared with each other, over
   several independent sets of planes: the deeper the cells, the more sets, so
   that a pair at the threshold shares a cell with a chance of ``recall``.
3. Rounds of neighbours-of-neighbours joins: the vectors in and around each
   vertex's list (reverse neighbours included, hubs cut into blocks) are
   compared with each other; every vertex keeps its nearest. Every pair seen
   at or above the threshold is kept as an edge, through a spanning forest
   of each block, so a full list loses no connection.
4. Lists saturated with links are enlarged to their whole component: inside
   every component of links all pairs are compared, in pairs of blocks, so a
   vector's number of links is exact within it and no pair becomes a row.
5. Audit: at most three passes ask vectors by brute force against all rows:
   AUDIT at random (in the order of their hashes); if fewer than AUDIT of them
   link, ASK further ones; and up to ASK whose nearest found neighbour lies
   less than MARGIN below the threshold, where links are lost first. Each
   linked vector counts alike, by the share of its links that was found; the
   recall is the lower of the shares at random and near the threshold. Where
   none of the m vectors asked at random links, at most 3 / m of all vectors
   do (with 95 % confidence): below one in 2,800. Below ``recall`` the lists
   double and new planes and another round are added, up to ``tries`` times;
   below it after that, all vectors are compared with all, ASK at a time.

Every vector length is searched on its own. Cosines are double precision over
the stored components. Vectors that are null, zero, or hold null or non-finite
components link with nothing. Ties keep the smaller
number. A null id counts as larger than every id and comes back as null; rows
that repeat an id are rows of their own that share the smallest id. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import Workspace, column, id_or_null, ids, prepare
from riskloom.llm.graph import components
from riskloom.llm.jaccard_join import _Forest, _sorted_units, _units

log = logging.getLogger(__name__)

THRESHOLD = 0.95
K = 8
TREES = 6
CELL = 48
BLOCK = 256
HUB = 48
AUDIT = 256
ASK = 8192  # vectors of one brute-force pass
MARGIN = 0.02
RECALL = 0.99
TRIES = 4


def _vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dims, h1, h2, vec): the components as doubles in bytes, null where nothing can link."""

    def run(batches):
        for batch in batches:
            out, dims = [], []
            for v in column(batch, vec_col).to_pylist():
                ok = v is not None and None not in v
                x = np.array(v, np.float64) if ok else np.zeros(0)
                ok = ok and np.isfinite(x).all() and x.any()
                out.append((x + 0.0).tobytes() if ok else None)
                dims.append(len(x) if ok else 0)
            h = [np.frombuffer(xxhash.xxh3_128_digest(x or b""), np.int64) for x in out]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids(column(batch, id_col))), pa.array(dims, pa.int32()), pa.array([x[0] for x in h], pa.int64()),
                    pa.array([x[1] for x in h], pa.int64()), pa.array(out, pa.binary()),
                ],
                ["id", "dims", "h1", "h2", "vec"],
            )

    return rows.select(id_col, vec_col).mapInArrow(run, "id long, dims int, h1 long, h2 long, vec binary")


def _units_of(vecs: list[bytes], dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), np.float64).reshape(-1, dims)
    top = np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(rows: DataFrame, dims: int, k: int, threshold: float) -> DataFrame:
    """All pairs of each unit: (u, v, sim) of every member's ``k`` nearest that beat its ``worst``, and a spanning forest of its links."""

    def run(batches):
        for table, unit in _units(batches, ["rid", "vec", "worst"]):
            rid, worst = table.column("rid").to_numpy(), table.column("worst").to_numpy()
            x = _units_of(table.column("vec").to_pylist(), dims)
            start = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            out: list[list[np.ndarray]] = [[], [], []]
            for s, e in zip(start, np.append(start[1:], len(unit))):
                mine, first = np.unique(rid[s:e], return_index=True)
                m = len(mine)
                if m < 2:
                    continue
                y = x[s:e][first]
                sim = y @ y.T
                np.fill_diagonal(sim, -2)
                links = np.argwhere(np.triu(sim >= threshold))
                if len(links):
                    forest, edge = _Forest(m), []
                    for i, j in links:
                        if forest.root(int(i)) != forest.root(int(j)):
                            forest.join(int(i), int(j))
                            edge.append((i, j))
                    i, j = np.array(edge).T
                    for a, b in ((i, j), (j, i)):
                        out[0].append(mine[a])
                        out[1].append(mine[b])
                        out[2].append(sim[a, b])
                near = np.argsort(-sim, axis=1, kind="stable")[:, : min(k, m - 1)]
                u = np.repeat(np.arange(m), near.shape[1])
                v = near.ravel()
                better = sim[u, v] > worst[s:e][first][u]
                out[0].append(mine[u[better]])
                out[1].append(mine[v[better]])
                out[2].append(sim[u[better], v[better]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, t), *x])) for t, x in zip((np.int64, np.int64, np.float64), out)], ["u", "v", "sim"]
            )

    return _sorted_units(rows).mapInArrow(run, "u long, v long, sim double")


def _trees(depth: int, threshold: float, recall: float) -> int:
    """Sets of ``depth`` planes of which one at least holds a pair at the threshold together with a chance of ``recall``."""
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** depth
    if together >= 1:
        return TREES
    return max(TREES, math.ceil(math.log(1 - min(recall, 0.999)) / math.log1p(-together)))


def _cells(reps: DataFrame, n: int, dims: int, seed: int, threshold: float, recall: float, ws: Workspace) -> DataFrame:
    """Every vector once per set of planes, in a block of its cell. Cell codes and sizes are written before they
    are joined: adaptive execution can split a large cell."""
    depth = max(0, math.ceil(math.log2(max(n, 1) / CELL)))
    trees = _trees(depth, threshold, recall)
    planes = np.random.default_rng(seed).standard_normal((trees, depth, dims))

    def run(batches):
        for batch in batches:
            rid = column(batch, "rid")
            if not batch.num_rows:
                continue
            x = _units_of(column(batch, "vec").to_pylist(), dims)
            for t in range(trees):
                code = (x @ planes[t].T > 0) @ (1 << np.arange(depth, dtype=np.int64)) if depth else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t), pa.int32()), pa.array(code), rid], ["tree", "cell", "rid"])

    cells = ws.save(reps.select("rid", "vec").mapInArrow(run, "tree int, cell long, rid long"), "codes")
    sizes = ws.save(cells.groupBy("tree", "cell").agg(F.count("*").alias("g")).where(F.col("g") > 1), "sizes")
    block = F.pmod(F.xxhash64("rid", "tree", F.lit(seed)), F.ceil(F.col("g") / F.lit(BLOCK)).cast("int"))
    placed = cells.join(sizes, ["tree", "cell"]).select("rid", F.xxhash64("tree", "cell", block).alias("unit"))
    return placed.join(reps.select("rid", "vec"), "rid").select("unit", "rid", "vec", F.lit(-2.0).alias("worst"))


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of every vertex, first among blocks of its candidates, then among those."""
    best = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    order = [F.col("sim").desc(), F.col("v")]
    part = best.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(16)))
    part = part.withColumn("r", F.row_number().over(Window.partitionBy("u", "part").orderBy(*order))).where(F.col("r") <= k)
    return part.withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy(*order))).where(F.col("r") <= k).select("u", "v", "sim")


def _around(graph: DataFrame, reps: DataFrame) -> DataFrame:
    """Units of one vertex's neighbours, reverse neighbours and itself; hubs in several units."""
    back = graph.groupBy("v").agg(F.count("*").alias("g")).select(F.col("v").alias("w"), F.ceil(F.col("g") / F.lit(HUB)).cast("int").alias("nb"))
    ahead = graph.select(F.col("u").alias("w"), F.col("v").alias("rid")).unionByName(graph.select(F.col("u").alias("w"), F.col("u").alias("rid")).distinct())
    ahead = ahead.join(back, "w", "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("nb", F.lit(1)) - 1)))
    behind = graph.select(F.col("v").alias("w"), F.col("u").alias("rid")).join(back, "w").withColumn("block", F.pmod(F.xxhash64("rid", "w"), "nb").cast("int"))
    rows = ahead.select("w", "block", "rid").unionByName(behind.select("w", "block", "rid")).withColumn("unit", F.xxhash64("w", "block"))
    worst = graph.groupBy("u").agg(F.min("sim").alias("worst"))
    return rows.select("unit", "rid").join(reps.select("rid", "vec"), "rid").join(worst, F.col("rid") == F.col("u"), "left").select(
        "unit", "rid", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst")
    )


def _count_links(linked: DataFrame, reps: DataFrame, dims: int, threshold: float, ws: Workspace) -> DataFrame:
    """(rid, links): the summed multiplicity of all classes of its component at or above the threshold."""
    sizes = ws.save(linked.groupBy("comp").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("nb")), "sizes")
    rows = linked.join(sizes, "comp").join(reps, F.col("node") == F.col("rid"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("rid", F.lit(5)), "nb").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.withColumn("unit", F.xxhash64("comp", F.least("mine", "other"), F.greatest("mine", "other")))
    # In the unit (i, j) block i is side 0; a block with itself has side 0 alone.
    rows = rows.select("unit", "rid", "vec", "mult", (F.col("mine") > F.col("other")).cast("int").alias("side"), (F.col("mine") == F.col("other")).alias("own"))

    def run(batches):
        for table, unit in _units(batches, ["rid", "vec", "mult", "side", "own"]):
            rid, mult, side = (table.column(c).to_numpy() for c in ("rid", "mult", "side"))
            own = table.column("own").to_numpy(zero_copy_only=False)
            x = _units_of(table.column("vec").to_pylist(), dims)
            start = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            links = np.zeros(len(rid), np.int64)
            for s, e in zip(start, np.append(start[1:], len(unit))):
                hit = x[s:e] @ x[s:e].T >= threshold
                np.fill_diagonal(hit, False)
                if not own[s]:
                    hit &= side[s:e, None] != side[None, s:e]
                links[s:e] = hit @ mult[s:e]
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(links)], ["rid", "links"])

    return _sorted_units(rows).mapInArrow(run, "rid long, links long").groupBy("rid").agg(F.sum("links").alias("links"))


def audit(reps: DataFrame, counted: DataFrame, nearest: DataFrame, dims: int, threshold: float) -> float:
    """Recall by brute force: the lower of the mean shares of found links of linked vectors at random and near the threshold.

    ``nearest``: (rid, sim), the nearest neighbour that the search found. At most three passes over all rows."""
    h = F.xxhash64("rid")  # one to one

    def shares(rows: DataFrame, size: int) -> tuple[list[float], int, int]:
        asked = rows.select("rid", "vec", h.alias("h")).orderBy("h").limit(size).collect()
        if not asked:
            return [], 0, 0
        q = np.array([r["rid"] for r in asked]), _units_of([bytes(r["vec"]) for r in asked], dims)
        true = _true_links(reps, q, threshold).where(F.col("true") > 0)
        both = true.join(counted, "rid", "left").select("true", F.coalesce("links", F.lit(0)).alias("found")).collect()
        return [min(1.0, r["found"] / r["true"]) for r in both], len(asked), asked[-1]["h"]

    random, n, last = shares(reps, AUDIT)
    if len(random) < AUDIT and n == AUDIT:
        random += shares(reps.where(h > F.lit(last)), ASK)[0]
    doubtful = nearest.where((F.col("sim") < threshold) & (F.col("sim") >= threshold - MARGIN)).select("rid")
    close = shares(reps.join(doubtful, "rid", "left_semi"), ASK)[0]
    return min((float(np.mean(x)) for x in (random, close) if x), default=1.0)


def _all_pairs(reps: DataFrame, dims: int, threshold: float, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Links of all vectors from comparing all with all, ASK at a time: (a, b) that connect what links, and (rid, links)."""
    h = F.xxhash64("rid")
    last, edges, counted = None, None, None
    while True:
        rest = reps if last is None else reps.where(h > F.lit(last))
        asked = rest.select("rid", "vec", h.alias("h")).orderBy("h").limit(ASK).collect()
        if not asked:
            return edges, counted
        last = asked[-1]["h"]
        q = np.array([r["rid"] for r in asked]), _units_of([bytes(r["vec"]) for r in asked], dims)
        part = ws.save(_true_links(reps, q, threshold).withColumnRenamed("true", "links"), "all-links")
        found = ws.save(_block_edges(reps, q, threshold), "all-edges")
        counted = part if counted is None else counted.unionByName(part)
        edges = found if edges is None else edges.unionByName(found)


def _block_edges(reps: DataFrame, asked: tuple[np.ndarray, np.ndarray], threshold: float) -> DataFrame:
    """(a, b): a spanning forest of the links between the asked vectors and the rows of each batch."""
    who = reps.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        rid, q = who.value
        for batch in batches:
            other = column(batch, "rid").to_numpy()
            edge: list[tuple[int, int]] = []
            if len(other):
                hit = q @ _units_of(column(batch, "vec").to_pylist(), q.shape[1]).T >= threshold
                forest = _Forest(len(rid) + len(other))
                for i, j in np.argwhere(hit & (rid[:, None] != other[None, :])):
                    a, b = forest.root(int(i)), forest.root(len(rid) + int(j))
                    if a != b:
                        forest.join(int(i), len(rid) + int(j))
                        edge.append((rid[i], other[j]))
            a, b = zip(*edge) if edge else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return reps.select("rid", "vec").mapInArrow(run, "a long, b long")


def _true_links(reps: DataFrame, asked: tuple[np.ndarray, np.ndarray], threshold: float) -> DataFrame:
    """(rid, true): the links of the asked vectors, from all rows."""
    who = reps.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        rid, q = who.value
        total = np.zeros(len(rid), np.int64)
        for batch in batches:
            if batch.num_rows:
                other, mult = column(batch, "rid").to_numpy(), column(batch, "mult").to_numpy()
                hit = q @ _units_of(column(batch, "vec").to_pylist(), q.shape[1]).T >= threshold
                total += (hit & (rid[:, None] != other[None, :])) @ mult
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(total[some])], ["rid", "true"])

    return reps.select("rid", "vec", "mult").mapInArrow(run, "rid long, true long").groupBy("rid").agg(F.sum("true").alias("true"))


def _search(rows: DataFrame, dims: int, threshold: float, k: int, rounds: int, recall: float, tries: int, ws: Workspace) -> DataFrame:
    """(h1, h2, n_links, component_id) of the vectors of one length."""
    reps = rows.where(F.col("dims") == dims).groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("mult"), F.first("vec").alias("vec"))
    reps = ws.save(reps.withColumn("rid", F.monotonically_increasing_id()), "classes")
    n = reps.count()
    graph = edges = None
    for attempt in range(tries):
        seen = ws.save(_compare(_cells(reps, n, dims, 101 + attempt, threshold, recall, ws), dims, k, threshold), "cells")
        for step in range(rounds + 1):
            links = seen.where(F.col("sim") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))
            edges = links if edges is None else edges.unionByName(links)
            graph = ws.save(_nearest(seen if graph is None else graph.unionByName(seen), k), "graph")
            if step < rounds:
                seen = ws.save(_compare(_around(graph, reps), dims, k, threshold), "round")
        linked = ws.save(components(edges, ws), "components")
        counted = ws.save(_count_links(linked, reps, dims, threshold, ws), "links")
        nearest = graph.groupBy(F.col("u").alias("rid")).agg(F.max("sim").alias("sim"))
        reached = audit(reps, counted, nearest, dims, threshold)
        if reached >= recall:
            break
        k *= 2
    else:
        log.warning("%.4f of the links of %d-component vectors found after %d tries: comparing all with all", reached, dims, tries)
        edges, counted = _all_pairs(reps, dims, threshold, ws)
        linked = ws.save(components(edges, ws), "components")
    named = reps.join(linked, F.col("rid") == F.col("node"), "left").withColumn("root", F.coalesce("comp", "rid"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    found = named.join(least, "root").join(counted, "rid", "left")
    return found.select("h1", "h2", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, k: int = K, rounds: int = 2, recall: float = RECALL, tries: int = TRIES,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    prepare(spark)
    ws = Workspace(spark, "nn-descent")
    rows = ws.save(_vectors(vectors, id_col, vec_col), "vectors")
    lengths = rows.where("dims > 0").groupBy("dims").agg(F.count("*").alias("n")).where("n > 1").orderBy("dims").collect()
    members = rows.withColumn("h1", F.when(F.col("dims") > 0, F.col("h1"))).select("id", "h1", "h2")
    searched = [_search(rows, dims, threshold, k, rounds, recall, tries, ws) for dims in [r["dims"] for r in lengths] or [1]]
    found = reduce(DataFrame.unionByName, searched)
    out = members.join(found, ["h1", "h2"], "left")
    out = out.withColumn("n_links", F.coalesce("n_links", F.lit(0))).withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(
        id_or_null("id").alias(id_col), "n_links", id_or_null("component_id").alias("component_id"), (F.col("id") == F.col("component_id")).alias("kept")
    )
