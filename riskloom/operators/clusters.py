"""K-means of many starts and sizes in shared passes, and silhouettes.

All (k, start) solutions advance together: a pass over the rows assigns each
row to its nearest centre of every solution still moving (one matrix product
a batch) and a task hands on, per centre, a count, a cost and sums. So a
pass costs one scan however many solutions there are, and only solutions x
centres x features numbers leave the tasks. The next pass drops solutions
that have settled. Starts are drawn by greedy k-means++ from a sample of at
most INIT_ROWS different rows; every pass reads all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import materialize

INIT_ROWS = 5000
# Rows that the exact silhouette compares with each other.
SAMPLE_ROWS = 2000
# A solution has settled when no centre moves farther.
SETTLED = 1e-4


class Solution(NamedTuple):
    """Centres with what their rows add up to: count, cost, squared norms, sums."""

    k: int
    centers: np.ndarray
    n: np.ndarray
    cost: np.ndarray
    squares: np.ndarray
    sums: np.ndarray

    @property
    def inertia(self) -> float:
        return float(self.cost.sum())


class CentroidModel:
    """Assigns ``cluster`` by the nearest centre (the first on ties) of a vector column."""

    def __init__(self, centers: np.ndarray, features_col: str = "features"):
        self.centers, self.features_col = np.asarray(centers, float), features_col

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name Spark ML uses
        return list(self.centers)

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        x = "_centroid_x"
        df = df.withColumn(x, vector_to_array(self.features_col))
        return df.withColumn("cluster", nearest([F.get(x, F.lit(i)) for i in range(self.centers.shape[1])], self.centers)).drop(x)


def nearest(x: Sequence[Column], centers: np.ndarray) -> Column:
    """Index of the centre with the least squared distance (the first on ties)."""
    far = [sum(((c - F.lit(float(v))) ** 2 for c, v in zip(x, center)), F.lit(0.0)) for center in centers]
    least = F.least(*far) if len(far) > 1 else far[0]
    return F.coalesce(*[F.when(d == least, F.lit(j)) for j, d in enumerate(far)], F.lit(0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0.0)


def _advance(rows: DataFrame, d: int, sets: list[np.ndarray]) -> list[Solution]:
    """One pass: what the rows nearest to each centre of every set add up to."""
    edges = np.cumsum([0, *map(len, sets)])
    stacked = np.concatenate(sets)
    names = ["n", "cost", "squares", *[f"s{i}" for i in range(d)]]
    schema = pa.schema([("at", pa.int32()), *[(n, pa.float64()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(stacked), len(names)))
        for batch in batches:
            x = _matrix(batch, d)
            far, norm = _distances(x, stacked), (x * x).sum(1)
            for a, b in zip(edges, edges[1:]):
                near = far[:, a:b].argmin(1)
                weights = [None, far[np.arange(len(x)), a + near], norm, *x.T]
                for j, w in enumerate(weights):
                    total[a:b, j] += np.bincount(near, w, b - a)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(stacked)), pa.int32()), *map(pa.array, total.T.copy())], schema=schema)

    sums = rows.mapInArrow(run, "at int, " + ", ".join(f"{n} double" for n in names)).groupBy("at").agg(*[F.sum(n).alias(n) for n in names])
    total = np.zeros((len(stacked), len(names)))
    for r in sums.collect():  # one row per centre
        total[r["at"]] = [r[n] for n in names]
    parts = [total[a:b] for a, b in zip(edges, edges[1:])]
    return [Solution(len(c), c, t[:, 0], t[:, 1], t[:, 2], t[:, 3:]) for c, t in zip(sets, parts)]


def _plus_plus(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each further centre is the best of a few rows drawn with a chance in proportion to their squared
    distance from the nearest centre."""
    centers = [sample[rng.integers(len(sample))]]
    far = _distances(sample, centers[0][None])[:, 0]
    while len(centers) < k:
        p = far / far.sum() if far.sum() > 0 else None
        drawn = sample[rng.choice(len(sample), 2 + int(np.log(k)), p=p)]
        left = np.minimum(far[:, None], _distances(sample, drawn))
        best = left.sum(0).argmin()
        centers.append(drawn[best])
        far = left[:, best]
    return np.array(centers)


def _sample(rows: DataFrame) -> np.ndarray:
    """At most INIT_ROWS different rows, the same whatever the partitions: of the rows of each hash class one."""
    h = F.xxhash64("x")
    one = rows.groupBy(F.pmod(h, F.lit(INIT_ROWS)).alias("c")).agg(F.min_by("x", F.xxhash64(h)).alias("x")).orderBy("c")
    return np.array([r["x"] for r in one.collect()])


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A written table of the features as one array; rows with a NULL, NaN or infinite value are left out."""
    cols = [F.col(f"`{f}`").cast("double") for f in features]
    kept = df
    for c in cols:
        kept = kept.where(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return materialize(kept.select(F.array(*cols).alias("x")), "vectors")


def shared_kmeans(rows: DataFrame, ks: Sequence[int], restarts: int = 10, max_iter: int = 300, seed: int = 42) -> dict[int, Solution]:
    """The solution of least cost for every k; ``rows`` come from :func:`vectors`."""
    sample = _sample(rows)
    if not len(sample):
        raise ValueError("no row has all clustering features")
    d = sample.shape[1]
    sets = [_plus_plus(sample, k, np.random.default_rng(seed + r)) for k in ks for r in range(restarts)]
    moving = list(range(len(sets)))
    for _ in range(max_iter):
        still = []
        for i, s in zip(moving, _advance(rows, d, [sets[i] for i in moving])):
            new = np.where(s.n[:, None] > 0, s.sums / np.maximum(s.n, 1)[:, None], s.centers)  # an empty cluster stays
            if np.sqrt(((new - s.centers) ** 2).sum(1)).max() > SETTLED:
                still.append(i)
            sets[i] = new
        moving = still
        if not moving:
            break
    best: dict[int, Solution] = {}
    for s in _advance(rows, d, sets):
        if s.k not in best or s.inertia < best[s.k].inertia:
            best[s.k] = s
    return best


def silhouettes(rows: DataFrame, solutions: Sequence[Solution]) -> list[float | None]:
    """Mean silhouette over all rows by squared Euclidean distance, for all solutions in one pass.

    A row's mean squared distance to a cluster follows from the cluster's
    count, sum and squared norms. None for a solution with one used cluster.
    """
    d = solutions[0].sums.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(solutions), 2))
        for batch in batches:
            x = _matrix(batch, d)
            norm, at = (x * x).sum(1), np.arange(len(x))
            for i, s in enumerate(solutions):
                near = _distances(x, s.centers).argmin(1)
                all_ = np.maximum(norm[:, None] * s.n + s.squares - 2 * x @ s.sums.T, 0.0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    own = all_[at, near] / (s.n[near] - 1)
                    mean = np.where(s.n > 0, all_ / s.n, np.inf)
                    mean[at, near] = np.inf
                    other = mean.min(1)
                    value = (other - own) / np.maximum(own, other)
                value = np.where((s.n[near] > 1) & np.isfinite(value), value, 0.0)
                total[i] += value.sum(), len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(solutions)), pa.int32()), *map(pa.array, total.T.copy())], ["at", "s", "n"])

    got = rows.mapInArrow(run, "at int, s double, n double").groupBy("at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    mean = {r["at"]: r["s"] / r["n"] for r in got if r["n"]}
    return [mean.get(i) if (s.n > 0).sum() > 1 else None for i, s in enumerate(solutions)]


def euclidean_silhouette(df: DataFrame, features: Sequence[str], key: str, cluster_col: str = "cluster", n: int = SAMPLE_ROWS) -> DataFrame:
    """(key, cluster, own, other, silhouette) by plain Euclidean distance among ``n`` sampled rows.

    The sample (the rows with the least md5 of the key) is one bounded matrix
    that every task holds; a task compares its share of the sample with it.
    ``own`` is the mean distance to the other rows of the cluster, ``other`` the
    least mean distance to another cluster; a row alone in its cluster has 0.
    """
    from riskloom.operators.splits import sample_n

    cols = [F.col(f"`{f}`").cast("double") for f in features]
    picked = materialize(sample_n(df.select(key, cluster_col, *features), key, n).select(
        F.col(key).cast("string").alias("key"), F.col(cluster_col).cast("long").alias("cluster"), F.array(*cols).alias("x")
    ), "silhouette-sample")
    held = picked.collect()  # at most n rows
    matrix = np.array([r["x"] for r in held], float).reshape(len(held), len(features))
    clusters, code = np.unique([r["cluster"] for r in held], return_inverse=True) if held else (np.zeros(0), np.zeros(0, int))
    size = np.bincount(code, minlength=len(clusters))
    member = np.eye(len(clusters))[code] if held else np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, matrix.shape[1])
            mine = np.searchsorted(clusters, batch.column("cluster").to_numpy())
            sums = np.empty((len(x), len(clusters)))
            for i, row in enumerate(x):  # differences, not products: rows that are equal have distance 0
                sums[i] = np.sqrt(((matrix - row) ** 2).sum(1)) @ member
            at = np.arange(len(x))
            own = sums[at, mine] / np.maximum(size[mine] - 1, 1)
            mean = sums / size
            mean[at, mine] = np.inf
            other = mean.min(1)
            with np.errstate(invalid="ignore", divide="ignore"):
                value = (other - own) / np.maximum(own, other)
            value = np.where((size[mine] > 1) & np.isfinite(value), value, 0.0)
            other = pa.array(other, mask=~np.isfinite(other))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("cluster"), pa.array(own), other, pa.array(value)], _NAMES)

    parts = max(1, min(len(held) // 100, df.sparkSession.sparkContext.defaultParallelism))
    return picked.repartition(parts, "key").mapInArrow(run, "key string, cluster long, own double, other double, silhouette double")


_NAMES = ["key", "cluster", "own", "other", "silhouette"]
