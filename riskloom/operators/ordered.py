"""Ordered primitives that scale: exact running sums and exact quantiles.

A window with ``orderBy`` but no (or a coarse) ``partitionBy`` runs in one
task. Every ordered statistic of the workflow (AUC, KS, ROC, average
precision, percentile edges, stratified ranks) is built instead on
:func:`prefix_sums`, which

1. works on data already collapsed to one row per distinct order value
   (ties collapse map-side, so a hot value is a single row);
2. if a group is larger than ``bucket_rows`` rows, cuts it into value
   ranges by ``percentile_approx`` edges (a bounded, mergeable sketch);
3. computes bucket totals (tiny), turns them into exclusive offsets with a
   window over the totals, and joins them back;
4. runs the running-sum window per ``(group, bucket)``.

The result is exact whatever the edges are: a distinct value never spans
two buckets, and offsets carry everything below the bucket.

Statistics per group stay a table (:class:`Groups`) that is joined on the
keys, NULL keys included: any number of groups; the driver sees one summary
row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest number of collapsed rows we let one window task sort.
DEFAULT_BUCKET_ROWS = 2_000_000
# Broadcast a helper table only when it has at most this many rows.
BROADCAST_ROWS = 200_000
# Below this many collapsed rows a plain window is cheapest.
PARALLEL_MIN_ROWS = 1_000_000
# Fewest rows worth a task of their own.
TASK_MIN_ROWS = 10_000
# Equal-width histogram bins used to locate quantile ranks.
HIST_BINS = 1024
# Most buckets that one level of cuts makes per group; larger groups are cut again inside their buckets.
LEVEL_BUCKETS = 256


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as parquet under the shared ``spark.checkpoint.dir`` and read it back.

    For intermediate tables that several later jobs read (collapsed value
    counts): the upstream scan runs once, the lineage is cut (a lost
    executor re-reads the files instead of replaying the scan), and later
    reads are split across many files.
    """
    import uuid

    from riskloom.session import scratch_root

    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def task_rows(df: DataFrame, total: int) -> int:
    """Bucket size that gives every core about two of ``total`` rows' buckets; small tables stay in few tasks."""
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return min(DEFAULT_BUCKET_ROWS, max(TASK_MIN_ROWS, math.ceil(total / (2 * cores))))


class Groups(NamedTuple):
    """Statistics per group as a written table, and what the driver needs to plan."""

    table: DataFrame
    n_groups: int
    total: int
    max_rows: int

    @property
    def small(self) -> bool:
        return self.n_groups <= BROADCAST_ROWS


def group_stats(df: DataFrame, keys: Sequence[str], **aggs: Column) -> Groups:
    """Rows per group (``_rows``) and ``aggs``; without keys one row for the whole table."""
    exprs = [F.count(F.lit(1)).alias("_rows"), *[e.alias(k) for k, e in aggs.items()]]
    table = materialize(df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs), "groups")
    r = table.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("t"), F.max("_rows").alias("m")).first()
    return Groups(table, r["n"], r["t"] or 0, r["m"] or 0)


def attach_groups(df: DataFrame, keys: Sequence[str], groups: Groups, cols: Sequence[str]) -> DataFrame:
    """Add per-group columns of ``groups`` to ``df`` (literals without keys)."""
    if not keys:
        r = groups.table.select(*cols).first()
        return df.withColumns({c: F.lit(r[c]).cast(groups.table.schema[c].dataType) for c in cols})
    return join_groups(df, groups.table.select(*keys, *cols), keys, groups.small)


def attach_rows(df: DataFrame, keys: Sequence[str], rows: list[dict], cols: Sequence[str]) -> DataFrame:
    """Add per-group scalars that the driver holds (features or classes in use) to ``df``."""
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    fields = [f for f in df.schema.fields if f.name in keys]
    for k in cols:
        sample = next((r[k] for r in rows if r.get(k) is not None), None)
        fields.append(StructField(k, LongType() if isinstance(sample, int) else DoubleType(), True))
    data = [tuple(r.get(f.name) for f in fields) for r in rows]
    return join_groups(df, df.sparkSession.createDataFrame(data, StructType(fields)), keys, len(rows) <= BROADCAST_ROWS)


def join_groups(df: DataFrame, table: DataFrame, keys: Sequence[str], broadcast: bool, how: str = "inner") -> DataFrame:
    """Join on group keys in which NULL is a group like any other: an inner join with all groups loses no row.

    ``broadcast`` is the caller's check of the row count; without it the join
    is a sort-merge join, since a file of many rows can be small enough for
    Spark to broadcast it.
    """
    other = {k: f"_key{i}" for i, k in enumerate(keys)}
    table = table.withColumnsRenamed(other)
    cond = None
    for k, o in other.items():
        same = F.col(k).eqNullSafe(F.col(o))
        cond = same if cond is None else cond & same
    return df.join(F.broadcast(table) if broadcast else table.hint("merge"), cond, how).drop(*other.values())


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    *,
    groups: Groups | None = None,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    suffix: str = "_cum",
) -> DataFrame:
    """Add ``<c><suffix>`` = running inclusive sum of ``c`` in ascending ``order``.

    ``df`` must hold one row per ``(keys, order)`` (collapse ties first).
    ``order[0]`` must be numeric: it is the column that buckets are cut on;
    later order columns only break ties inside a bucket.
    ``groups`` (from :func:`group_stats`; with ``_min`` and ``_max`` of
    ``order[0]`` few groups are cut into ranges without a further job) saves
    a job.
    """
    keys, order = list(keys), list(order)
    groups = group_stats(df, keys) if groups is None else groups
    o0 = order[0]

    def plain(d: DataFrame) -> DataFrame:
        w = (Window.partitionBy(*keys) if keys else Window).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return d.withColumns({f"{x}{suffix}": F.sum(x).over(w) for x in cols})

    if groups.max_rows <= bucket_rows:
        nb = 2 * max(1, df.sparkSession.sparkContext.defaultParallelism)
        ranged = {"_min", "_max"} <= set(groups.table.columns)
        if groups.total < PARALLEL_MIN_ROWS or not ranged or groups.n_groups >= nb:
            return plain(df)
        # Each group fits one task, but few groups would leave cores idle and
        # sort long runs of equal keys: cut equal-width value ranges between
        # the group's min and max (known from the stats job) - no extra job.
        b = _width_bins(attach_groups(df, keys, groups, ["_min", "_max"]), o0, nb, "_bucket")
        return bucket_sums(b, keys, ["_bucket"], order, cols, groups.n_groups * nb, suffix)

    if keys:
        # only groups beyond the limit are cut; there are at most total / bucket_rows of them
        over = groups.table.where(F.col("_rows") > bucket_rows).select(*keys)
        few = groups.total // bucket_rows <= BROADCAST_ROWS
        b, levels, n_small = _cut_groups(join_groups(df, over, keys, few, "left_semi"), keys, o0, groups.max_rows, bucket_rows)
        cut = bucket_sums(b, keys, levels, order, cols, n_small, suffix)
        return plain(join_groups(df, over, keys, few, "left_anti")).unionByName(cut)
    # one global set of edges: binary search via Bucketizer
    from pyspark.ml.feature import Bucketizer

    n_buckets = int(math.ceil(groups.max_rows / bucket_rows))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    e = df.agg(F.percentile_approx(o0, probs, max(10_000, 20 * n_buckets)).alias("e")).collect()[0]["e"] or []
    splits = [float("-inf")] + sorted({float(v) for v in e if not math.isnan(v)}) + [float("inf")]
    b = df.withColumn("_o0", F.col(o0).cast("double"))
    b = Bucketizer(splits=splits, inputCol="_o0", outputCol="_bk", handleInvalid="keep").transform(b)
    # NULL sorts before every value (as in a plain window); NaN has the extra last bucket
    b = b.withColumn("_bucket", F.when(F.col("_o0").isNull(), F.lit(-1)).otherwise(F.col("_bk").cast("int"))).drop("_o0", "_bk")
    return bucket_sums(b, keys, ["_bucket"], order, cols, n_buckets + 2, suffix)


def _width_bins(df: DataFrame, value: str, n_bins: int, out: str) -> DataFrame:
    """Add the equal-width bin of ``value`` between ``_min`` and ``_max`` (dropped); NaN in the last one."""
    x = F.col(value)
    span = (F.col("_max") - F.col("_min")).cast("double")
    pos = F.floor(F.try_divide((x - F.col("_min")).cast("double"), span) * n_bins)
    place = (
        F.when(F.isnan(x.cast("double")), F.lit(n_bins - 1))
        .when(span > 0, F.least(F.greatest(pos, F.lit(0)), F.lit(n_bins - 1)))
        .otherwise(F.lit(0))
    )
    return df.withColumn(out, place.cast("int")).drop("_min", "_max")


def _cut_groups(df: DataFrame, keys: list, o0: str, max_rows: int, bucket_rows: int) -> tuple[DataFrame, list[str], int]:
    """Value-range buckets of about ``bucket_rows`` rows inside every group.

    Each level cuts by at most LEVEL_BUCKETS approximate quantiles per group
    (a codegen'd count of edges below the value; NULL counts as below all,
    NaN as above all); while a bucket is still too large, the next level cuts
    inside the buckets. Stops when cutting no longer helps (one hot value).
    """
    from riskloom.functions.exprs import bin_value

    levels: list[str] = []
    while True:
        n = min(int(math.ceil(max_rows / bucket_rows)), LEVEL_BUCKETS)
        probs = [i / n for i in range(1, n)]
        by = [*keys, *levels]
        edges = df.groupBy(*by).agg(F.percentile_approx(o0, probs, max(10_000, 20 * n)).alias("_edges"))
        level = f"_bucket{len(levels)}"
        df = join_groups(df, edges, by, False).withColumn(level, bin_value("_edges", F.col(o0), n)).drop("_edges")
        levels.append(level)
        row = df.groupBy(*by, level).agg(F.count(F.lit(1)).alias("c")).agg(F.max("c").alias("m"), F.count(F.lit(1)).alias("n")).first()
        if row["m"] <= 2 * bucket_rows or row["m"] >= max_rows:
            return df, levels, row["n"]
        max_rows = row["m"]


def bucket_sums(
    b: DataFrame, keys: Sequence[str], levels: Sequence[str], order: Sequence[str], cols: Sequence[str], n_small: int, suffix: str = "_cum"
) -> DataFrame:
    """Exact running sums given value-range bucket columns: bucket totals (``n_small`` rows) ->
    exclusive offsets -> joined back -> window per (bucket, group). The bucket comes first:
    it has more values than the groups, so a sort mostly compares that."""
    bk = [*keys, *levels]
    totals = b.groupBy(*bk).agg(*[F.sum(x).alias(f"_t_{x}") for x in cols])
    wt = (Window.partitionBy(*keys) if keys else Window).orderBy(*levels).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *bk, *[F.coalesce(F.sum(f"_t_{x}").over(wt), F.lit(0)).alias(f"_o_{x}") for x in cols]
    )
    b = join_groups(b, offsets, bk, n_small <= BROADCAST_ROWS)
    w = Window.partitionBy(*levels, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = b.withColumns({f"{x}{suffix}": F.col(f"_o_{x}") + F.sum(x).over(w) for x in cols})
    return out.drop(*levels, *[f"_o_{x}" for x in cols])


def _target_ranks(groups: Groups, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, _j, _pos, _rlo, _rhi): the wanted position of every prob in every group, and the ranks around it."""
    n = F.col("_n") - 1
    spots = F.array(*[F.struct(F.lit(j).alias("_j"), (n.cast("double") * F.lit(float(p))).alias("_pos")) for j, p in enumerate(probs)])
    t = groups.table.where("_n > 0").select(*keys, F.explode(spots).alias("_t")).select(*keys, "_t.*")
    return t.withColumns({"_rlo": F.floor("_pos"), "_rhi": F.ceil("_pos")})


def _selected_bins(
    coll: DataFrame, keys: list, value: str, targets: DataFrame, groups: Groups, n_targets: int, bucket_rows: int
) -> DataFrame | None:
    """Rows of the histogram bins that hold a target rank, with exact ``_w_cum``.

    An equal-width histogram per group (exact counts, at most groups x bins
    rows, a written table) tells by a window per group which bins hold a
    target rank and how many rows lie below them; only those bins are sorted.
    Returns None (caller sorts everything with the bucketed prefix sum) when a
    needed bin holds more than ``bucket_rows`` values.
    """
    b = _width_bins(attach_groups(coll, keys, groups, ["_min", "_max"]), value, HIST_BINS, "_bin")
    hist = b.groupBy(*keys, "_bin").agg(F.sum("_w").alias("_c"), F.count(F.lit(1)).alias("_d"))
    line = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_below", F.coalesce(F.sum("_c").over(line), F.lit(0)))
    ranks = targets.groupBy(*keys).agg(F.collect_set("_rlo").alias("_lo"), F.collect_set("_rhi").alias("_hi"))  # probs of one group
    few = groups.n_groups * n_targets <= BROADCAST_ROWS
    held = lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_c"))
    need = join_groups(hist, ranks, keys, few).where(F.exists("_lo", held) | F.exists("_hi", held))
    need = materialize(need.select(*keys, "_bin", "_below", "_d"), "bins")
    if (need.agg(F.max("_d")).first()[0] or 0) > bucket_rows:
        return None
    picked = join_groups(b, need.drop("_d"), [*keys, "_bin"], few)
    w = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return picked.withColumn("_w_cum", F.col("_below") + F.sum("_w").over(w)).drop("_bin", "_below")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    weight: str | None = None,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    collapsed: bool = False,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, fully distributed, for any number of groups.

    Returns ``(keys..., edges array<double>)`` with one entry per prob, in
    prob order. Same rule as ``quantile_cont`` / NumPy ``linear``: position
    ``(n-1)*p``, value ``lo + (hi-lo)*(pos-floor(pos))``. NULL values are
    ignored. ``weight`` names a count column when ``df`` is already
    collapsed to ``(keys, value, weight)``; ``collapsed=True`` says it already
    holds one row per ``(keys, value)``.

    The rows holding the target ranks are found through an exact
    equal-width histogram (see :func:`_selected_bins`), so only a few bins
    are sorted; with a bin too large (heavy skew) the bucketed prefix sum
    over all values is used instead. Both are exact. Group statistics,
    histograms and target ranks are tables, joined on the keys.
    """
    given = list(keys)
    keys = given or ["_all"]
    base = df.where(F.col(value).isNotNull())
    if not given:
        base = base.withColumn("_all", F.lit(0))
    if collapsed:
        coll = base.select(*keys, value, F.col(weight).cast("long").alias("_w"))
    elif weight is None:
        coll = base.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w"))
    else:
        coll = base.groupBy(*keys, value).agg(F.sum(weight).cast("long").alias("_w"))
    coll = materialize(coll, "values")
    groups = group_stats(coll, keys, _n=F.sum("_w"), _min=F.min(value), _max=F.max(value))
    targets = _target_ranks(groups, keys, probs)
    pre = _selected_bins(coll, keys, value, targets, groups, len(probs), bucket_rows)
    if pre is None:
        pre = prefix_sums(coll, keys, [value], ["_w"], groups=groups, bucket_rows=bucket_rows)
    # a collapsed row covers ranks _w_cum - _w .. _w_cum - 1; at most 2 rows per target hold one of its ranks
    hits = join_groups(pre, targets, keys, groups.n_groups * len(probs) <= BROADCAST_ROWS)
    start, end = F.col("_w_cum") - F.col("_w"), F.col("_w_cum") - 1
    is_lo, is_hi = F.col("_rlo").between(start, end), F.col("_rhi").between(start, end)
    per_q = hits.where(is_lo | is_hi).groupBy(*keys, F.col("_j").alias("j")).agg(
        F.max(F.when(is_lo, F.col(value).cast("double"))).alias("_lo"),
        F.max(F.when(is_hi, F.col(value).cast("double"))).alias("_hi"),
        F.max("_pos").alias("_pos"),
    )
    step = (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor(F.col("_pos")))
    q = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") + step)
    edges = F.transform(F.array_sort(F.collect_list(F.struct("j", q.alias("q")))), lambda s: s["q"]).alias("edges")
    out = per_q.groupBy(*keys).agg(edges)  # one entry per prob
    return out if given else out.select("edges")
