"""Ranking and calibration metrics, computed off one cumulative pass.

All ordered metrics share :func:`cumulative_table`: scores are collapsed
to one row per distinct ``(group, score)`` with positive/negative counts
(ties must collapse for correctness and it makes hot scores cheap), then
running sums come from the bucketed :func:`prefix_sums`. ``keys`` turns
every metric into a grouped one (per model, split, fold, period,
subgroup) with no extra code and no single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import bin_right_lit
from riskloom.operators.ordered import attach_groups, group_stats, materialize, prefix_sums


def _base(df: DataFrame, score: str, label: str, keys: Sequence[str], count: str | None = None) -> DataFrame:
    copies = [] if count is None else [F.col(count).cast("long").alias("_copies")]
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *keys, F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"), *copies
    )


def cumulative_table(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """One row per distinct ``(keys, s)``: pos, neg, inclusive ascending
    running sums ``pos_cum``/``neg_cum`` and group totals ``P``/``N``.
    ``count`` names a column that says how many rows a row stands for."""
    keys = list(keys)
    copies = F.lit(1) if count is None else F.col("_copies")
    coll = (
        _base(df, score, label, keys, count)
        .groupBy(*keys, "s")
        .agg(F.sum(copies * F.col("y")).cast("long").alias("pos"), F.sum(copies * (1 - F.col("y"))).cast("long").alias("neg"))
    )
    # the stats job and the final plan both read the collapsed scores: write
    # them once so the upstream plan runs once
    coll = materialize(coll, "scores")
    groups = group_stats(coll, keys, P=F.sum("pos"), N=F.sum("neg"), _min=F.min("s"), _max=F.max("s"))
    pre = prefix_sums(coll, keys, ["s"], ["pos", "neg"], groups=groups)
    return attach_groups(pre, keys, groups, ["P", "N"])


def _tp_fp(t: DataFrame) -> tuple[Column, Column]:
    """Counts predicted positive at threshold = this score (s >= t)."""
    tp = F.col("P") - F.col("pos_cum") + F.col("pos")
    fp = F.col("N") - F.col("neg_cum") + F.col("neg")
    return tp, fp


def _auc_expr() -> Column:
    num = F.sum(F.col("pos").cast("double") * (F.col("neg_cum") - F.col("neg") / 2.0))
    return F.try_divide(num, F.max("P").cast("double") * F.max("N").cast("double"))


def _ks_expr() -> Column:
    tp, fp = _tp_fp(None)
    d = F.try_divide(tp.cast("double"), F.col("P").cast("double")) - F.try_divide(
        fp.cast("double"), F.col("N").cast("double")
    )
    return F.greatest(F.max(d), F.lit(0.0))


def _ap_expr() -> Column:
    tp, fp = _tp_fp(None)
    prec = tp.cast("double") / (tp + fp).cast("double")
    return F.try_divide(F.sum(F.col("pos") * prec), F.max("P").cast("double"))


def _group(t: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return t.groupBy(*keys).agg(*aggs) if keys else t.agg(*aggs)


def auc_gini(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """ROC AUC (ties count one half) and Gini = 2*AUC - 1, per group."""
    t = cumulative_table(df, score, label, keys, count)
    out = _group(t, keys, _auc_expr().alias("auc"))
    return out.withColumn("gini", 2 * F.col("auc") - 1)


def ks_stat(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """KS = max(TPR - FPR) over distinct thresholds (including the empty one)."""
    t = cumulative_table(df, score, label, keys)
    return _group(t, keys, _ks_expr().alias("ks"))


def avg_precision(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Average precision = sum over thresholds of (recall step) * precision."""
    t = cumulative_table(df, score, label, keys)
    return _group(t, keys, _ap_expr().alias("avg_precision"))


def brier(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    b = _base(df, score, label, keys)
    return _group(b, keys, F.avg(F.pow(F.col("s") - F.col("y"), 2)).alias("brier"))


def evaluate_model(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """One metrics row per group from a single cumulative pass:
    n, event_rate, auc, gini, ks, avg_precision, brier."""
    keys = list(keys)
    t = cumulative_table(df, score, label, keys)
    t = t.withColumn("_sq", F.col("pos") * F.pow(F.col("s") - 1, 2) + F.col("neg") * F.pow(F.col("s"), 2))
    out = _group(
        t,
        keys,
        (F.max("P") + F.max("N")).alias("n"),
        (F.max("P") / (F.max("P") + F.max("N"))).alias("event_rate"),
        _auc_expr().alias("auc"),
        _ks_expr().alias("ks"),
        _ap_expr().alias("avg_precision"),
        (F.sum("_sq") / (F.max("P") + F.max("N"))).alias("brier"),
    )
    return out.withColumn("gini", 2 * F.col("auc") - 1)


def ks_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative event / non-event shares by ascending score; ``diff`` = their gap."""
    t = cumulative_table(df, score, label, keys)
    return t.select(
        *keys,
        F.col("s").alias("score"),
        (F.col("pos_cum") / F.col("P")).alias("cum_events"),
        (F.col("neg_cum") / F.col("N")).alias("cum_nonevents"),
        F.abs(F.col("pos_cum") / F.col("P") - F.col("neg_cum") / F.col("N")).alias("diff"),
    )


def roc_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, plus the (0, 0, +inf) point."""
    t = cumulative_table(df, score, label, keys)
    tp, fp = _tp_fp(t)
    pts = t.select(
        *keys,
        (fp / F.col("N")).alias("fpr"),
        (tp / F.col("P")).alias("tpr"),
        F.col("s").alias("threshold"),
    )
    origin = t.select(*keys).distinct() if keys else df.sparkSession.range(1)
    origin = origin.select(
        *keys, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return pts.unionByName(origin)


# Right-closed inner edges of ten equal-width probability bins
def calibration_curve(df: DataFrame, score: str, label: str, n_bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins on [0,1] (right-closed, 0 in the first); empty bins dropped."""
    edges = [i * (1.0 / n_bins) for i in range(0, n_bins + 1)]
    b = _base(df, score, label, keys).withColumn("bin", bin_right_lit(edges, "s"))
    return b.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("s").alias("mean_predicted"),
        F.avg("y").alias("fraction_positives"),
    )


def score_histogram(
    df: DataFrame, score: str, label: str, lo: float = 300.0, hi: float = 850.0, n_bins: int = 39
) -> DataFrame:
    """Equal-width density histogram of scores by class (NumPy ``histogram`` rule:
    left-closed bins, last bin closed)."""
    width = (hi - lo) / n_bins
    b = _base(df, score, label, [])
    b = b.where((F.col("s") >= lo) & (F.col("s") <= hi))
    idx = F.least(F.floor((F.col("s") - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1)).cast("int")
    counts = b.groupBy("y", idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    totals = b.groupBy("y").agg(F.count(F.lit(1)).alias("n_class"))
    out = counts.join(F.broadcast(totals), "y")
    return out.select(
        "y",
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        "n",
        (F.col("n") / (F.col("n_class") * F.lit(width))).alias("density"),
    )


def model_comparison(df: DataFrame, score: str, label: str, keys: Sequence[str] = ("model", "split")) -> DataFrame:
    """All models/splits side by side (long table of scores -> one metrics row each)."""
    return evaluate_model(df, score, label, keys)
