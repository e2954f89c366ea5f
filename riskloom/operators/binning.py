"""Quantile edges, WoE/IV tables and the WoE transform.

All features are handled together: the wide table is unpivoted to
``(feature, x, y)`` inside the scan, edges come from
:mod:`riskloom.operators.quantiles`, and rows are counted per
``(feature, bin)``. Every shuffle carries partial aggregates of at most
features x bins rows a task; values themselves are never shuffled or
written. String features are categories: one bin per value of a fitted
vocabulary, the rarest values together where there are more than the bins
allow. Fitted state (edges, WoE per bin) is bounded by features x bins
and is applied as literal expressions: no join, no shuffle at transform time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions import constants as K
from riskloom.functions.exprs import bin_left_lit, bin_right_lit, bin_value_lit
from riskloom.operators.ordered import attach_rows, materialize
from riskloom.operators.quantiles import bin_values, first_histogram, quantiles, value_stats


# pandas qcut asks for linspace(0, 1, q+1): i * (1/q) ...
def qcut_probs(q: int) -> list[float]:
    step = 1.0 / q
    return [i * step for i in range(q + 1)]


# ... NumPy percentile of linspace(0, 100, q+1) divides by 100
def percentile_probs(q: int) -> list[float]:
    step = 100.0 / q
    return [(i * step) / 100.0 for i in range(q + 1)]


def unpivot_features(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Wide -> long ``(extra..., feature, x double)``; NULL x dropped."""
    features = list(features)
    cols = [*extra, *[F.col(f"`{f}`").cast("double").alias(f) for f in features]]
    w = df.select(*cols)
    if len(features) == 1:
        long = w.select(*extra, F.lit(features[0]).alias("feature"), F.col(f"`{features[0]}`").alias("x"))
    else:
        long = w.unpivot(list(extra) if extra else [], features, "feature", "x")
    return long.where(F.col("x").isNotNull())


def feature_quantiles(df: DataFrame, features: Sequence[str], probs: Sequence[float], stats=None, first=None) -> dict[str, list[float]]:
    """:func:`quantiles` per feature; passes after the first unpivot only the features that need them."""
    return quantiles(unpivot_features(df, features), "feature", "x", probs, stats, first, lambda some: unpivot_features(df, some))


def quantile_edges(
    df: DataFrame, features: Sequence[str], q: int = 10, probs: Sequence[float] | None = None, where: Column | None = None
) -> DataFrame:
    """``(feature, edges)``: sorted unique exact quantiles per feature."""
    q_ = feature_quantiles(df if where is None else df.where(where), features, probs if probs is not None else qcut_probs(q))
    rows = [(f, list(dict.fromkeys(e))) for f, e in sorted(q_.items())]
    return df.sparkSession.createDataFrame(rows, "feature string, edges array<double>")


def _woe_columns(g: DataFrame) -> DataFrame:
    pe = F.greatest(F.col("n_events") / F.col("E"), F.lit(K.WOE_PCT_FLOOR))
    pn = F.greatest(F.col("n_nonevents") / F.col("N"), F.lit(K.WOE_PCT_FLOOR))
    g = g.withColumns({"pct_events": pe, "pct_nonevents": pn})
    g = g.withColumn("woe", F.log(F.col("pct_events") / F.col("pct_nonevents")))
    return g.withColumn("iv", (F.col("pct_events") - F.col("pct_nonevents")) * F.col("woe"))


# (kind, edges): 'value' and 'quantile' hold doubles, 'category' and 'top' (category plus a bin for all others) hold texts
Bins = dict[str, tuple[str, list]]


def is_text(df: DataFrame, feature: str) -> bool:
    return isinstance(df.schema[feature].dataType, StringType)


def fit_vocabulary(df: DataFrame, features: Sequence[str], label: str, n_bins: int = K.WOE_MAX_BINS) -> tuple[Bins, list[dict]]:
    """Categories of string features, and per-feature stats.

    Up to ``n_bins`` distinct values: one bin each. More: the ``n_bins - 1``
    most frequent ones (ties: the smaller text) and one bin for the others.
    Values are counted per (feature, value); at most ``n_bins + 1`` rows a
    feature reach the driver.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").alias("v")) for f in features])
    long = df.select(F.col(label).cast("long").alias("ev"), F.explode(cells).alias("c")).select("ev", "c.*").where("v IS NOT NULL")
    counts = long.groupBy("feature", "v").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "v"))
    top: dict[str, list[str]] = {}
    for r in counts.withColumn("place", place).where(F.col("place") <= n_bins + 1).orderBy("place").collect():
        top.setdefault(r["feature"], []).append(r["v"])
    bins: Bins = {
        f: ("category", sorted(v)) if len(v) <= n_bins else ("top", sorted(v[: n_bins - 1])) for f, v in top.items()
    }
    totals = long.groupBy("feature").agg(F.sum("ev").alias("E"), F.count("ev").alias("n")).collect()
    return bins, [{"feature": r["feature"], "E": r["E"], "N": r["n"] - r["E"]} for r in totals]


def fit_bins(
    df: DataFrame, features: Sequence[str], label: str = "y", n_bins: int = K.WOE_MAX_BINS
) -> tuple[Bins, list[dict]]:
    """Returns (edges, per-feature stats).

    Edges per numeric feature: ('value', distinct values) with <= n_bins of them
    (one bin per value), else ('quantile', qcut edges). The first histogram of the
    quantiles shows the values of most features that have few; where its few bins
    hold several values each, an approximate distinct count says whether the values
    are looked at one by one.
    String features: see :func:`fit_vocabulary`.
    """
    df = df.where(F.col(label).isNotNull())
    texts = [f for f in features if is_text(df, f)]
    edges, rows = fit_vocabulary(df, texts, label, n_bins) if texts else ({}, [])
    features = [f for f in features if f not in texts]
    if not features:
        return edges, rows
    long = unpivot_features(df, features, extra=[label]).select("feature", "x", F.col(label).cast("long").alias("ev"))
    stats = value_stats(long, "feature", "x", E=F.sum("ev"))
    first = first_histogram(long, "feature", "x", stats)
    values = {f: bin_values(cells) for f, cells in first.items() if len(cells) <= n_bins}
    unclear = [f for f, v in values.items() if v is None]
    values = {f: v for f, v in values.items() if v is not None}
    if unclear:
        near = value_stats(unpivot_features(df, unclear), "feature", "x", d=F.approx_count_distinct("x"))
        few = [f for f, r in near.items() if r["d"] <= 4 * n_bins]
        if few:
            for r in unpivot_features(df, few).select("feature", "x").distinct().orderBy("feature", "x").collect():
                values.setdefault(r["feature"], []).append(r["x"])
    edges |= {f: ("value", v) for f, v in values.items() if len(v) <= n_bins}
    many = [f for f in stats if f not in edges]
    if many:
        got = feature_quantiles(df, many, qcut_probs(n_bins), {f: stats[f] for f in many}, first)
        edges |= {f: ("quantile", list(dict.fromkeys(e))) for f, e in got.items()}
    return edges, rows + [{"feature": f, "E": r["E"], "N": r["n"] - r["E"]} for f, r in stats.items()]


def bin_category_lit(values: Sequence[str], x: Column, others: bool) -> Column:
    """Index of a text among ``values``; any other text gets the next index (``others``) or none."""
    if not values:
        return F.when(x.isNotNull(), F.lit(0)) if others else F.lit(None).cast("int")
    out = None
    for i, v in enumerate(values):
        out = F.when(x == v, F.lit(i)) if out is None else out.when(x == v, F.lit(i))
    return out.when(x.isNotNull(), F.lit(len(values))) if others else out


def _bin_lit(kind: str, edges: list, x: Column) -> Column:
    if kind in ("category", "top"):
        return bin_category_lit(edges, x, kind == "top")
    return {"value": bin_value_lit, "quantile": bin_right_lit, "left": bin_left_lit}[kind](edges, x.cast("double"))


def binned_rows(df: DataFrame, edges: Bins, extra: Sequence[Column]) -> DataFrame:
    """Long ``(extra..., feature, bin, x)`` with the fitted edges as literals; NULL values dropped (x of a text is NULL)."""
    if not edges:
        return df.select(*extra, F.lit("").alias("feature"), F.lit(0).alias("bin"), F.lit(0.0).alias("x")).limit(0)
    cells = []
    for f, (kind, e) in edges.items():
        v = F.col(f"`{f}`")
        x = F.lit(None).cast("double") if kind in ("category", "top") else v.cast("double")
        b = F.when(v.isNotNull() if kind in ("category", "top") else x.isNotNull(), _bin_lit(kind, e, v).cast("int"))
        cells.append(F.struct(F.lit(f).alias("feature"), b.alias("bin"), x.alias("x")))
    return df.select(*extra, F.explode(F.array(*cells)).alias("_c")).select("*", "_c.*").drop("_c").where(F.col("bin").isNotNull())


def _count_bins(df: DataFrame, label: str, edges: Bins, stats: list[dict]) -> DataFrame:
    """Counts and value range per (feature, bin), with the totals E and N of features that have both classes."""
    rows = binned_rows(df.where(F.col(label).isNotNull()), edges, [F.col(label).cast("long").alias("_ev")])
    g = rows.groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum("_ev").alias("n_events"),
        F.min("x").alias("bin_lo"),
        F.max("x").alias("bin_hi"),
    )
    kinds = F.create_map(*[F.lit(x) for f, (kind, _) in edges.items() for x in (f, kind)]) if edges else None
    g = g.withColumns({
        "kind": F.element_at(kinds, F.col("feature")) if edges else F.lit("quantile"),
        "n_nonevents": F.col("n_total") - F.col("n_events"),
    })
    return attach_rows(g, ["feature"], stats, ["E", "N"]).where((F.col("E") > 0) & (F.col("N") > 0))


def woe_table(
    df: DataFrame, features: Sequence[str], label: str = "y", n_bins: int = K.WOE_MAX_BINS
) -> DataFrame:
    """Per (feature, bin): n_total, n_events, n_nonevents, event_rate, pct_events,
    pct_nonevents (floored at 1e-9), woe, iv, bin_lo/bin_hi (value range seen).

    Rows with NULL x or y are dropped per feature; features whose target has
    one class are skipped (their IV is 0). A bin of a string feature has no
    value range; :func:`bin_labels` names it.
    """
    edges, stats = fit_bins(df, features, label, n_bins)
    return _woe_rows(df, label, edges, stats)


def _woe_rows(df: DataFrame, label: str, edges: Bins, stats: list[dict]) -> DataFrame:
    g = _count_bins(df, label, edges, stats)
    g = g.withColumn("event_rate", F.col("n_events") / F.col("n_total"))
    g = _woe_columns(g)
    return g.select(
        "feature", "bin", "kind", "bin_lo", "bin_hi", "n_total", "n_events", "n_nonevents", "event_rate",
        "pct_events", "pct_nonevents", "woe", "iv",
    )


OTHERS = "(others)"


def bin_labels(edges: Bins) -> list[tuple[str, int, str]]:
    """(feature, bin, label) of fitted bins: a value, a right-closed interval, a category, or all others."""
    out = []
    for f, (kind, e) in edges.items():
        if kind in ("category", "top"):
            names = [*e, OTHERS] if kind == "top" else e
        elif kind == "value":
            names = [f"{v:g}" for v in e]
        else:
            names = [f"({a:g}, {b:g}]" for a, b in zip(e, e[1:])] or [f"{e[0]:g}"]
        out += [(f, i, n) for i, n in enumerate(names)]
    return out


def labelled_woe_table(df: DataFrame, features: Sequence[str], label: str = "y", n_bins: int = K.WOE_MAX_BINS) -> DataFrame:
    """:func:`woe_table` with the ``label`` of every bin (features x bins names, a broadcast join)."""
    edges, stats = fit_bins(df, features, label, n_bins)
    names = df.sparkSession.createDataFrame(bin_labels(edges), "feature string, bin int, label string")
    return _woe_rows(df, label, edges, stats).join(F.broadcast(names), ["feature", "bin"], "left")


def iv_table(woe: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """IV per feature (rounded 4), number of bins, flag; sorted by IV desc.

    ``features`` lists every feature that was binned, so skipped one-class
    features appear with IV 0 and 0 bins.
    """
    g = woe.groupBy("feature").agg(F.sum("iv").alias("iv_raw"), F.count(F.lit(1)).alias("n_bins"))
    if features is not None:
        spark = woe.sparkSession
        all_f = spark.createDataFrame([(f,) for f in features], "feature string")
        g = F.broadcast(all_f).join(g, "feature", "left").na.fill({"iv_raw": 0.0, "n_bins": 0})
    flag = (
        F.when(F.col("iv_raw") < K.IV_THRESHOLD_DROP, "DROP (low IV)")
        .when(F.col("iv_raw") > K.IV_THRESHOLD_SUSPICIOUS, "SUSPICIOUS (possible leakage)")
        .otherwise("")
    )
    return g.select(
        "feature", F.round("iv_raw", 4).alias("iv"), F.col("n_bins").cast("long").alias("n_bins"), flag.alias("flag")
    ).orderBy(F.desc("iv"), "feature")


def iv_select(iv: DataFrame) -> DataFrame:
    """Selected features: IV >= 0.02 and not suspicious."""
    return iv.where((F.col("iv") >= K.IV_THRESHOLD_DROP) & ~F.col("flag").contains("SUSPICIOUS"))


def iv_strength(iv: DataFrame) -> DataFrame:
    """Strength band per feature and the count of features per band."""
    band = None
    for hi, name in K.IV_STRENGTH_BANDS:
        cond = F.col("iv") < hi
        band = F.when(cond, name) if band is None else band.when(cond, name)
    band = band.otherwise(K.IV_STRENGTH_TOP)
    return iv.withColumn("strength", band).groupBy("strength").agg(F.count(F.lit(1)).alias("n_features"))


class WoEModel:
    """Fitted edges + WoE per bin, applied as literal expressions (no shuffle)."""

    def __init__(self, edges: Bins, woe: dict[str, dict[int, float]]):
        self.edges = edges
        self.woe = woe

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], label: str = "y", n_bins: int = K.WOE_MAX_BINS):
        e, stats = fit_bins(df, features, label, n_bins)
        return cls._read(e, _woe_columns(_count_bins(df, label, e, stats)))

    @classmethod
    def fit_table(cls, df: DataFrame, features: Sequence[str], label: str = "y", n_bins: int = K.WOE_MAX_BINS) -> tuple["WoEModel", DataFrame]:
        """The model and its written :func:`woe_table`, from one fit of the bins."""
        e, stats = fit_bins(df, features, label, n_bins)
        table = materialize(_woe_rows(df, label, e, stats), "woe")
        return cls._read(e, table), table

    @classmethod
    def _read(cls, edges: Bins, g: DataFrame) -> "WoEModel":
        w: dict[str, dict[int, float]] = {}
        for r in g.select("feature", "bin", "woe").collect():
            w.setdefault(r["feature"], {})[int(r["bin"])] = float(r["woe"])
        return cls(edges, w)

    def bin_expr(self, feature: str) -> Column:
        kind, edges = self.edges[feature]
        return _bin_lit(kind, edges, F.col(f"`{feature}`"))

    def woe_expr(self, feature: str) -> Column:
        table = self.woe.get(feature, {})
        if feature not in self.edges or not table:
            return F.lit(0.0)
        x, zero = F.col(f"`{feature}`"), F.lit(0.0)
        kind, edges = self.edges[feature]
        woe = [F.lit(table.get(i, 0.0)) for i in range(len(edges) + 1)]
        # one chain of comparisons straight to the WoE, the same bins as bin_expr; no value, or one
        # that training never saw and that has no bin: WoE 0
        if kind == "quantile":  # right-closed; the first and the last bin are open, NaN is above all
            out, last = F.when(x.isNull(), zero), max(len(edges) - 2, 0)
            for i, e in enumerate(edges[1:-1]):
                out = out.when(x.cast("double") <= F.lit(float(e)), woe[i])
            return out.otherwise(woe[last])
        out = F.when(x.isNull(), zero)
        for i, e in enumerate(edges):
            out = out.when(x == F.lit(e) if kind in ("category", "top") else x.cast("double") == F.lit(float(e)), woe[i])
        return out.otherwise(woe[len(edges)] if kind == "top" else zero)

    def transform(self, df: DataFrame, features: Sequence[str] | None = None, prefix: str = "WOE_") -> DataFrame:
        feats = list(features if features is not None else self.edges)
        return df.withColumns({f"{prefix}{f}": self.woe_expr(f) for f in feats})


def psi_table(
    df: DataFrame, features: Sequence[str], part_col: str = "part", expected: str = "expected", actual: str = "actual",
    n_bins: int = 10,
) -> DataFrame:
    """Per (feature, bin): exp_pct, act_pct, psi_bin.

    Edges = unique percentiles of the expected side, outer edges open;
    bins are left-closed; empty bins get 1e-6. Both sides are counted per
    (feature, bin) over a single scan.
    """
    sides = df.where(F.col(part_col).isin(expected, actual))
    e = psi_edges(sides.where(F.col(part_col) == expected), features, n_bins)
    rows = binned_rows(sides, e, [F.col(part_col).alias("_part")])
    counts = rows.groupBy("feature", "bin").agg(
        F.count_if(F.col("_part") == expected).alias("c_exp"), F.count_if(F.col("_part") == actual).alias("c_act")
    )
    return psi_rows(counts, e)


def psi_edges(expected: DataFrame, features: Sequence[str], n_bins: int = 10) -> Bins:
    """Unique percentiles per feature; bins are left-closed, the outer ones open."""
    q = feature_quantiles(expected, features, percentile_probs(n_bins))
    return {f: ("left", list(dict.fromkeys(v))) for f, v in q.items()}


def psi_rows(counts: DataFrame, e: Bins) -> DataFrame:
    """PSI per (feature, bin) of ``c_exp`` and ``c_act`` counts; bins that ``counts`` lacks are empty."""
    bins = [(f, i) for f, (_, v) in e.items() for i in range(max(len(v) - 1, 1))]
    spine = counts.sparkSession.createDataFrame(bins, "feature string, bin int")
    t = spine.join(counts, ["feature", "bin"], "left").na.fill({"c_exp": 0, "c_act": 0})
    # features x bins rows
    whole = Window.partitionBy("feature")
    t = t.withColumns({"n_exp": F.sum("c_exp").over(whole), "n_act": F.sum("c_act").over(whole)})
    ep = F.when(F.col("c_exp") > 0, F.col("c_exp") / F.col("n_exp")).otherwise(F.lit(K.PSI_PCT_FLOOR))
    ap = F.when(F.col("c_act") > 0, F.col("c_act") / F.col("n_act")).otherwise(F.lit(K.PSI_PCT_FLOOR))
    t = t.withColumns({"exp_pct": ep, "act_pct": ap})
    t = t.withColumn("psi_bin", (F.col("act_pct") - F.col("exp_pct")) * F.log(F.col("act_pct") / F.col("exp_pct")))
    return t.select("feature", "bin", "c_exp", "c_act", "exp_pct", "act_pct", "psi_bin")


def psi_status(psi: Column) -> Column:
    s, m, h = K.PSI_STATUS
    return F.when(psi < K.PSI_STABLE, s).when(psi < K.PSI_MODERATE, m).when(psi.isNotNull(), h)


def psi_report(df: DataFrame, features: Sequence[str], part_col: str = "part", **kw) -> DataFrame:
    """PSI per feature (rounded 5), status, number of bins; sorted by PSI desc.
    A feature without expected values has 0 bins and neither PSI nor status."""
    return psi_summary(psi_table(df, features, part_col, **kw), features)


def psi_summary(t: DataFrame, features: Sequence[str]) -> DataFrame:
    """PSI per feature of :func:`psi_rows`."""
    g = t.groupBy("feature").agg(F.sum("psi_bin").alias("psi_raw"), F.count(F.lit(1)).alias("n_bins"))
    names = t.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    g = F.broadcast(names).join(g, "feature", "left").na.fill({"n_bins": 0})
    g = g.withColumn("psi", F.round("psi_raw", 5))
    return g.select("feature", "psi", psi_status(F.col("psi")).alias("status"), "n_bins").orderBy(
        F.desc("psi"), "feature"
    )
