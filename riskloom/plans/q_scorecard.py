"""Queries: quantile bins, WoE / IV, WoE transform, points, deciles, logistic fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import binning as B
from riskloom.operators import scorecard as SC
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.sources import fixtures as fx

FEATS = fx.LI_FEATURES


def _dbl_list(vals) -> str:
    return "[" + ", ".join(f"{v!r}::double" for v in vals) + "]"


QCUT = _dbl_list(B.qcut_probs(K.WOE_MAX_BINS))
PCT = _dbl_list(B.percentile_probs(10))


def long_sql(src: str, feats, extra: str = "y", where: str = "") -> str:
    casts = ", ".join(f"cast({f} AS double) AS {f}" for f in feats)
    w = f" WHERE {where}" if where else ""
    return (
        f"SELECT {extra}, feature, x FROM (UNPIVOT (SELECT {extra}, {casts} FROM {src}{w}) "
        f"ON {', '.join(feats)} INTO NAME feature VALUE x) u WHERE x IS NOT NULL"
    )


def woe_ctes(src: str = "li_risk", feats=FEATS, label: str = "y") -> str:
    """CTE text ending in ``woe`` (one row per feature x bin)."""
    return f"""
long AS ({long_sql(src, feats, label, f'{label} IS NOT NULL')}),
coll AS (SELECT feature, x, count(*) AS n, sum({label}) AS ev FROM long GROUP BY feature, x),
fs AS (SELECT feature, count(*) AS d, sum(ev) AS tot_ev, sum(n) - sum(ev) AS tot_ne FROM coll GROUP BY feature),
vals AS (SELECT feature, list_sort(list(x)) AS v FROM coll
         WHERE feature IN (SELECT feature FROM fs WHERE d <= {K.WOE_MAX_BINS}) GROUP BY feature),
qs AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, {QCUT}))) AS q FROM long GROUP BY feature),
ed AS (SELECT fs.feature, CASE WHEN d <= {K.WOE_MAX_BINS} THEN 'value' ELSE 'quantile' END AS kind,
              CASE WHEN d <= {K.WOE_MAX_BINS} THEN v ELSE q END AS edges, tot_ev, tot_ne
       FROM fs LEFT JOIN vals ON fs.feature = vals.feature JOIN qs ON fs.feature = qs.feature),
binned AS (SELECT c.feature, c.x, c.n, c.ev, ed.kind, ed.tot_ev, ed.tot_ne,
             cast(CASE WHEN kind = 'value' THEN len(list_filter(edges, lambda z: z < c.x))
                  ELSE len(list_filter(edges[2:len(edges) - 1], lambda z: z < c.x)) END AS int) AS bin
           FROM coll c JOIN ed ON c.feature = ed.feature),
g AS (SELECT feature, bin, any_value(kind) AS kind, min(x) AS bin_lo, max(x) AS bin_hi,
             cast(sum(n) AS bigint) AS n_total, cast(sum(ev) AS bigint) AS n_events,
             any_value(tot_ev) AS tot_ev, any_value(tot_ne) AS tot_ne
      FROM binned GROUP BY feature, bin),
pw AS (SELECT *, n_total - n_events AS n_nonevents, n_events / cast(n_total AS double) AS event_rate,
              greatest(n_events / cast(tot_ev AS double), {K.WOE_PCT_FLOOR!r}) AS pct_events,
              greatest((n_total - n_events) / cast(tot_ne AS double), {K.WOE_PCT_FLOOR!r}) AS pct_nonevents
       FROM g WHERE tot_ev > 0 AND tot_ne > 0),
woe AS (SELECT feature, bin, kind, bin_lo, bin_hi, n_total, n_events, n_nonevents, event_rate,
               pct_events, pct_nonevents, ln(pct_events / pct_nonevents) AS woe,
               (pct_events - pct_nonevents) * ln(pct_events / pct_nonevents) AS iv
        FROM pw)"""


WOE_DBL = ["bin_lo", "bin_hi", "event_rate", "pct_events", "pct_nonevents", "woe", "iv"]


@register("woe_table", with_fixtures("WITH " + woe_ctes() + " SELECT * FROM woe", "li_risk"), WOE_DBL)
def q_woe_table(spark, sf):
    return B.woe_table(fx.li_risk(spark, sf), FEATS, "y")


SQL_QBINS = f"""
SELECT feature, cast(generate_subscripts(q, 1) AS int) AS edge_idx, unnest(q) AS edge
FROM (SELECT feature, list_sort(list_distinct(quantile_cont(x, {QCUT}))) AS q
      FROM ({long_sql('li_risk', FEATS)}) l GROUP BY feature) t"""


@register("quantile_bins", with_fixtures(SQL_QBINS, "li_risk"), ["edge"])
def q_quantile_bins(spark, sf):
    e = B.quantile_edges(fx.li_risk(spark, sf), FEATS, q=K.WOE_MAX_BINS)
    return e.select("feature", F.posexplode("edges").alias("edge_idx", "edge")).withColumn(
        "edge_idx", (F.col("edge_idx") + 1).cast("int")
    )


LOWCARD = ["l_discount", "l_tax", "ship_year"]
SQL_LOWCARD = f"""
SELECT feature, x AS value, cast(rank() OVER (PARTITION BY feature ORDER BY x) - 1 AS int) AS bin
FROM (SELECT DISTINCT feature, x FROM ({long_sql('li_risk', LOWCARD)}) l) d
WHERE feature IN (SELECT feature FROM (SELECT feature, count(DISTINCT x) AS d
                  FROM ({long_sql('li_risk', LOWCARD)}) l2 GROUP BY feature) WHERE d <= {K.WOE_MAX_BINS})"""


@register("low_card_bins", with_fixtures(SQL_LOWCARD, "li_risk"), ["value"])
def q_low_card_bins(spark, sf):
    """One bin per distinct value for features with <= 10 values."""
    edges, _ = B.fit_bins(fx.li_risk(spark, sf), LOWCARD, "y")
    rows = [(f, v, i) for f, (kind, values) in edges.items() if kind == "value" for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "feature string, value double, bin int")


IV_SQL = f"""
SELECT f.feature, round(coalesce(s.iv, 0.0), 4) AS iv, cast(coalesce(s.n_bins, 0) AS bigint) AS n_bins,
  CASE WHEN coalesce(s.iv, 0.0) < {K.IV_THRESHOLD_DROP} THEN 'DROP (low IV)'
       WHEN coalesce(s.iv, 0.0) > {K.IV_THRESHOLD_SUSPICIOUS} THEN 'SUSPICIOUS (possible leakage)' ELSE '' END AS flag
FROM (SELECT unnest({[f for f in FEATS]!r}) AS feature) f
LEFT JOIN (SELECT feature, sum(iv) AS iv, count(*) AS n_bins FROM woe GROUP BY feature) s ON f.feature = s.feature"""


@register("iv_select", with_fixtures("WITH " + woe_ctes() + IV_SQL.replace("\nSELECT", ", ivt AS (SELECT", 1) + ") SELECT * FROM ivt", "li_risk"), ["iv"])
def q_iv_select(spark, sf):
    w = B.woe_table(fx.li_risk(spark, sf), FEATS, "y")
    return B.iv_table(w, FEATS)


_BAND = (
    "CASE "
    + " ".join(f"WHEN iv < {hi} THEN '{name}'" for hi, name in K.IV_STRENGTH_BANDS)
    + f" ELSE '{K.IV_STRENGTH_TOP}' END"
)


@register(
    "iv_strength",
    with_fixtures(
        "WITH " + woe_ctes() + IV_SQL.replace("\nSELECT", ", ivt AS (SELECT", 1)
        + f") SELECT {_BAND} AS strength, count(*) AS n_features FROM ivt GROUP BY 1",
        "li_risk",
    ),
)
def q_iv_strength(spark, sf):
    w = B.woe_table(fx.li_risk(spark, sf), FEATS, "y")
    return B.iv_strength(B.iv_table(w, FEATS))


def _woe_join_sql() -> str:
    cols, joins = [], []
    for i, f in enumerate(FEATS):
        a = f"w{i}"
        cols.append(f"coalesce({a}.woe, 0.0) AS WOE_{f}")
        binexpr = (
            f"cast(CASE WHEN e{i}.kind = 'value' THEN len(list_filter(e{i}.edges, lambda z: z < cast(r.{f} AS double))) "
            f"ELSE len(list_filter(e{i}.edges[2:len(e{i}.edges) - 1], lambda z: z < cast(r.{f} AS double))) END AS int)"
        )
        joins.append(
            f"LEFT JOIN ed e{i} ON e{i}.feature = '{f}' "
            f"LEFT JOIN woe {a} ON {a}.feature = '{f}' AND {a}.bin = {binexpr}"
        )
    return f"SELECT r.key, {', '.join(cols)} FROM li_risk r " + " ".join(joins)


@register(
    "woe_transform",
    with_fixtures("WITH " + woe_ctes() + " " + _woe_join_sql(), "li_risk"),
    [f"WOE_{f}" for f in FEATS],
)
def q_woe_transform(spark, sf):
    li = fx.li_risk(spark, sf)
    m = B.WoEModel.fit(li, FEATS, "y")
    return m.transform(li.select("key", *FEATS), FEATS).select("key", *[f"WOE_{f}" for f in FEATS])


SQL_STD = f"""
SELECT key, {', '.join(f'({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {f}' for f in FEATS)}
FROM li_risk"""


@register("standardize", with_fixtures(SQL_STD, "li_risk"), FEATS)
def q_standardize(spark, sf):
    from riskloom.operators.scaling import fit_standard

    li = fx.li_risk(spark, sf)
    return fit_standard(li, FEATS).transform(li.select("key", *FEATS))


# ------------------------------------------------------ string categories
CATEGORIES = ["seg", "nation"]
SEGMENT_SRC = "(SELECT *, cast(nationkey AS varchar) AS nation FROM panel)"


def category_ctes(src: str, cats=CATEGORIES, label: str = "y", where: str = "true") -> str:
    """CTE text ending in ``cwoe``: WoE per category, the rarest together beyond the bins."""
    arms = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, {label} AS y FROM {src} s WHERE {where}" for c in cats)
    n = K.WOE_MAX_BINS
    return f"""
cl AS (SELECT * FROM ({arms}) a WHERE v IS NOT NULL AND y IS NOT NULL),
cn AS (SELECT feature, v, count(*) AS n, sum(y) AS ev FROM cl GROUP BY feature, v),
cr AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS place, count(*) OVER (PARTITION BY feature) AS d FROM cn),
cb AS (SELECT *, CASE WHEN d <= {n} OR place < {n} THEN v END AS kept, CASE WHEN d <= {n} THEN 'category' ELSE 'top' END AS kind FROM cr),
ci AS (SELECT *, cast(CASE WHEN kept IS NULL THEN {n} - 1 ELSE row_number() OVER (PARTITION BY feature, kept IS NULL ORDER BY v) - 1 END AS int) AS bin FROM cb),
cg AS (SELECT feature, bin, any_value(kind) AS kind, coalesce(any_value(kept), '{B.OTHERS}') AS label,
              cast(sum(n) AS bigint) AS n_total, cast(sum(ev) AS bigint) AS n_events FROM ci GROUP BY feature, bin),
ct AS (SELECT *, sum(n_events) OVER (PARTITION BY feature) AS te, sum(n_total - n_events) OVER (PARTITION BY feature) AS tn FROM cg),
cp AS (SELECT *, greatest(n_events / cast(te AS double), {K.WOE_PCT_FLOOR!r}) AS pct_events,
              greatest((n_total - n_events) / cast(tn AS double), {K.WOE_PCT_FLOOR!r}) AS pct_nonevents FROM ct WHERE te > 0 AND tn > 0),
cwoe AS (SELECT feature, bin, kind, label, n_total, n_events, n_total - n_events AS n_nonevents, n_events / cast(n_total AS double) AS event_rate,
                pct_events, pct_nonevents, ln(pct_events / pct_nonevents) AS woe,
                (pct_events - pct_nonevents) * ln(pct_events / pct_nonevents) AS iv FROM cp)"""


def _segments(spark, sf):
    return fx.panel(spark, sf).withColumn("nation", F.col("nationkey").cast("string"))


CAT_COLS = ["feature", "bin", "kind", "label", "n_total", "n_events", "n_nonevents", "event_rate", "pct_events", "pct_nonevents", "woe", "iv"]
SQL_TYPED = (
    "WITH " + woe_ctes("panel", ["limit_bal"]) + "," + category_ctes(SEGMENT_SRC)
    + f" SELECT {', '.join(CAT_COLS)} FROM cwoe UNION ALL SELECT {', '.join('NULL' if c == 'label' else c for c in CAT_COLS)} FROM woe"
)


@register("woe_table_typed", with_fixtures(SQL_TYPED, "panel"), ["event_rate", "pct_events", "pct_nonevents", "woe", "iv"])
def q_woe_table_typed(spark, sf):
    """WoE of customers by market segment, nation (25 texts: the nine largest and all others) and limit."""
    w = B.labelled_woe_table(_segments(spark, sf), [*CATEGORIES, "limit_bal"], "y")
    text = F.col("kind").isin("category", "top")
    return w.withColumn("label", F.when(text, F.col("label"))).select(CAT_COLS)


SQL_CATS = "WITH " + category_ctes(SEGMENT_SRC, label="0") + " SELECT feature, label AS value, bin, kind FROM cg"


@register("category_bins", with_fixtures(SQL_CATS, "panel"))
def q_category_bins(spark, sf):
    """The fitted vocabulary of string features."""
    edges, _ = B.fit_vocabulary(_segments(spark, sf), CATEGORIES, "y")
    rows = [(f, v, i, edges[f][0]) for f, i, v in B.bin_labels(edges)]
    return spark.createDataFrame(rows, "feature string, value string, bin int, kind string")


UNSEEN = "MACHINERY"
SQL_CAT_WOE = (
    "WITH " + category_ctes(SEGMENT_SRC, where=f"seg <> '{UNSEEN}'")
    + f""" SELECT id, coalesce(a.woe, 0.0) AS WOE_seg, coalesce(b.woe, c.woe, 0.0) AS WOE_nation FROM {SEGMENT_SRC} p
LEFT JOIN cwoe a ON a.feature = 'seg' AND a.label = p.seg
LEFT JOIN cwoe b ON b.feature = 'nation' AND b.label = p.nation
LEFT JOIN cwoe c ON c.feature = 'nation' AND c.label = '{B.OTHERS}'"""
)


@register("woe_transform_typed", with_fixtures(SQL_CAT_WOE, "panel"), ["WOE_seg", "WOE_nation"])
def q_woe_transform_typed(spark, sf):
    """WoE of categories fitted without one segment: its customers get 0, nations outside the vocabulary their common bin."""
    t = _segments(spark, sf)
    m = B.WoEModel.fit(t.where(F.col("seg") != UNSEEN), CATEGORIES, "y")
    return m.transform(t, CATEGORIES).select("id", "WOE_seg", "WOE_nation")


@register("score_points", with_fixtures(f"SELECT id, pd_score, {SC.SCORE_SQL} AS score FROM scored", "scored"), ["pd_score", "score"])
def q_score_points(spark, sf):
    return SC.score_points(fx.scored(spark, sf)).select("id", "pd_score", "score")


# Coefficients are a parameter of the points table; the oracle uses a fixed set.
FIXED_COEF = {f: 0.5 for f in FEATS}
SQL_POINTS = f"""
, mom AS (SELECT feature, sum(n_total * woe) / sum(n_total) AS s_mean FROM woe GROUP BY feature),
mom2 AS (SELECT w.feature, any_value(s_mean) AS s_mean,
               sqrt(sum(n_total * pow(woe - s_mean, 2)) / sum(n_total)) AS s_std
         FROM woe w JOIN mom m ON w.feature = m.feature GROUP BY w.feature)
SELECT w.feature AS Feature, w.bin AS Bin, w.n_total AS N_Total, round(event_rate, 4) AS Event_Rate,
       round(woe, 4) AS WoE, round(0.5::double, 4) AS Coefficient,
       round(-{SC.FACTOR!r} * 0.5 * (woe - s_mean) / (s_std + 1e-9), 1) AS Points
FROM woe w JOIN mom2 m ON w.feature = m.feature"""


@register("scorecard_points", with_fixtures("WITH " + woe_ctes() + SQL_POINTS, "li_risk"))
def q_scorecard_points(spark, sf):
    li = fx.li_risk(spark, sf)
    w = B.woe_table(li, FEATS, "y")
    mom = w.groupBy("feature").agg((F.sum(F.col("n_total") * F.col("woe")) / F.sum("n_total")).alias("m"))
    m = {r["feature"]: r["m"] for r in mom.collect()}
    sd = w.groupBy("feature").agg(
        F.sqrt(
            F.sum(F.col("n_total") * F.pow(F.col("woe") - F.element_at(F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v))]), F.col("feature")), 2))
            / F.sum("n_total")
        ).alias("s")
    )
    s = {r["feature"]: r["s"] for r in sd.collect()}
    return SC.points_table(w, FIXED_COEF, m, s)


SQL_DECILES = f"""
WITH s AS (SELECT y, {SC.SCORE_SQL} AS score FROM scored),
e AS (SELECT list_sort(list_distinct(quantile_cont(score, {QCUT}))) AS q FROM s)
SELECT cast(len(list_filter((SELECT q FROM e)[2:len((SELECT q FROM e)) - 1], lambda z: z < score)) AS int) AS decile,
       count(*) AS n_total, cast(sum(y) AS bigint) AS n_events, min(score) AS score_min, max(score) AS score_max,
       avg(score) AS score_mean, sum(y) / cast(count(*) AS double) AS event_rate
FROM s GROUP BY 1"""


@register("score_deciles", with_fixtures(SQL_DECILES, "scored"), ["score_min", "score_max", "score_mean", "event_rate"])
def q_score_deciles(spark, sf):
    s = SC.score_points(fx.scored(spark, sf)).select("score", "y")
    return SC.score_deciles(s, "score", "y")


@register("fit_logit")
def q_fit_logit(spark, sf):
    """Class-balanced L2 logistic regression on standardised WoE features (Spark ML)."""
    from riskloom.operators.scaling import fit_standard
    from riskloom.session import wide_rows

    wide_rows(spark)
    li = fx.li_risk(spark, sf)
    m = B.WoEModel.fit(li, FEATS, "y")
    woe_cols = [f"WOE_{f}" for f in FEATS]
    t = SC.counted(m.transform(li, FEATS), ["y", *woe_cols])
    t = fit_standard(t, woe_cols, SC.COUNT).transform(t)
    model, b0, coefs = SC.fit_logit(t, woe_cols, "y", count=SC.COUNT)
    rows = [("(intercept)", b0)] + list(coefs.items())
    return spark.createDataFrame(rows, "term string, coef double")
