"""Exact values at given ranks of many columns, without shuffling rows.

A quantile needs the value at a known rank. Every pass counts, map-side, how
many rows fall into equal-width bins of the intervals that still hold a wanted
rank (``groups x bins`` rows leave the tasks); the driver keeps the bins that
hold one and the next pass divides those. Intervals of at most LEAF_ROWS rows
are read out value by value. No exchange and no written table grows with the
input: a pass is one pruned scan, and the first pass usually leaves leaves.

The input is read once per pass: hand over a scan or a written table, not an
expensive plan. Groups are features or classes; with unbounded groups use
``ordered.exact_quantiles``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

FIRST_BINS = 1024
NEXT_BINS = 64
LEAF_ROWS = 1024


class Interval(NamedTuple):
    """Closed value range of one group that holds the wanted ``ranks``; ``below`` rows come before it."""

    group: object
    lo: object
    hi: object
    below: int
    ranks: list[int]


def _finite(x):
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def value_stats(df: DataFrame, key: str, value: str, **more) -> dict:
    """``{group: row}`` with ``n`` and the finite range ``lo``/``hi`` of the non-NULL values, and ``more`` aggregates."""
    x = F.col(value)
    inside = F.when(_finite(x), x)
    rows = df.groupBy(key).agg(F.count(x).alias("n"), F.min(inside).alias("lo"), F.max(inside).alias("hi"), *[e.alias(k) for k, e in more.items()]).collect()
    return {r[key]: r for r in rows}


def _mark(df: DataFrame, key: str, value: str, intervals: Sequence[Interval], whole: bool) -> DataFrame:
    """Rows inside an interval, with its number ``_i`` and range. ``whole``: intervals cover their groups,
    infinite and NaN values included. The interval table is broadcast: at most groups x ranks rows."""
    schema = StructType([
        StructField("_group", df.schema[key].dataType), StructField("_i", IntegerType()),
        StructField("_lo", DoubleType()), StructField("_hi", DoubleType()),
    ])
    table = df.sparkSession.createDataFrame([(v.group, i, v.lo, v.hi) for i, v in enumerate(intervals)], schema)
    on = F.col(key).eqNullSafe(F.col("_group"))
    if not whole:
        on = on & F.col(value).between(F.col("_lo"), F.col("_hi"))
    return df.where(F.col(value).isNotNull()).join(F.broadcast(table), on).drop("_group")


def _histogram(df: DataFrame, key: str, value: str, intervals: Sequence[Interval], bins: int, whole: bool) -> dict[int, list]:
    """Per interval its filled bins in value order: ``(bin, rows, smallest, largest)``."""
    x, lo, hi = F.col(value), F.col("_lo"), F.col("_hi")
    part, span = x / 2 - lo / 2, hi / 2 - lo / 2  # halves: a range can be wider than the largest double
    place = F.least(F.floor(F.try_divide(part, span) * bins), F.lit(bins - 1))
    place = F.when(span > 0, place).otherwise(F.lit(0))
    if whole:
        place = (
            F.when(F.isnan(x), F.lit(bins + 1)).when(x == F.lit(float("inf")), F.lit(bins))
            .when(x == F.lit(float("-inf")), F.lit(-1)).otherwise(place)
        )
    marked = _mark(df, key, value, intervals, whole).withColumn("_bin", place.cast("int"))
    out: dict[int, list] = {}
    for r in marked.groupBy("_i", "_bin").agg(F.count(F.lit(1)).alias("c"), F.min(value).alias("a"), F.max(value).alias("b")).collect():
        out.setdefault(r["_i"], []).append((r["_bin"], r["c"], r["a"], r["b"]))
    return {i: sorted(rows, key=lambda t: t[0]) for i, rows in out.items()}


def first_histogram(df: DataFrame, key: str, value: str, stats: dict) -> dict[object, list]:
    """Per group its filled bins ``(bin, rows, smallest, largest)`` over its whole range, in value order."""
    whole = [Interval(g, r["lo"], r["hi"], 0, []) for g, r in stats.items() if r["n"]]
    hist = _histogram(df, key, value, whole, FIRST_BINS, True) if whole else {}
    return {v.group: hist.get(i, []) for i, v in enumerate(whole)}


def bin_values(cells: Sequence[tuple]) -> list[float] | None:
    """The distinct values in the bins of :func:`first_histogram`, ascending; None where a bin holds several."""
    if any(a != z and not (math.isnan(a) and math.isnan(z)) for _, _, a, z in cells):
        return None
    return [a + 0.0 for _, _, a, _ in cells]  # -0.0 is 0.0


def values_at_ranks(
    df: DataFrame, key: str, value: str, wanted: dict[object, Iterable[int]], stats: dict, first: dict | None = None,
    rows: Callable[[list], DataFrame] | None = None,
) -> dict[tuple, float]:
    """``{(group, rank): value}`` for 0-based ranks among a group's non-NULL doubles in ascending order
    (NaN last); ``stats`` come from :func:`value_stats`, ``first`` from :func:`first_histogram` (else it is
    taken here). ``rows`` gives the rows of some groups for less than a scan of ``df``: most groups need no
    second pass."""
    found: dict[tuple, float] = {}
    todo = [Interval(g, stats[g]["lo"], stats[g]["hi"], 0, sorted(set(r))) for g, r in wanted.items() if r]
    leaves: list[Interval] = []
    of = (lambda intervals: rows(sorted({v.group for v in intervals}))) if rows else (lambda _: df)
    bins, whole = FIRST_BINS, True
    while todo:
        if whole and first is not None:
            hist = {i: first[v.group] for i, v in enumerate(todo)}
        else:
            hist = _histogram(of(todo), key, value, todo, bins, whole)
        nxt = []
        for i, iv in enumerate(todo):
            below = iv.below
            for b, c, a, z in hist.get(i, []):
                ranks = [r for r in iv.ranks if below <= r < below + c]
                if ranks and (a == z or not 0 <= b < bins):
                    found.update({(iv.group, r): a for r in ranks})
                elif ranks:
                    stuck = not whole and (a, z) == (iv.lo, iv.hi)
                    (leaves if c <= LEAF_ROWS or stuck else nxt).append(Interval(iv.group, a, z, below, ranks))
                below += c
        todo, bins, whole = nxt, NEXT_BINS, False
    if leaves:
        cells: dict[int, list] = {}
        for r in _mark(of(leaves), key, value, leaves, False).groupBy("_i", value).agg(F.count(F.lit(1)).alias("c")).collect():
            cells.setdefault(r["_i"], []).append((r[value], r["c"]))
        for i, iv in enumerate(leaves):
            below = iv.below
            for v, c in sorted(cells[i]):
                found.update({(iv.group, r): v for r in iv.ranks if below <= r < below + c})
                below += c
    return found


def quantiles(
    df: DataFrame, key: str, value: str, probs: Sequence[float], stats: dict | None = None, first: dict | None = None,
    rows: Callable[[list], DataFrame] | None = None,
) -> dict[object, list[float]]:
    """Linear-interpolated quantiles per group, in prob order: position ``(n-1)*p``, value
    ``lo + (hi-lo)*fraction`` (``quantile_cont``, NumPy ``linear``). Groups without values are left out.
    ``first`` and ``rows``: see :func:`values_at_ranks`."""
    stats = value_stats(df, key, value) if stats is None else stats
    spots = {g: [(s["n"] - 1) * float(p) for p in probs] for g, s in stats.items() if s["n"]}
    wanted = {g: {f(p) for p in at for f in (math.floor, math.ceil)} for g, at in spots.items()}
    got = values_at_ranks(df, key, value, wanted, stats, first, rows)
    out = {}
    for g, at in spots.items():
        ends = [(float(got[g, math.floor(p)]), float(got[g, math.ceil(p)]), p - math.floor(p)) for p in at]
        out[g] = [lo if frac == 0 or lo == hi else lo + (hi - lo) * frac for lo, hi, frac in ends]
    return out
