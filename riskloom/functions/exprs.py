"""Null-safe column expressions used by every operator.

Missing values are SQL NULL only. Division by zero yields NULL
(``try_divide``), clipping keeps NULL, and the row aggregates skip NULL
like pandas' row reductions do. Everything here is a plain Catalyst
expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(a: ColLike, b: ColLike) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI-safe)."""
    return F.try_divide(c(a).cast("double"), c(b).cast("double"))


def clip(x: ColLike, lo: float | None = None, hi: float | None = None) -> Column:
    """pandas ``clip``: bounds applied, NULL stays NULL."""
    x = c(x)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out.cast("double"))


def nn_count(cols: Sequence[ColLike]) -> Column:
    """Number of non-NULL values among ``cols``."""
    return sum((c(x).isNotNull().cast("int") for x in cols), F.lit(0))


def row_sum(cols: Sequence[ColLike]) -> Column:
    """Row sum skipping NULL; 0 when all are NULL (pandas ``sum(axis=1)``)."""
    return sum((F.coalesce(c(x).cast("double"), F.lit(0.0)) for x in cols), F.lit(0.0))


def row_mean(cols: Sequence[ColLike]) -> Column:
    """Row mean skipping NULL; NULL when all are NULL."""
    return F.try_divide(row_sum(cols), nn_count(cols).cast("double"))


def row_std(cols: Sequence[ColLike]) -> Column:
    """Row sample standard deviation (ddof=1) skipping NULL; NULL below 2 values."""
    m = row_mean(cols)
    ss = sum(
        (F.coalesce(F.pow(c(x).cast("double") - m, F.lit(2.0)), F.lit(0.0)) for x in cols),
        F.lit(0.0),
    )
    n = nn_count(cols)
    return F.when(n >= 2, F.sqrt(ss / (n - 1).cast("double")))


def row_max(cols: Sequence[ColLike]) -> Column:
    """Row max skipping NULL (Spark's greatest already skips NULL)."""
    return F.greatest(*[c(x) for x in cols])


def row_min(cols: Sequence[ColLike]) -> Column:
    return F.least(*[c(x) for x in cols])


def row_count_if(preds: Sequence[Column]) -> Column:
    """Count of true predicates in a row (NULL counts as false)."""
    return sum((F.coalesce(p, F.lit(False)).cast("int") for p in preds), F.lit(0))


def row_prod(cols: Sequence[ColLike]) -> Column:
    """Row product skipping NULL; 1 when all are NULL (pandas ``prod``)."""
    out = F.lit(1.0)
    for x in cols:
        out = out * F.coalesce(c(x).cast("double"), F.lit(1.0))
    return out


def nan_to_null(x: ColLike) -> Column:
    """NaN and +/-inf become NULL."""
    x = c(x).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


# Bin indices are sums of comparisons (whole-stage codegen), not
# higher-order ``filter`` lambdas (interpreted). ``max_len`` bounds the
# edge array length (e.g. q+1 quantile edges).
MAX_EDGES = 64


def _count_less(e: Column, x: Column, first: int, last_from_end: int, max_len: int, strict: bool) -> Column:
    """#{ e[i] (0-based) < x } for first <= i <= size(e)-1-last_from_end."""
    out = F.lit(0)
    for i in range(first, max_len):
        hit = (F.get(e, i) < x) if strict else (F.get(e, i) <= x)
        ok = F.lit(i) <= F.size(e) - 1 - last_from_end
        out = out + F.when(ok & hit, F.lit(1)).otherwise(F.lit(0))
    return F.when(F.size(e) > max_len, F.raise_error(F.lit(f"more than {max_len} bin edges"))).otherwise(out)


def bin_right(edges: ColLike, x: ColLike, max_len: int = MAX_EDGES) -> Column:
    """Right-closed bin index of ``x`` against sorted unique ``edges``.

    Bins are (e0,e1], (e1,e2], ... with the lowest edge included
    (pandas ``qcut``). Values beyond the outer edges fall into the first
    or last bin. Counting only the inner edges keeps ties on an edge in
    the lower bin.
    """
    return _count_less(c(edges), c(x), 1, 1, max_len, strict=True)


def bin_left(edges: ColLike, x: ColLike, max_len: int = MAX_EDGES) -> Column:
    """Left-closed bin index (NumPy ``histogram`` with open outer edges)."""
    return _count_less(c(edges), c(x), 1, 1, max_len, strict=False)


def bin_value(values: ColLike, x: ColLike, max_len: int = MAX_EDGES) -> Column:
    """Index of ``x`` among sorted distinct ``values`` (one bin per value)."""
    return _count_less(c(values), c(x), 0, 0, max_len, strict=True)


def bin_right_lit(edges: Sequence[float], x: ColLike) -> Column:
    """``bin_right`` for edges known on the driver: literal comparisons."""
    inner = list(edges)[1:-1]
    return sum(((c(x) > F.lit(float(e))).cast("int") for e in inner), F.lit(0))


def bin_left_lit(edges: Sequence[float], x: ColLike) -> Column:
    inner = list(edges)[1:-1]
    return sum(((c(x) >= F.lit(float(e))).cast("int") for e in inner), F.lit(0))


def bin_value_lit(values: Sequence[float], x: ColLike) -> Column:
    return sum(((c(x) > F.lit(float(v))).cast("int") for v in values), F.lit(0))


def logit(p: ColLike) -> Column:
    p = c(p)
    return F.log(p / (F.lit(1.0) - p))


def sigmoid(z: ColLike) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c(z)))


def md5_key(*cols: ColLike) -> Column:
    """Deterministic row key: md5 of the '|'-joined string forms."""
    return F.md5(F.concat_ws("|", *[c(x).cast("string") for x in cols]))
