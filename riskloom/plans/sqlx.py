"""SQL-text counterparts of ``riskloom.functions.exprs`` for oracle queries."""

from __future__ import annotations

from collections.abc import Sequence


def div(a: str, b: str) -> str:
    return f"(cast({a} AS double) / nullif(cast({b} AS double), 0))"


def clip(x: str, lo: float | None = None, hi: float | None = None) -> str:
    out = f"cast({x} AS double)"
    if lo is not None:
        out = f"greatest({out}, {float(lo)!r})"
    if hi is not None:
        out = f"least({out}, {float(hi)!r})"
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE {out} END)"


def nn(cols: Sequence[str]) -> str:
    return "(0 + " + " + ".join(f"cast({c} IS NOT NULL AS int)" for c in cols) + ")"


def rsum(cols: Sequence[str]) -> str:
    return "(0.0 + " + " + ".join(f"coalesce(cast({c} AS double), 0.0)" for c in cols) + ")"


def rmean(cols: Sequence[str]) -> str:
    return f"({rsum(cols)} / nullif(cast({nn(cols)} AS double), 0))"


def rstd(cols: Sequence[str]) -> str:
    m = rmean(cols)
    ss = "(0.0 + " + " + ".join(f"coalesce(pow(cast({c} AS double) - {m}, 2.0), 0.0)" for c in cols) + ")"
    n = nn(cols)
    return f"(CASE WHEN {n} >= 2 THEN sqrt({ss} / cast({n} - 1 AS double)) END)"


def rmax(cols: Sequence[str]) -> str:
    return "greatest(" + ", ".join(cols) + ")"


def rmin(cols: Sequence[str]) -> str:
    return "least(" + ", ".join(cols) + ")"


def count_if(preds: Sequence[str]) -> str:
    return "(0 + " + " + ".join(f"cast(coalesce({p}, false) AS int)" for p in preds) + ")"


def rprod(cols: Sequence[str]) -> str:
    return "(1.0 * " + " * ".join(f"coalesce(cast({c} AS double), 1.0)" for c in cols) + ")"


def round_cols(sql: str, cols: Sequence[str], digits: int = 6) -> str:
    """Wrap a query so the listed double columns are rounded."""
    if not cols:
        return sql
    rep = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) _q"
