"""DuckDB-side text of the fixtures, for the oracle queries.

Written independently from the DataFrame versions in
``riskloom.sources.fixtures``; the two must agree row for row.
"""

from __future__ import annotations


def _panel() -> str:
    cols = []
    for k in range(1, 7):
        yr = 2001 - k
        cols += [
            f"coalesce(sum(CASE WHEN yr = {yr} THEN amt END), 0) AS bill_amt{k}",
            f"coalesce(sum(CASE WHEN yr = {yr} THEN paid END), 0) AS pay_amt{k}",
            f"cast(coalesce(max(CASE WHEN yr = {yr} THEN late END), -2) AS int) AS pay_{k}",
        ]
    return f"""
SELECT c_custkey AS id, c_mktsegment AS seg, c_nationkey AS nationkey,
       greatest(c_acctbal, 0) * 50 AS limit_bal,
       {', '.join(cols)},
       cast(coalesce(max(CASE WHEN yr = 2001 AND late > 0 THEN 1 END), 0) AS int) AS y
FROM customer LEFT JOIN (
  SELECT o_custkey, year(o_orderdate) AS yr, sum(o_totalprice) AS amt,
         sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS paid,
         sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS late
  FROM orders GROUP BY o_custkey, year(o_orderdate)) s ON o_custkey = c_custkey
GROUP BY c_custkey, c_mktsegment, c_nationkey, c_acctbal"""


PD_SQL = (
    "round(1/(1+exp(-(-1.6 + 0.25*greatest(pay_3,0) + 0.35*greatest(pay_1,0) + 0.15*greatest(pay_5,0)"
    " + 0.4*least(greatest(coalesce(bill_amt1/nullif(limit_bal,0),0),0),2) - 0.00002*limit_bal/10))), 6)"
)

FIXTURES = {
    "panel": _panel(),
    "scored": f"SELECT *, {PD_SQL} AS pd_score FROM panel",
    "li_risk": """
SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS key,
       l_quantity, l_extendedprice, l_discount, l_tax,
       cast(year(l_shipdate) AS double) AS ship_year,
       cast(l_returnflag = 'R' AS int) AS y,
       CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'expected' ELSE 'actual' END AS part
FROM lineitem""",
    "docs_q": """
SELECT d.doc_id, n_chars, lang, source, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "events_period": """
SELECT event_id, date_trunc('week', ts) AS period, value AS score,
       cast(event_type = 'error' AS int) AS y, user_id, event_type
FROM events""",
}

def _uci_raw() -> str:
    cols = ['id AS "Unnamed: 0"', "limit_bal AS X1", "cast(1 + id % 2 AS int) AS X2", "cast(id % 7 AS int) AS X3",
            "cast(id % 4 AS int) AS X4", "cast(21 + id % 50 AS int) AS X5"]
    cols += [f"pay_{k} AS X{5 + k}" for k in range(1, 7)]
    cols += [f"bill_amt{k} AS X{11 + k}" for k in range(1, 7)]
    cols += [f"pay_amt{k} AS X{17 + k}" for k in range(1, 7)]
    cols.append("cast(y AS varchar) AS Y")
    return "SELECT " + ", ".join(cols) + " FROM panel"


FIXTURES["uci_raw"] = _uci_raw()

# dependency order
_ORDER = ["panel", "scored", "uci_raw", "li_risk", "docs_q", "events_period"]
_DEPS = {"scored": ["panel"], "uci_raw": ["panel"]}


def with_fixtures(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs (dependencies included)."""
    need: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=_ORDER.index)
    ctes = [f"{n} AS ({FIXTURES[n]})" for n in need]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v})")
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
