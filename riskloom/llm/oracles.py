"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_LOWER = "translate({0}, '" + ascii_uppercase + "', '" + ascii_lowercase + "')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"
_REACH = """
reach AS (
    SELECT x, x AS y FROM nodes
    UNION
    SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a
),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)"""

OP7 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, ws, unnest(range(0, len(ws) - 49)) AS s FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, s, md5(array_to_string(ws[s + 1 : s + 50], ' ')) AS h FROM g),
shared AS (SELECT h FROM h GROUP BY h HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT doc_id, s FROM h JOIN shared USING (h)),
gap AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
island AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM gap)
SELECT doc_id, min(s) AS start_word, max(s) + 50 AS end_word, max(s) + 50 - min(s) AS n_words FROM island GROUP BY doc_id, k
"""

OP8 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
    SELECT vec_id, e FROM v
    WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
edges AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
nodes AS (SELECT vec_id AS x FROM embeddings),{_REACH},
n AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON vec_id = x LEFT JOIN n ON vec_id = a
"""

OP9 = f"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
),
k AS (
    SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l
),
s AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, coalesce(owner <> doc_id, FALSE) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS t
    FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
edges AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 90 * (na.n + nb.n - i)),
nodes AS (SELECT doc_id AS x FROM documents),{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN comp ON d.doc_id = x LEFT JOIN n ON d.doc_id = n.doc_id
"""

_M64 = "18446744073709551615::UHUGEINT"


def _xxh(value: str, seed: str, into: str, table: str) -> str:
    """``table`` with ``into``: XXH64 of the eight bytes of ``value`` (the seed itself where it is null), step by step."""
    p1, p2, p3, p4, p5 = (
        f"{p}::UHUGEINT"
        for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
    )
    steps = [
        (f"({value}::UHUGEINT * {p2}) & {_M64}", "x1"),
        (f"(((x1 << 31) | (x1 >> 33)) & {_M64}) * {p1} & {_M64}", "x2"),
        (f"xor(({seed}::UHUGEINT + {p5} + 8) & {_M64}, x2)", "x3"),
        (f"((((x3 << 27) | (x3 >> 37)) & {_M64}) * {p1} + {p4}) & {_M64}", "x4"),
        (f"(xor(x4, x4 >> 33) * {p2}) & {_M64}", "x5"),
        (f"(xor(x5, x5 >> 29) * {p3}) & {_M64}", "x6"),
        (f"CASE WHEN {value} IS NULL THEN {seed}::UHUGEINT ELSE xor(x6, x6 >> 32) END", into),
    ]
    for expr, name in steps:
        table = f"SELECT *, {expr} AS {name} FROM ({table})"
    return f"SELECT * EXCLUDE (x1, x2, x3, x4, x5, x6) FROM ({table})"


def _xxh_all(values: list[str], table: str) -> str:
    seed = "42"
    for i, v in enumerate(values):
        table = _xxh(v, seed, f"h{i + 1}", table)
        seed = f"h{i + 1}"
    return table


# CRC-32: the table of its reflected polynomial, and the checksum of a list of bytes.
_CRC_TABLE = """
crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_table
)"""
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295, {0}), "
    "lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"
)
_ASCII = "list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)"
_UTF8 = "list_transform(range(0, octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)"

OP11 = f"""
WITH {_CRC_TABLE.strip()},
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
    SELECT doc_id, text, length(text) AS n_chars,
        coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id,
        coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text
    FROM d WINDOW o AS (ORDER BY doc_id)
),
e AS (SELECT *, left(text, n_chars - n_chars // 4) || left(next_text, n_chars // 4) AS edited FROM n),
texts AS (SELECT doc_id, 0 AS v, text FROM e UNION ALL SELECT doc_id, 1 AS v, edited FROM e),
w AS (SELECT doc_id, v, {_WORDS} AS ws FROM texts),
vocabulary AS (SELECT DISTINCT unnest(ws) AS word FROM w),
codes AS (SELECT word, {_CRC.format(_UTF8.format('word'))} AS code FROM vocabulary, crc),
places AS (SELECT doc_id, v, unnest(ws) AS word, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM w),
runs AS (
    SELECT doc_id, v, p, n, code AS c1, lead(code, 1) OVER q AS c2, lead(code, 2) OVER q AS c3, lead(code, 3) OVER q AS c4,
        lead(code, 4) OVER q AS c5
    FROM places JOIN codes USING (word) WINDOW q AS (PARTITION BY doc_id, v ORDER BY p)
),
shingles AS (SELECT DISTINCT c1, c2, c3, c4, c5 FROM runs WHERE p = 1 OR p <= n - 4),
hashed AS ({_xxh_all(['c1', 'c2', 'c3', 'c4', 'c5'], 'SELECT * FROM shingles')}),
minima AS (
    SELECT doc_id, v, ((h5 >> 1) >> 55)::INT AS bin, min(h5 >> 1) AS m
    FROM (SELECT * FROM runs WHERE p = 1 OR p <= n - 4) r JOIN hashed s
        ON r.c1 = s.c1 AND r.c2 IS NOT DISTINCT FROM s.c2 AND r.c3 IS NOT DISTINCT FROM s.c3
        AND r.c4 IS NOT DISTINCT FROM s.c4 AND r.c5 IS NOT DISTINCT FROM s.c5
    GROUP BY 1, 2, 3
),
grid AS (SELECT j, b FROM range(256) x(j), range(256) y(b)),
ranks AS (
    SELECT j::INT AS j, b::INT AS b, CASE WHEN r >= 9223372036854775808 THEN r::HUGEINT - 18446744073709551616 ELSE r::HUGEINT END AS r
    FROM (SELECT j, b, (h2 & 18446744073709551360::UHUGEINT) | b::UHUGEINT AS r FROM ({_xxh_all(['j', 'b'], 'SELECT * FROM grid')}))
),
docs AS (SELECT DISTINCT doc_id, v FROM minima),
empty AS (
    SELECT doc_id, v, j::INT AS j FROM docs, range(256) x(j)
    WHERE NOT EXISTS (SELECT 1 FROM minima m WHERE m.doc_id = docs.doc_id AND m.v = docs.v AND m.bin = j)
),
filled AS (
    SELECT doc_id, v, bin, m FROM minima
    UNION ALL
    SELECT e.doc_id, e.v, e.j, arg_min(m.m, r.r) FROM empty e JOIN minima m ON e.doc_id = m.doc_id AND e.v = m.v
        JOIN ranks r ON r.j = e.j AND r.b = m.bin GROUP BY 1, 2, 3
),
prints AS (
    SELECT doc_id, v, string_agg(substr('0123456789abcdef', (m & 15)::INT + 1, 1), '' ORDER BY bin) AS print FROM filled GROUP BY 1, 2
),
near AS (
    SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, coalesce(a.print, '') AS fingerprint, coalesce(b.print, '') AS edited_fingerprint,
        coalesce(c.print, '') AS next_print
    FROM e LEFT JOIN prints a USING (doc_id) LEFT JOIN prints b USING (doc_id) LEFT JOIN prints c ON c.doc_id = e.next_id AND c.v = 0
    WHERE coalesce(a.v, 0) = 0 AND coalesce(b.v, 1) = 1
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    {{0}} AS near_edited, {{1}} AS near_next FROM near
"""


def _like(a: str, b: str) -> str:
    same = f"list_sum(list_transform(range(1, 257), lambda i: (substr({a}, i, 1) = substr({b}, i, 1))::INT))"
    like = f"greatest((({same})::DOUBLE / 256.0 - 0.0625) / 0.9375, 0.0)"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE {like} END"


OP11 = OP11.format(_like("fingerprint", "edited_fingerprint"), _like("fingerprint", "next_print"))

_NEVER = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"


def _best(*audits: str) -> str:
    return f"list_sort([{', '.join(audits)}])[1]"


def _edit(audit: str, cost: str, letter: str, line: str | None = None) -> str:
    """An audit (cost, letters, text) with one more edit."""
    text = f"{audit}.t"
    if line is not None:
        text += f" || CASE WHEN {audit}.t = '' THEN '' ELSE chr(10) END || {line}"
    return f"{{'c': ({audit}.c + {cost})::BIGINT, 'a': {audit}.a || '{letter}', 't': {text}}}"


def _stay(audit: str, initial: str, name: str) -> str:
    """Keep or rerole a row as user or assistant."""
    keep = _edit(audit, f"CASE WHEN go OR first <> '{initial}' THEN 1000000000 ELSE stay END", "K", "line")
    return keep + ", " + _edit(audit, "CASE WHEN go THEN 1000000000 ELSE 3 + stay END", "R", f"'{name}:' || text")


_CLOSED = f"""
SELECT *, {_best('a', _edit('u1', '3', 'I', "'assistant:'"))} AS a1
FROM (SELECT *, {_best('u', *(_edit(x, '3', 'I', "'user:'") for x in 'sya'))} AS u1 FROM walk)"""

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE.strip()},
c AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
k AS (SELECT *, {_CRC.format(_ASCII.format('key'))} % 20 AS kind FROM c, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM k WHERE kind <> 0
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
        trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
    FROM damaged
),
judged AS (
    SELECT *, left(role, 1) AS first, role || ':' || text AS line, core = '' AS blank, core <> '' AND nth > 1 AS duplicate,
        core <> '' AND nth = 1 AND right(core, 1) NOT IN ('.', '!', '?') AS truncated,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM ordered
),
steps AS (SELECT *, blank OR duplicate AS go, CASE WHEN truncated THEN 3 ELSE 0 END AS stay FROM judged),
walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS step, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s, {_NEVER} AS y, {_NEVER} AS u, {_NEVER} AS a
    FROM conversations
    UNION ALL
    SELECT w.conv_id, i,
        {_edit('s', '4', 'D')},
        {_best(_edit('y', '4', 'D'), _edit('s', "CASE WHEN go OR first <> 's' THEN 1000000000 ELSE stay END", 'K', 'line'))},
        {_best(_edit('u1', '4', 'D'), *(_stay(x, 'u', 'user') for x in ('s', 'y', 'a1')))},
        {_best(_edit('a1', '4', 'D'), _stay('u1', 'a', 'assistant'))}
    FROM ({_CLOSED}) w JOIN steps t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND i = step + 1
),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
        count(*) FILTER (WHERE before IS NOT NULL AND before || first NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
),
done AS (SELECT conv_id, step, {_best('s', 'a1')} AS e FROM ({_CLOSED}))
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.c AS cost, e.a AS audit, sha256(e.t) AS repaired_sha256
FROM done d LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM d.conv_id WHERE step = coalesce(n, 0)
"""

OP13 = f"""
WITH {_CRC_TABLE.strip()},
t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
    FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC.format(_ASCII.format('id'))} % 4 AS h
    FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS id FROM t), crc
),
parts AS (
    SELECT c.conv_id, 0 AS part, r, role, text FROM c JOIN t ON t.conv_id = base WHERE r <= h
    UNION ALL
    SELECT c.conv_id, 1, r, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE r > h
),
seqs AS (
    SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY part, r) FILTER (WHERE r IS NOT NULL), []) AS s
    FROM c LEFT JOIN parts p ON c.conv_id = p.conv_id GROUP BY c.conv_id
),
depths AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM seqs),
p AS (
    SELECT conv_id, depth, md5(s[1:depth]::JSON::VARCHAR) AS node, CASE WHEN depth > 0 THEN md5(s[1:depth - 1]::JSON::VARCHAR) END AS parent,
        CASE WHEN depth > 0 THEN len(regexp_extract_all(s[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words,
        depth = len(s) AS ends
    FROM depths
),
nodes AS (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM p GROUP BY node, depth
),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT DISTINCT a.node, b.node AS sub FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
    SELECT b.node, sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves
    FROM below b JOIN nodes n ON n.node = b.sub LEFT JOIN kids k ON k.node = b.sub GROUP BY b.node
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes u ON u.node = n.parent
"""

ORACLES = {"op7_repeated_passages": OP7, "op8_nn_descent": OP8, "op9_line_dedup": OP9, "op10_jaccard_join": OP10,
    "op11_minhash": OP11, "op12_structure_repair": OP12, "op13_prefix_trie": OP13}
