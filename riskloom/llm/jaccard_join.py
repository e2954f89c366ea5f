"""N-gram Jaccard join with several global token orders.

A document's set is its distinct ``k``-word shingles (fewer words: the whole
sequence as one). Two documents link when |A and B| * den >= num * |A or B|.
Linked sets share at least ceil(t * n) of either set's n tokens, so under any
total order of tokens the first n - ceil(t * n) + 1 tokens of both (their
prefixes) have a token in common.

1. One scan hashes every set. Equal sets collapse to one class, grouped with
   map-side partial results, so a third of all rows being copies is one row.
2. First order: tokens whose hash lies in a window (a fixed share of the hash
   range, wider than a prefix: ``slack``) come first, by document frequency and
   hash, then the others by hash. Exact frequencies are counted for the
   window's tokens alone, over all classes. Tokens of one class only take
   their place in the prefix but make no candidates; the window is wide enough
   for them to fill the prefixes of most sets, so that long sets, which share
   some frequent tokens with many others, don't meet.
3. Classes that share a prefix token meet in that token's group. A group over
   ``block`` members is cut into blocks, a task sees two blocks. Size and a
   parity bitmap (its distance bounds the symmetric difference from below)
   rule pairs out, and a union-find keeps a spanning forest of the rest: rows
   grow with members, never with pairs. Components of the forests bound
   where links can be.
4. Inside a candidate component (again in pairs of blocks) the full sets meet.
   A bitmap of the members' hashed ids, of fixed size, leaves all other texts
   where they are read; ids that it lets through by chance go at the join.
   A pair must share prefix tokens under a second and a third order (hashes
   of their own) as well; then the intersection is counted exactly. Pairs
   that links already connect are skipped: components, not links, are asked.

Defined results: a null or empty text, or one without words, is an empty set
that links with nothing (its component is its own id); a null id counts as
larger than every id and comes back as null; repeated rows are copies; an
empty table gives an empty result; extra columns are ignored, or kept by
``drop_copies``. Sets are compared as 64-bit token hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import NO_ID, Workspace, column, id_or_null, ids, lists_of, prepare, text_bytes
from riskloom.llm.graph import components
from riskloom.llm.words import distinct, mix, shingles, words

BLOCK = 256
BITS = 1024
_ORDERS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
_PIECE = 4 << 20
_FILTER_BITS = 1 << 26


def row_slices(offsets: np.ndarray, limit: int = _PIECE):
    """Runs of rows of about ``limit`` bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def token_sets(col: pa.Array, k: int):
    """(first row, sorted distinct tokens, offsets) over the rows of a text column, piece by piece."""
    data, offsets = text_bytes(col)
    for a, b in row_slices(offsets):
        h, rows, _, _ = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        tokens, at, _ = distinct(*shingles(h, rows, k))
        yield a, tokens, at


def set_hash(tokens: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def prefix_length(n, num: int, den: int):
    """Tokens of a set of n that must hold a shared one: n - ceil(t * n) + 1."""
    return n - -(-num * n // den) + 1


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        while True:
            new = self.up[self.up]
            if (new == self.up).all():
                return new
            self.up = new


def _units(batches, fields: list[str]):
    """Rows of each unit together, from batches sorted by unit: lists of (unit's columns), batch by batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        unit = table.column("unit").to_numpy()
        if not len(unit):
            continue
        last = int(np.searchsorted(unit, unit[-1]))
        rest = table.slice(last)
        if last:
            yield table.slice(0, last).combine_chunks(), unit[:last]
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), rest.column("unit").to_numpy()


def _fixed(col, width: int) -> np.ndarray:
    """A binary column of fixed width as uint64 rows."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(-1, width // 8)


def _edges(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _close(n1, n2, distance, num: int, den: int):
    """Sizes and a lower bound of the symmetric difference still allow a link."""
    sizes = den * np.minimum(n1, n2) >= num * np.maximum(n1, n2)
    return sizes & (distance * (den + num) <= (den - num) * (n1 + n2))


def _blocks(rows: DataFrame, count: str, member: str, *key: str) -> DataFrame:
    """Each member once per pair of blocks that its block is part of; ``unit`` names the pair."""
    nb = F.ceil(F.col(count) / F.lit(BLOCK)).cast("int")
    mine = F.when(nb > 1, F.pmod(F.xxhash64(member, F.lit(7)), nb)).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("nb", nb).withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return rows.withColumn("unit", F.xxhash64(*key, F.least("mine", "other"), F.greatest("mine", "other"))).drop("nb", "mine", "other", count)


def _sorted_units(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "unit").sortWithinPartitions("unit")


def slack(k: int) -> float:
    """Times that the window is wider than a prefix: shingles of few words recur in texts with nothing else in common."""
    return 2.0 if k <= 3 else 1.3


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """One row per document: set size, set hash, tokens that can be in the prefix, how many lie in the window, parity bitmap."""
    share = min(1.0, slack(k) * (den - num) / den)
    cut = np.uint64(min(2**64 - 1, int(share * 2**64)))

    def sign(batches):
        for batch in batches:
            doc = ids(column(batch, id_col))
            for a, tokens, at in token_sets(column(batch, text_col), k):
                n = np.diff(at)
                inside = np.array([np.searchsorted(tokens[i:j], cut) for i, j in zip(at, at[1:])], np.int64)
                keep = np.where(n > 0, np.maximum(inside, prefix_length(n, num, den)), 0)
                kept = np.concatenate([tokens[i : i + m] for i, m in zip(at, keep)] or [tokens[:0]])
                hashes = [set_hash(tokens[i:j]) for i, j in zip(at, at[1:])]
                bits = [
                    np.packbits((np.bincount((tokens[i:j] >> np.uint64(3)) & np.uint64(BITS - 1), minlength=BITS) & 1).astype(np.uint8)).tobytes()
                    for i, j in zip(at, at[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[a : a + len(n)]), pa.array(n, pa.int64()),
                        pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
                        lists_of(kept.view(np.int64), np.concatenate([[0], np.cumsum(keep)])),
                        pa.array(np.minimum(inside, keep), pa.int32()), pa.array(bits, pa.binary()),
                    ],
                    ["id", "n", "h1", "h2", "tokens", "inside", "bits"],
                )

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(sign, "id long, n long, h1 long, h2 long, tokens array<long>, inside int, bits binary")


def prefixes(reps: DataFrame, num: int, den: int, ws: Workspace) -> DataFrame:
    """(token, rid) for the tokens of each class's first-order prefix that another class emits, too."""
    rows = reps.select("rid", F.posexplode("tokens").alias("place", "token"))
    # Written first, so that both sides of the join are plain shuffles and a hot token's partition can be split.
    df = ws.save(rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    shared = rows.join(df, "token").join(reps.select("rid", "n", "inside"), "rid")
    first = F.col("place") < F.col("inside")
    of = Window.partitionBy("rid")
    alone = F.col("inside") - F.sum(first.cast("int")).over(of)  # window tokens of this class only: they come first
    among = F.row_number().over(of.orderBy(first.desc(), "df", "token")) - 1
    rank = F.when(first, alone + among).otherwise(F.col("place"))
    p = F.col("n") - F.ceil(F.lit(num) * F.col("n") / F.lit(den)) + 1
    return shared.select("token", "rid", rank.alias("rank"), p.alias("p")).where("rank < p").select("token", "rid")


def candidates(prefix: DataFrame, reps: DataFrame, num: int, den: int, ws: Workspace) -> DataFrame:
    """Spanning edges between classes that share a prefix token and that size and bitmap leave possible."""
    groups = ws.save(prefix.groupBy("token").agg(F.count("*").alias("g")).where("g > 1"), "groups")
    rows = prefix.join(groups, "token").join(reps.select("rid", "n", "bits"), "rid")

    def pair_up(batches):
        for table, unit in _units(batches, ["rid", "n", "bits"]):
            rid, n = table.column("rid").to_numpy(), table.column("n").to_numpy()
            bits = _fixed(table.column("bits"), BITS // 8)
            start = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            size = np.diff(np.append(start, len(unit)))
            i = start[size == 2]
            d = np.bitwise_count(bits[i] ^ bits[i + 1]).sum(axis=1, dtype=np.int64)
            i = i[_close(n[i], n[i + 1], d, num, den)]
            a, b = [rid[i]], [rid[i + 1]]
            for s, m in zip(start[size > 2], size[size > 2]):
                forest, nn, bb = _Forest(m), n[s : s + m], bits[s : s + m]
                for x in range(m - 1):
                    d = np.bitwise_count(bb[x] ^ bb[x + 1 :]).sum(axis=1, dtype=np.int64)
                    for y in np.flatnonzero(_close(nn[x], nn[x + 1 :], d, num, den)):
                        forest.join(x, x + 1 + int(y))
                root = forest.roots()
                moved = np.flatnonzero(root != np.arange(m))
                a.append(rid[s + root[moved]])
                b.append(rid[s + moved])
            yield _edges(np.concatenate(a), np.concatenate(b))

    return _sorted_units(_blocks(rows, "g", "rid", "token")).mapInArrow(pair_up, "a long, b long").distinct()


def _share_prefix(tokens: list[np.ndarray], seed: np.uint64, num: int, den: int) -> np.ndarray:
    """Which pairs share a prefix token under the order of this seed."""
    firsts = []
    for t in tokens:
        h = mix(t ^ seed)
        p = prefix_length(len(h), num, den)
        firsts.append(np.partition(h, p - 1)[:p] if p < len(h) else h)
    row = np.repeat(np.arange(len(tokens)), [len(x) for x in firsts])
    _, token, often = np.unique(np.concatenate(firsts), return_inverse=True, return_counts=True)
    out = np.zeros((len(tokens), len(tokens)), bool)
    if len(tokens) == 2:
        out[:] = (often > 1).any()
        return out
    held = often[token] > 1
    _, token = np.unique(token[held], return_inverse=True)
    row = row[held]
    for at in range(0, int(token.max(initial=-1)) + 1, 2048):
        here = (token >= at) & (token < at + 2048)
        seen = np.zeros((len(tokens), 2048), np.float32)
        seen[row[here], token[here] - at] = 1
        out |= seen @ seen.T > 0
    return out


def _linked(tokens: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Root of each set's component under exact links among these sets."""
    m, n = len(tokens), np.array([len(t) for t in tokens], np.int64)
    maybe = den * np.minimum.outer(n, n) >= num * np.maximum.outer(n, n)
    for seed in _ORDERS:
        maybe &= _share_prefix(tokens, seed, num, den)
    forest = _Forest(m)
    for x in range(m - 1):
        ys = np.flatnonzero(maybe[x, x + 1 :]) + x + 1
        mine = forest.root(x)
        ys = np.array([y for y in ys if forest.root(int(y)) != mine], np.int64)
        if not len(ys):
            continue
        many = np.concatenate([tokens[y] for y in ys])
        at = np.minimum(np.searchsorted(tokens[x], many), n[x] - 1)
        both = np.add.reduceat(tokens[x][at] == many, np.concatenate([[0], np.cumsum(n[ys])[:-1]]), dtype=np.int64)
        for y in ys[den * both >= num * (n[x] + n[ys] - both)]:
            forest.join(x, int(y))
    return forest.roots()


def _place(doc: np.ndarray, size: int) -> np.ndarray:
    """Bit of each id in a filter of ``size`` bits, a power of two."""
    return mix(doc.astype(np.int64).view(np.uint64)) & np.uint64(size - 1)


def id_filter(rows: DataFrame) -> np.ndarray:
    """Bits set at the places of the ids of ``rows``; tasks send words of 64 bits, as many as the filter has at most."""
    size = _FILTER_BITS

    def mark(batches):
        for batch in batches:
            at = _place(ids(column(batch, "id")), size)
            word, of = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, of, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    words = rows.select("id").mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def verify(docs: DataFrame, reps: DataFrame, cand: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """Spanning edges of the exact links inside the candidate components."""
    sizes = cand.groupBy("comp").agg(F.count("*").alias("g"))
    members = cand.join(sizes, "comp").join(reps.select("rid", "id", "h1", "h2"), F.col("node") == F.col("rid"))
    members = members.select("rid", "id", "h1", "h2", "comp", "g")
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(members))

    def sets(batches):
        for batch in batches:
            doc = ids(column(batch, id_col))
            at = _place(doc, 64 * len(wanted.value))
            here = np.flatnonzero(wanted.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1))
            for a, tokens, at in token_sets(column(batch, text_col).take(pa.array(here)), k):
                parts = [tokens[i:j] for i, j in zip(at, at[1:])]
                h = [set_hash(p) for p in parts]
                columns = [pa.array(doc[here[a : a + len(h)]]), pa.array([x[0] for x in h], pa.int64()), pa.array([x[1] for x in h], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([p.tobytes() for p in parts], pa.binary())], ["id", "h1", "h2", "tokens"])

    rows = docs.select(id_col, text_col).mapInArrow(sets, "id long, h1 long, h2 long, tokens binary")
    full = rows.join(members, ["id", "h1", "h2"]).select("rid", "comp", "g", "tokens")

    def check(batches):
        for table, unit in _units(batches, ["rid", "tokens"]):
            rid, tokens = table.column("rid").to_numpy(), table.column("tokens").to_pylist()
            a, b = [], []
            start = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            for s, e in zip(start, np.append(start[1:], len(unit))):
                mine, at = np.unique(rid[s:e], return_index=True)  # rows of one id and set occur once
                root = _linked([np.frombuffer(tokens[s + i], np.uint64) for i in at], num, den)
                moved = np.flatnonzero(root != np.arange(len(mine)))
                a.append(mine[root[moved]])
                b.append(mine[moved])
            yield _edges(np.concatenate(a), np.concatenate(b))

    return _sorted_units(_blocks(full, "g", "rid", "comp")).mapInArrow(check, "a long, b long")


def _classes(docs, ws, id_col, text_col, k, num, den) -> tuple[DataFrame, DataFrame]:
    """(members: id, n, h1, h2) and (h1, h2, component) of every non-empty set."""
    spark = docs.sparkSession
    prepare(spark)
    signed = ws.save(signatures(docs, id_col, text_col, k, num, den), "signatures")
    members = ws.save(signed.select("id", "n", "h1", "h2"), "members")
    one = [F.first(c).alias(c) for c in ("n", "tokens", "inside", "bits")]
    reps = signed.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("id"), *one)
    reps = ws.save(reps.withColumn("rid", F.monotonically_increasing_id()), "classes")
    ws.drop(signed)
    prefix = ws.save(prefixes(reps, num, den, ws), "prefixes")
    pairs = ws.save(candidates(prefix, reps, num, den, ws), "candidates")
    ws.drop(prefix)
    cand = ws.save(components(pairs, ws), "candidate-components")
    links = ws.save(verify(docs, reps, cand, k, num, den, id_col, text_col), "links")
    linked = components(links, ws)
    rooted = reps.select("h1", "h2", "id", "rid").join(linked, F.col("rid") == F.col("node"), "left")
    return members, ws.save(rooted.select("h1", "h2", "id", F.coalesce("comp", "rid").alias("root")), "roots")


def jaccard_components(
    docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) of every document; links at Jaccard >= num / den."""
    ws = Workspace(docs.sparkSession, "jaccard")
    members, rooted = _classes(docs, ws, id_col, text_col, k, num, den)
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("h1", "h2", "component_id")
    out = members.join(named, ["h1", "h2"], "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(id_or_null("id").alias(id_col), F.col("n").alias("n_shingles"), id_or_null("component_id").alias("component_id"))


def drop_copies(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the smallest id's (of its equal rows, one). Documents without words stay."""
    ws = Workspace(docs.sparkSession, "jaccard-drop")
    _, rooted = _classes(docs, ws, id_col, text_col, k, num, den)
    kept = rooted.groupBy("root").agg(F.min(F.struct("id", "h1", "h2")).alias("best")).select("best.*")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in ("__id", "__n", "__h1", "__h2"))])

    def sign(batches):
        for batch in batches:
            n, h = [], []
            for _, tokens, at in token_sets(column(batch, text_col), k):
                n.extend(np.diff(at).tolist())
                h.extend(set_hash(tokens[i:j]) for i, j in zip(at, at[1:]))
            extra = [ids(column(batch, id_col)), n, [x[0] for x in h], [x[1] for x in h]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in extra)], schema.names)

    signed = docs.mapInArrow(sign, schema)
    keys = ["__id", "__h1", "__h2"]
    mine = signed.where("__n > 0").dropDuplicates(keys)
    best = kept.select(F.col("id").alias("__id"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))
    return mine.join(best, keys, "left_semi").select(names).unionByName(signed.where("__n = 0").select(names))
