"""Document fingerprints: one-permutation MinHash with optimal densification, in Spark's own expressions.

A document is its set of ``k``-word shingles (words ``[^\\x20\\x09-\\x0D]+``
with A-Z lower-cased; 1..k-1 words are one shingle). Every shingle is hashed
once: the upper bits of the hash choose one of ``bins`` bins and the least
hash of a bin is its value. An empty bin takes the value of the occupied bin
that comes first in the empty bin's own random order of all bins (optimal
densification: uniform over the occupied bins, independent between bins,
equal for two documents whenever that bin is occupied in both). Of each
value ``bits`` low-order bits are kept, packed into 64-bit words.

The likeness of two fingerprints is the share of equal bins, corrected for
the 2**-bits of unlike bins that agree by chance, and lies in 0..1.

Everything is a column expression: arrays live inside a row, rows never
meet, and nothing is shuffled. ``edited_pairs`` (below) also needs each
document's successor; its rows are cut into id ranges for that.

Nulls and empty texts have no words; texts without words share the empty
fingerprint, which is like itself (1) and unlike all others (0). Very long
texts are whole: their hashes are one array of 8 bytes a word. Rows are
independent, so repeated rows, ties and extra columns change nothing; an
empty table gives no rows. Two different words share their 32-bit code with
a chance of 2**-32, which may raise a likeness.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID

K, BINS, BITS = 5, 256, 4
# Candidates of a bin's random order that are tried one by one before all occupied bins are ranked.
PROBES = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "[\\x20\\x09-\\x0D]+"
# Ranges of ids per shuffle partition when successors are looked up.
RANGES_PER_PARTITION = 4
# Copies of one row that one task writes at most, when an id is frequent.
COPY_CHUNK = 10_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _numbers(values, kind: str) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _hash_two(a: int, b: int) -> int:
    """Spark's ``xxhash64`` of two bigints."""
    h = 42
    for v in (a, b):
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h - 2**64 if h >= 2**63 else h


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SPACES), lambda w: w != "")


def shingle_hashes(text: Column, k: int = K) -> Column:
    """A 63-bit hash of every shingle, in order."""
    codes = F.transform(words(text), lambda w: F.crc32(F.encode(w, "utf-8")))

    def runs(c: Column) -> Column:
        first = F.slice(c, 1, F.greatest(F.size(c) - (k - 1), F.lit(1)))
        # xxhash64 passes over nulls, so fewer than k words are hashed as they are
        return F.transform(first, lambda x, i: F.shiftrightunsigned(F.xxhash64(x, *[F.get(c, i + j) for j in range(1, k)]), 1))

    return _let(codes, runs)


def bin_minima(hashes: Column, bins: int = BINS) -> Column:
    """The least hash of every bin, in bin order; a bin without one holds its largest possible hash."""
    shift = 64 - bins.bit_length()
    ends = _numbers([(j << shift) | ((1 << shift) - 1) for j in range(bins)], "bigint")

    def firsts(s: Column) -> Column:
        new = lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s, i - 1), shift))
        return F.filter(s, new)

    return _let(F.sort_array(F.concat(hashes, ends)), firsts)


def densify(minima: Column, bins: int = BINS) -> Column:
    """Values of empty bins from the occupied bin that their random order names first."""
    shift = 64 - bins.bit_length()
    top = (1 << shift) - 1
    order = [sorted(range(bins), key=lambda i: _hash_two(j, i)) for j in range(bins)]
    table = _numbers([i for j in range(bins) for i in order[j][:PROBES]], "int")
    rank_mask = ~(bins - 1)

    def occupied(x: Column) -> Column:
        return x.bitwiseAND(F.lit(top)) != F.lit(top)

    def fill(m: Column) -> Column:
        def with_list(held: Column) -> Column:
            def ranked(j: Column) -> Column:
                ranks = F.transform(
                    held, lambda b: F.xxhash64(j, b).bitwiseAND(F.lit(rank_mask)).bitwiseOR(b)
                )
                return F.get(m, F.array_min(ranks).bitwiseAND(F.lit(bins - 1)).cast("int"))

            def value(x: Column, j: Column) -> Column:
                probes = [_let(F.get(m, F.get(table, j * PROBES + t)), lambda y: F.when(occupied(y), y)) for t in range(PROBES)]
                return F.when(occupied(x), x).otherwise(F.coalesce(*probes, ranked(j.cast("bigint"))))

            return F.transform(m, value)

        return _let(F.transform(F.filter(m, occupied), lambda x: F.shiftright(x, shift)), with_list)

    return _let(minima, fill)


def pack(values: Column, bits: int = BITS, bins: int = BINS) -> Column:
    """Low-order ``bits`` of every value, the first bin in the highest bits of the first word."""
    per = 64 // bits
    low = (1 << bits) - 1

    def word(v: Column, g: int) -> Column:
        add = lambda a, x: F.shiftleft(a, bits).bitwiseOR(x.bitwiseAND(F.lit(low)))
        return F.aggregate(F.slice(v, g * per + 1, per), F.lit(0).cast("bigint"), add)

    return _let(values, lambda v: F.array(*[word(v, g) for g in range(bins // per)]))


def fingerprint(text: Column, k: int = K, bins: int = BINS, bits: int = BITS) -> Column:
    """Packed fingerprint of a text column as ``array<bigint>``; empty for texts without words.

    ``bins`` is a power of two, ``bits`` divides 64 and ``bins`` is a multiple of 64 / ``bits``.
    """
    hashes = shingle_hashes(text, k)
    none = F.array().cast("array<bigint>")
    return _let(hashes, lambda h: F.when(F.size(h) == 0, none).otherwise(pack(densify(bin_minima(h, bins), bins), bits, bins)))


def to_hex(packed: Column) -> Column:
    """16 hexadecimal digits a word."""
    return F.array_join(F.transform(packed, lambda p: F.lpad(F.lower(F.hex(p)), 16, "0")), "")


def likeness(a: Column, b: Column, bits: int = BITS, bins: int = BINS) -> Column:
    """Estimated Jaccard similarity of the texts behind two packed fingerprints."""
    per = 64 // bits
    lowest = sum(1 << (bits * i) for i in range(per))
    lowest -= 2**64 if lowest >= 2**63 else 0

    def unlike(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        spread = d
        for s in range(1, bits):
            spread = spread.bitwiseOR(F.shiftright(d, s))
        return F.bit_count(spread.bitwiseAND(F.lit(lowest).cast("bigint")))

    bad = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda s, x: s + x)
    equal = (F.lit(bins) - bad).cast("double") / F.lit(float(bins))
    chance = 2.0**-bits
    corrected = F.greatest((equal - F.lit(chance)) / F.lit(1.0 - chance), F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(corrected)


def _place(x: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``x``: first among every ``step``-th one, then inside that step."""
    step = max(1, math.isqrt(len(cuts)))
    fine, coarse = _numbers(cuts, "bigint"), _numbers(cuts[step - 1 :: step], "bigint")

    def upto(of: Column) -> Column:
        return F.size(F.filter(of, lambda c: c <= x))

    return _let(upto(coarse) * step, lambda at: at + upto(F.slice(fine, at + 1, F.lit(step))))


def _ranges(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with ``r`` and ``sub``, which grow with (``oid``, ``h``), and whether an id is frequent.

    ``r`` is a range of ids between approximate quantiles; an id on several
    quantiles is frequent and its rows are divided further by their text's hash.
    """
    n = RANGES_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx("oid", probs, max(10_000, 20 * n))).first()[0] or [0]
    hot = {v: cuts.count(v) + 1 for v in set(cuts) if cuts.count(v) > 1}
    rows = rows.withColumn("r", _place(F.col("oid"), sorted(set(cuts))))
    sub = F.lit(0)
    if hot:
        at = F.create_map(*[x for v, c in hot.items() for x in (F.lit(v), F.lit(c))])
        share = (F.col("h").cast("double") + 2.0**63) / 2.0**64
        size = F.element_at(at, F.col("oid"))
        above = F.lit(max(hot.values()) + 1)
        sub = F.when(size.isNotNull(), F.least(F.floor(share * size), size - 1)).otherwise(above)
    return rows.withColumn("sub", sub.cast("int")), bool(hot)


def with_next(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with their fingerprint ``fp`` and the next row's text and fingerprint; after the last comes the first.

    Each range of ids is one window partition. The first row of the following
    range joins a range as a guest at its end, so no row needs a join.
    Where an id is frequent, equal rows are collapsed before anything is
    shuffled by range and ``copies`` counts them.
    """
    rows, hot = _ranges(rows)
    if hot:
        rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("bigint"))
    first = rows.groupBy("r", "sub").agg(F.min(F.struct("oid", "h", "text")).alias("f"))
    line = Window.orderBy("r", "sub")  # one row per range
    guests = first.withColumn("g", F.coalesce(F.lead("f").over(line), F.first("f").over(line)))
    guests = guests.select("g.*", "r", "sub", F.lit(0).cast("bigint").alias("copies"))
    both = rows.select(guests.columns).withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
    both = both.withColumn("fp", fingerprint(F.col("text")))
    w = Window.partitionBy("r", "sub").orderBy("guest", "oid", "h", "text")
    return both.withColumns({f"next_{c}": F.lead(c).over(w) for c in ("text", "fp")}).where("guest = 0"), hot


def _copies(pairs: DataFrame) -> DataFrame:
    """One row per copy: a copy's next row is a copy, the last one's is the next text. Long runs are dealt to several tasks."""
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPY_CHUNK)))
    runs = pairs.withColumn("chunk", chunk)
    size = F.least(F.lit(COPY_CHUNK), F.col("copies") - F.col("chunk") * COPY_CHUNK)
    rows = runs.withColumn("n", size).repartition("oid", "h", "chunk")
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    inner = F.col("chunk") * COPY_CHUNK + F.col("i") < F.col("copies")
    return rows.withColumns({c: F.when(inner, F.col(c[5:])).otherwise(F.col(c)) for c in ("next_text", "next_fp")})


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they and the next document's are.

    Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text replaces the
    last quarter of the code points by as many from the start of the next
    document. Documents follow in ascending doc_id, null ids last; rows of
    one id follow by a hash of their text, then by text. One shuffle of the
    texts, by ranges of ids.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("oid"), text.alias("text"), F.xxhash64(text).alias("h"))
    pairs, hot = with_next(rows)
    if hot:
        pairs = _copies(pairs)
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    pairs = pairs.select("oid", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    pairs = pairs.select("*", fingerprint(F.col("edited")).alias("edited_fp"))
    return pairs.select(
        F.when(F.col("oid") != NO_ID, F.col("oid")).alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        to_hex(F.col("fp")).alias("fingerprint"),
        to_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
