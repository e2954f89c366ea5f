"""Repeated passages across documents by a sparse suffix array.

Only suffixes at content-selected positions are kept: the minimiser (least
4-word hash) of every ``WINDOW`` consecutive positions. Two copies of a
passage of ``MIN_WORDS`` words select the same positions, the first of them
within ``WINDOW`` words, so ``HEAD = MIN_WORDS - WINDOW + 1`` words from there
lie inside both.

1. A scan emits (hash of the HEAD words, id, word) of every selected suffix;
   heads that only one id holds are dropped after a count with map-side sums.
2. The documents that hold shared heads are read again: every shared suffix
   gets WINDOW words to its right (after the head) and to its left.
3. The suffixes are range-partitioned and sorted by (head, right, left, id).
   A passage of MIN_WORDS words around a head has one of WINDOW places: l
   words left of it and WINDOW - 1 - l right. For each l, neighbours in order
   that agree in all of these words form a group; with two ids in it, all its
   members repeat. Range borders can fall inside a head, so a passage that a
   third of all documents hold is spread.
4. What agrees need not be adjacent: others sort between, or the copy lies in
   another range. Members of groups of one id, whose head has other groups or
   touches a range border, are looked up by the hash of the whole passage
   (least and largest id a hash, map-side), against each other and the groups
   with two ids.
5. The union of these passages is every word of a repeated passage of
   MIN_WORDS words: any such passage holds a selected head in all its copies.
   Overlapping spans of a document are merged.

Defined results: a null or empty text has no passage; rows that share an id
are one document, so equal rows with one id do not repeat each other; rows
with a null id are one document, reported with a null id; an empty table gives
an empty result; extra columns are ignored. Words are compared by 64-bit
(heads) and 32-bit (extensions) hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, Workspace, column, id_or_null, ids, prepare, text_bytes
from riskloom.llm.jaccard_join import row_slices
from riskloom.llm.words import chain, mix, words

MIN_WORDS = 50
WINDOW = 16
GRAM = 4


def selected(h: np.ndarray, at: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the minimiser positions that have ``head`` words before the row's end."""
    rows, places = [], []
    grams = chain(h, GRAM)
    if len(grams) >= WINDOW:
        least = np.arange(len(grams) - WINDOW + 1) + np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1)
        for row, (a, b) in enumerate(zip(at, at[1:])):
            if b - a >= head + WINDOW - 1:
                pos = np.unique(least[a : b - GRAM - WINDOW + 2])
                pos = pos[pos + head <= b]
                rows.append(np.full(len(pos), row))
                places.append(pos)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(rows or none), np.concatenate(places or none)


def _suffixes(batch: pa.RecordBatch, head: int):
    """(first row, word hashes, offsets, rows, places, head hashes) piece by piece."""
    data, offsets = text_bytes(column(batch, "text"))
    for a, b in row_slices(offsets):
        h, at, _, _ = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        rows, places = selected(h, at, head)
        yield a, h, at, rows, places, chain(h, head)[places]


def _contexts(h: np.ndarray, at: np.ndarray, rows, places, head: int) -> tuple[np.ndarray, np.ndarray]:
    """WINDOW words after the head and WINDOW words before it (nearest first); beyond the text nothing matches."""
    low = np.maximum((h & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.uint32(1))  # 0: beyond the text
    steps = np.arange(WINDOW)
    r, l = places[:, None] + head + steps, places[:, None] - 1 - steps
    right = np.where(r < at[rows + 1][:, None], low[np.minimum(r, len(h) - 1)], np.uint32(0))
    left = np.where(l >= at[rows][:, None], low[np.maximum(l, 0)], np.uint32(0))
    return right.astype(">u4"), left.astype(">u4")


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading equal words of two context tables, row by row, up to the end of either text."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


class _Sorted:
    """Suffixes in order, as arrays."""

    def __init__(self, table):
        self.head, self.id, self.place = (column_of(table, c) for c in ("head", "id", "place"))
        self.right, self.left = (_matrix(table, c) for c in ("right", "left"))

    def key(self, i: np.ndarray, l: int) -> np.ndarray:
        """Hash of the passage around the heads of ``i`` with ``l`` words left."""
        h = mix(self.head[i].view(np.uint64) + np.uint64(l + 1))
        for c in range(l):
            h = mix(h + self.left[i, c].astype(np.uint64))
        for c in range(WINDOW - 1 - l):
            h = mix(h + self.right[i, c].astype(np.uint64))
        return h.view(np.int64)

    def matches(self, head: int):
        """Spans (id, start, end) shared by adjacent suffixes of two ids, and open passages (key, least id, largest id, start or -1)."""
        n = len(self.id)
        same = np.append(False, self.head[1:] == self.head[:-1])
        of = np.cumsum(~same) - 1
        border = np.zeros(of[-1] + 1, bool)
        border[[0, -1]] = True
        right, left = (np.append(0, _same(x[1:], x[:-1])) for x in (self.right, self.left))
        far_right, far_left = ((x != 0).sum(axis=1) for x in (self.right, self.left))
        least_l, most_l = np.full(n, WINDOW), np.full(n, -1)
        rest = []
        for l in range(WINDOW):
            whole = (far_left >= l) & (far_right >= WINDOW - 1 - l)
            first = np.flatnonzero(~(same & (left >= l) & (right >= WINDOW - 1 - l)))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
            least, most = np.minimum.reduceat(self.id, first), np.maximum.reduceat(self.id, first)
            many = least != most
            found = many[group] & whole
            least_l[found] = np.minimum(least_l[found], l)
            most_l[found] = l
            others = np.bincount(of[first[whole[first]]], minlength=len(border)) > 1
            lone = np.flatnonzero(whole & ~found & (others | border)[of])
            asked = border.copy()
            asked[of[lone]] = True
            known = np.flatnonzero(many & whole[first] & asked[of[first]])
            rest.append((self.key(lone, l), self.id[lone], self.id[lone], self.place[lone] - l))
            rest.append((self.key(first[known], l), least[known], most[known], np.full(len(known), -1)))
        i = np.flatnonzero(most_l >= 0)
        spans = self.id[i], self.place[i] - most_l[i], self.place[i] + head + WINDOW - 1 - least_l[i]
        return spans, tuple(np.concatenate(x) for x in zip(*rest))


def column_of(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _matrix(table, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), ">u4").reshape(-1, WINDOW)


_RECORD = "head long, right binary, left binary, id long, place long"


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, start_word, end_word, n_words) of every passage of ``min_words`` words that another document holds, too."""
    if min_words < WINDOW + GRAM + 1:
        raise ValueError(f"min_words must be {WINDOW + GRAM + 1} at least")
    spark, head = docs.sparkSession, min_words - WINDOW + 1
    prepare(spark)
    ws = Workspace(spark, "repeats")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("text"))  # places are kept per text: an id can have any number of texts

    def emit(batches):
        for batch in batches:
            doc, text = ids(column(batch, "id")), column(batch, "row").to_numpy()
            for a, _, at, row, place, key in _suffixes(batch, head):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(doc[a + row]), pa.array(text[a + row]), pa.array(place - at[row])],
                    ["head", "id", "row", "place"],
                )

    suffixes = ws.save(rows.mapInArrow(emit, "head long, id long, row long, place long"), "suffixes")
    shared = suffixes.groupBy("head").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most").select("head")
    shared = ws.save(shared, "shared")  # both sides of the join are then plain shuffles, a hot head's can be split
    held = suffixes.join(shared, "head").groupBy("id", "row").agg(F.collect_set("place").alias("places"))  # of one text
    held = ws.save(held, "held")

    def extend(batches):
        for batch in batches:
            doc, wanted = ids(column(batch, "id")), column(batch, "places").to_pylist()
            for a, h, at, row, place, key in _suffixes(batch, head):
                keep = np.zeros(len(place), bool)
                for r in np.unique(row):
                    mine = row == r
                    keep[mine] = np.isin(place[mine] - at[r], wanted[a + r])
                row, place, key = row[keep], place[keep], key[keep]
                right, left = _contexts(h, at, row, place, head)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)), pa.array([x.tobytes() for x in right], pa.binary()),
                        pa.array([x.tobytes() for x in left], pa.binary()), pa.array(doc[a + row]), pa.array(place - at[row]),
                    ],
                    ["head", "right", "left", "id", "place"],
                )

    records = ws.save(rows.join(held, ["id", "row"]).mapInArrow(extend, _RECORD), "records")
    ws.drop(suffixes)
    spans = _in_order(records, head, min_words, ws)
    by = Window.partitionBy("id").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    merged = spans.distinct().withColumn("reach", reach).withColumn("island", island).groupBy("id", "island")
    merged = merged.agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"))
    return merged.select(id_or_null("id").alias(id_col), "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))


_ORDER = ("head", "right", "left", "id", "place")


def _in_order(records: DataFrame, head: int, min_words: int, ws: Workspace) -> DataFrame:
    """(id, start, end) of the parts of every suffix's surroundings that another id shares over ``min_words``."""
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = records.distinct().repartitionByRange(n, *_ORDER).sortWithinPartitions(*_ORDER)

    def compare(batches):
        batches = [b for b in batches if b.num_rows]  # one range: its size follows the number of partitions
        if not batches:
            return
        (doc, start, end), (key, least, most, at) = _Sorted(pa.Table.from_batches(batches)).matches(head)
        m, k = len(doc), len(key)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([doc, least])), pa.array(np.concatenate([doc, most])), pa.array(np.concatenate([start, at])),
                pa.array(np.concatenate([end, at + min_words])), pa.array(np.concatenate([np.zeros(m, np.int64), key])),
                pa.array(np.arange(m + k) >= m),
            ],
            ["id", "most", "start", "end", "key", "open"],
        )

    compared = ws.save(ranged.mapInArrow(compare, "id long, most long, start long, end long, key long, open boolean"), "compared")
    rest = compared.where("open")
    keys = rest.groupBy("key").agg(F.min("id").alias("least"), F.max("most").alias("largest")).where("least <> largest").select("key")
    keys = ws.save(keys, "keys")  # both sides of the join are then plain shuffles, a hot key's can be split
    again = rest.where("start >= 0").join(keys, "key")
    return compared.where("not open").select("id", "start", "end").unionByName(again.select("id", "start", "end"))
