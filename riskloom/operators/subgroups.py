"""AUC of every subgroup from one sort by score.

Scores are collapsed to one row per score and combination of group values,
dealt by ranges of the score, and read once in score order. Each task keeps a
vector of negatives seen so far, one entry per group value, and adds up every
group's positives times the negatives below them (ties count one half). What
lies below a range is added afterwards from the ranges' totals: a few numbers
per group value and range. More group columns make the vector longer, never
the data: no row is copied per group column.

Range bounds never split equal scores, so ties meet in one task; a hot score
is a few collapsed rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OVERALL = ("OVERALL", "All")
_PARTIAL = "lo double, group_col int, group_val string, pos long, neg long, num double"
_SCHEMA = pa.schema([
    ("lo", pa.float64()), ("group_col", pa.int32()), ("group_val", pa.string()), ("pos", pa.int64()), ("neg", pa.int64()),
    ("num", pa.float64()),
])


class _Vector:
    """Totals per value of one group column."""

    def __init__(self) -> None:
        self.codes: dict[str | None, int] = {}
        self.pos = np.zeros(0, np.int64)
        self.neg = np.zeros(0, np.int64)
        self.num = np.zeros(0)

    def encode(self, values: pa.Array) -> np.ndarray:
        d = values.dictionary_encode(null_encoding="encode")
        known = np.array([self.codes.setdefault(v, len(self.codes)) for v in d.dictionary.to_pylist()], np.int64)
        grow = len(self.codes) - len(self.pos)
        if grow:
            self.pos, self.neg = (np.append(x, np.zeros(grow, np.int64)) for x in (self.pos, self.neg))
            self.num = np.append(self.num, np.zeros(grow))
        return known[d.indices.to_numpy(zero_copy_only=False).astype(np.int64)]

    def add(self, code: np.ndarray, run: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        """Rows in score order; ``run`` numbers equal scores, which are complete."""
        order = np.lexsort((run, code))
        code, run, pos, neg = code[order], run[order], pos[order], neg[order]
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (run[1:] != run[:-1])))
        p, n, c = np.add.reduceat(pos, first), np.add.reduceat(neg, first), code[first]
        below = np.cumsum(n) - n
        start = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        below -= np.repeat(below[start], np.diff(np.append(start, len(c))))
        below += self.neg[c]
        self.num += np.bincount(c, p * (below + n / 2.0), len(self.num))
        self.pos += np.bincount(c, p, len(self.pos)).astype(np.int64)
        self.neg += np.bincount(c, n, len(self.neg)).astype(np.int64)


def _partials(n_cols: int):
    """Per range of scores and group value: positives, negatives, and positives times negatives below them in the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, lo, held = [_Vector() for _ in range(n_cols + 1)], None, None

        def take(table: pa.Table) -> None:
            s = table.column("s").to_numpy()
            new = (s[1:] != s[:-1]) & ~(np.isnan(s[1:]) & np.isnan(s[:-1]))
            runs = np.cumsum(np.append(0, new))
            pos, neg = (table.column(c).to_numpy() for c in ("pos", "neg"))
            vectors[0].add(vectors[0].encode(pa.repeat(None, len(s)).cast(pa.string())), runs, pos, neg)
            for i in range(n_cols):
                values = table.column(f"g{i}").combine_chunks()
                values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
                vectors[i + 1].add(vectors[i + 1].encode(values), runs, pos, neg)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            if lo is None:
                lo = batch.column(0)[0].as_py()
            if held is not None:
                table = pa.concat_tables([held, table])
            # the last score may go on in the next batch
            s = table.column("s").to_numpy()
            last = s[-1]
            cut = int(np.argmax(np.isnan(s))) if np.isnan(last) else int(np.searchsorted(s, last, "left"))
            if cut:
                take(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None:
            take(held)
            for i, v in enumerate(vectors):
                n = len(v.pos)
                cols = [np.full(n, lo), np.full(n, i, np.int32), list(v.codes), v.pos, v.neg, v.num]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)

    return run


def subgroup_auc(df: DataFrame, score: str, label: str, group_cols: Sequence[str]) -> DataFrame:
    """(group_col, group_val, n_pos, n_neg, auc): a row for all rows (OVERALL, All) and one per value of every column.

    Group values are compared as text, NULL is a value. Rows without a score
    or label are left out; groups of one class have no AUC.
    """
    kept = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    rows = kept.select(
        F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"),
        *[F.col(f"`{c}`").cast("string").alias(f"g{i}") for i, c in enumerate(group_cols)],
    )
    names = [f"g{i}" for i in range(len(group_cols))]
    collapsed = rows.groupBy("s", *names).agg(F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    ranged = collapsed.repartitionByRange("s").sortWithinPartitions("s").select("s", "pos", "neg", *names)
    parts = ranged.mapInArrow(_partials(len(group_cols)), _PARTIAL)
    below = F.sum("neg").over(Window.partitionBy("group_col", "group_val").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("num", F.col("num") + F.col("pos") * F.coalesce(below, F.lit(0)).cast("double"))
    total = parts.groupBy("group_col", "group_val").agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("num").alias("num"))
    labels = F.array(*[F.lit(c) for c in (OVERALL[0], *group_cols)])
    return total.select(
        F.get(labels, F.col("group_col")).alias("group_col"),
        F.when(F.col("group_col") == 0, F.lit(OVERALL[1])).otherwise(F.col("group_val")).alias("group_val"),
        "n_pos",
        "n_neg",
        F.try_divide("num", F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
    )
