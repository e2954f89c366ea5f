"""Reproducible stratified splits, k-folds and samples.

Rows are ordered within each class by the md5 of their key (a
deterministic shuffle that needs no seed state and is identical in any
engine). A split needs only the hashes at its two cut ranks: rows compare
their hash with them and are neither shuffled nor sorted. Folds need every
rank; those come from running counts within ranges of the hash, so even a
class holding most rows is ranked by many tasks, never one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.functions import constants as K
from riskloom.functions.exprs import md5_key
from riskloom.operators.ordered import BROADCAST_ROWS, Groups, attach_groups, bucket_sums, group_stats, join_groups, task_rows
from riskloom.operators.quantiles import LEAF_ROWS

# Hex digits by which hashes are counted at a time, and digits of an md5.
DIGITS = 3
MD5_DIGITS = 32
# Rows of a class that share their first digits: few enough that a sort mostly compares those digits.
RUN_ROWS = 1024


def _round_half_up(x: float) -> int:
    return int(Decimal(repr(x)).quantize(Decimal(1), ROUND_HALF_UP))


def hash_rank(df: DataFrame, key: Sequence[str] | str, label: str) -> DataFrame:
    """Add ``_h`` (md5 of the key), ``_rank`` (1-based within the class by ``_h``)
    and ``_n`` (class size)."""
    key = [key] if isinstance(key, str) else list(key)
    d = df.withColumn("_h", md5_key(*key)).withColumn("_one", F.lit(1))
    # hashes spread evenly over their first digits: those are even ranges for any class size, without a pass over the
    # data. A hash stays text: text is compared in place, bytes would be copied for every comparison of the sort.
    groups = group_stats(d, [label], _n=F.count(F.lit(1)))
    digits = _range_digits(groups, task_rows(d, groups.total))
    d = d.withColumn("_bucket", F.substring("_h", 1, digits))
    r = bucket_sums(d, [label], ["_bucket"], ["_h"], ["_one"], groups.n_groups * 16**digits)
    r = attach_groups(r, [label], groups, ["_n"])
    return r.withColumnRenamed("_one_cum", "_rank").drop("_one")


def _range_digits(groups: Groups, most: int) -> int:
    """Hex digits that divide the largest class into ranges of at most ``most`` rows; more of them, down to
    RUN_ROWS, while the counts per class and range stay a table to broadcast."""
    digits = 1
    while 16**digits * most < groups.max_rows:
        digits += 1
    while 16**digits * RUN_ROWS < groups.max_rows and groups.n_groups * 16 ** (digits + 1) <= BROADCAST_ROWS:
        digits += 1
    return digits


def _hash_cuts(hashes: DataFrame, label: str, sizes: Callable[[int], list[int]]) -> dict[object, list[str]]:
    """Per class the ``_h`` of its s-th row in hash order for every s of ``sizes(class size)`` ('' for 0).

    Counts per hash prefix (classes x 16^DIGITS rows) tell which prefix holds a
    cut; a prefix with too many rows is divided by the next digits.
    """
    def prefix_counts(df: DataFrame, digits: int) -> dict:
        out: dict = {}
        for r in df.groupBy(label, F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("c")).collect():
            out.setdefault(r[label], []).append((r["_p"], r["c"]))
        return out

    def under(parts: list[tuple]) -> DataFrame:  # two rows a class: broadcast
        schema = StructType([StructField(label, hashes.schema[label].dataType), StructField("_p", StringType())])
        table = hashes.sparkSession.createDataFrame([p[:2] for p in parts], schema).withColumnRenamed(label, "_y").distinct()
        on = F.col(label).eqNullSafe(F.col("_y")) & F.col("_h").startswith(F.col("_p"))
        return hashes.join(F.broadcast(table), on, "left_semi")

    digits = DIGITS
    counts = prefix_counts(hashes, digits)
    want = {y: sizes(sum(c for _, c in rows)) for y, rows in counts.items()}
    todo = [(y, "", 0, s) for y, ends in want.items() for s in ends if s]
    cut: dict[tuple, str] = {}
    leaves: list[tuple] = []
    while todo:
        deeper = []
        for y, prefix, below, s in todo:
            for p, c in sorted(t for t in counts[y] if t[0].startswith(prefix)):
                if below < s <= below + c:
                    if digits >= MD5_DIGITS:
                        cut[y, s] = p
                    else:
                        (leaves if c <= LEAF_ROWS else deeper).append((y, p, below, s))
                    break
                below += c
        todo, digits = deeper, min(digits + DIGITS, MD5_DIGITS)
        counts = prefix_counts(under(todo), digits) if todo else {}
    rows = prefix_counts(under(leaves), MD5_DIGITS) if leaves else {}
    for y, prefix, below, s in leaves:
        for h, c in sorted(t for t in rows[y] if t[0].startswith(prefix)):
            below += c
            if s <= below:
                cut[y, s] = h
                break
    return {y: [cut.get((y, s), "") for s in ends] for y, ends in want.items()}


def stratified_split(
    df: DataFrame,
    key: Sequence[str] | str,
    label: str = "y",
    oot: float = K.OOT_FRACTION,
    test: float = K.TEST_SIZE,
    out: str = "split",
) -> DataFrame:
    """oot = first round(oot*n_y) rows of each class in hash order; test = the next
    round(test*(n_y - n_oot)); the rest is train. Event rates are equal by design.
    Rows that share a key share their part."""
    key = [key] if isinstance(key, str) else list(key)
    d = df.withColumn("_h", md5_key(*key))

    def sizes(n: int) -> list[int]:
        n_oot = _round_half_up(oot * n)
        return [n_oot, n_oot + _round_half_up(test * (n - n_oot))]

    cuts = [(y, *last) for y, last in _hash_cuts(d.select(label, "_h"), label, sizes).items()]
    schema = StructType([StructField(label, df.schema[label].dataType), StructField("_c1", StringType()), StructField("_c2", StringType())])
    r = join_groups(d, d.sparkSession.createDataFrame(cuts, schema), [label], len(cuts) <= BROADCAST_ROWS)
    split = F.when(F.col("_h") <= F.col("_c1"), "oot").when(F.col("_h") <= F.col("_c2"), "test").otherwise("train")
    return r.withColumn(out, split).drop("_h", "_c1", "_c2")


def stratified_kfold(df: DataFrame, key: Sequence[str] | str, label: str = "y", k: int = K.CV_FOLDS) -> DataFrame:
    """fold = (rank - 1) % k within each class: class-balanced folds."""
    r = hash_rank(df, key, label)
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank", "_n")


def sample_n(df: DataFrame, key: Sequence[str] | str, n: int) -> DataFrame:
    """n reproducible rows: smallest md5 of the key (a distributed top-k)."""
    key = [key] if isinstance(key, str) else list(key)
    return df.withColumn("_h", md5_key(*key)).orderBy("_h").limit(n).drop("_h")
