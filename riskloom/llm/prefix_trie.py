"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns (role, text); every distinct sequence
of first turns is a node, the empty one is the root. A node's members are
the conversations that start with it, its id is its smallest member.

Method: a conversation's turns become digests, and its digests become blocks
of ``block`` turns; a block's key hashes the key of the block before it and
the digests inside. Equal conversations are collapsed to one path first.
Paths are grouped by block keys. Where every path that reaches a block runs
through it whole, all nodes in the block have the same members and the block
is one unit; turn boundaries are hashed (and become units) only in blocks
where paths part or end.

A node's smallest path owns it, and the nodes that a path owns are the last
ones of the path, from depth ``o`` on. So children, leaves and saved tokens
of a subtree are sums over the paths through a unit, given each path's ``o``:
two groupings of the units and no walk over levels. Groupings are combined
before the shuffle, so a unit that a third of all paths share is one row a
task. The ids that end at a node are hashed as a sorted stream.

Texts are never shuffled, only 16-byte digests and word counts. Null roles
and texts count as empty; null turns come first, rows of one turn follow by
their digest. Rows with a null ``conv_id`` belong to no conversation and are
not read. Very long texts count whole. Repeated rows are repeated turns.
Extra columns are not read. Without conversations there is no root: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import Workspace, column, prepare

BLOCK = 4
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
WORD = "[^\\x20\\x09-\\x0D]+"

BLOCKS = (
    "conv_id long, k long, parent binary, key binary, turns array<binary>, words array<long>, cum long, "
    "first long, last long, is_end boolean"
)
ENDS = "end binary, rep long, mult long, ends_sha256 string"


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, rank from 1, digest, n_words) of every turn, in the order of its conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat_ws(":", F.char_length(role).cast("string"), F.concat(role, text))))
    light = rows.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words")
    )
    line = Window.partitionBy("conv_id").orderBy("turn", "digest")
    return light.select("conv_id", F.row_number().over(line).cast("long").alias("rank"), "digest", "n_words")


def _block_rows(block: int):
    """Cut every conversation's stream of turns into block rows; block 0 is the root."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("k", pa.int64()), ("parent", pa.binary()), ("key", pa.binary()), ("turns", pa.list_(pa.binary())),
        ("words", pa.list_(pa.int64())), ("cum", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("is_end", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, digests, words = None, [], []

        def close() -> tuple:
            """The next block from the turns gathered so far."""
            conv, k, key, cum, last = held
            cum, last, parent = cum[0] + cum[1], last, key
            new = hashlib.md5(parent + b"".join(digests), usedforsecurity=False).digest()
            return (conv, k + 1, parent, new, digests, words, cum, last + 1, last + len(digests))

        waiting = None  # a finished block; whether the conversation ends with it shows with the next row
        for batch in batches:
            cols = [column(batch, n).to_pylist() for n in ("conv_id", "digest", "n_words")]
            for conv, digest, n in zip(*cols):
                if digest is None:  # a conversation begins
                    if held is not None:
                        if digests:
                            yield (*waiting, False)
                            waiting = close()
                        yield (*waiting, True)
                    held, digests, words = (conv, 0, ROOT, (0, 0), 0), [], []
                    waiting = (conv, 0, None, ROOT, [], [0], 0, 0, 0)
                    continue
                digests.append(digest)
                words.append(n)
                if len(digests) == block:
                    yield (*waiting, False)
                    waiting = close()
                    held = (conv, waiting[1], waiting[3], (waiting[6], sum(words)), waiting[8])
                    digests, words = [], []
        if held is not None:
            if digests:
                yield (*waiting, False)
                waiting = close()
            yield (*waiting, True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in run(batches):
            rows.append(row)
            if len(rows) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return cut


def _end_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per end of paths: smallest conversation, how many end there, SHA-256 of their sorted ids."""
    schema = pa.schema([("end", pa.binary()), ("rep", pa.int64()), ("mult", pa.int64()), ("ends_sha256", pa.string())])
    now, rep, mult, sha = None, 0, 0, None
    for batch in batches:
        out = []
        for end, conv in zip(column(batch, "key").to_pylist(), column(batch, "conv_id").to_pylist()):
            if end != now:
                if now is not None:
                    out.append((now, rep, mult, sha.hexdigest()))
                now, rep, mult, sha = end, conv, 0, hashlib.sha256()
            sha.update((f",{conv}" if mult else f"{conv}").encode())
            mult += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((now, rep, mult, sha.hexdigest()), schema)], schema=schema)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def _units(paths: DataFrame) -> DataFrame:
    """A unit per block that no path leaves or enters inside, else a unit per turn."""

    def whole() -> Column:
        return F.array(F.struct("key", "parent", "first", "last", "words", "cum"))

    def prefix(j: Column) -> Column:
        """Key of the first ``j`` turns of the block."""
        inner = F.unhex(F.md5(F.aggregate(F.slice("turns", 1, j), F.col("parent"), lambda a, x: F.concat(a, x))))
        return F.when(j == 0, F.col("parent")).when(j == F.size("turns"), F.col("key")).otherwise(inner)

    def single(_, i: Column) -> Column:
        depth = F.col("first") + i
        before = F.col("cum") + _sum(F.slice("words", 1, i))
        return F.struct(
            prefix(i + 1).alias("key"), prefix(i).alias("parent"), depth.alias("first"), depth.alias("last"),
            F.slice("words", i + 1, 1).alias("words"), before.alias("cum"),
        )

    parts = (F.col("n_before") > F.col("n")) & (F.size("turns") > 1)
    unit = F.explode(F.when(parts, F.transform("turns", single)).otherwise(whole()))
    return paths.select("conv_id", "mult", "length", "total", "ends_sha256", unit.alias("u")).select("*", "u.*").drop("u")


def trie(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """All nodes of the conversations in ``sequences``.

    ``sequences``: conv_id, digest, n_words, dealt and sorted by conversation
    in turn order, each conversation begun by a row with a null digest.
    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 per node.
    """
    spark = sequences.sparkSession
    prepare(spark)
    ws = Workspace(spark, "trie")
    blocks = ws.save(sequences.select("conv_id", "digest", "n_words").mapInArrow(_block_rows(block), BLOCKS), "blocks")

    tail = F.col("cum") + _sum(F.col("words"))
    ends = blocks.where("is_end").select("conv_id", "key", F.col("last").alias("length"), tail.alias("total"))
    heads = ends.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_end_rows, ENDS)
    reps = heads.join(ends, F.col("rep") == F.col("conv_id")).select("conv_id", "mult", "length", "total", "ends_sha256")
    paths = ws.save(blocks.drop("is_end").join(reps, "conv_id"), "paths")

    # how many paths run through each block; most blocks belong to one path
    shared = ws.save(paths.where("k > 0").groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    n_all = paths.where("k = 0").count()
    counted = paths.join(shared, "key", "left").withColumn("n", F.when(F.col("k") == 0, n_all).otherwise(F.coalesce("n", F.lit(1))))
    before = F.lag("n").over(Window.partitionBy("conv_id").orderBy("k"))
    units = ws.save(_units(counted.withColumn("n_before", F.coalesce(before, F.col("n")))), "units")

    owners = ws.save(
        units.groupBy("key").agg(
            F.min("conv_id").alias("owner"), F.count("*").alias("n_paths"), F.min("first").alias("first"), F.min("cum").alias("cum")
        ), "owners",
    )
    mine = owners.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("first").alias("o"), F.min_by("cum", "first").alias("cum_o"), (F.min("n_paths") == 1).alias("leaf")
    )
    known = units.join(ws.save(mine, "owned"), "conv_id", "left")
    after = F.col("total") - F.col("cum") - _sum(F.col("words"))
    own_after = F.when(F.col("o") <= F.col("last") + 1, after).otherwise(F.col("total") - F.col("cum_o"))
    child = (F.col("length") > F.col("last")) & (F.col("o") <= F.col("last") + 1)
    sums = known.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("mult").alias("n_convs"),
        F.sum(F.col("mult") * after).alias("after"),
        F.sum(F.coalesce(own_after, F.lit(0))).alias("own_after"),
        F.count_if(child).alias("children"),
        F.count_if("leaf").alias("n_leaves"),
        F.max(F.when(F.col("length") == F.col("last"), F.col("ends_sha256"))).alias("ends"),
    )
    # only a path's first own unit hangs on another path's node
    above = owners.select(F.col("key").alias("parent"), F.col("owner").alias("above"))
    joints = known.where("o = first").select("key", "conv_id", "parent").join(above, "parent").select("key", "conv_id", "above")
    nodes = units.select("key", "conv_id", "first", "last", "words").join(ws.save(sums, "sums"), ["key", "conv_id"])
    nodes = nodes.join(joints, ["key", "conv_id"], "left").select("*", F.posexplode("words").alias("i", "w"))

    depth = F.col("first") + F.col("i")
    at_end = depth == F.col("last")
    rest = _sum(F.slice("words", F.col("i") + 1, F.size("words")))
    own = F.when(depth > 0, F.when(F.col("i") > 0, F.col("conv_id")).otherwise(F.coalesce("above", "conv_id")))
    return nodes.select(
        "conv_id",
        depth.alias("depth"),
        own.alias("parent_conv_id"),
        "n_convs",
        F.when(at_end, F.col("children")).otherwise(1).alias("n_children"),
        "n_leaves",
        (F.col("after") - F.col("own_after") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
    )


def _dealt(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """Each conversation's opening row, then its turns by (part, rank), in the partitions of ``trie``."""
    opening = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("rank"))
    both = opening.unionByName(steps, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "rank")


def conversation_trie(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of conversations as they are."""
    steps = turns(rows)
    return trie(_dealt(steps.select("conv_id").distinct(), steps.withColumn("part", F.lit(0))), block)


def rebuilt(rows: DataFrame) -> DataFrame:
    """Turns of every conversation with its opening replaced, in the form ``trie`` reads.

    The first h turns of conversation c give way to the first h (or all) of
    conversation c - c % 20, h = crc32 of c's decimal digits mod 4.
    """
    steps = Workspace(rows.sparkSession, "turns").save(turns(rows), "turns")
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % 4
    convs = steps.select("conv_id").distinct()
    heads = steps.where("conv_id % 20 = 0 AND rank <= 3").withColumnRenamed("conv_id", "base")
    wants = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), h.alias("h"))
    lent = wants.join(heads, "base").where("rank <= h").select("conv_id", F.lit(0).alias("part"), "rank", "digest", "n_words")
    own = steps.where(F.col("rank") > h).withColumn("part", F.lit(1))
    return _dealt(convs, lent.unionByName(own))
