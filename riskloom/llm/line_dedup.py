"""Line dedup: documents probe sharded minimal perfect hashes instead of joining their lines.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
A-Z lower-cased. Keys of at least ``min_chars`` code points found in at least
two documents lose all their lines except in the smallest id that holds them.

1. One scan emits a 128-bit hash per distinct key of a document; a grouping
   with map-side partial sums keeps (owner = smallest id, number of documents)
   of keys that two ids share, so a line held by a third of all rows is one row.
2. These keys are cut by hash into shards of about ``shard_keys`` keys; a task
   per shard builds a minimal perfect hash over them (about 4 bits a key) with
   fingerprint, owner and count arrays, and publishes it in the shared folder.
3. A second scan hashes the lines of each batch, loads the shards it needs
   (least recently used ones go, so memory is bounded) and drops lines in place.
   No line and no text is shuffled.

Defined results: a null or empty text is one empty line and stays as it is
(null stays null); a null id counts as larger than every id; repeated rows of
one id are one document; a text that loses every line becomes empty; an empty
table gives an empty table; extra columns pass through, except that columns
named like the two statistics are replaced by them.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import Workspace, column, fetch, ids, prepare, publish
from riskloom.llm.mphf import KeyIndex

MIN_CHARS = 10
SHARD_KEYS = 1 << 18
CACHE_BYTES = 128 << 20
_STRIP = " \t\n\x0b\x0c\r"


def _digests(lines: list[str], min_chars: int) -> list[bytes | None]:
    """128-bit hash of each line's key, None for keys that are too short."""
    out = []
    for line in lines:
        key = line.strip(_STRIP)
        out.append(xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None)
    return out


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pair = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)
    return pair[:, 0], pair[:, 1]


def shared_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(hi, lo, owner, docs) for every line key found under at least two ids."""

    def keys(batches):
        for batch in batches:
            found, owner = [], []
            for doc, text in zip(ids(column(batch, id_col)), column(batch, text_col).to_pylist()):
                mine = {d for d in _digests(text.split("\n"), min_chars) if d} if text else ()
                found.extend(mine)
                owner.extend([doc] * len(mine))
            hi, lo = _halves(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(owner, pa.int64())], ["hi", "lo", "doc"]
            )

    rows = docs.select(id_col, text_col).mapInArrow(keys, "hi long, lo long, doc long")
    grouped = rows.groupBy("hi", "lo").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"), F.count("*").alias("docs"))
    return grouped.where("owner <> last").drop("last")


def build_index(shared: DataFrame, folder: str, shard_keys: int = SHARD_KEYS) -> int:
    """Publish one index file per shard; returns the number of shards."""
    shards = max(1, -(-shared.count() // shard_keys))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["hi", "lo"])
        index = KeyIndex.build(
            part["hi"].to_numpy().view(np.uint64),
            part["lo"].to_numpy().view(np.uint64),
            owner=part["owner"].to_numpy(),
            docs=part["docs"].to_numpy().clip(0, 2**32 - 1).astype(np.uint32),
        )
        publish(folder, f"shard-{key[0]:06d}", index.to_bytes())
        return pd.DataFrame({"shard": [key[0]], "n": [len(part)]})

    keyed = shared.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
    keyed.groupBy("shard").applyInPandas(build, "shard int, n long").agg(F.sum("n")).collect()
    return shards


_LOADED: OrderedDict[str, KeyIndex | None] = OrderedDict()


def _shard(folder: str, shard: int) -> KeyIndex | None:
    """A shard's index from this worker's cache, or from the shared folder; None if it holds no key."""
    at = f"{folder}/{shard}"
    if at not in _LOADED:
        try:
            _LOADED[at] = KeyIndex.from_bytes(fetch(folder, f"shard-{shard:06d}"))
        except FileNotFoundError:
            _LOADED[at] = None
        size = lambda x: 0 if x is None else x.bits.nbytes + sum(v.nbytes for v in x.values.values())
        while len(_LOADED) > 1 and sum(map(size, _LOADED.values())) > CACHE_BYTES:
            _LOADED.popitem(last=False)
    _LOADED.move_to_end(at)
    return _LOADED[at]


def _owners(folder: str, shards: int, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The owner of each key, -1 and a false mask where the key isn't shared."""
    owner, known = np.full(len(hi), -1, np.int64), np.zeros(len(hi), bool)
    which = np.mod(hi.view(np.int64), shards)
    order = np.argsort(which, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(which[order])) + 1) if len(order) else []:
        index = _shard(folder, int(which[at[0]]))
        if index is None:
            continue
        slot = index.find(hi[at], lo[at])
        hit = slot >= 0
        owner[at[hit]] = index.values["owner"][slot[hit]]
        known[at[hit]] = True
    return owner, known


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    shard_keys: int = SHARD_KEYS,
    stats: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with repeated lines dropped from the text, and two counts per row (see above)."""
    spark = docs.sparkSession
    prepare(spark)
    ws = Workspace(spark, "line-dedup")
    shared = ws.save(shared_lines(docs, id_col, text_col, min_chars), "shared")
    folder = ws.path("index")
    shards = build_index(shared, folder, shard_keys)
    kept = [f for f in docs.schema.fields if f.name not in stats]
    schema = T.StructType([*kept, T.StructField(stats[0], T.LongType()), T.StructField(stats[1], T.LongType())])

    def drop(batches):
        for batch in batches:
            texts, doc = column(batch, text_col).to_pylist(), ids(column(batch, id_col))
            lines = [(t or "").split("\n") for t in texts]
            digests = [_digests(x, min_chars) for x in lines]
            flat = [(r, i, d) for r, row in enumerate(digests) for i, d in enumerate(row) if d]
            hi, lo = _halves([d for _, _, d in flat])
            owner, known = _owners(folder, shards, hi, lo)
            gone = [set() for _ in texts]
            for (r, i, _), o, k in zip(flat, owner, known):
                if k and o != doc[r]:
                    gone[r].add(i)
            for r, bad in enumerate(gone):
                if bad:
                    texts[r] = "\n".join(x for i, x in enumerate(lines[r]) if i not in bad)
            arrays = [pa.array(texts, column(batch, text_col).type) if f.name == text_col else column(batch, f.name) for f in kept]
            counts = [pa.array(map(len, lines), pa.int64()), pa.array(map(len, gone), pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, *counts], schema.names)

    return docs.select([f.name for f in kept]).mapInArrow(drop, schema)
