"""Benchmark decontamination: SimHash of item-sized windows, then exact verification.

Words are runs of bytes outside 0x20 and 0x09-0x0D, A-Z lower-cased; an item
of L words is the multiset of its 5-word shingles (fewer words: the whole
sequence as one). A window of a document is L of its consecutive words. They
match when the weighted Jaccard similarity (sum of minima over sum of maxima
of the shingles' counts) is at least ``threshold``.

1. For a similarity of t the shingles of a window and of an item of c
   shingles must share t (c + c') / (1 + t) of them, c' being the window's.
   Windows are laid wherever that many occurrences of an item's shingles lie
   close enough, at every start that covers them, in whatever order they
   come: any other window is below the threshold. Where an item goes beyond
   the text's ends, the part of its window inside the text is a window too.
2. Each window and each item gets a 256-bit SimHash of its weighted shingles.
   The fingerprints are cut into 16 blocks of 16 bits. Fingerprints within
   radius r agree in some block up to r // 16 bits, so probing all block
   values that near finds every item within the radius, for certain. The
   radius follows from the weights: sharing that much, the vectors of window
   w and item v have a cosine of at least the shared count / (|w| |v|),
   which gives the expected distance; five deviations are added (a chance below
   1e-6 to miss). Items whose shingles repeat much have a radius of their own.
3. Candidates get their exact similarity.

Documents are only scanned: no shuffle, a passage that a third of all
documents hold is found in each on its own. The benchmark is cut into blocks
of bounded size by hash, each shipped to one scan: a benchmark of up to
BLOCK_BYTES of text takes one.

Result: one row per (document row, item) with the best window, of equal ones
the first. Null or empty
texts and items match nothing; a null id is reported as null; repeated rows
are reported each; very long texts are read whole; empty tables give an empty
result; extra columns are ignored, or kept by ``drop_contaminated``.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import column, prepare, text_bytes
from riskloom.llm.jaccard_join import row_slices
from riskloom.llm.words import chain, mix, words

SHINGLE = 5
THRESHOLD = 0.8
BITS, BLOCKS = 256, 16
DEVIATIONS = 5
# Weights are even while their squares add up to at most this multiple of the shingles.
EVEN = 1.05
# Beyond so many bits a block, all fingerprints are compared instead of probing blocks.
PROBE_BITS = 5
BLOCK_BYTES = 16 << 20


def simhash(tokens: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """BITS-bit fingerprint as 16-bit blocks."""
    seeds = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    spread = mix(tokens[:, None] ^ seeds[None, :])
    bits = np.unpackbits(spread.view(np.uint8).reshape(len(tokens), -1), axis=1).astype(np.int64)
    total = (2 * bits - 1).T @ weights
    return np.packbits(total > 0).view(np.uint16)


def radius(cosine: np.ndarray | float) -> np.ndarray:
    """Bits by which fingerprints of vectors of at least that cosine differ, DEVIATIONS included."""
    p = np.arccos(np.clip(cosine, 0.0, 1.0)) / np.pi
    return np.ceil(BITS * p + DEVIATIONS * np.sqrt(BITS * p * (1 - p)))


class HammingIndex:
    """All fingerprints within a radius of a probe, by blocks."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints  # items x BLOCKS
        values = np.arange(1 << 16, dtype=np.uint16)
        self._by_weight = values[np.argsort(np.bitwise_count(values), kind="stable")]
        self._upto = np.cumsum(np.bincount(np.bitwise_count(values)))  # how many values have at most so many bits
        self._order = [np.argsort(prints[:, b], kind="stable") for b in range(BLOCKS)]
        self._first = [np.searchsorted(prints[o, b], np.arange((1 << 16) + 1)) for b, o in enumerate(self._order)]

    def within(self, probe: np.ndarray, r: int) -> np.ndarray:
        near = r // BLOCKS
        if near > PROBE_BITS:
            items = np.arange(len(self.prints))
        else:
            masks, found = self._by_weight[: self._upto[near]], []
            for b in range(BLOCKS):
                at = (probe[b] ^ masks).astype(np.int64)
                lo, hi = self._first[b][at], self._first[b][at + 1]
                found += [self._order[b][i:j] for i, j in zip(lo[hi > lo], hi[hi > lo])]
            items = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return items[np.bitwise_count(self.prints[items] ^ probe).sum(axis=1) <= r]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets given as (sorted tokens, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


class Benchmark:
    """Shingles, places and fingerprints of a block of items."""

    def __init__(self, rows: list[tuple[int, str]]):
        texts = pa.array([t for _, t in rows], pa.string())
        h, at, _, _ = words(*text_bytes(texts))
        items = [(i, h[a:b]) for (i, _), a, b in zip(rows, at, at[1:]) if b > a]
        self.ids = [i for i, _ in items]
        self.lengths = np.array([len(w) for _, w in items], np.int64)
        self.runs = [chain(w, min(SHINGLE, len(w))) for _, w in items]
        self.sets = [np.unique(r, return_counts=True) for r in self.runs]
        self.sizes = sorted({min(SHINGLE, int(n)) for n in self.lengths})

    @cached_property
    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle size: sorted shingles, the item and the word where each occurs."""
        out = {}
        for k in self.sizes:
            mine = [i for i, n in enumerate(self.lengths) if min(SHINGLE, n) == k]
            token = np.concatenate([self.runs[i] for i in mine])
            item = np.concatenate([np.full(len(self.runs[i]), i) for i in mine])
            place = np.concatenate([np.arange(len(self.runs[i])) for i in mine])
            order = np.argsort(token, kind="stable")
            out[k] = token[order], item[order], place[order]
        return out

    @cached_property
    def index(self) -> HammingIndex:
        return HammingIndex(np.array([simhash(*s) for s in self.sets]).reshape(-1, BLOCKS))

    @cached_property
    def counts(self) -> np.ndarray:
        """Shingles of every item."""
        return np.array([len(r) for r in self.runs], np.int64)

    @cached_property
    def uneven(self) -> np.ndarray:
        return np.array([(n * n).sum() for _, n in self.sets]) > EVEN * self.counts

    def windows(self, h: np.ndarray, threshold: float) -> dict[tuple[int, int, int], list[int]]:
        """(first word, words, shingle size) of every item-sized window that shares enough shingles with an item,
        and the items."""
        out: dict[tuple[int, int, int], list[int]] = {}
        for k, (token, item, place) in self.places.items():
            run = chain(h, k)
            if not len(run):
                continue
            lo = np.searchsorted(token, run, "left")
            held = np.flatnonzero(token[np.minimum(lo, len(token) - 1)] == run)
            if not len(held):
                continue
            lo = lo[held]
            n = np.searchsorted(token, run[held], "right") - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            q, who, where = np.repeat(held, n), item[at], place[at]
            order = np.lexsort((q, who))
            q, who, where = q[order], who[order], where[order]
            edges = np.append(np.flatnonzero(np.append(True, who[1:] != who[:-1])), len(who))
            for a, b in zip(edges, edges[1:]):
                self._item_windows(out, int(who[a]), k, q[a:b], where[a:b], len(h), threshold)
        return out

    def _item_windows(self, out, i: int, k: int, q: np.ndarray, where: np.ndarray, n: int, threshold: float) -> None:
        """Windows for item ``i``, whose shingles ``where`` occur in a text of ``n`` words at ``q``."""
        c, words_, share = int(self.counts[i]), int(self.lengths[i]), threshold / (1 + threshold)
        spots = np.unique(q)

        def enough(of: int) -> int:
            return max(1, int(np.ceil(share * (c + of) - 1e-9)))

        if n >= words_ and len(spots) >= enough(c):
            # need hits from spots[j] on that end within one window: all starts that cover them
            last = spots[enough(c) - 1 :]
            first = spots[: len(last)]
            lo, hi = np.maximum(last - (c - 1), 0), np.minimum(first, n - words_)
            ok = lo <= hi
            if ok.any():
                edge = np.zeros(n + 2, np.int64)
                np.add.at(edge, lo[ok], 1)
                np.add.at(edge, hi[ok] + 1, -1)
                for s in np.flatnonzero(np.cumsum(edge) > 0):
                    out.setdefault((int(s), words_, k), []).append(i)
        for s in np.unique(q - where):
            a, b = max(0, int(s)), min(n, int(s) + words_)
            if b - a < words_ and b - a >= k:
                inside = np.searchsorted(spots, b - k, "right") - np.searchsorted(spots, a)
                if inside >= enough(b - a - k + 1):
                    out.setdefault((a, b - a, k), []).append(i)

    def candidates(self, tokens: np.ndarray, weights: np.ndarray, laid_for: list[int], threshold: float) -> list[int]:
        """Items to compare with a window: those whose fingerprint lies within the radius that even weights call for,
        and where weights are not even, the items that the window was laid for."""
        size, square = int(weights.sum()), float((weights * weights).sum())
        if square > EVEN * size:
            return laid_for
        cosine = 2 * threshold / (1 + threshold) * np.sqrt(size / EVEN / square)
        near = self.index.within(simhash(tokens, weights), int(radius(cosine)))
        return [*near.tolist(), *(i for i in laid_for if self.uneven[i])]

    def matches(self, h: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, first word, words) of each matched item in a document's words."""
        best: dict[int, tuple[float, int, int]] = {}
        for (first, n, k), laid_for in sorted(self.windows(h, threshold).items()):
            mine = np.unique(chain(h[first : first + n], k), return_counts=True)
            for i in self.candidates(*mine, laid_for, threshold):
                s = similarity(mine, self.sets[i])
                if s >= threshold and (i not in best or s > best[i][0]):
                    best[int(i)] = (s, first, n)
        return best


def _blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark in blocks of about ``block_bytes`` of text, each small enough to ship."""
    rows = bench.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect()
        block = Benchmark([(r["id"], r["text"]) for r in part])
        if len(block.lengths):
            yield block


def _documents(batch: pa.RecordBatch, text_col: str):
    data, offsets = text_bytes(column(batch, text_col))
    for a, b in row_slices(offsets):
        h, at, _, _ = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        for row, (i, j) in enumerate(zip(at, at[1:])):
            yield a + row, h[i:j]


def contaminated(
    docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, item, similarity, start_word, n_words) for every document row and benchmark item that match."""
    spark = docs.sparkSession
    prepare(spark)
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    schema = "__doc long, __item long, similarity double, start_word long, n_words long"
    rows = docs.select(F.col(id_col).cast("long").alias("__doc"), F.col(text_col).alias("text"))

    def scan(block):
        def run(batches):
            mine = block.value
            for batch in batches:
                doc = column(batch, "__doc").to_pylist()
                found = [
                    (doc[r], mine.ids[i], s, first, n)
                    for r, h in _documents(batch, "text")
                    for i, (s, first, n) in sorted(mine.matches(h, threshold).items())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(list(zip(*found)) or [()] * 5, kinds)],
                    ["__doc", "__item", "similarity", "start_word", "n_words"],
                )

        return run

    out = spark.createDataFrame([], schema)
    for block in _blocks(bench, item_col, item_text_col, block_bytes):
        out = out.unionByName(rows.mapInArrow(scan(spark.sparkContext.broadcast(block)), schema))
    return out.withColumnsRenamed({"__doc": id_col, "__item": item_col})


def drop_contaminated(
    docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the rows that match an item."""
    spark = docs.sparkSession
    prepare(spark)

    def keep(block):
        def run(batches):
            mine = block.value
            for batch in batches:
                clean = [not mine.matches(h, threshold) for _, h in _documents(batch, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for block in _blocks(bench, item_col, item_text_col, block_bytes):
        docs = docs.mapInArrow(keep(spark.sparkContext.broadcast(block)), docs.schema)
    return docs
