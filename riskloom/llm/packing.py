"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents longer than ``capacity`` are cut into pieces of that length. How
pieces go together depends on their lengths alone, so the plan is made from
the histogram of lengths (at most ``capacity`` numbers, whatever the corpus):

1. Linear grouping: lengths above ``capacity / small`` in descending order
   fall into groups of equal cardinality, each rounded up to its longest.
2. Few-size configurations: a linear programme over these few sizes, by
   column generation (a knapsack proposes the next configuration), rounded
   down; what is left is packed first-fit.
3. Actual lengths replace the rounded ones. Pieces are used in descending
   order, so the bins of a configuration fall into few runs of equal content.
4. Small lengths, longest first, go to the run with the least room that holds
   them; new bins open when none does.

Every step moves runs of equal bins, so the plan is a list of intervals
(length, ranks lo..hi) -> (first sequence, offset): a piece finds its place
from its length and its rank among the pieces of that length, with no
shuffle by sequence. Ranks are a count inside each partition plus a prefix
sum over (length, partition) counts, so a length that a third of all pieces
share is never one task's.

A null text is an empty document (its end id alone). Repeated ids are separate
documents, equal rows included. A null id stays null. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import Workspace, column, prepare
from riskloom.llm.encode import encoder

CAPACITY = 4096
GROUPS = (12, 24)
SMALL = 3


def linear_groups(hist: dict[int, int], floor: int, groups: int) -> list[tuple[int, list[list[int]]]]:
    """[(size, [[length, rank, count], ...])] for the lengths above ``floor``, longest first."""
    lengths = sorted((x for x in hist if x > floor), reverse=True)
    share = -(-sum(hist[x] for x in lengths) // groups)
    out, room = [], 0
    for x in lengths:
        rank, left = 0, hist[x]
        while left:
            if not room:
                if not out or out[-1][0] != x:
                    out.append((x, []))
                room = share
            n = min(room, left)
            out[-1][1].append([x, rank, n])
            rank, left, room = rank + n, left - n, room - n
    return out


def _knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration and its value; a bin holds few of these sizes, so one round per item."""
    best, takes = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        worth = np.full((len(sizes) + 1, capacity + 1), -1.0)
        for i, s in enumerate(sizes):
            worth[i, s:] = best[: capacity + 1 - s] + price[i]
        worth[-1] = best
        takes.append(worth.argmax(axis=0))
        best = worth.max(axis=0)
    items, c = np.zeros(len(sizes)), capacity
    for take in takes[::-1]:
        if take[c] < len(sizes):
            items[take[c]] += 1
            c -= int(sizes[take[c]])
    return float(best[capacity]), items


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """[(items of each size, bins)] that hold the demand exactly: the programme's optimum, rounded down, then first-fit."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        use, price = inverse @ demand, inverse.sum(axis=0)
        best, new = _knapsack(sizes, price, capacity)
        if best <= 1 + 1e-7:
            break
        direction = inverse @ new
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, int(ratio.argmin())] = new
    use = np.floor(np.linalg.inv(basis) @ demand + 1e-7).astype(int).clip(0)
    out, left = [], demand.astype(int).copy()
    for pattern, n in sorted(zip(basis.T.astype(int).tolist(), use.tolist()), reverse=True):
        pattern = np.array(pattern)
        held = pattern > 0
        n = int(min(n, (left[held] // pattern[held]).min())) if held.any() else 0
        if n > 0:
            out.append((pattern, n))
            left -= n * pattern
    while left.any():
        room, pattern = capacity, np.zeros(k, int)
        for i in range(k):
            pattern[i] = min(left[i], room // sizes[i])
            room -= pattern[i] * sizes[i]
        held = pattern > 0
        n = int((left[held] // pattern[held]).min())
        out.append((pattern, n))
        left -= n * pattern
    return out


class _Bins:
    """Runs of bins with equal content, found by the room that they have left."""

    def __init__(self, capacity: int):
        self.capacity, self.used, self.moves = capacity, 0, []
        self._rooms: list[int] = []
        self._runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def open(self, n: int) -> int:
        self.used += n
        return self.used - n

    def keep(self, room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            if not self._runs[room]:
                insort(self._rooms, room)
            self._runs[room].append((first, n))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        at = bisect_left(self._rooms, length)
        if at == len(self._rooms):
            return None
        room = self._rooms[at]
        first, n = self._runs[room].pop()
        if not self._runs[room]:
            self._rooms.pop(at)
        return room, first, n

    def place(self, length: int, rank: int, n: int, first: int, offset: int) -> None:
        self.moves.append((length, rank, n, first, offset))


def plan(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS[0], small: int = SMALL) -> tuple[np.ndarray, int]:
    """Moves (length, first rank, pieces, first sequence, offset) for all pieces, and the number of sequences."""
    bins, hist = _Bins(capacity), dict(hist)
    full = hist.pop(capacity, 0)
    if full:
        bins.place(capacity, 0, full, bins.open(full), 0)
    floor = capacity // small
    large = linear_groups(hist, floor, groups)
    if large:
        sizes = np.array([s for s, _ in large])
        demand = np.array([sum(n for _, _, n in runs) for _, runs in large], float)
        queues = [runs[::-1] for _, runs in large]
        for pattern, n in configurations(sizes, demand, capacity):
            slots = []
            for g in np.flatnonzero(pattern):
                for _ in range(pattern[g]):
                    slots.append(_take(queues[g], n))
            first = bins.open(n)
            while n:
                run = min(s[-1][2] for s in slots)
                offset = 0
                for s in slots:
                    length, rank, have = s[-1]
                    bins.place(length, rank, run, first, offset)
                    offset += length
                    s[-1] = [length, rank + run, have - run]
                    if have == run:
                        s.pop()
                bins.keep(capacity - offset, first, run)
                first, n = first + run, n - run
    for length in sorted((x for x in hist if x <= floor), reverse=True):
        rank, left = 0, hist[length]
        while left:
            got = bins.tightest(length)
            if got is None:
                n = -(-left // (capacity // length))
                got = capacity, bins.open(n), n
            room, first, n = got
            deep = room // length
            whole = min(n, left // deep)
            for j in range(deep if whole else 0):
                bins.place(length, rank, whole, first, capacity - room + j * length)
                rank += whole
            left -= whole * deep
            bins.keep(room - deep * length, first, whole)
            first, n = first + whole, n - whole
            if n and left:  # the last pieces of this length share one bin
                for j in range(left):
                    bins.place(length, rank + j, 1, first, capacity - room + j * length)
                bins.keep(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            bins.keep(room, first, n)
    return np.array(sorted(bins.moves), np.int64).reshape(-1, 5), bins.used


def _take(queue: list[list[int]], n: int) -> list[list[int]]:
    """The next ``n`` pieces of a group as runs, the first one last."""
    out = []
    while n:
        length, rank, have = queue[-1]
        got = min(n, have)
        out.append([length, rank, got])
        if got == have:
            queue.pop()
        else:
            queue[-1] = [length, rank + got, have - got]
        n -= got
    return out[::-1]


def best_plan(hist: dict[int, int], capacity: int) -> np.ndarray:
    """The plan with the fewest sequences over the numbers of groups in ``GROUPS``."""
    return min((plan(hist, capacity, g) for g in GROUPS), key=lambda x: x[1])[0]


def pieces(docs: DataFrame, tokenizer_json: str, spaces: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece with its rank among the pieces of its length in its partition."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    names = ["id", "piece", "start", "length", "ids_crc32", "part", "rank"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def cut(batches):
        enc, part, seen = encoder(tokenizer, spaces), TaskContext.get().partitionId(), defaultdict(int)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            out = []
            for doc, text in zip(column(batch, "id").to_pylist(), column(batch, "text").to_pylist()):
                tokens = np.frombuffer(enc.encode(text) + end, enc.dtype).astype("<u4")
                for i, at in enumerate(range(0, len(tokens), capacity)):
                    one = tokens[at : at + capacity]
                    out.append((doc, i, at, len(one), zlib.crc32(one.tobytes()), part, seen[len(one)]))
                    seen[len(one)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out)) or [()] * 7, kinds)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def pack(
    docs: DataFrame, tokenizer_json: str, spaces: str = "joins", end_id: int = 0, capacity: int = CAPACITY,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    prepare(docs.sparkSession)
    ws = Workspace(docs.sparkSession, "packing")
    cut = ws.save(pieces(docs, tokenizer_json, spaces, end_id, capacity, id_col, text_col), "pieces")
    counts = ws.save(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    moves = best_plan(hist, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = cut.join(counts.select("length", "part", before.alias("before")), ["length", "part"])
    starts = moves[:, 0] << 44 | moves[:, 1]  # a length has fewer than 2**44 pieces

    def place(batches):
        for batch in batches:
            length = column(batch, "length").to_numpy()
            rank = column(batch, "rank").to_numpy()
            move = moves[np.searchsorted(starts, length << 44 | rank, side="right") - 1]
            arrays = [column(batch, c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(move[:, 3] + rank - move[:, 1]), pa.array(move[:, 4])],
                [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")).mapInArrow(place, schema)
