"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and shares over the whole text, computed on byte buffers.
Each is cut into bins at quantiles of the training rows. Cyclic boosting
visits the features in turn and adds a shallow tree (four leaves at most)
over that feature's bins to its lookup table; the pairs that explain most of
what is left get small two-way tables by the same rule. A score is the
logistic of a sum of table entries: bin numbers, lookups and additions.

Training rows: labelled rows outside the held-out quarter (crc32 of the id as
text, modulo 4, is 2), at most ``MAX_TRAIN`` of them, those with the smallest
hash of the id (a bounded sample; every document is scored). Ids, language,
source and labels are never inputs.

Defined results: null and empty texts have all counts zero and are scored like
any other; a null id is not held out and never trained on; labels other than 0
and 1 are ignored; repeated rows are scored each; with no label, or labels of
one kind, the score is that share (1 without labels, so nothing is rejected);
an empty table gives an empty result; extra columns are ignored, or kept by
``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Workspace, column, prepare, text_bytes
from riskloom.llm.jaccard_join import row_slices
from riskloom.llm.words import IS_SPACE, row_of, words

MAX_TRAIN = 20_000
CUT = 0.7
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "long_word", "short_words", "upper", "digits", "stops", "marks", "odd_marks",
    "bangs", "bars", "beyond_ascii", "line_words", "short_lines", "same_lines", "distinct_words", "top_word", "same_next",
    "same_pairs", "odd_words", "upper_words", "entropy",
)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _LOWER, _DIGIT = (_class("".join(map(chr, range(a, b)))) for a, b in ((65, 91), (97, 123), (48, 58)))
_STOP, _MARK, _BANG, _BAR = _class(".?"), _class(",;:'\"()-"), _class("!"), _class("|")
_HIGH = np.arange(256) >= 128
_ODD = ~(_UPPER | _LOWER | _DIGIT | _STOP | _MARK | _BANG | _BAR | IS_SPACE | _HIGH)
_NEWLINE = _class("\n")


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _repeat_share(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: share of distinct values and share of the most frequent one."""
    row = row_of(offsets)
    n, rows = np.diff(offsets).astype(float), len(offsets) - 1
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(rows)
    np.maximum.at(top, r[at], np.diff(np.append(at, len(v))))
    return np.bincount(r[at], minlength=rows) / np.maximum(n, 1), top / np.maximum(n, 1)


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows by features."""
    rows = len(offsets) - 1
    h, at, start, end = words(data, offsets)
    row = row_of(at)
    size = np.diff(offsets).astype(float)
    n = np.diff(at).astype(float)
    one, per_word = np.maximum(size, 1), np.maximum(n, 1)
    length = (end - start).astype(float)
    longest = np.zeros(rows)
    np.maximum.at(longest, row, length)
    share = lambda table: _per_row(table[data], offsets) / one
    word = lambda mask: np.bincount(row, weights=mask, minlength=rows) / per_word
    first, last = (data[start], data[end - 1]) if len(start) else (np.zeros(0, np.uint8),) * 2
    second = data[np.minimum(start + 1, end - 1)] if len(start) else first
    next_same = np.zeros(len(h), bool)
    if len(h) > 1:
        next_same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    distinct, top = _repeat_share(h, at)
    pairs = h.copy()
    if len(h) > 1:
        pairs[1:] = h[1:] * np.uint64(3) + h[:-1]
    pair_distinct, _ = _repeat_share(pairs, at)
    # Lines by the hash of their words: the sum of word hashes is enough to tell repeats.
    breaks = np.concatenate([[0], np.cumsum(_NEWLINE[data], dtype=np.int64)])
    line = breaks[start] + row
    new_line = np.ones(len(h), bool)
    new_line[1:] = line[1:] != line[:-1]
    line_at = np.flatnonzero(new_line)
    line_hash = np.add.reduceat(h * np.uint64(0x9E3779B97F4A7C15), line_at) if len(line_at) else h
    line_words = np.diff(np.append(line_at, len(h)))
    line_offsets = np.searchsorted(row[line_at], np.arange(rows + 1))
    line_distinct, _ = _repeat_share(line_hash, line_offsets)
    lines = np.maximum(np.diff(line_offsets).astype(float), 1)
    short = np.bincount(row[line_at], weights=line_words <= 2, minlength=rows) / lines
    kinds = np.stack([share(t) for t in (_UPPER, _LOWER, _DIGIT, _STOP | _MARK, _ODD | _BANG | _BAR, IS_SPACE, _HIGH)])
    entropy = -(kinds * np.log(np.where(kinds > 0, kinds, 1))).sum(axis=0)
    return np.column_stack([
        np.log1p(size), np.log1p(n), np.bincount(row, weights=length, minlength=rows) / per_word, np.log1p(longest),
        word(length <= 3), share(_UPPER), share(_DIGIT), share(_STOP), share(_MARK), share(_ODD), share(_BANG), share(_BAR),
        share(_HIGH), np.log1p(n / lines), short, 1 - line_distinct, distinct, top, word(next_same), 1 - pair_distinct,
        word((_ODD | _BANG | _BAR)[last]), word(_UPPER[first] & (_UPPER | _HIGH)[second] & (length > 1)), entropy,
    ])


def features(col: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(col)
    parts = [_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in row_slices(offsets, 2 << 20)]
    return np.concatenate(parts or [np.zeros((0, len(FEATURES)))])


@dataclass
class Gam:
    """Bin edges, one table per feature, one per chosen pair."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin -> coarse bin of the pair tables

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if self.edges:
            b = self.bins(x)
            for j, t in enumerate(self.tables):
                out += t[b[j]]
            for (i, j), t in self.pairs.items():
                out += t[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


_RIDGE = 1.0


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best cut of a row of bins: gain and first bin of the right side."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + _RIDGE) + gr**2 / (hr + _RIDGE)
    gain[(hl < 1e-3) | (hr < 1e-3)] = -1
    if not len(gain) or gain.max() < 0:
        return 0.0, 0
    k = int(gain.argmax())
    return float(gain[k] - g.sum() ** 2 / (h.sum() + _RIDGE)), k + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Newton steps of a tree of this depth over ordered bins."""
    gain, k = _split(g, h) if depth and len(g) > 1 else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), -g.sum() / (h.sum() + _RIDGE))
    return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A cut along one axis, then one along the other on either side; the step and its gain."""
    best, out = -1.0, np.zeros_like(g)
    for axis in (0, 1):
        ga, ha = (g, h) if axis == 0 else (g.T, h.T)
        _, k = _split(ga.sum(axis=1), ha.sum(axis=1))
        if not k:
            continue
        step = np.concatenate([np.tile(_tree(ga[s].sum(axis=0), ha[s].sum(axis=0), 1), (n, 1)) for s, n in ((slice(0, k), k), (slice(k, None), len(ga) - k))])
        gain = float(-(ga * step).sum())
        if gain > best:
            best, out = gain, step if axis == 0 else step.T
    return out, best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, rate: float = 0.15, n_pairs: int = 6, pair_rounds: int = 40) -> Gam:
    """Cyclic boosting of main effects, then of the best pairs."""
    if not len(y) or y.min() == y.max():
        return Gam(40.0 if not len(y) or y[0] else -40.0)
    p = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(p / (1 - p))))
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])))
        n = len(model.edges[-1]) + 1
        model.tables.append(np.zeros(n))
        model.coarse.append(np.arange(n) * min(8, n) // n)
    b, margin = model.bins(x), np.full(len(y), model.base)

    def slopes():
        s = 1 / (1 + np.exp(-margin))
        return s - y, np.maximum(s * (1 - s), 1e-6)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[j], g, len(table)), np.bincount(b[j], h, len(table)))
            table += step
            margin += step[b[j]]

    def grid(i, j, g, h):
        ni, nj = model.coarse[i][-1] + 1, model.coarse[j][-1] + 1
        cell = model.coarse[i][b[i]] * nj + model.coarse[j][b[j]]
        return cell, np.bincount(cell, g, ni * nj).reshape(ni, nj), np.bincount(cell, h, ni * nj).reshape(ni, nj)

    g, h = slopes()
    gains = {(i, j): _pair_tree(*grid(i, j, g, h)[1:])[1] for i, j in combinations(range(x.shape[1]), 2)}
    for pair in sorted(gains, key=gains.get, reverse=True)[:n_pairs]:
        model.pairs[pair] = np.zeros((model.coarse[pair[0]][-1] + 1, model.coarse[pair[1]][-1] + 1))
    for _ in range(pair_rounds):
        for (i, j), table in model.pairs.items():
            cell, gg, hh = grid(i, j, *slopes())
            step = rate * _pair_tree(gg, hh)[0]
            table += step
            margin += step.ravel()[cell]
    return model


def is_held_out(id_col: str):
    """True for the quarter of ids that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _feature_rows(docs: DataFrame, text_col: str, names: list[str]) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = features(column(batch, "text"))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in names), flat], [*names, "x"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text") + ", x array<double>")


def train(rows: DataFrame, labels: DataFrame, label_id: str, label_col: str, max_train: int = MAX_TRAIN) -> Gam:
    """``rows``: (id, held_out, x). Fits on at most ``max_train`` labelled rows."""
    known = labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.min("y").alias("y"))
    some = rows.where("not held_out").join(known, "id").select("id", "x", "y")
    every = max(1, some.count() // max_train)  # a thin slice by hash first, so that no task sends more than its share
    some = some.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(every)) == 0)
    got = some.orderBy(F.xxhash64("id"), "id").limit(max_train).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    label_id: str = "doc_id", cut: float = CUT, max_train: int = MAX_TRAIN,
) -> DataFrame:
    """(id, held_out, score, predicted) of every row; the texts are read once."""
    spark = docs.sparkSession
    prepare(spark)
    ws = Workspace(spark, "quality")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    rows = ws.save(_feature_rows(rows, "text", ["id", "held_out"]), "features")
    model = spark.sparkContext.broadcast(train(rows, labels, label_id, label_col, max_train))

    def run(batches):
        for batch in batches:
            x = column(batch, "x").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "held_out"), pa.array(model.value.score(x))], ["id", "held_out", "score"])

    scored = rows.mapInArrow(run, "id long, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    label_id: str = "doc_id", cut: float = CUT, max_train: int = MAX_TRAIN,
) -> DataFrame:
    """``docs`` without the rows that score below ``cut``. Trains on the labelled rows only, then scores every text in place."""
    spark = docs.sparkSession
    prepare(spark)
    ids_known = labels.select(F.col(label_id).cast("long").alias("id")).distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    rows = rows.where("not held_out").join(ids_known, "id", "left_semi")
    sample = Workspace(spark, "quality").save(_feature_rows(rows, "text", ["id", "held_out"]), "features")
    model = spark.sparkContext.broadcast(train(sample, labels, label_id, label_col, max_train))

    def run(batches):
        for batch in batches:
            good = model.value.score(features(column(batch, text_col))) >= cut
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
