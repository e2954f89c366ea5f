"""Language identification with error-correcting output codes.

Every language gets a codeword of bits, far from the others. One binary
classifier per bit says from a text's letter n-grams (1 to 3 letters, hashed)
on which side of the bit its language lies: a linear margin of log-odds
weights, fitted on the n-gram counts of all training documents. Decoding sums,
for each language, a loss of every margin against the codeword's bit, weighted
by how well that bit separates the training documents; the least loss wins,
and two losses close together flag the text as ambiguous.

Training documents: rows with a language outside the held-out quarter (crc32
of the id as text, modulo 4, is 2). Counts cover all of them; the margins'
scales and weights come from a bounded sample (``SCALE_ROWS`` rows, smallest
hashes first). Ids, source and labels are never inputs of a prediction.

Defined results: a null text or one without a letter is ``und`` with score 0;
without any training row every text is ``und``; a null id is not held out and
may train; repeated rows are predicted each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Workspace, column, prepare
from riskloom.llm.quality import is_held_out

BUCKETS = 1 << 14  # for each n-gram length
ORDERS = 3
SCALE_ROWS = 2000
UNKNOWN = "und"
_PIECE = 1 << 20
_K = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _pieces(texts: list[str | None]):
    """(rows, code points, offsets) over about _PIECE letters; a longer text goes in several pieces that overlap by an n-gram."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, max(len(text), 1), _PIECE):
            part = text[at : at + _PIECE + ORDERS - 1]
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= _PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(part, bucket) of every n-gram; anything but a letter is a border, and runs of borders give none."""
    joined = "".join(p + "\n" for p in parts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    part = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])
    letter = _is_letter()[code]
    c = np.where(letter, code, 0)
    if len(c) < ORDERS:
        at = np.flatnonzero(letter)
        return part[at], _bucket(c[at] * _K[0], 0)
    prev, mid, nxt = c[:-2], c[1:-1], c[2:]
    h1 = c * _K[0]
    h2 = h1[:-1] ^ (c[1:] * _K[1])
    h3 = (prev * _K[0]) ^ (mid * _K[1]) ^ ((nxt + np.uint32(1)) * _K[2])
    one, two = np.flatnonzero(letter), np.flatnonzero(letter[:-1] & letter[1:])
    three = np.flatnonzero(letter[1:-1])
    return (
        np.concatenate([part[one], part[two], part[three + 1]]),
        np.concatenate([_bucket(h1[one], 0), _bucket(h2[two], 1), _bucket(h3[three], 2)]),
    )


def _bucket(h: np.ndarray, order: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int64) + order * BUCKETS


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n rows of -1/+1: all distinct splits for up to 6 languages, else the best of some random codes."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        return np.array([[1 if (c >> i) & 1 else -1 for c in range(1, 2 ** (n - 1))] for i in range(n)], float)
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = max(31, int(np.ceil(10 * np.log2(n))))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * bits
        if distance.min() > far:
            best, far = code, distance.min()
    return best


@dataclass
class Coder:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # n-gram buckets x bits
    scale: np.ndarray
    trust: np.ndarray

    @classmethod
    def fit(cls, langs: list[str], counts: np.ndarray) -> Coder:
        """``counts``: languages x buckets."""
        code = codewords(len(langs))
        share = (counts + 0.05) / (counts.sum(axis=1, keepdims=True) + 0.05 * counts.shape[1])
        side = lambda sign: np.stack([share[code[:, j] == sign].mean(axis=0) if (code[:, j] == sign).any() else share.mean(axis=0) for j in range(code.shape[1])], axis=1)
        weights = np.log(side(1)) - np.log(side(-1))
        return cls(langs, code, weights.astype(np.float32), np.ones(code.shape[1]), np.ones(code.shape[1]))

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-odds per bit, and the number of n-grams."""
        total, n = np.zeros((len(texts), self.code.shape[1])), np.zeros(len(texts))
        for rows, parts in _pieces(texts):
            part, bucket = grams(parts)
            rows = np.array(rows)
            for j in range(total.shape[1]):
                np.add.at(total[:, j], rows, np.bincount(part, self.weights[bucket, j], len(rows)))
            np.add.at(n, rows, np.bincount(part, minlength=len(rows)))
        return total / np.maximum(n, 1)[:, None], n

    def calibrate(self, margins: np.ndarray, lang: np.ndarray) -> None:
        """Scales and trust of the bits from margins of labelled texts."""
        want = self.code[lang]
        self.scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
        right = (np.sign(margins) == want).mean(axis=0)
        self.trust = np.maximum(2 * right - 1, 0.01)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, share of its likelihood, ambiguous) by the least weighted logistic loss."""
        z = margins / self.scale
        loss = np.stack([(np.logaddexp(0, -3 * z * c) * self.trust).sum(axis=1) for c in self.code], axis=1) / self.trust.sum()
        like = np.exp(-8 * (loss - loss.min(axis=1, keepdims=True)))
        like /= like.sum(axis=1, keepdims=True)
        best = like.argmax(axis=1)
        top = np.sort(like, axis=1)
        close = top[:, -1] < 2 * top[:, -2] if like.shape[1] > 1 else np.zeros(len(like), bool)
        return best, like.max(axis=1, initial=0), close


def train(rows: DataFrame, ws: Workspace) -> Coder | None:
    """``rows``: (id, text, lang) of the training documents."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = column(batch, "text").to_pylist(), column(batch, "lang").to_pylist()
            for row, parts in _pieces(texts):
                part, bucket = grams(parts)
                of = np.array([langs[r] for r in row])[part]
                for lang in set(of.tolist()):
                    mine = total.setdefault(lang, np.zeros(ORDERS * BUCKETS, np.int64))
                    mine += np.bincount(bucket[of == lang], minlength=len(mine))
        for lang, mine in total.items():
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(mine[at])], ["lang", "bucket", "n"])

    counted = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toPandas()  # languages x buckets at most
    if got.empty:
        return None
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), ORDERS * BUCKETS))
    counts[[langs.index(x) for x in got["lang"]], got["bucket"]] = got["n"]
    coder = Coder.fit(langs, counts)
    every = max(1, rows.count() // SCALE_ROWS)
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(every)) == 0)
    shipped = rows.sparkSession.sparkContext.broadcast(coder)

    def measure(batches):
        for batch in batches:
            z, n = shipped.value.margins(column(batch, "text").to_pylist())
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "lang"), flat, pa.array(n)], ["id", "lang", "z", "n"])

    sample = some.mapInArrow(measure, "id long, lang string, z array<double>, n double").where("n > 0")
    sample = sample.orderBy(F.xxhash64("id"), "lang").limit(2 * SCALE_ROWS).toPandas()
    if len(sample):
        coder.calibrate(np.array(sample["z"].tolist()), np.array([langs.index(x) for x in sample["lang"]]))
    return coder


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous) of every row."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    coder = train(rows.where("not held_out and text is not null and lang is not null").select("id", "text", "lang"), Workspace(spark, "langid"))
    model = spark.sparkContext.broadcast(coder)

    def run(batches):
        for batch in batches:
            texts, k = column(batch, "text").to_pylist(), model.value
            lang, score, close = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if k is not None:
                z, n = k.margins(texts)
                best, like, unsure = k.decode(z)
                lang = [k.langs[b] if m else UNKNOWN for b, m in zip(best, n)]
                score, close = np.where(n > 0, like, 0.0), unsure & (n > 0)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), column(batch, "held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(close)],
                ["id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    out = rows.select("id", "held_out", "text").mapInArrow(run, "id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)
