"""Words and word shingles as 64-bit hashes, computed on whole byte buffers with numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, with A-Z
lower-cased (in UTF-8 these bytes never occur inside another character).
Its hash is a polynomial over a random byte table, taken from prefix sums
modulo 2**64, so cost per byte is a few vector operations.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_M = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = {"up": _powers(_P, 1024), "down": _powers(_P_INV, 1024)}


def _pows(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["up"]) <= n:
        if n > 4 * CHUNK:
            return _powers(_P, n), _powers(_P_INV, n)
        _POW.update(up=_powers(_P, n), down=_powers(_P_INV, n))
    return _POW["up"], _POW["down"]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Chunk borders of about CHUNK bytes that never fall inside a word."""
    cuts, end = [0], len(data)
    while cuts[-1] + CHUNK < end:
        at = cuts[-1] + CHUNK
        row = int(offsets[np.searchsorted(offsets, at)])  # next row border
        step = 0
        while step < row - at and not IS_SPACE[data[at + step]]:
            step += 1
        cuts.append(at + step)
    cuts.append(end)
    return cuts


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all rows, word offsets per row, and each word's byte start and end."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    space = IS_SPACE[data]
    before = np.empty(n, bool)
    before[1:] = space[:-1]
    before[0] = True
    rows = offsets[:-1]
    before[rows[rows < n]] = True
    starts = np.flatnonzero(~space & before)
    after = np.empty(n, bool)
    after[:-1] = space[1:]
    after[-1] = True
    ends_of_rows = offsets[1:][offsets[1:] > offsets[:-1]]
    after[ends_of_rows - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    out = np.empty(len(starts), np.uint64)
    cuts = _cuts(data, offsets)
    for a, b in zip(cuts, cuts[1:]):
        i, j = np.searchsorted(starts, [a, b])
        if i == j:
            continue
        up, down = _pows(b - a)
        total = np.empty(b - a + 1, np.uint64)
        total[0] = 0
        np.cumsum(_VALUE[data[a:b]] * up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * down[s]
    return mix(out), np.searchsorted(starts, offsets), starts, ends


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (order counts)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:n].copy()
    for j in range(1, k):
        h *= _M
        h += hashes[j : j + n]
    return mix(h + np.uint64(k))


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``k``-word shingles of every row, in order; a row of 1..k-1 words is one shingle."""
    counts = np.diff(offsets)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(out_offsets[-1], np.uint64)
    runs = chain(hashes, k)
    first = np.repeat(offsets[:-1] - out_offsets[:-1], n) + np.arange(len(out))
    long = np.repeat(counts >= k, n)
    out[long] = runs[first[long]]
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        out[out_offsets[row]] = chain(hashes[offsets[row] : offsets[row + 1]], int(counts[row]))[0]
    return out, out_offsets


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each element, the row that it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, their offsets, and how often each occurs."""
    row = row_of(offsets)
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(v)))
    return v[at], np.searchsorted(r[at], np.arange(len(offsets))), counts
