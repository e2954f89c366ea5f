"""A minimal perfect hash over 128-bit keys, with value arrays behind it.

Levels of bit arrays: a key that is alone at its place in a level is stored
there, the others go on to the next level. The rank of its bit is the key's
number, so n keys use the slots 0..n-1. Slots hold the second half of the
key as fingerprint: a key outside the set passes with probability 2**-64.
"""

from __future__ import annotations

import io

import numpy as np

from riskloom.llm.words import mix

_GAMMA = 2.0


def _place(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    return (mix(hi ^ mix(lo + seed)) % np.uint64(size)).astype(np.int64)


class KeyIndex:
    """Maps a key (hi, lo) to its slot in the value arrays, or to -1."""

    def __init__(self, sizes, bits, values: dict[str, np.ndarray]):
        self.sizes, self.bits, self.values = sizes, bits, values
        self.starts = np.concatenate([[0], np.cumsum(sizes // 64)]).astype(np.int64)
        ones = np.bitwise_count(bits).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray, **values: np.ndarray) -> KeyIndex:
        """Keys must be distinct."""
        hi, lo = hi.astype(np.uint64), lo.astype(np.uint64)
        left, sizes, bits = np.arange(len(hi)), [], []
        while len(left):
            size = max(64, int(len(left) * _GAMMA) // 64 * 64 + 64)
            at = _place(hi[left], lo[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64)[:, 0]
            sizes.append(size)
            bits.append(words)
            left = left[~alone[at]]
        index = cls(np.array(sizes, np.int64), np.concatenate([*bits, np.zeros(0, np.uint64)]), {})
        slot = index._slot(hi, lo)
        for name, v in {"fingerprint": lo, **values}.items():
            out = np.empty(len(hi), v.dtype)
            out[slot] = v
            index.values[name] = out
        return index

    def _slot(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        slot, open_ = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, size in enumerate(self.sizes):
            at = _place(hi[open_], lo[open_], level, int(size))
            word = self.starts[level] + (at >> 6)
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (self.bits[word] & bit) != 0
            below = np.bitwise_count(self.bits[word] & (bit - np.uint64(1))).astype(np.int64)
            slot[open_[hit]] = (self.rank[word] + below)[hit]
            open_ = open_[~hit]
        return slot

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        hi, lo = hi.astype(np.uint64), lo.astype(np.uint64)
        slot = self._slot(hi, lo)
        known = slot >= 0
        slot[known] = np.where(self.values["fingerprint"][slot[known]] == lo[known], slot[known], -1)
        return slot

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, sizes=self.sizes, bits=self.bits, **{f"v_{k}": v for k, v in self.values.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> KeyIndex:
        with np.load(io.BytesIO(data)) as z:
            return cls(z["sizes"], z["bits"], {k[2:]: z[k] for k in z.files if k.startswith("v_")})
