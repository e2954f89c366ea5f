"""Every item-sized window by brute force: moved, repeated, reversed and substituted parts, uneven weights, long texts."""

from collections import Counter

import numpy as np
import pytest

from riskloom.llm import decontaminate as D


def words_of(seed, n, letters="abcdefgh"):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(letters), rng.integers(3, 8))) for _ in range(n)]


def weighted(w):
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute(docs, items, threshold=0.8):
    """Best similarity over all windows of an item's length."""
    out = {}
    for d, w in enumerate(docs):
        for i, item in enumerate(items):
            have, n = weighted(item), len(item)
            sims = []
            for s in range(len(w) - n + 1):
                win = weighted(w[s : s + n])
                sims.append(sum((win & have).values()) / sum((win | have).values()))
            if sims and max(sims) >= threshold:
                out[d, i] = max(sims)
    return out


def edited(rng, w):
    """One of several edits that keep about nine tenths of the shingles."""
    w, kind, n = list(w), rng.integers(0, 7), len(w)
    if n < 20:
        return w
    cut = int(rng.integers(n // 4, 3 * n // 4))
    if kind == 0:
        return w[cut:] + w[:cut]  # halves change places
    if kind == 1:
        w[int(rng.integers(0, n))] = "zz"
    if kind == 2:
        a = int(rng.integers(0, n - 8))
        w[a : a + 4] = w[a : a + 4][::-1]
    if kind == 3:
        return w[:cut] + ["inserted"] + w[cut:]
    if kind == 4:
        del w[cut : cut + 2]
    if kind == 5:
        return w[:cut] + w[cut - 6 : cut] + w[cut:]  # a part twice
    return w


@pytest.fixture(scope="module")
def items():
    out = [words_of(i, int(np.random.default_rng(i).integers(25, 90))) for i in range(14)]
    refrain = words_of(77, 6)
    out += [words_of(50, 30) + refrain * 6 + words_of(51, 10), refrain * 8, ["la"] * 40 + words_of(52, 20), words_of(53, 5), words_of(54, 3)]
    return out


def test_all_windows(spark, items):
    rng = np.random.default_rng(9)
    docs = []
    for d in range(120):
        body = edited(rng, items[d % len(items)])
        docs.append(words_of(1000 + d, int(rng.integers(0, 30))) + body + words_of(2000 + d, int(rng.integers(0, 30))))
    docs += [items[3] * 3, items[2] + items[5], items[14][::-1], [], ["la"] * 300]
    want = brute(docs, items)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in D.contaminated(table, bench).collect()}
    assert set(want) <= set(got)
    for key, r in got.items():
        w = docs[key[0]][r["start_word"] : r["start_word"] + r["n_words"]]
        a, b = weighted(w), weighted(items[key[1]])
        assert r["similarity"] == pytest.approx(sum((a & b).values()) / sum((a | b).values())) and r["similarity"] >= 0.8
        # windows cut off at the text's ends may be better than whole ones
        assert r["similarity"] >= want.get(key, 0.0) - 1e-12
        assert key in want or len(w) < len(items[key[1]])
    assert len(want) > 60


def test_halves_in_reverse_order_are_found():
    a, b = words_of(1, 20), words_of(2, 20)
    bench = D.Benchmark([(1, " ".join(a + b))])
    h = D.words(*D.text_bytes(D.pa.array([" ".join(words_of(3, 50) + b + a + words_of(4, 50))])))[0]
    s, first, n = bench.matches(h, 0.8)[0]
    assert s == 0.8 and first == 50 and n == 40


def test_index_finds_all_within_any_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 16, (500, D.BLOCKS)).astype(np.uint16)
    prints[:200] = prints[0] ^ (np.uint16(1) << rng.integers(0, 16, (200, D.BLOCKS)).astype(np.uint16)) * (rng.random((200, D.BLOCKS)) < 0.9)
    index = D.HammingIndex(prints)
    for r in (0, 15, 40, 72, 95, 130, 256):
        far = np.bitwise_count(prints ^ prints[0]).sum(1)
        assert sorted(index.within(prints[0], r)) == np.flatnonzero(far <= r).tolist()


def test_radius_holds_for_even_weights_at_the_threshold():
    """Fingerprints of pairs at the threshold lie within the radius."""
    rng, missed, seen = np.random.default_rng(6), 0, 0
    for _ in range(400):
        c = 9 * int(rng.integers(2, 25))
        a = rng.integers(0, 2**63, c).astype(np.uint64)
        b = a.copy()
        b[rng.choice(c, c // 9, replace=False)] = rng.integers(0, 2**63, c // 9).astype(np.uint64)
        (ta, wa), (tb, wb) = (np.unique(x, return_counts=True) for x in (a, b))
        assert D.similarity((ta, wa), (tb, wb)) == pytest.approx(0.8)
        far = np.bitwise_count(D.simhash(ta, wa) ^ D.simhash(tb, wb)).sum()
        missed += far > D.radius(2 * 0.8 / 1.8 * np.sqrt(1 / D.EVEN))
        seen += 1
    assert missed == 0 and seen == 400


def test_long_text_with_many_hits(spark):
    item = words_of(8, 60)
    text = " ".join((words_of(9, 200) + item) * 40)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string")
    got = D.contaminated(spark.createDataFrame([(5, text), (5, text)], "doc_id long, text string"), bench).collect()
    assert [(r["doc_id"], r["similarity"], r["start_word"], r["n_words"]) for r in got] == [(5, 1.0, 200, 60)] * 2
