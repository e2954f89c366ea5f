"""Each stage of the corpus pipeline against a plain version on its own input, and the run as a whole."""

import re
import zlib
from collections import Counter

import pytest
from conftest import SF001

import corpus_pipeline as P
from riskloom.llm import quality
from riskloom.llm.queries import tokenizer

_WORD = re.compile("[^\x20\x09-\x0d]+")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_ASCII = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return _WORD.findall((text or "").translate(_ASCII))


def shingles(w, k=5):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else [])


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage."""
    root, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in P.STAGES:
        stage(spark, docs, SF001).write.parquet(str(root / name))
        after = spark.read.parquet(str(root / name))
        out[name] = docs, after
        docs = after
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_quality_keeps_what_the_score_keeps(spark, stages):
    before, after = stages["quality"]
    scored = quality.quality_scores(before, spark.read.parquet(f"{SF001}/labels.parquet")).collect()
    good = {r["doc_id"] for r in scored if r["predicted"] == 1}
    assert rows(after) == {d: t for d, t in rows(before).items() if d in good}
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) for r in scored)


def test_line_dedup_keeps_first_owners(stages):
    before, after = (rows(x) for x in stages["line_dedup"])
    key = lambda line: line.strip(_SPACE).translate(_ASCII)
    holders: dict[str, set] = {}
    for d, t in before.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(d)
    gone = lambda d, line: len(holders.get(key(line), ())) > 1 and min(holders[key(line)]) != d
    want = {d: "\n".join(x for x in (t or "").split("\n") if not gone(d, x)) for d, t in before.items()}
    assert {d: t or "" for d, t in after.items()} == want and want != before


def test_near_duplicates_keep_the_smallest_of_each_group(stages):
    before, after = (rows(x) for x in stages["near_duplicates"])
    sets = {d: frozenset(shingles(tokens(t))) for d, t in before.items()}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    assert after == {d: t for d, t in before.items() if root(d) == d}


def test_decontamination_drops_what_holds_an_item(spark, stages):
    before, after = (rows(x) for x in stages["decontamination"])
    items = [tokens(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect() if tokens(r["text"])]

    def holds(w, item):
        """Any window of the item's length, or its part inside the text, at 0.8."""
        have, n, k = Counter(shingles(item)), len(item), min(5, len(item))
        places = set(have)
        if not places & set(shingles(w, k)):
            return False
        for s in range(-n + k, len(w) - k + 1):
            win = Counter(shingles(w[max(0, s) : min(len(w), s + n)], k))
            both = sum((win & have).values())
            if both and 5 * both >= 4 * (sum(win.values()) + sum(have.values()) - both):
                return True
        return False

    want = {d: t for d, t in before.items() if not any(holds(tokens(t), i) for i in items)}
    assert after == want and len(want) < len(before)


def test_packing_places_every_token(spark, stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    tok = Tokenizer.from_str(tokenizer("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    pieces: dict[int, list] = {}
    for r in after.collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    total = 0
    for d, text in rows(before).items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        mine = sorted(pieces.pop(d), key=lambda r: r["piece"])
        assert [r["start"] for r in mine] == list(range(0, len(ids), 4096)) and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r["ids_crc32"]
    assert not pieces
    sequences: dict[int, list] = {}
    for r in after.collect():
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.05 * (-(-total // 4096)) + 1


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(P.run(spark, SF001)) == key(stages["packing"][1])
