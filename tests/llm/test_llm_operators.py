"""Corpus operators against plain versions: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import decontaminate, encode, html_text, jaccard_join, langid, line_dedup, mphf, nn_descent, packing, quality, repeats, token_store, words
from riskloom.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score string, `start` string, n_lines int"
_WORD = re.compile("[^\x20\x09-\x0d]+")
_ASCII = {i: i + 32 for i in range(65, 91)}


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(n))


def corpus():
    base, passage = sentence(1, 120), sentence(2, 70)
    swapped = base.split()
    swapped[60] = "zzz"
    texts = [
        (1, base), (2, base), (2, base), (3, " ".join(swapped)), (4, base.upper()), (5, None), (6, ""), (7, " \n\t "), (8, "One two"),
        (9, "one  TWO"), (10, sentence(3, 40) + "\n" + passage + "\n" + sentence(4, 30)), (11, passage + " " + sentence(5, 90)),
        (12, "A shared line here\nunique to twelve"), (13, "  a SHARED line here \nunique to thirteen\nshort\n"), (14, "short\na shared line here"),
        (None, base), (None, sentence(6, 55)), (15, sentence(7, 30_000)), (16, "!!! ... 123"), (17, "Ünïcode ßtraße " * 30),
    ]
    return [(i, t, None if k % 5 == 0 else "en", "s", None, "x", "y", "z", 7) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text):
    return _WORD.findall((text or "").translate(_ASCII))


def shingle_set(text, k):
    w = tokens(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def roots(n, edges):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return [root(i) for i in range(n)]


def test_words_of_bytes_match_a_regular_expression():
    import pyarrow as pa

    from riskloom.llm.common import text_bytes

    texts = [t for _, t, *_ in corpus()] + ["x" * 3_000_000 + " y", "q " * 600_000, "\x0bA\x1cB\x85c"]
    data, offsets = text_bytes(pa.array(texts))
    h, at, _, _ = words.words(data, offsets)
    seen = {}
    for i, t in enumerate(texts):
        mine = tokens(t)
        assert at[i + 1] - at[i] == len(mine)
        for w, v in zip(mine, h[at[i] : at[i + 1]].tolist()):
            assert seen.setdefault(w, v) == v
    assert len(set(seen.values())) == len(seen)


def test_key_index_finds_its_keys_and_no_others():
    rng = np.random.default_rng(0)
    hi, lo = rng.integers(0, 2**63, (2, 5000), dtype=np.uint64)
    index = mphf.KeyIndex.from_bytes(mphf.KeyIndex.build(hi, lo, value=np.arange(5000)).to_bytes())
    assert (index.values["value"][index.find(hi, lo)] == np.arange(5000)).all()
    assert (index.find(lo, hi) == -1).all()
    assert (mphf.KeyIndex.build(hi[:0], lo[:0]).find(hi, lo) == -1).all()


TOKENIZERS = [("byte_bpe_50k.json", "leads"), ("word_bpe_49k.json", "dropped")]


@pytest.mark.parametrize(("name", "spaces"), TOKENIZERS)
def test_encoder_equals_the_library(name, spaces):
    odd = ["a   b", "  lead", " \n x", "a\t b \n\n c  ", "<|endoftext|> it's I'LL 123", "x\x1c!\x1cy \x85 \xa0 z", "ΑΣ Σας", "é ́x", "日本 語"]
    e = encode.Encoder(tokenizer(name), spaces, memo=50)
    for t in odd + [t for _, t, *_ in corpus() if t]:
        assert np.frombuffer(e.encode(t), e.dtype).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_memo_of_separated_words_holds_words_alone():
    e = encode.Encoder(tokenizer("word_bpe_49k.json"), "dropped")
    text = "Der der, DER.\nder! über Über, x\x1cx X;x"
    assert np.frombuffer(e.encode(text), e.dtype).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids
    assert set(e._plain) == {"der", ",", ".", "!", "über", "x", "\x1c", ";"}


def test_token_files_round_trip(docs, nothing, spark):
    e = encode.Encoder(tokenizer("byte_bpe_50k.json"), "leads")
    got = rows_of(token_store.token_files(docs, tokenizer("byte_bpe_50k.json"), "leads", end_id=2, file_bytes=20_000))
    want = Counter()
    for i, t, *_ in corpus():
        ids = np.append(np.frombuffer(e.encode(t), e.dtype), 2).astype("<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((i, n, c) for i, _, n, c in got) == want
    ordered = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in ordered] == np.cumsum([0, *(r[2] for r in ordered[:-1])]).tolist()
    known = [r[0] for r in ordered if r[0] is not None]
    assert known == sorted(known) and all(r[0] is None for r in ordered[len(known) :])
    assert rows_of(token_store.token_files(nothing, tokenizer("byte_bpe_50k.json"), "leads", end_id=2)) == []


def test_token_file_reads_one_document_and_refuses_another_dictionary():
    w = token_store.ShardWriter(b"", 2)
    for i in range(5):
        w.add(i, np.arange(i, dtype="<u2").tobytes())
    data = w.to_bytes()
    assert token_store.ShardReader(data, b"").tokens(3).tolist() == [0, 1, 2]
    with pytest.raises(ValueError):
        token_store.ShardReader(data, b"other")


@pytest.mark.parametrize("hist", [{}, {4096: 3}, {1: 5000}, {2049: 10, 2047: 10}, {n: 1 + n % 7 for n in range(1, 4096, 13)}, {1500: 1000, 900: 400, 7: 9}])
def test_packing_plan_places_every_piece_without_gaps(hist):
    moves, used = packing.plan(hist, 4096)
    bins, ranks = defaultdict(list), Counter()
    for length, rank, n, first, offset in moves.tolist():
        for j in range(n):
            bins[first + j].append((offset, length))
            ranks[(length, rank + j)] += 1
    assert ranks == Counter((x, r) for x, n in hist.items() for r in range(n))
    assert len(bins) == used
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(x * n for x, n in hist.items())
    assert used <= 1.25 * -(-total // 4096) + 2 + sum(n for x, n in hist.items() if x > 2048)


def test_packing_places_all_pieces(docs, nothing):
    e = encode.Encoder(tokenizer("word_bpe_49k.json"), "dropped")
    got = packing.pack(docs, tokenizer("word_bpe_49k.json"), "dropped", end_id=1, capacity=256).collect()
    want = Counter()
    for i, t, *_ in corpus():
        ids = np.append(np.frombuffer(e.encode(t), e.dtype), 1).astype("<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            want[(i, k, at, len(ids[at : at + 256]), zlib.crc32(ids[at : at + 256].tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 256
    assert rows_of(packing.pack(nothing, tokenizer("word_bpe_49k.json"), "dropped", end_id=1)) == []


def test_line_dedup(docs, nothing):
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(_ASCII) for x in (t or "").split("\n")]
    big = 2**63 - 1
    owners = defaultdict(set)
    for i, t, *_ in corpus():
        for k in keys(t):
            owners[k].add(big if i is None else i)
    want = Counter()
    for i, t, *_ in corpus():
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys(t)) if len(k) < 10 or len(owners[k]) < 2 or min(owners[k]) == (big if i is None else i)]
        text = None if t is None else "\n".join(kept)
        want[(i, text, len(lines), len(lines) - len(kept), "x")] += 1
    out = line_dedup.dedup_lines(docs, shard_keys=2)
    assert Counter(tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_dropped", "n_tokens").collect()) == want
    assert rows_of(line_dedup.dedup_lines(nothing)) == []


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (2, 1, 2)])
def test_jaccard_components(docs, nothing, k, num, den):
    data = corpus()
    sets = [shingle_set(t, k) for _, t, *_ in data]
    edges = [
        (a, b) for a in range(len(data)) for b in range(a)
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    root = roots(len(data), edges)
    least = defaultdict(list)
    for (i, *_), r in zip(data, root):
        least[r].append(2**63 - 1 if i is None else i)
    name = {r: (None if min(v) == 2**63 - 1 else min(v)) for r, v in least.items()}
    want = Counter((i, len(s), name[r]) for (i, *_), s, r in zip(data, sets, root))
    assert Counter(tuple(r) for r in jaccard_join.jaccard_components(docs, k, num, den).collect()) == want
    assert rows_of(jaccard_join.jaccard_components(nothing, k, num, den)) == []


def test_jaccard_family_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng, base = np.random.default_rng(5), sentence(9, 100).split()
    data = []
    for i in range(90):
        w = list(base)
        for at in rng.choice(100, rng.integers(0, 5), replace=False):
            w[at] = f"edit{i}"
        data.append((i, " ".join(w)))
    sets = [shingle_set(t, 3) for _, t in data]
    edges = [(a, b) for a in range(90) for b in range(a) if 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])]
    root = roots(90, edges)
    first = {}
    for i, r in enumerate(root):
        first.setdefault(r, i)
    got = jaccard_join.jaccard_components(spark.createDataFrame(data, "doc_id long, text string"), 3, 9, 10).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: first[r] for i, r in enumerate(root)}


def test_drop_copies_keeps_one_of_each_group(docs, nothing):
    kept = jaccard_join.drop_copies(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    data = [(i, t) for i, t, *_ in corpus()]
    sets = [shingle_set(t, 5) for _, t in data]
    root = roots(len(data), [(a, b) for a in range(len(data)) for b in range(a) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])])
    best = {}
    for (i, t), s, r in zip(data, sets, root):
        best.setdefault(r, []).append(2**63 - 1 if i is None else i)
    want = Counter(d for d, s in zip(data, sets) if not s)
    assert sum(got.values()) == sum(want.values()) + len({r for r, s in zip(root, sets) if s})
    assert {i for i, _ in got if i is not None} == {i for (i, _), s in zip(data, sets) if not s} | {min(best[r]) for r, s in zip(root, sets) if s} - {2**63 - 1}
    assert rows_of(jaccard_join.drop_copies(nothing)) == []


def test_decontamination(docs, nothing, spark):
    bench = spark.createDataFrame(
        [(1, sentence(2, 70)), (2, sentence(99, 40)), (3, None), (4, ""), (5, "one two"), (None, sentence(6, 55)), (7, "never seen before")], "item_id long, text string"
    )
    for block in (1 << 20, 50):
        got = decontaminate.contaminated(docs, bench, block_bytes=block).collect()
        pairs = {(r["doc_id"], r["item_id"]) for r in got if r["similarity"] == 1.0}
        assert pairs == {(10, 1), (11, 1), (8, 5), (9, 5), (None, None)}
        assert {(r["doc_id"], r["item_id"]) for r in got} == pairs
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 5
    assert rows_of(decontaminate.contaminated(nothing, bench)) == []
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_decontamination_equals_all_windows(spark):
    """Items with edits: every item-sized window by brute force."""
    rng = np.random.default_rng(3)
    items = [(i, sentence(100 + i, int(rng.integers(30, 70)))) for i in range(12)]
    data = []
    for d in range(40):
        w = items[d % 12][1].split()
        for at in rng.choice(len(w), d // 12, replace=False):
            w[at] = "changed"
        data.append((d, " ".join([sentence(500 + d, 30), *w, sentence(900 + d, 20)])))

    def weighted(w):
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    want = set()
    for d, t in data:
        w = t.split()
        for i, item in items:
            want_set, n = weighted(item.split()), len(item.split())
            best = max(sum((weighted(w[s : s + n]) & want_set).values()) / sum((weighted(w[s : s + n]) | want_set).values()) for s in range(len(w) - n + 1))
            if best >= 0.8:
                want.add((d, i, round(best, 9)))
    got = decontaminate.contaminated(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in got.collect()} == want
    assert len(want) > 12


def test_hamming_index_guarantees_its_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**16, (50, decontaminate.BLOCKS)).astype(np.uint16)
    index = decontaminate.HammingIndex(prints)
    for i in range(50):
        for radius in (15, 63, 72, 110):
            bits = np.unpackbits(prints[i].view(np.uint8))
            bits[rng.choice(len(bits), radius, replace=False)] ^= 1
            assert i in index.within(np.packbits(bits).view(np.uint16), radius)


def test_repeated_passages(docs, nothing):
    owner = defaultdict(set)
    texts = defaultdict(list)
    for i, t, *_ in corpus():
        texts[i].append(tokens(t))
        for s in range(len(tokens(t)) - 49):
            owner[tuple(tokens(t)[s : s + 50])].add(i)
    want = set()
    for i, many in texts.items():
        hit = sorted({s for w in many for s in range(len(w) - 49) if len(owner[tuple(w[s : s + 50])]) > 1})
        while hit:
            a = b = hit.pop(0)
            while hit and hit[0] <= b + 50:
                b = hit.pop(0)
            want.add((i, a, b + 50, b + 50 - a))
    assert set(rows_of(repeats.repeated_passages(docs))) == want
    assert rows_of(repeats.repeated_passages(nothing)) == []


def labelled(spark, n=400):
    data = []
    for i in range(n):
        t = sentence(i, 60)
        if i % 4 == 0:
            t = " ".join(w + "###" for w in t.split()) if i % 8 else t.upper()
        data.append((i, t, int(i % 4 != 0)))
    return spark.createDataFrame(data, "doc_id long, text string, quality int").repartition(3)


def test_quality_on_held_out_rows(spark, docs, nothing):
    rows = labelled(spark)
    labels = rows.select("doc_id", "quality")
    got = quality.quality_scores(rows.drop("quality"), labels, max_train=200)
    both = got.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in both)
    held = [r for r in both if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert quality.quality_scores(docs, labels).count() == docs.count()
    assert rows_of(quality.quality_scores(nothing, labels)) == []
    kept = quality.keep_good(rows, labels)
    assert kept.columns == rows.columns and abs(kept.count() - 300) <= 10
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()  # nothing learned: nothing rejected


def test_gam_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction alone
    model = quality.fit(x, y, n_pairs=2)
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x) > 0.5) == y) > 0.9
    assert np.allclose(quality.fit(x[:5], np.ones(5)).score(x), 1)


def test_languages(spark, docs, nothing):
    rng = np.random.default_rng(4)
    alphabet = {"aa": "abcde", "bb": "defgh", "cc": "ñóíab"}
    data = [(i, " ".join("".join(rng.choice(list(a), 5)) for _ in range(20)), lang) for i, (lang, a) in enumerate([*alphabet.items()] * 60)]
    data += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !?", "cc"), (1003, "abc abc", None), (None, "abcde", None)]
    got = langid.languages(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(data)
    truth = {i: lang for i, _, lang in data}
    named = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1000]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in named if r["held_out"]]) > 0.95
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1000, 1001, 1002)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert langid.languages(docs).count() == docs.count()
    assert rows_of(langid.languages(nothing)) == []
    code = langid.codewords(9)
    assert min((code[a] != code[b]).sum() for a in range(9) for b in range(a)) >= 8


PAGES = [
    ("<html><head><title>T</title></head><body><nav><a href=x>Menu</a></nav><article><h1>Head</h1><p>One &amp; <b>t</b>wo<br>three<p>Four</article>"
     "<div class='comments'><p>Reader</p></div><footer>&copy; f</footer></body></html>", "Head One & two three Four"),
    ("<body><div id=cookie-notice>We use cookies</div><div><p>" + "word " * 40 + "</p><p>short.</p></div><ul><li><a>l</a></li></ul></body>", "word " * 40 + "short."),
    ("<p>a &lt;p&gt; b<script>var t='</p>x';</script> c<!-- no --></p>", "a <p> b c"),
    (None, ""), ("", ""), ("<nav>only menu</nav>", ""), ("plain  text\n here", "plain text here"), ("<article>open <p>ended", "open ended"),
]


def test_html_text(spark):
    assert [html_text.main_text(h) for h, _ in PAGES] == [t for _, t in PAGES]
    df = spark.createDataFrame([(i, None, h, "clash") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(df).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert html_text.extract(df.limit(0)).collect() == []


def test_embedding_links(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    family = x[0] + 0.05 * rng.normal(size=(60, 16)).astype(np.float32)
    vectors = [*x, *family, *(x[5] * 2 for _ in range(4)), x[5]]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [1.0] * 15, [None] * 16]
    data = [(i, [float(a) for a in v], "c") for i, v in enumerate(vectors)] + [(1000 + i, v, "c") for i, v in enumerate(odd)] + [(None, [float(a) for a in x[7]], "c")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, n_links string").repartition(4)
    unit = np.array([v for i, v, _ in data if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    got = nn_descent.near_duplicates(df).collect()
    assert len(got) == len(data)
    links = {r["vec_id"]: r["n_links"] for r in got}
    assert [links[i] for i in range(len(vectors))] == hit.sum(axis=1)[: len(vectors)].tolist()
    assert all(links[1000 + i] == 0 for i in range(len(odd)))
    assert {r["component_id"] for r in got if r["vec_id"] is not None and 300 <= r["vec_id"] < 360} == {0}
    assert {r["component_id"] for r in got if r["vec_id"] is None} == {7}
    assert nn_descent.near_duplicates(df.limit(0)).collect() == []


def test_embedding_links_of_every_length(spark):
    rng = np.random.default_rng(8)
    data = []
    for dims, n in ((16, 30), (15, 10), (3, 2)):
        x = rng.normal(size=(n, dims))
        data += [(len(data) + i, v.tolist()) for i, v in enumerate([*x, *(x + 0.001 * rng.normal(size=x.shape))])]
    links = {}
    for i, v in data:
        u = np.array(v) / np.linalg.norm(v)
        links[i] = sum(j != i and len(w) == len(v) and u @ (np.array(w) / np.linalg.norm(w)) >= 0.95 for j, w in data)
    got = nn_descent.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == links
    assert min(links.values()) > 0


def classes(spark, x):
    return spark.createDataFrame([(i, 1, bytearray(v.tobytes())) for i, v in enumerate(x)], "rid long, mult long, vec binary")


def test_embedding_audit_weighs_vectors_alike(spark):
    rng = np.random.default_rng(9)
    near = spark.createDataFrame([], "rid long, sim double")
    pairs = np.repeat(rng.normal(size=(100, 32)), 2, axis=0) + 0.001 * rng.normal(size=(200, 32))
    hot = rng.normal(size=32) + 0.001 * rng.normal(size=(200, 32))
    counted = spark.createDataFrame([(200 + i, 199) for i in range(200)], "rid long, links long")  # no pair was found
    assert 0.3 < nn_descent.audit(classes(spark, np.concatenate([pairs, hot])), counted, near, 32, 0.95) < 0.7
    lone = rng.normal(size=(1500, 32))
    assert nn_descent.audit(classes(spark, np.concatenate([lone, lone[:1] + 0.001])), counted.limit(0), near, 32, 0.95) == 0
    assert nn_descent.audit(classes(spark, lone), counted.limit(0), near, 32, 0.95) == 1


def test_embedding_audit_is_bounded_and_asks_near_the_threshold(spark, monkeypatch):
    """Vectors without links cost three passes at most; a lost link of a vector near the threshold is seen."""
    monkeypatch.setattr(nn_descent, "AUDIT", 20)
    monkeypatch.setattr(nn_descent, "ASK", 50)
    asked, plain = [], nn_descent._true_links
    monkeypatch.setattr(nn_descent, "_true_links", lambda reps, q, t: asked.append(len(q[0])) or plain(reps, q, t))
    lone = np.random.default_rng(10).normal(size=(2000, 16))
    reps, nothing = classes(spark, [*lone, lone[7] + 0.001]), spark.createDataFrame([], "rid long, links long")
    near = spark.createDataFrame([(7, 0.94), (8, 0.5), (9, 0.96)], "rid long, sim double")
    assert nn_descent.audit(reps, nothing, near, 16, 0.95) == 0.0
    assert asked == [20, 50, 1]


def test_embedding_search_widens_with_depth_and_compares_all_below_its_recall(spark, monkeypatch):
    for depth in (4, 8, 14, 21):
        together = (1 - np.arccos(0.95) / np.pi) ** depth
        assert 1 - (1 - together) ** nn_descent._trees(depth, 0.95, 0.99) >= 0.99
    rng = np.random.default_rng(11)
    x = rng.normal(size=(120, 12))
    x = np.concatenate([x, x[:50] + 0.001 * rng.normal(size=(50, 12)), x[:1].repeat(30, 0) + 0.05 * rng.normal(size=(30, 12)), x[3:4]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, nn_descent.near_duplicates(df).collect()))
    monkeypatch.setattr(nn_descent, "audit", lambda *_: 0.5)
    monkeypatch.setattr(nn_descent, "_around", lambda graph, reps: pytest.fail("no round was asked for"))
    monkeypatch.setattr(nn_descent, "ASK", 64)
    assert sorted(map(tuple, nn_descent.near_duplicates(df, rounds=0, tries=1).collect())) == want
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert [r[1] for r in want] == ((unit @ unit.T >= 0.95).sum(1) - 1).tolist()


def passages(data):
    """Repeated passages of 50 words by brute force."""
    owner, texts = defaultdict(set), defaultdict(list)
    for i, t in data:
        w = tokens(t)
        texts[i].append(w)
        for s in range(len(w) - 49):
            owner[tuple(w[s : s + 50])].add(i)
    want = set()
    for i, many in texts.items():
        hit = sorted({s for w in many for s in range(len(w) - 49) if len(owner[tuple(w[s : s + 50])]) > 1})
        while hit:
            a = b = hit.pop(0)
            while hit and hit[0] <= b + 50:
                b = hit.pop(0)
            want.add((i, a, b + 50, b + 50 - a))
    return want


def test_repeated_passages_end_with_their_texts(spark):
    opening, copy = sentence(31, 42), sentence(32, 80)
    data = [(i, opening + " " + sentence(40 + i, 60)) for i in range(6)] + [(i, copy) for i in (10, 11)] + [(12, sentence(33, 60) + " " + opening)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, "1")  # every text is the first of its slice
    try:
        got = repeats.repeated_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()
    finally:
        spark.conf.set(key, was)
    assert {tuple(r) for r in got} == passages(data) == {(10, 0, 80, 80), (11, 0, 80, 80)}


def test_repeated_passages_of_least_length_among_many_near_ones(spark):
    rng, source = np.random.default_rng(6), sentence(34, 64).split()
    data = []
    for i in range(240):
        a, b = (0, 56) if i in (100, 200) else (rng.integers(3, 15), 64) if i % 2 else (0, rng.integers(36, 50))
        data.append((i, " ".join([sentence(1000 + i, 20), *source[a:b], sentence(3000 + i, 20)])))
    got = repeats.repeated_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()
    want = passages(data)
    assert {tuple(r) for r in got} == want
    assert {i for i, *_ in want} >= {100, 200}


def test_repeated_passages_of_an_id_that_fills_ranges(spark):
    passage = sentence(35, 60)
    data = [(1, " ".join(passage + " " + sentence(5000 + i, 30) for i in range(300))), (2, passage + " " + sentence(36, 30))]
    got = repeats.repeated_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == passages(data)


def test_repeated_passages_keep_places_per_text(spark, monkeypatch):
    passage, saved = sentence(37, 60), {}
    data = [(None if i % 2 else 5, sentence(6000 + i, 30) + " " + passage + " " + sentence(7000 + i, 30)) for i in range(60)]

    class Kept(repeats.Workspace):
        def save(self, df, name):
            saved[name] = super().save(df, name)
            return saved[name]

    monkeypatch.setattr(repeats, "Workspace", Kept)
    got = repeats.repeated_passages(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    assert {tuple(r) for r in got} == {(None, 30, 90, 60), (5, 30, 90, 60)}
    assert saved["held"].count() == 60 and saved["held"].selectExpr("max(size(places))").first()[0] < 40
