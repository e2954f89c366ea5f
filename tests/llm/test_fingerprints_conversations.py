"""Fingerprints, structure repair and the prefix trie against plain versions and on awkward rows."""

import hashlib
import random
import re
import struct
import zlib

import pytest
import xxhash

from riskloom.llm import minhash, prefix_trie, structure_repair

_WORD = re.compile("[^\x20\x09-\x0d]+")
_ASCII = {i: i + 32 for i in range(65, 91)}
EMPTY = hashlib.sha256(b"").hexdigest()


def chained(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def plain_print(text, k=5, bins=256, bits=4):
    """Values of all bins by loops; None without words."""
    codes = [zlib.crc32(w.encode()) for w in _WORD.findall((text or "").translate(_ASCII))]
    if not codes:
        return None
    runs = [codes[i : i + k] for i in range(len(codes) - k + 1)] or [codes]
    shift = 64 - bins.bit_length()
    least = {}
    for r in runs:
        h = chained(r) >> 1
        least[h >> shift] = min(h, least.get(h >> shift, h))
    out = []
    for j in range(bins):
        donor = j if j in least else min(least, key=lambda b: signed(chained([j, b])))
        out.append(least[donor] % 2**bits)
    return out


def plain_like(a, b, bits=4):
    if a == b:
        return 1.0
    if a is None or b is None:
        return 0.0
    same = sum(x == y for x, y in zip(a, b)) / len(a)
    return max((same - 2.0**-bits) / (1 - 2.0**-bits), 0.0)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def texts():
    base = prose(1, 150)
    return [
        base, base.upper(), base + " one more", "", None, " \n\t", "two Words", "two words", prose(2, 5), prose(3, 40_000),
        "Ünïcode ßtraße 😀 " * 20, "x" * 100_000, "a b c d e " * 50,
    ]


def check_pairs(rows, got):
    """``got`` against loops over ``rows`` (id, text) in their order of succession."""
    want = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = plain_print(text), plain_print(edited), plain_print(after)
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, plain_like(a, b), plain_like(a, c)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted((tuple(r) for r in got), key=key)
    assert len(got) == len(want)
    for w, g in zip(sorted(want, key=key), got):
        digits = lambda p: "" if p is None else "".join(f"{v:x}" for v in p)
        assert g[:3] == w[:3] and (g[3], g[4]) == (digits(w[3]), digits(w[4]))
        assert g[5:] == pytest.approx(w[5:], abs=1e-12)


SCHEMA = "doc_id long, text string, fp int, r string, sub string, copies string, next_text int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", "z", 2) for i, t in rows], SCHEMA)


def test_pairs_match_loops_on_awkward_texts(spark):
    rows = [(10 * i - 30, t) for i, t in enumerate(texts())]
    shuffled = random.Random(5).sample(rows, len(rows))
    check_pairs(rows, minhash.edited_pairs(frame(spark, shuffled).repartition(4)).collect())


def test_frequent_and_null_ids_and_repeated_rows(spark):
    plain = [(i, prose(i, 8 + i)) for i in range(12)]
    hot = [(5, prose(99, 30))] * 40 + [(5, prose(n, 9)) for n in range(40)]
    nulls = [(None, prose(7, 12))] * 60 + [(None, None)] * 3 + [(None, "")]
    rows = plain + hot + nulls
    of = lambda t: signed(xxhash.xxh64_intdigest((t or "").encode(), 42))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, of(r[1]), r[1] or ""))
    df = frame(spark, random.Random(3).sample(rows, len(rows))).repartition(5)
    assert minhash._ranges(df.selectExpr("coalesce(doc_id, 9223372036854775807) AS oid", "coalesce(text, '') AS text", "xxhash64(text) AS h"))[1]
    check_pairs(order, minhash.edited_pairs(df).collect())


def test_long_runs_of_copies_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "COPY_CHUNK", 7)
    rows = [(None, "a b c d e f")] * 50 + [(1, "g h i j k l m n")]
    check_pairs([rows[-1], *rows[:-1]], minhash.edited_pairs(frame(spark, rows)).collect())


def test_places_among_cuts(spark):
    import bisect

    rng = random.Random(1)
    for n in (1, 2, 3, 10, 97, 800):
        cuts = sorted(rng.sample(range(-(10**15), 10**15), n))
        xs = [*cuts, cuts[0] - 1, cuts[-1] + 1, *(rng.randrange(-(10**15), 10**15) for _ in range(50)), 2**63 - 1]
        df = spark.createDataFrame([(x,) for x in xs], "x long")
        got = [r[0] for r in df.select(minhash._place(df["x"], cuts)).collect()]
        assert got == [bisect.bisect_right(cuts, x) for x in xs]


def test_one_document_and_none(spark):
    check_pairs([(4, "one two three four five six")], minhash.edited_pairs(frame(spark, [(4, "one two three four five six")])).collect())
    assert minhash.edited_pairs(frame(spark, [])).collect() == []


def test_likeness_estimates_jaccard(spark):
    """Mean error near zero and spread as expected of 256 bins over texts of one to 3000 words."""
    from pyspark.sql import functions as F

    rng, rows, truth = random.Random(1), [], []
    for i in range(60):
        words = prose(i, rng.choice([12, 60, 300, 3000])).split()
        other = [w if rng.random() > rng.choice([0.005, 0.02, 0.1]) else "zz" for w in words]
        sets = [{tuple(x[j : j + 5]) for j in range(len(x) - 4)} for x in (words, other)]
        truth.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        rows.append((i, " ".join(words), " ".join(other)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    for bins, bits in ((256, 4), (128, 8), (64, 1)):
        like = minhash.likeness(*(minhash.fingerprint(F.col(c), bins=bins, bits=bits) for c in "ab"), bits=bits, bins=bins)
        errors = [r[1] - truth[r[0]] for r in df.select("i", like).collect()]
        assert abs(sum(errors) / 60) < 0.05 and (sum(e * e for e in errors) / 60) ** 0.5 < 0.9 / bins**0.5


def test_no_python_in_the_fingerprint_plan(spark):
    plan = minhash.edited_pairs(frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|UDF|bucketizer", plan)


# --- structure repair ---------------------------------------------------------------------------------------------


def plain_repair(rows):
    """rows (role, text, must_go, cut) in order -> cost, audit, repaired lines, by a table of strings."""
    states = {0: (0, "", ())}

    def offer(table, state, item):
        if state not in table or item[:2] < table[state][:2]:
            table[state] = item

    def inserts(table):
        for _ in range(4):
            for s, (c, a, out) in list(table.items()):
                role = "assistant" if s == 2 else "user"
                offer(table, 3 if s == 2 else 2, (c + 3, a + "I", (*out, f"{role}:")))

    for role, text, must_go, cut in rows:
        inserts(states)
        new = {}
        for s, (c, a, out) in states.items():
            offer(new, s, (c + 4, a + "D", out))
            if must_go:
                continue
            extra = 3 if cut else 0
            targets = {2: "user"} if s != 2 else {3: "assistant"}
            if s == 0 and role[:1] == "s":
                offer(new, 1, (c + extra, a + "K", (*out, f"{role}:{text}")))
            for t, name in targets.items():
                if role[:1] == name[0]:
                    offer(new, t, (c + extra, a + "K", (*out, f"{role}:{text}")))
                offer(new, t, (c + 3 + extra, a + "R", (*out, f"{name}:{text}")))
        states = new
    inserts(states)
    c, a, out = min(states[s] for s in (0, 3) if s in states)
    return c, a, hashlib.sha256("\n".join(out).encode()).hexdigest()


def random_rows(rng, n):
    roles = rng.choice([["user", "assistant", "system"], ["user", "user", "tool", "assistant", "s", ""], ["x"]])
    return [(rng.choice(roles), rng.choice("pqr"), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("settle, mod", [(4096, 2**61 - 1), (5, 2**61 - 1), (5, 3)])
def test_repair_matches_a_table_of_strings(monkeypatch, settle, mod):
    """Also with letters settled early, and with hashes that nearly always collide."""
    monkeypatch.setattr(structure_repair, "SETTLE", settle)
    monkeypatch.setattr(structure_repair, "_MOD", mod)
    rng = random.Random(4)
    for n in [*range(9)] * 25 + [60, 200, 300]:
        rows = random_rows(rng, n)
        dp = structure_repair.Repair()
        for r in rows:
            dp.row(*r)
        assert dp.result() == plain_repair(rows)


def test_settled_letters_leave_few_nodes(monkeypatch):
    monkeypatch.setattr(structure_repair, "SETTLE", 64)
    dp = structure_repair.Repair()
    for i in range(5000):
        dp.row(("user", "assistant")[i % 2], "t.", False, False)
    assert max(len(structure_repair._spell(h[1])) for h in dp.best.values()) < 200
    assert dp.result()[:2] == (0, "K" * 5000)


def plain_summary(conv, rows):
    """rows (turn, role, text, copy) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3]))
    seen, fed, counts, last, illegal = set(), [], [0, 0, 0, 0], None, 0
    for _, role, text, _ in rows:
        core = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = 1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0
        seen.add((role, text))
        counts[fault] += 1
        fed.append((role, text, fault in (1, 2), fault == 3))
        illegal += last is not None and last + role[:1] not in ("su", "ua", "au")
        last = role[:1]
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *counts[1:], illegal, *plain_repair(fed))


CONV = "conv_id long, turn long, role string, text string, copy string, gone string, fault int, nth int"


def conversations():
    rng, out = random.Random(8), []
    for conv in [None, -41, *range(0, 130), 2**62]:
        for i in range(rng.choice([0, 1, 2, 5, 8, 12]) if conv != 100 else 700):
            turn = rng.choice([None, i, i, i, 2 * i, 3])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool"])
            text = rng.choice(["Hi there.", "Why?", "cut off", "", None, " \t", "Well... no", "é!", prose(conv or 0, 20) + "."])
            out.append((conv, turn, role, text))
    out += [(7, 1, "user", "same."), (7, 1, "user", "same."), (300, 0, "user", "x " * 300_000 + "."), (301, None, None, None)]
    return out


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text, c) for c in range(2 if kind == 3 else 1)]
    return out


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "a", "b", 5, 6) for r in conversations()], CONV).repartition(3).cache()


def by_repr(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_summaries_after_damage_match_plain_ones(talks):
    got = structure_repair.repair(structure_repair.damage(talks)).collect()
    assert by_repr(got) == by_repr(plain_summary(c, rows) for c, rows in damaged(conversations()).items())


def test_summaries_without_damage(talks):
    plain = {}
    for conv, turn, role, text in conversations():
        plain.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text, 0))
    assert by_repr(structure_repair.repair(talks).collect()) == by_repr(plain_summary(c, rows) for c, rows in plain.items())


def test_repaired_rows_have_the_audited_hash(talks):
    dirty = structure_repair.damage(talks)
    lines = {}
    for conv, place, edit, role, text in structure_repair.repaired_rows(dirty).collect():
        lines.setdefault(conv, {})[place] = (edit, f"{role}:{text}")
    for row in structure_repair.repair(dirty).collect():
        kept = [lines.get(row.conv_id, {})[i] for i in range(len(lines.get(row.conv_id, {})))]
        assert "".join(e for e, _ in kept) == row.audit.replace("D", "")
        assert hashlib.sha256("\n".join(t for _, t in kept).encode()).hexdigest() == row.repaired_sha256


# --- prefix trie --------------------------------------------------------------------------------------------------


def sequences(rows, rebuild):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0, tie), (role, text)))
    convs = {c: [t for _, t in sorted(rows)] for c, rows in convs.items()}
    if not rebuild:
        return convs
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(seqs):
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        sub = [k for k in nodes if k[: len(key)] == key]
        kids = sum(len(k) == len(key) + 1 for k in sub)
        leaves = sum(not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in sub) for k in sub)
        saved = sum((len(nodes[k]) - 1) * len(_WORD.findall(k[-1][1])) for k in sub if k)
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(key))
        parent = min(nodes[key[:-1]]) if key else None
        out.append((min(members), len(key), parent, len(members), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def branching(seed):
    rng, out = random.Random(seed), []
    for conv in range(60):
        conv = conv * rng.choice([1, 1, 7]) - 5
        n = rng.choice([1, 2, 4, 5, 8, 9, 11])
        stop = rng.randint(0, n)
        for i in range(n):
            text = f"turn {i} of all" if i < stop else rng.choice(["A b", "c  D e", "", None])
            out.append((conv, i if rng.random() > 0.1 else None, rng.choice(["user", "user", "user", None]) if i >= stop else "user", text))
    return out


@pytest.mark.parametrize("block", [1, 2, 4])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_matches_a_plain_one(spark, block, rebuild):
    rows = branching(block) + [r for r in conversations() if r[0] is None or r[0] < 25]
    df = spark.createDataFrame([(*r, "a", "b", 5, 6) for r in rows], CONV).repartition(3)
    got = prefix_trie.trie(prefix_trie.rebuilt(df), block) if rebuild else prefix_trie.conversation_trie(df, block)
    assert by_repr(got.collect()) == by_repr(plain_trie(sequences(rows, rebuild)))


def test_conversations_without_turns_end_at_the_root(spark):
    ids = range(1, 20)
    rows = [(c, 0, "user", "gone") for c in ids]  # their first turns give way to those of an absent conversation
    got = prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    bare = [c for c in ids if zlib.crc32(str(c).encode()) % 4]
    root = next(r for r in got if r.depth == 0)
    assert bare and root.n_convs == 19 and root.ends_sha256 == hashlib.sha256(",".join(map(str, bare)).encode()).hexdigest()


def test_tables_without_rows(spark):
    nothing = spark.createDataFrame([], CONV)
    assert structure_repair.repair(structure_repair.damage(nothing)).collect() == []
    assert structure_repair.repaired_rows(nothing).collect() == []
    assert prefix_trie.trie(prefix_trie.rebuilt(nothing)).collect() == []
