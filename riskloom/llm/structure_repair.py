"""Repair of conversation structure: the cheapest edits that make the roles alternate, with an audit.

A conversation's rows are read by turn (nulls first; rows of one turn by
role, then text, a repeated row next to its original). A row's first fault
counts: blank (no character outside ``[\\x20\\x09-\\x0D]``), duplicate (role
and text seen earlier), truncated (the last such character is none of
``.!?``). Edits per row: K(eep) 0, R(erole) to user or assistant 3, D(elete)
4, and I(nsert) of an empty user or assistant row anywhere 3. Blank and
duplicate rows are deleted; a truncated row that stays adds 3. The edited
role initials match ``(s?(ua)+)?``. Of the cheapest edits those whose
letters come first in ASCII win.

Method (persistent audit DP): what was written so far is in one of four
states (nothing, system, ends with user, ends with assistant). Each state
keeps its cheapest audit as a node linked to the node of the audit before
its last letter, so audits share their prefixes. A node holds a rolling hash
and its ancestors at distances of powers of two; equal costs are told apart
at the longest common prefix, found by lifting both nodes. Equal hashes of
different nodes are verified letter by letter. The letters that all states
share are settled from time to time, so memory follows the unsettled part.
Every state also carries a running SHA-256 of its text, so no text is kept.

Spark deals rows by ``conv_id`` once and sorts them inside partitions (this
spills); duplicates are found by a window in the same partitions, and the DP
reads the sorted rows as a stream. One conversation is one task: its audit
and hash are sequential.

Nulls in role or text count as one space (so a null text is blank); null
turns come first; rows with a null ``conv_id`` are one conversation. Empty
texts are blank. Very long texts are hashed as they stream by. Extra columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import column, prepare

SPACE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
# States: nothing written, system written, user last, assistant last.
START, SYSTEM, USER, ASSISTANT = range(4)
SETTLE = 4096
_MOD, _BASE = 2**61 - 1, 1_000_003

SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
ROWS = "conv_id long, place long, edit string, role string, text string"


class Node:
    """An audit: its last letter, length, rolling hash, and ancestors 1, 2, 4, ... letters back."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str, depth: int, hash_: int, up: list[Node]):
        self.letter, self.depth, self.hash, self.up = letter, depth, hash_, up

    def add(self, letter: str) -> Node:
        up = [self]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])
        return Node(letter, self.depth + 1, (self.hash * _BASE + ord(letter)) % _MOD, up)


def _lift(node: Node, depth: int) -> Node:
    """The ancestor of that length."""
    while node.depth > depth:
        node = node.up[min((node.depth - depth).bit_length(), len(node.up)) - 1]
    return node


def _same(a: Node, b: Node) -> bool:
    """Whether two audits of one length are equal; equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def precedes(a: Node, b: Node) -> bool:
    """Whether audit ``a`` comes before ``b`` in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = _lift(a, depth), _lift(b, depth)
    if _same(x, y):
        return a.depth < b.depth
    for j in range(len(x.up) - 1, -1, -1):
        if j < len(x.up) and j < len(y.up) and not _same(x.up[j], y.up[j]):
            x, y = x.up[j], y.up[j]
    return x.letter < y.letter


def _fork(a: Node, b: Node) -> Node:
    """The last node that two audits share."""
    depth = min(a.depth, b.depth)
    a, b = _lift(a, depth), _lift(b, depth)
    while a is not b:
        j = next((j for j in range(len(a.up) - 1, -1, -1) if a.up[j] is not b.up[j]), None)
        if j is None:
            return a.up[0]
        a, b = a.up[j], b.up[j]
    return a


def _spell(node: Node, above: Node | None = None) -> list[Node]:
    """Nodes from just after ``above`` (or the first one kept) to ``node``."""
    out = []
    while node is not above and node.up:
        out.append(node)
        node = node.up[0]
    return out[::-1]


class Repair:
    """The DP over one conversation's rows, fed in order."""

    def __init__(self) -> None:
        # state -> (cost, audit, SHA-256 of the rows written)
        self.best = {START: (0, Node("", 0, 0, []), hashlib.sha256())}
        self.settled: list[str] = []
        self.limit = SETTLE

    def _relax(self, states: dict, to: int, frm: tuple, cost: int, letter: str, written: str | None) -> None:
        """Offer ``to`` the audit of ``frm`` with one more letter."""
        total = frm[0] + cost
        held = states.get(to)
        if held is not None and held[0] < total:
            return
        node = frm[1].add(letter)
        if held is not None and held[0] == total and not precedes(node, held[1]):
            return
        sha = frm[2]
        if written is not None:
            sha = sha.copy()
            sha.update(written.encode("utf-8", "surrogatepass"))
        states[to] = (total, node, sha)

    def _insert(self) -> None:
        """Inserts from every state; more than one of a kind in a row never pays."""
        old = dict(self.best)
        for frm in (START, SYSTEM, ASSISTANT):
            if frm in old:
                self._relax(self.best, USER, old[frm], INSERT, "I", self._line(frm, "user", ""))
        if USER in self.best:
            self._relax(self.best, ASSISTANT, self.best[USER], INSERT, "I", self._line(USER, "assistant", ""))

    @staticmethod
    def _line(frm: int, role: str, text: str) -> str:
        return f"{role}:{text}" if frm == START else f"\n{role}:{text}"

    def row(self, role: str, text: str, must_go: bool, cut: bool) -> None:
        self._insert()
        new: dict = {}
        stay = CUT if cut else 0
        for state, held in self.best.items():
            self._relax(new, state, held, DELETE, "D", None)
            if must_go:
                continue
            to, name = (ASSISTANT, "assistant") if state == USER else (USER, "user")
            if role[:1] == name[0]:
                self._relax(new, to, held, stay, "K", self._line(state, role, text))
            elif state == START and role[:1] == "s":
                self._relax(new, SYSTEM, held, stay, "K", self._line(state, role, text))
            self._relax(new, to, held, REROLE + stay, "R", self._line(state, name, text))
        if ASSISTANT in new:
            # an assistant's end completes like these states at no more cost (but for one system row)
            done = new[ASSISTANT][0]
            if SYSTEM in new and new[SYSTEM][0] > done:
                del new[SYSTEM]
            if START in new and new[START][0] > done + DELETE:
                del new[START]
        self.best = new
        if max(h[1].depth for h in new.values()) > self.limit:
            self._settle()

    def _settle(self) -> None:
        """Put down the letters that all states share and link what follows to a new first node."""
        tips = [h[1] for h in self.best.values()]
        fork = tips[0]
        for t in tips[1:]:
            fork = _fork(fork, t)
        self.settled.extend(n.letter for n in _spell(fork))
        moved = {id(fork): Node("", fork.depth, fork.hash, [])}
        for state, (cost, tip, sha) in self.best.items():
            last = moved[id(fork)]
            for n in _spell(tip, fork):
                if id(n) not in moved:
                    moved[id(n)] = last.add(n.letter)
                last = moved[id(n)]
            self.best[state] = (cost, last, sha)
        deepest = max(h[1].depth for h in self.best.values())
        self.limit = deepest + max(SETTLE, deepest - fork.depth)

    def result(self) -> tuple[int, str, str]:
        """Cost, audit letters and SHA-256 of the cheapest legal end."""
        self._insert()
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        end = ends[0]
        for other in ends[1:]:
            if other[0] < end[0] or (other[0] == end[0] and precedes(other[1], end[1])):
                end = other
        return end[0], "".join(self.settled) + "".join(n.letter for n in _spell(end[1])), end[2].hexdigest()


class _Conversation:
    """Counts of one conversation's rows, and their repair."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.repair = conv_id, Repair()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.rows += 1
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        self.repair.row(role, text, fault in (1, 2), fault == 3)

    def summary(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        counts = (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal)
        return (*counts, *self.repair.result())


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column(batch, n).to_pylist() for n in names))


def _emit(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def run() -> Iterator[tuple]:
        now = None
        for conv_id, turn, role, text, fault, gone in _rows(batches, ("conv_id", "turn", "role", "text", "fault", "__gone")):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.summary()
                now = _Conversation(conv_id)
            if not gone:
                now.add(turn, role, text, fault)
        if now is not None:
            yield now.summary()

    return _emit(run(), _schema(SUMMARY))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply each conversation's audit, which comes before its rows, to the rows."""

    def run() -> Iterator[tuple]:
        conv, letters, at, place, state = None, "", 0, 0, START

        def inserts() -> Iterator[tuple]:
            nonlocal at, place, state
            while letters[at : at + 1] == "I":
                role = "assistant" if state == USER else "user"
                yield conv, place, "I", role, ""
                at, place, state = at + 1, place + 1, ASSISTANT if state == USER else USER

        for conv_id, role, text, gone, audit in _rows(batches, ("conv_id", "role", "text", "__gone", "audit")):
            if audit is not None:
                yield from inserts()
                conv, letters, at, place, state = conv_id, audit, 0, 0, START
            elif not gone:
                yield from inserts()
                edit, at = letters[at], at + 1
                if edit == "D":
                    continue
                if edit == "R":
                    role = "assistant" if state == USER else "user"
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                yield conv_id, place, edit, role, text
                place += 1
        yield from inserts()

    return _emit(run(), _schema(ROWS))


_TURN = ("turn", "role", "text", "__copy")


def _plain(rows: DataFrame) -> DataFrame:
    """The columns that are read, nulls in role and text as one space."""
    space = F.lit(" ")
    own = {"__copy": F.lit(0), "__gone": F.lit(False)}
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        *[F.col(c) if c in rows.columns else e.alias(c) for c, e in own.items()],
    )


def faults(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation, with ``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated.

    ``rows`` holds conv_id, turn, role and text, and from ``damage`` ``__copy``
    (which repeat of a row this is) and ``__gone`` (a row that only stands for
    its conversation).
    """
    seen = Window.partitionBy("conv_id", "__gone", "role", "text").orderBy("turn", "__copy")
    rows = _plain(rows).repartition("conv_id").withColumn("nth", F.row_number().over(seen))
    core = F.btrim("text", F.lit(SPACE))
    fault = F.when(core == "", 1).when(F.col("nth") > 1, 2).when(~F.right(core, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    return rows.withColumn("fault", fault).drop("nth")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation (SUMMARY): counts of faults and of illegal neighbours, cost, audit, hash of the repair."""
    prepare(rows.sparkSession)
    dealt = faults(rows).sortWithinPartitions("conv_id", *_TURN)
    return dealt.select("conv_id", "turn", "role", "text", "fault", "__gone").mapInArrow(_summaries, SUMMARY)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations (ROWS): every row that stays or was inserted, by ``place`` from 0."""
    audits = repair(rows).select("conv_id", "audit")
    both = _plain(rows).withColumn("later", F.lit(1)).unionByName(audits.withColumn("later", F.lit(0)), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "later", *_TURN)
    return both.select("conv_id", "role", "text", "__gone", "audit").mapInArrow(_edited, ROWS)


def damage(rows: DataFrame) -> DataFrame:
    """Deterministic damage by crc32(``conv_id:turn``) mod 20: 0 drops a row, 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 makes its role user. A dropped row stays as ``__gone`` so that its conversation is known."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(key, "utf-8")) % 20
    text = F.coalesce("text", space)
    text = F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 0, F.lit("")).when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", space))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("__gone"), F.explode(copies).alias("__copy"))
