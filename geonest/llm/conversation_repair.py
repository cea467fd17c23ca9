r"""Conversation structure repair (12) by a survivor-coalescence Viterbi.

A repaired conversation's roles begin with at most one system turn and then
alternate user, assistant, ending with assistant; or it is empty. Rows are
kept, given another role or deleted, and empty user or assistant turns
inserted, at the least cost. The states of the search are what the output
ends with; each state's survivor is the cheapest way to it, of equal costs
the one whose edits come first in ASCII order.

The survivors are leaves of a tree of backpointers with reference counts: a
node whose count falls to zero goes, and as soon as the root has a single
child and is no survivor itself, all survivors share that child's edits,
which are handed over and forgotten. So only the edits (and rows) on which
the survivors still differ are held. Ties compare complete unresolved
suffixes: no survivor's edits are a prefix of another's (each ends with the
edit of the latest row, and a longer one would have further insertions and
so a higher cost), so their order is a rank that every row carries on.

Spark sorts the rows by conversation and turn and streams them through the
search. A conversation is one sequence, and is never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import pick, write_table

BLANKS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
#: Costs; an undeleted truncated row adds the last.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAULTS = ("", "blank", "duplicate", "truncated")

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Role whose turn may come next as an insertion or a changed role, and the state after it.
NEXT = {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The most by which a state's cost may exceed another's and it can still win:
#: (state, other) -> what the other pays at most to follow any of its futures.
FOLLOW = {
    (EMPTY, ASSISTANT): 3, (EMPTY, USER): 5, (EMPTY, SYSTEM): 4,
    (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): 2, (USER, ASSISTANT): 2, (ASSISTANT, USER): 2,
}


def _inserted(state: int) -> list[tuple[int, str, int]]:
    """(state, edits, cost) after no, one or two insertions; more come back to a state for nothing."""
    out, edits = [(state, "", 0)], ""
    for _ in range(2):
        state, edits = NEXT[state], edits + "I"
        out.append((state, edits, INSERT * len(edits)))
    return out


def row_moves(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, str, int]]:
    """(from, to, edits, cost): the best way through a row between each two states, insertions before it included."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        for state, edits, cost in _inserted(start):
            ways = [(state, "D", DELETE)]
            if not must_go:
                more = TRUNCATED if truncated else 0
                ways.append((NEXT[state], "R", REROLE + more))
                kept = {"s": SYSTEM if state == EMPTY else None, "u": USER, "a": ASSISTANT}.get(initial)
                if kept == SYSTEM or kept == NEXT[state]:
                    ways.append((kept, "K", more))
            for to, edit, extra in ways:
                found = (cost + extra, edits + edit)
                best[start, to] = min(best.get((start, to), found), found)
    return [(start, to, edits, cost) for (start, to), (cost, edits) in best.items()]


_MOVES: dict[tuple[str, bool, bool], list[tuple[int, int, str, int]]] = {
    (i, go, cut): row_moves(i, go, cut) for i in ("s", "u", "a", "") for go, cut in ((False, False), (False, True), (True, False))
}
#: Insertions that end a conversation.
_LAST = {EMPTY: ("", 0), ASSISTANT: ("", 0), USER: ("I", INSERT), SYSTEM: ("II", 2 * INSERT)}


class Node:
    """Edits of one row, insertions before it included, after the parent's."""

    __slots__ = ("parent", "state", "edits", "row", "refs", "child")

    def __init__(self, parent: "Node | None", state: int, edits: str, row):
        self.parent, self.state, self.edits, self.row = parent, state, edits, row
        self.refs, self.child = 0, {}
        if parent is not None:
            parent.refs += 1
            parent.child[id(self)] = self


class Repair:
    """The search over one conversation: ``add`` rows in order, then ``end``.
    Both return the edits that are settled: (edit, role, row) each, the role
    as in the repaired conversation (None for a deletion)."""

    def __init__(self):
        self.root = Node(None, EMPTY, "", None)
        self.root.refs = 1
        self.at: dict[int, tuple[int, int, Node]] = {EMPTY: (0, 0, self.root)}

    def add(self, initial: str, fault: str, row) -> list[tuple]:
        kind = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
        best: dict[int, tuple] = {}
        for start, to, edits, extra in _MOVES[kind]:
            if start in self.at:
                cost, rank, node = self.at[start]
                found = (cost + extra, rank, edits, node)
                if to not in best or found[:3] < best[to][:3]:
                    best[to] = found
        for state, other in FOLLOW:
            if state in best and other in best and best[state][0] > best[other][0] + FOLLOW[state, other]:
                del best[state]
        if SYSTEM in best and ASSISTANT in best and best[ASSISTANT][:3] < best[SYSTEM][:3]:
            del best[SYSTEM]  # it may do all that the other may, and no tie falls to it
        order = sorted(best, key=lambda s: best[s][1:3])
        old = self.at
        self.at = {}
        for rank, state in enumerate(order):
            cost, _, edits, node = best[state]
            leaf = Node(node, state, edits, row)
            leaf.refs = 1
            self.at[state] = (cost, rank, leaf)
        for _, _, node in old.values():
            self._release(node)
        return self._settled()

    def end(self) -> list[tuple]:
        cost, rank, state = min((c + _LAST[s][1], r, s) for s, (c, r, _) in self.at.items())
        chosen, last = self.at[state][2], _LAST[state][0]
        chain = []
        while chosen is not self.root:
            chain.append(chosen)
            chosen = chosen.parent
        out = [e for n in reversed(chain) for e in _edits(n.parent.state, n.edits, n.row)]
        return out + _edits(state, last, None)

    def held(self) -> int:
        """Nodes below the root."""
        count, open_ = 0, [self.root]
        while open_:
            node = open_.pop()
            count += len(node.child)
            open_ += node.child.values()
        return count

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            parent = node.parent
            del parent.child[id(node)]
            parent.refs -= 1
            node = parent

    def _settled(self) -> list[tuple]:
        out = []
        while self.root.refs == 1 and len(self.root.child) == 1:
            (child,) = self.root.child.values()
            out += _edits(self.root.state, child.edits, child.row)
            child.parent, child.row = None, None
            self.root = child
        return out


def _edits(state: int, edits: str, row) -> list[tuple]:
    out = []
    for e in edits:
        if e == "D":
            out.append((e, None, row))
        elif e == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[row[1][:1]]
            out.append((e, row[1], row))
        else:
            state = NEXT[state]
            out.append((e, NAMES[state], row if e == "R" else None))
    return out


EDITS = "conv_id bigint, edit string, role string, text string, fault string, turn bigint, old_role string"


def _fault(earlier: bool, text: str) -> str:
    stripped = text.rstrip(BLANKS)
    if not stripped:
        return "blank"
    if earlier:
        return "duplicate"
    return "" if stripped[-1] in SENTENCE_ENDS else "truncated"


#: Edits, and characters of text, that are handed over at once.
ROWS, CHARS = 1 << 14, 8 << 20


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, present, turn, role, text, earlier), a conversation's together and in order, to edits."""
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.string()) for c in ("edit", "role", "text", "fault")), ("turn", pa.int64()), ("old_role", pa.string())])
    out: list[list] = [[] for _ in schema]
    size, search, conv, before, begun = 0, None, None, None, False

    def put(edits: list[tuple]) -> None:
        nonlocal size
        for edit, role, row in edits:
            turn, old, text, fault = row if row is not None else (None, None, None, None)
            kept = text if edit in "KR" else "" if edit == "I" else None
            size += len(kept or "")
            for c, v in zip(out, (conv, edit, role, kept, fault, turn, old), strict=True):
                c.append(v)

    def flush() -> pa.RecordBatch:
        nonlocal size
        b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
        for c in out:
            c.clear()
        size = 0
        return b

    def finish() -> None:
        if search is not None:
            put(search.end())
        else:
            for c, v in zip(out, (conv, "", None, None, None, None, None), strict=True):
                c.append(v)

    for b in batches:
        for conv_id, present, turn, role, text, earlier in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if not begun or conv_id != conv:
                if begun:
                    finish()
                conv, search, before, begun = conv_id, None, None, True
            if present:
                if search is None:
                    search = Repair()
                same = (turn, role, text)
                fault = _fault(earlier or same == before, text)
                before = same
                put(search.add(role[:1], fault, (turn, role, text, fault)))
            if len(out[0]) >= ROWS or size >= CHARS:
                yield flush()
    if begun:
        finish()
    if out[0]:
        yield flush()


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    r"""The cheapest edits of every conversation of ``rows`` (``conv_id``,
    ``turn``, ``role``, ``text``): one row per edit with ``edit`` (Keep,
    Rerole, Delete, Insert by initial), the repaired ``role`` and ``text``
    (null for D), and of the row it stands for ``fault``, ``turn`` and
    ``old_role``. Conversations of ``conversations`` (``conv_id``) without
    rows have one row with an empty ``edit``. A conversation's edits lie in
    one partition, together and in order.

    A row's fault is blank (no ``[^\x20\x09-\x0D]``), duplicate (role and
    text as in an earlier row) or truncated (last such character not
    ``[.!?]``), the first that holds. Blank and duplicate rows must go.

    Defined cases: a null role or text is one space; rows are in the order of
    turn (null first), role and text; equal rows are duplicates of the first;
    a null conv_id is a conversation; an empty table gives no rows; other
    columns are ignored. Roles are told by their first character.

    Duplicates are found by hash (MD5 of role and text): only rows of a
    conversation that share one over several turns are joined back to the
    earliest turn. The search streams; what it holds is what its survivors
    differ in, in the worst case a run of rows of one role."""
    d = pick(rows, conv_id="conv_id:bigint", turn="turn:bigint", role="role:string", text="text:string")
    space = F.lit(" ")
    d = d.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    # an order that holds null turns, as the smallest
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    keyed = d.withColumn("key", F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.unhex(key)))
    shared = write_table(
        keyed.where("key is not null").select("conv_id", "key", place.alias("place"))
        .groupBy("conv_id", "key").agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
        .where("earliest < latest").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "earliest"),
        "repeated-turns",
    )
    marked = keyed.join(shared.hint("merge"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    marked = marked.select(
        "conv_id", F.lit(True).alias("present"), "turn", "role", "text", F.coalesce(F.col("earliest") < place, F.lit(False)).alias("earlier")
    )
    if conversations is not None:
        none = F.lit(None)
        ids = pick(conversations, conv_id="conv_id:bigint").distinct()
        marked = marked.union(ids.select("conv_id", F.lit(False), none.cast("bigint"), none.cast("string"), none.cast("string"), F.lit(False)))
    together = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return together.mapInArrow(_repair, EDITS)


SUMMARY = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
LEGAL = {"su", "ua", "au"}


class _Summary:
    """Figures of one conversation, edit by edit."""

    def __init__(self, conv_id):
        self.conv_id, self.faults, self.illegal, self.cost = conv_id, dict.fromkeys(FAULTS, 0), 0, 0
        self.low = self.high = self.last_turn = self.last_role = None
        self.turns, self.audit, self.sha, self.lines = 0, [], hashlib.sha256(), 0

    def add(self, edit, role, text, fault, turn, old_role) -> None:
        if not edit:
            return
        self.audit.append(edit)
        if edit != "I":
            self.faults[fault] += 1
            if self.last_role is not None and self.last_role[:1] + old_role[:1] not in LEGAL:
                self.illegal += 1
            self.last_role = old_role
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.high = turn
                self.turns += turn != self.last_turn
                self.last_turn = turn
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if edit != "D":
            self.sha.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *(self.faults[f] for f in FAULTS[1:]), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    now, done = None, []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    for b in batches:
        for conv_id, *edit in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Summary(conv_id)
            now.add(*edit)
        if len(done) >= ROWS:
            yield batch()
            done = []
    if now is not None:
        done.append(now.row())
    if done:
        yield batch()


def summarise_repairs(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_conversations``' result, read as
    it comes: ``gaps`` in the turns, rows by fault, ``illegal`` neighbours
    before repair, ``cost``, ``audit`` (the edits) and the SHA-256 of the
    repaired ``role:text`` lines."""
    return edits.mapInArrow(_summarise, SUMMARY)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults put in by the remainder of
    crc32(``conv_id:turn``) by 20: 0 drops the row, 1 empties the text, 2
    takes its ``[.!?]`` out, 3 repeats it, 4 makes its role user. Nulls count
    as one space."""
    c = pick(conversations, conv_id="conv_id:bigint", turn="turn:bigint", role="role:string", text="text:string")
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    r = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return c.withColumn("r", r).where("r <> 0").select(
        "conv_id", "turn",
        F.when(F.col("r") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("r") == 1, "").when(F.col("r") == 2, F.translate(text, SENTENCE_ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("r") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
