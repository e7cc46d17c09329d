"""Conversations brought into the order of roles by a generalised LR repair.

The grammar of roles is turned into SLR tables.  Rows of a conversation are read in
the order of their turns; every row may be kept, reroled or deleted, and turns may be
inserted anywhere, each at its price.  All readings that are still open share one
graph of stacks: a stack is a node (LR state, node beneath), every node exists once,
and readings that meet on an equal node keep the minimum of (cost, audit).  A node's
value carries the running hash of the repaired conversation, so no text is held back.

Spark sorts: the rows of a conversation reach one task in order and stream through it,
as its hash is one over all its rows.  A task holds, per open reading, one link per
edit; the reading costs the same per row for a conversation of any length.  Rows seen
earlier are found by a shuffle of digests apart, by conversation and digest, so no set
of seen rows is held either.

Defined cases: a null ``conv_id`` is a conversation of its own; a null turn comes
first; null roles, texts, ids and turns count as one space where their text is asked
for.  Rows of one turn are taken by role and digest, so equal rows are adjacent, and
all but the first are duplicates.  A role is known by its first character, an empty
one by none.  A conversation whose rows are all dropped has zeros, no audit and the
hash of nothing.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import record_batch

END = "$"
#: system? (user assistant)+, or nothing.
ROLE_GRAMMAR = (("C", ()), ("C", ("s", "P")), ("C", ("P",)), ("P", ("Q",)), ("P", ("P", "Q")), ("Q", ("u", "a")))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DAMAGE_KINDS = 20
LEGAL_PAIRS = ("su", "ua", "au")


@dataclass(frozen=True)
class Node:
    """A stack: the LR state on top and the stack beneath.  ``Tables`` makes each of them once."""

    state: int
    beneath: Node | None = field(repr=False)


class Tables:
    """SLR tables of a grammar of ``(head, body)`` rules, the first head being the start.

    A state may have several actions for a symbol: all of them are followed.
    """

    def __init__(self, rules: Sequence[tuple[str, tuple[str, ...]]]) -> None:
        self.rules = [("^", (rules[0][0],)), *rules]
        self.heads = {h for h, _ in self.rules}
        follow = self._follow()
        start = self._closure({(0, 0)})
        numbers, todo = {start: 0}, deque([start])
        self.go: dict[tuple[int, str], int] = {}
        self.reduces: dict[tuple[int, str], list[int]] = {}
        self.accepting: set[int] = set()
        while todo:
            items = todo.popleft()
            here = numbers[items]
            ahead: dict[str, set[tuple[int, int]]] = {}
            for rule, dot in items:
                head, body = self.rules[rule]
                if dot < len(body):
                    ahead.setdefault(body[dot], set()).add((rule, dot + 1))
                elif rule == 0:
                    self.accepting.add(here)
                else:
                    for symbol in follow[head]:
                        self.reduces.setdefault((here, symbol), []).append(rule)
            for symbol, kernel in sorted(ahead.items()):
                found = self._closure(kernel)
                if found not in numbers:
                    numbers[found] = len(numbers)
                    todo.append(found)
                self.go[here, symbol] = numbers[found]
        self._nodes: dict[tuple[int, int], Node] = {}
        self._moves: dict[tuple[int, str], list[Node]] = {}
        self.root = self._node(0, None)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        out, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body) and body[dot] in self.heads:
                new = {(k, 0) for k, (head, _) in enumerate(self.rules) if head == body[dot]} - out
                out |= new
                todo += new
        return frozenset(out)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {h: set() for h in self.heads}
        follow: dict[str, set[str]] = {h: set() for h in self.heads}
        follow["^"].add(END)
        before = -1
        while (now := len(empty) + sum(map(len, (*first.values(), *follow.values())))) != before:
            before = now
            for head, body in self.rules:
                if all(x in empty for x in body):
                    empty.add(head)
                for x in body:
                    first[head] |= first.get(x, {x})
                    if x not in empty:
                        break
                after = follow[head]
                for x in reversed(body):
                    if x in self.heads:
                        follow[x] |= after
                        after = first[x] | (after if x in empty else set())
                    else:
                        after = {x}
        return follow

    def _node(self, state: int, beneath: Node | None) -> Node:
        return self._nodes.setdefault((state, id(beneath)), Node(state, beneath))

    def moves(self, top: Node, symbol: str) -> list[Node]:
        """The stacks after ``symbol`` was read on ``top``; for END, the accepting ones."""
        found = self._moves.get((id(top), symbol))
        if found is None:
            found = self._moves[id(top), symbol] = self._read(top, symbol)
        return found

    def _read(self, top: Node, symbol: str) -> list[Node]:
        open_, seen, out = [top], {id(top)}, []
        while open_:
            node = open_.pop()
            if symbol == END:
                if node.state in self.accepting:
                    out.append(node)
            elif (state := self.go.get((node.state, symbol))) is not None:
                out.append(self._node(state, node))
            for rule in self.reduces.get((node.state, symbol), ()):
                head, body = self.rules[rule]
                base = node
                for _ in body:
                    base = base.beneath
                reduced = self._node(self.go[base.state, head], base)
                if id(reduced) not in seen:
                    seen.add(id(reduced))
                    open_.append(reduced)
        return out


class Audit:
    """A sequence of edits as a chain from its last one, so that readings share what they have in common."""

    __slots__ = ("before", "edit", "length")

    def __init__(self, before: Audit | None, edit: str) -> None:
        self.before, self.edit = before, edit
        self.length = before.length + 1 if before else 1


def _less(a: Audit | None, b: Audit | None) -> bool:
    """``a`` before ``b`` in ASCII order; walks back only as far as the two differ."""
    short = a.length < b.length if a and b else b is not None
    while a and a.length > (b.length if b else 0):
        a = a.before
    while b and b.length > (a.length if a else 0):
        b = b.before
    while a is not b:
        if a.edit != b.edit:
            short = a.edit < b.edit
        a, b = a.before, b.before
    return short


def spelled(audit: Audit | None) -> str:
    out = []
    while audit:
        out.append(audit.edit)
        audit = audit.before
    return "".join(reversed(out))


class Reading:
    """All open readings of one conversation: ``stack -> (cost, audit, hash)``."""

    def __init__(self, tables: Tables) -> None:
        self.tables = tables
        self.tops: dict[int, tuple[Node, int, Audit | None, object]] = {}
        self._offer(self.tops, tables.root, 0, None, None)
        self._insert()

    @staticmethod
    def _offer(tops: dict, node: Node, cost: int, audit: Audit | None, digest: object) -> bool:
        """Equal stacks are merged by the minimum of (cost, audit)."""
        had = tops.get(id(node))
        if had and (had[1] < cost or (had[1] == cost and not _less(audit, had[2]))):
            return False
        tops[id(node)] = (node, cost, audit, digest)
        return True

    @staticmethod
    def _spoken(digest: object, line: bytes) -> object:
        if digest is None:
            return hashlib.sha256(line)
        digest = digest.copy()
        digest.update(b"\n" + line)
        return digest

    def _insert(self) -> None:
        """Turns without text, wherever one makes a stack cheaper."""
        todo = deque(self.tops.values())
        while todo:
            node, cost, audit, digest = top = todo.popleft()
            if self.tops[id(node)] is not top:
                continue
            for symbol, role in ROLES.items():
                for after in self.tables.moves(node, symbol):
                    had = self.tops.get(id(after))
                    if had and had[1] < cost + INSERT:
                        continue
                    longer = Audit(audit, "I")
                    if had and had[1] == cost + INSERT and not _less(longer, had[2]):
                        continue
                    self._offer(self.tops, after, cost + INSERT, longer, self._spoken(digest, f"{role}:".encode()))
                    todo.append(self.tops[id(after)])

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        after: dict = {}
        extra = TRUNCATED if truncated else 0
        edits = [("K", role[:1], role, KEEP + extra)] if role else []
        edits += [("R", symbol, new, REROLE + extra) for symbol, new in ROLES.items()]
        for node, cost, audit, digest in self.tops.values():
            self._offer(after, node, cost + DELETE, Audit(audit, "D"), digest)
            if must_go:
                continue
            for edit, symbol, new, price in edits:
                for top in self.tables.moves(node, symbol):
                    had = after.get(id(top))
                    if had is None or had[1] >= cost + price:
                        # The hash is brought up to date once, when all readings have been merged.
                        self._offer(after, top, cost + price, Audit(audit, edit), (digest, new))
        for key, (node, cost, audit, digest) in after.items():
            if isinstance(digest, tuple):
                after[key] = (node, cost, audit, self._spoken(digest[0], f"{digest[1]}:{text}".encode()))
        self.tops = after
        self._insert()

    def best(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the cheapest reading that the grammar accepts."""
        best = None
        for node, *value in self.tops.values():
            if self.tables.moves(node, END):
                cost, audit, _ = value
                if best is None or cost < best[0] or (cost == best[0] and _less(audit, best[1])):
                    best = value
        cost, audit, digest = best
        return cost, spelled(audit), (digest or hashlib.sha256()).hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows after damage; a dropped row stays as one without text.

    ``crc32("conv_id:turn") % 20`` decides: 0 drops, 1 empties, 2 removes sentence ends,
    3 repeats, 4 gives the row to the user.
    """
    conv_id, turn = (F.col(c).cast("bigint") for c in ("conv_id", "turn"))
    key = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)))
    kind = F.crc32(key.cast("binary")) % DAMAGE_KINDS
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(conv_id.alias("conv_id"), turn.alias("turn"), kind.alias("kind"), role.alias("r"), text.alias("t"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.withColumn("copy", copies)
    gone = F.col("kind") == 0
    role = F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("r"))
    text = F.when(gone | (F.col("kind") == 1), "").when(F.col("kind") == 2, F.translate("t", ".!?", "")).otherwise(F.col("t"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), gone.alias("gone"))


DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
SCHEMA = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in DDL.split(", "))])


class Repair:
    """One conversation, row by row in order."""

    def __init__(self, tables: Tables, conv_id: int | None) -> None:
        self.conv_id, self.reading = conv_id, Reading(tables)
        self.low = self.high = self.last_turn = self.last = self.marked = None
        self.initial: str | None = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, digest: str, role: str | None, text: str | None) -> None:
        if role is None:  # a mark ahead of its rows: these were seen in an earlier turn
            self.marked = (turn, digest)
            return
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.turns += 1
        seen = (turn, digest) in (self.last, self.marked)
        self.last = (turn, digest)
        if self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = role[:1]
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        blank = not shown
        cut = not blank and not seen and shown[-1] not in ".!?"
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut
        self.reading.row(role, text, blank or seen, cut)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.reading.best())


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables, now, done = Tables(ROLE_GRAMMAR), None, []
    for batch in batches:
        for conv_id, turn, digest, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = Repair(tables, conv_id)
            if not gone:
                now.add(turn, digest, role, text)
        if done:
            yield record_batch(list(zip(*done, strict=True)), SCHEMA)
            done = []
    if now is not None:
        yield record_batch(list(zip(now.result(), strict=True)), SCHEMA)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damaged``: its faults, the cheapest repair and the repaired text's hash."""
    # Of fixed length for any row, and different for different pairs of role and text.
    digest = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    rows = rows.withColumn("digest", digest).select("conv_id", "turn", "digest", "role", "text", "gone")
    earliest = Window.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn"))
    told = rows.filter("NOT gone").select("conv_id", "turn", "digest").withColumn("first", F.first("turn").over(earliest))
    nothing = F.lit(None).cast("string")
    marks = told.filter(~F.col("turn").eqNullSafe(F.col("first"))).select(
        "conv_id", "turn", "digest", nothing.alias("role"), nothing.alias("text"), F.lit(False).alias("gone")
    )
    ordered = (
        rows.unionByName(marks)
        .repartition("conv_id")
        # A mark has no role, and comes before the rows of its turn and digest.
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest", F.asc_nulls_first("role"))
    )
    return ordered.mapInArrow(_repaired, DDL)
