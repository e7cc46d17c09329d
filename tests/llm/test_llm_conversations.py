"""Conversation repair against plain versions: all repairs of short conversations, a table of prefixes for long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from jobtide.llm import conversation_repair as cr
from jobtide.llm.queries import QUERIES

GRAMMAR = re.compile("(s?(ua)+)?")
DDL = "conv_id long, turn long, role string, text string, kind string, gone string, digest string"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv_id, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    """``rows``: (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def by_table(rows, found):
    """Cheapest (cost, audit, repaired) by a table over (rows read, part of the pattern matched)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for symbol, role in (("u", "user"), ("a", "assistant")):
                    if after := step.get((state, symbol)):
                        new = (cost + 3, audit + "I", [*lines, f"{role}:"])
                        table[after] = min(table.get(after, new), new)
        return table

    table = inserted({"": (0, "", [])})
    for (role, text), fault in zip(rows, found, strict=True):
        new: dict = {}
        extra = 3 * (fault == "truncated")
        for state, (cost, audit, lines) in table.items():
            ways = [(state, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                for edit, symbol, name, price in (
                    ("K", role[:1], role, 0),
                    ("R", "u", "user", 3),
                    ("R", "a", "assistant", 3),
                ):
                    if after := step.get((state, symbol)):
                        ways.append((after, (cost + price + extra, audit + edit, [*lines, f"{name}:{text}"])))
            for after, value in ways:
                new[after] = min(new.get(after, value), value)
        table = inserted(new)
    return min(table[s] for s in ("", "a") if s in table)


def by_trying(rows, found):
    """The same over all sequences of edits, with up to two turns inserted at each place."""
    best = None
    places = list(itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1))
    edits = list(itertools.product("DKua", repeat=len(rows)))
    names = {"u": "user", "a": "assistant"}
    for chosen in edits:
        if any(f in ("blank", "duplicate") and e != "D" for e, f in zip(chosen, found)):
            continue
        for added in places:
            cost, audit, initials, lines = 0, "", "", []
            for i in range(len(rows) + 1):
                cost += 3 * len(added[i])
                audit += "I" * len(added[i])
                initials += added[i]
                lines += [f"{names[x]}:" for x in added[i]]
                if i < len(rows):
                    (role, text), edit = rows[i], chosen[i]
                    if edit == "D":
                        cost, audit = cost + 4, audit + "D"
                    else:
                        name = role if edit == "K" else names[edit]
                        cost += 3 * (edit != "K") + 3 * (found[i] == "truncated")
                        audit += "K" if edit == "K" else "R"
                        initials += name[:1] or "?"
                        lines.append(f"{name}:{text}")
            if GRAMMAR.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected(rows):
    out = {}
    for conv_id in dict.fromkeys(r[0] for r in rows):
        own = damage([r for r in rows if r[0] == conv_id])
        digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
        talk = [(r[2], r[3]) for r in own]
        found = faults(talk)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = zip(talk, talk[1:])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, lines = by_table(talk, found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def as_dict(frame):
    rows = frame.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def test_the_whole_table_against_a_table_of_prefixes(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert as_dict(QUERIES["op11_conversation_repair"](spark, sf_dir)) == expected([r[:4] for r in rows])


def talk(rng, n):
    roles = ["user", "assistant", "system", "", "tool"]
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?\n", "a:b."]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def read(rows, found):
    reading = cr.Reading(cr.Tables(cr.ROLE_GRAMMAR))
    for (role, text), fault in zip(rows, found, strict=True):
        reading.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
    return reading.best()


def test_short_conversations_against_all_repairs():
    rng = random.Random(3)
    for n in (0, 1, 2, 3):
        for _ in range(12 if n == 3 else 40):
            rows = talk(rng, n)
            found = faults(rows)
            cost, audit, lines = by_trying(rows, found)
            assert read(rows, found) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), rows
            assert by_table(rows, found)[:2] == (cost, audit)


def test_long_conversations_against_the_table():
    rng = random.Random(4)
    for n in (10, 60, 400):
        rows = talk(rng, n)
        found = faults(rows)
        cost, audit, lines = by_table(rows, found)
        assert read(rows, found) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_a_grammar_with_two_readings_follows_both():
    # x+ read as a list from the left or the right: every reduction is followed.
    tables = cr.Tables((("S", ("L",)), ("L", ("L", "L")), ("L", ("x",))))
    tops = [tables.root]
    for n in range(1, 6):
        tops = list({id(t): t for top in tops for t in tables.moves(top, "x")}.values())
        assert any(tables.moves(t, cr.END) for t in tops), n
    assert not tables.moves(tables.root, cr.END)


@pytest.fixture(scope="module")
def odd(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "k", "g", "d") for r in rows], DDL).repartition(4)

    return make


def test_odd_rows(odd):
    rng = random.Random(5)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(12)]
    rows += [(None, None, None, None), (None, 3, "user", "a."), (2, None, "user", None), (2, None, None, "x."), (3, 1, "", "")]
    rows += [(4, t, "user", "same.") for t in range(9)] + [(5, 7, "user", "tie."), (5, 7, "assistant", "tie."), (5, 7, "user", "tie.")]
    rows += [(6, 1, "user", "x" * 50_000 + "."), (6, 2, "assistant", "é\n\x00:" * 1000)]
    rows += [(100 + i, t, *rng.choice([("user", "Hm."), ("assistant", "So?"), ("system", "cut")])) for i in range(60) for t in range(4)]
    rows += [(7, t, r, x) for t, (r, x) in enumerate(talk(rng, 500))]
    assert as_dict(cr.repair(cr.damaged(odd(rows)))) == expected(rows)


def test_a_conversation_of_dropped_rows_and_an_empty_table(odd):
    dropped = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    got = as_dict(cr.repair(cr.damaged(odd([(c, 0, "user", "x.") for c in dropped]))))
    assert got == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in dropped}
    assert cr.repair(cr.damaged(odd([]))).collect() == []
