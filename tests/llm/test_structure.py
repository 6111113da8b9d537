"""Conversation repair against brute force, whole conversations in blocks, odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from conftest import SMALL
from oracle_compare import assert_same, connect

import __spark_entry__ as entry_module
from tempolake.llm import structure

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def ordered(rows):
    """Rows (turn, role, text) in their order, nulls as spaces."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(
        filled,
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()),
    )


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        cut = text.rstrip(" \t\n\x0b\x0c\r")
        if not cut:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if cut[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def brute(rows):
    """(cost, audit, repaired): every sequence of edits with two insertions in a row at most."""
    found = faults(rows)
    best = None

    def go(i, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows):
            if LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in out)):
                best = min(filter(None, (best, (cost, audit, out))), key=lambda b: b[:2])
        if not audit.endswith("III") and len(out) < 2 * len(rows) + 4:
            for role in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*out, (role, "")])
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, cost + 3, audit + "D", out)
        if found[i] in ("blank", "duplicate"):
            return
        extra = int(found[i] == "truncated")
        go(i + 1, cost + extra, audit + "K", [*out, (role, text)])
        for other in ("user", "assistant"):
            go(i + 1, cost + 2 + extra, audit + "R", [*out, (other, text)])

    go(0, 0, "", [])
    return best


def quick(rows):
    """The same by a program over (place, last role) that holds whole edit strings."""
    found = faults(rows)
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    after = {"": (0, "", ()), "a": (0, "", ()), "u": (2, "I", (("assistant", ""),))}
    after["s"] = (4, "II", (("user", ""), ("assistant", "")))
    for i in reversed(range(len(rows))):
        _, role, text = rows[i]
        now = {}
        for state in follow:
            cost, audit, out = after[state]
            options = [(cost + 3, "D" + audit, out)]
            if found[i] not in ("blank", "duplicate"):
                extra = int(found[i] == "truncated")
                initial = role[:1]
                if initial == follow[state] or (initial == "s" and state == ""):
                    c, a, o = after[initial]
                    options.append((c + extra, "K" + a, ((role, text), *o)))
                c, a, o = after[follow[state]]
                options.append((c + 2 + extra, "R" + a, ((names[follow[state]], text), *o)))
            now[state] = min(options, key=lambda b: b[:2])
        for _ in range(3):
            for state, to in follow.items():
                c, a, o = now[to]
                now[state] = min(
                    now[state], (c + 2, "I" + a, ((names[to], ""), *o)), key=lambda b: b[:2]
                )
        after = now
    return after[""]


def report(rows, solve=quick):
    rows = ordered(rows)
    cost, audit, out = solve(rows) if rows else (0, "", ())
    found = faults(rows)
    initials = [r[1][:1] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    text = "\n".join(f"{r}:{x}" for r, x in out)
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def reports(spark, conversations, **options):
    rows = [(c, *row) for c, own in conversations.items() for row in own]
    random.Random(len(rows)).shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = structure.reports(frame, **options).collect()
    assert len(found) == len(conversations)
    return {r[0]: tuple(r)[1:] for r in found}


ROLES = ["system", "user", "assistant", "tool", "User", "", None, "u", "assist"]
TEXTS = ["Hi.", "no end", "Well?", "", " \n", None, "Yes! \t", "ünd.", "Hi."]


def conversation(seed, size, roles=ROLES):
    draw = random.Random(seed)
    return [
        (draw.choice([None, *range(size)]), draw.choice(roles), draw.choice(TEXTS) or None)
        for _ in range(size)
    ]


def test_both_brute_forces_agree():
    for seed in range(150):
        rows = ordered(conversation(seed, seed % 4))
        one, other = brute(rows), quick(rows)
        assert one[:2] == other[:2] and list(one[2]) == list(other[2])


def test_reports_equal_brute_force(spark):
    conversations = {i: conversation(i, 1 + i % 9) for i in range(300)}
    got = reports(spark, conversations)
    assert got == {i: report(rows) for i, rows in conversations.items()}


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_change_nothing(spark, block):
    conversations = {i: conversation(i, 1 + 7 * (i % 6), ROLES[:4]) for i in range(40)}
    conversations[99] = conversation(99, 120, ROLES[1:3])
    got = reports(spark, conversations, block=block)
    assert got == {i: report(rows) for i, rows in conversations.items()}


def test_one_conversation_holds_most_rows(spark):
    conversations = {i: conversation(i, 3) for i in range(20)}
    conversations[7] = [(i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(9000)]
    conversations[8] = [(1, "user", "Same.")] * 3000
    got = reports(spark, conversations)
    assert got[7][5:7] == (0, "K" * 9000)
    assert got[8] == (0, 0, 2999, 0, 2999, 8999, "K" + "D" * 2999 + "I", got[8][-1])
    assert got == {i: report(rows) for i, rows in conversations.items()}


def test_ranks_order_paths_by_their_edits():
    draw = np.random.default_rng(5)
    codes = draw.integers(0, 16, 60).astype(np.uint8)
    codes[codes % 4 == 3] = 1
    offsets = np.array([0, 7, 7 + 21, 60])
    final = np.array([True, True, True])
    found = structure.costs(codes, offsets, np.tile(structure._END, (3, 1)))
    arcs = structure.optimal_arcs(codes, offsets, found, final)
    paths = structure.rank_paths(*arcs, found.size)

    def all_paths(node):
        own = np.flatnonzero(arcs[0] == node)
        return [
            structure._EDITS[arcs[1][e]] + rest for e in own for rest in all_paths(arcs[2][e])
        ] or [""]

    nodes = np.array([0, 1, 2, 3, 4 * 9, 4 * 9 + 2, 4 * 50 + 1])
    read, counts = paths.read(nodes)
    at = np.concatenate([[0], np.cumsum(counts)])
    for i, node in enumerate(nodes):
        own = "".join(structure._EDITS[e] for e in arcs[1][read[at[i] : at[i + 1]]])
        assert own == min(all_paths(node))


def test_odd_rows(spark):
    conversations = {
        None: [(0, "user", "Hi."), (1, "assistant", "Yes.")],
        1: [(None, None, None)],
        2: [(None, "user", "Hi."), (None, "assistant", "Yes.")],
        3: [(-5, "user", "Hi."), (7, "assistant", "Yes."), (7, "assistant", "Yes.")],
        4: [(0, "user", "word " * 400_000 + "."), (1, "assistant", "Yes.")],
        5: [(0, "user", "a \u0085"), (1, "assistant", "😀!\x0b")],
    }
    assert reports(spark, conversations) == {i: report(r) for i, r in conversations.items()}


def test_conversations_without_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA)
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: r for r in structure.reports(rows, ids).collect()}
    assert set(got) == {1, 2, None}
    assert tuple(got[2]) == (2, 0, 0, 0, 0, 0, 0, "", empty) and tuple(got[None])[1:] == tuple(got[2])[1:]
    assert got[1].audit == "KI"
    assert structure.reports(rows.limit(0), ids.limit(0)).collect() == []
    assert structure.repaired(rows.limit(0)).collect() == []


def test_other_columns_are_ignored(spark):
    rows = [(1, *r) for r in conversation(3, 8)]
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = frame.selectExpr("*", "1 AS key", "2 AS at", "'x' AS audit", "3 AS kind", "4 AS `a b`")
    assert structure.reports(extra).collect() == structure.reports(frame).collect()


def test_repaired_rows(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "cut off"),
        (2, 0, "user", ""),
    ]
    got = structure.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [
        (1, 0, "system", "Be kind."), (1, 1, "user", ""), (1, 2, "assistant", "Hi."),
    ]
    assert report([r[1:] for r in rows[:3]])[5:7] == (5, "KIKD")


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(5)]
    rows += [(None, None, None, None), (None, 3, "user", None)]
    expected = []
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        expected += [(c, t, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = structure.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_query_matches_its_sql(spark):
    name = "op12_conversation_repair"
    query, sql = entry_module.queries()[name], entry_module.oracle_sql()[name]
    assert assert_same(query(spark, SMALL), connect(SMALL), sql) > 0
