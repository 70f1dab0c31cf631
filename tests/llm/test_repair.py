"""Conversation repair against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from functools import lru_cache
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair as r

TEXTS = ["Yes.", "No!", "Why?  \n", "cut off", "", " \t", "Yes.", "ß…", "more text here.", "1. and"]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", None]


def _key(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, text)


def _search(rows):
    """(cost, audit, repaired) with up to three rows inserted anywhere, from the last row to the first."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\f\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    follows = {"": "us", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, inserts):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            for to in follows[state].replace("s", ""):
                cost, audit, lines = best(i, to, inserts + 1)
                ways.append((cost + 5, "I" + audit, (names[to] + ":",) + lines))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                price = 5 if faults[i] else 0
                if role[:1] and role[:1] in follows[state]:
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    ways.append((cost + price, "K" + audit, (f"{role}:{text}",) + lines))
                for to in follows[state].replace("s", ""):
                    cost, audit, lines = best(i + 1, to, 0)
                    ways.append((cost + price + 1, "R" + audit, (f"{names[to]}:{text}",) + lines))
        return min(ways) if ways else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    return faults, cost, audit, "\n".join(lines)


def _expected(rows):
    """The report of every conversation, rows given as (conv, turn, role, text, copies)."""
    by = defaultdict(list)
    for conv, turn, role, text, copies in rows:
        by[conv] += [(turn, " " if role is None else role, " " if text is None else text)] * copies
    out = {}
    for conv, own in by.items():
        own.sort(key=_key)
        faults, cost, audit, text = _search(tuple(own))
        turns = {t for t, _, _ in own if t is not None}
        initials = [role[:1] for _, role, _ in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256(text.encode()).hexdigest())
    return out


def _random(seed, conversations=60, longest=9):
    rng = random.Random(seed)
    out = []
    for conv in [None, *range(conversations)]:
        turn = rng.randrange(3)
        for _ in range(rng.randrange(longest + 1)):
            turn += rng.choice([0, 1, 1, 1, 3])
            out.append((conv, None if rng.random() < 0.1 else turn, rng.choice(ROLES), rng.choice(TEXTS + [None]),
                        rng.choice([0, 1, 1, 1, 1, 2])))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, copies int"


def _report(spark, rows, **how):
    got = r.report(r.repair(spark.createDataFrame(rows, SCHEMA), copies=F.col("copies"), **how)).collect()
    assert len({g.conv for g in got}) == len(got)
    return {g.conv: tuple(g)[1:] for g in got}


@pytest.mark.parametrize("seed, how", [(1, {}), (2, {"size": 1}), (3, {"size": 3}), (4, {"chars": 1})])
def test_cheapest_and_least_edits(spark, seed, how):
    rows = _random(seed)
    assert _report(spark, rows, **how) == _expected(rows)


def test_long_conversation_in_chunks_over_partitions(spark):
    rng = random.Random(9)
    rows = [(7, i // 2, rng.choice(["user", "assistant", "tool"]), f"{rng.choice('ab')}{rng.randrange(40)}{rng.choice('.,')}", 1)
            for i in range(200)] + [(c, 0, "user", "Hi.", 1) for c in range(20)]
    want = _expected(rows)
    assert _report(spark, rows, size=8) == want
    assert _report(spark, rows) == want


def test_survivors_coalesce():
    rng = random.Random(3)
    tree, deepest, out = r.Survivors(), 0, []
    for i in range(20_000):
        tree.step(r._MOVES[rng.choice("sua"), rng.choice([r.OK, r.OK, r.OK, r.CUT, r.BLANK])])
        out += tree.settled()
        deepest = max(deepest, tree._depth)
    assert deepest < 500 and len(out) > 19_000


def test_references_free_dead_branches():
    tree = r.Survivors()
    for _ in range(50):
        tree.step(r._MOVES["", r.BLANK])
        tree.step(r._MOVES["u", r.OK])
    live, todo = set(), [node for _, node in tree.ends.values()]
    while todo:
        node = todo.pop()
        if node is not None and id(node) not in live:
            live.add(id(node))
            todo.append(node.parent)
    refs = sum(node.refs for _, node in tree.ends.values())
    assert refs == len(tree.ends) and len(live) <= 1 + 100 * len(tree.ends)


def test_equal_costs_take_the_least_audit(spark):
    rows = [(1, 0, "user", "A.", 1), (1, 1, "user", "B.", 1), (1, 2, "assistant", "C.", 1), (2, 0, "system", "S.", 1),
            (3, 0, "assistant", "A.", 1), (3, 1, "user", "B.", 1)]
    got = _report(spark, rows)
    assert got == _expected(rows)
    assert got[1][5:7] == (2, "DKK") and got[2][5:7] == (2, "D") and got[3][5:7] == (2, "RR")


def test_copies_of_a_row_are_deleted_in_one_step(spark):
    got = _report(spark, [(1, 0, "user", "A.", 5_000), (1, 1, "assistant", "B.", 1)])
    assert got[1][:7] == (0, 0, 4_999, 0, 4_999, 9_998, "K" + "D" * 4_999 + "K")


def test_empty_nulls_long_texts_and_other_columns(spark):
    schema = SCHEMA + ", _key string, part int, digest string, salt int, start string, fault int, `first` string, conv string"
    none = spark.createDataFrame([], schema)
    assert r.report(r.repair(none)).count() == 0
    long = "word " * 200_000 + "end."
    rows = [(1, 0, "user", long, 1, "k", 5, "d", 1, "s", 9, "f", "c"), (1, 1, "assistant", "B.", 1, "k", 5, "d", 1, "s", 9, "f", "c"),
            (2, None, None, None, 1, "k", 5, "d", 1, "s", 9, "f", "c"), (None, 3, "user", None, 0, "k", 5, "d", 1, "s", 9, "f", "c")]
    chunks = r.repair(spark.createDataFrame(rows, schema), copies=F.col("copies"))
    got = {g.conv: tuple(g)[1:] for g in r.report(chunks).collect()}
    blank = hashlib.sha256(b"").hexdigest()
    assert got[1] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(f"user:{long}\nassistant:B.".encode()).hexdigest())
    assert got[2] == (0, 1, 0, 0, 0, 2, "D", blank) and got[None] == (0, 0, 0, 0, 0, 0, "", blank)
    assert chunks.filter("conv = 1").first().texts[0] == long


def test_query_against_search(spark, sf):
    rows = []
    for g in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        fault = crc32(f"{g.conv_id}:{g.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", g.text) if fault == 2 else g.text
        rows.append((g.conv_id, g.turn, "user" if fault == 4 else g.role, text, {0: 0, 3: 2}.get(fault, 1)))
    got = {g.conv_id: tuple(g)[1:] for g in r.op12_conversation_repair(spark, sf).collect()}
    assert got == _expected(rows)
