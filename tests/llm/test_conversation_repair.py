"""Conversation repair: the search against all scripts, whole against cut conversations, odd rows."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lendwise.llm import conversation_repair as cr

LONG = cr.RepairParams(whole_turns=2, segment_turns=3)


def _all_scripts(marks):
    """The least (cost, audit) by trying every script that costs no more than
    deleting all turns."""
    best = (3 * len(marks), "D" * len(marks))

    def go(at, roles, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        body = roles[1:] if roles[:1] == "s" else roles
        if len(roles) > 0 and "s" in body or any(r != "ua"[i % 2] for i, r in enumerate(body)):
            return
        if at == len(marks) and (not roles or (body and len(body) % 2 == 0)):
            best = min(best, (cost, audit))
        if at < len(marks):
            mark = marks[at]
            go(at + 1, roles, cost + 3, audit + "D")
            if mark != "x":
                cut = mark.isupper() or mark == "_"
                if mark.lower() in "sua":
                    go(at + 1, roles + mark.lower(), cost + cut, audit + "K")
                for r in "ua":
                    go(at + 1, roles + r, cost + 2 + cut, audit + "R")
        for r in "ua":
            go(at, roles + r, cost + 2, audit + "I")

    go(0, "", 0, "")
    return best


def test_search_equals_all_scripts():
    for n in range(4):
        for marks in itertools.product("xsua-SUA_", repeat=n):
            assert cr.shortest("".join(marks)) == _all_scripts("".join(marks)), marks
    rng = random.Random(5)
    for _ in range(60):
        marks = "".join(rng.choice("xssuuaa-SUA_") for _ in range(rng.randrange(4, 7)))
        assert cr.shortest(marks) == _all_scripts(marks), marks


def test_routes_put_together_equal_the_whole():
    rng = random.Random(6)
    for _ in range(40):
        marks = "".join(rng.choice("xssuuaa-SUA_") for _ in range(rng.randrange(2, 14)))
        cut = rng.randrange(1, len(marks))
        ways = [(a[0] + b[0], a[1] + b[1]) for q in range(4) for e in cr.ACCEPT
                if (a := cr.shortest(marks[:cut], cr.START, (q,))) and (b := cr.shortest(marks[cut:], q, (e,)))]
        assert min(ways) == cr.shortest(marks)


def test_script_gives_a_wellformed_conversation():
    rng = random.Random(7)
    for _ in range(200):
        marks = "".join(rng.choice("xssuuaa-SUA_") for _ in range(rng.randrange(0, 12)))
        words, after, state = cr.script(marks, cr.shortest(marks)[1])
        assert state in cr.ACCEPT and len(words) == len(marks)
        roles = "".join(m.lower() if c == "K" else c.lower() for m, w in zip([*marks, ""], [*words, after]) for c in w if c != "D")
        body = roles[1:] if roles[:1] == "s" else roles
        assert body == "ua" * (len(body) // 2) and (not roles or body)


def _digest(messages):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()


def _results(spark, rows, params):
    found = cr.repair(rows, params)
    out = {}
    digests = {}
    if found.long_messages is not None:
        digests = {r.name: r.sha256 for r in cr.long_digests(found.long_messages).collect()}
    for r in found.conversations.collect():
        own = digests.get(r.conv, _digest([])) if r.messages is None else _digest([(m.role, m.text) for m in r.messages])
        out[r.conv] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, own)
    return out


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(8)
    rows = []
    for conv in [*range(30), None]:
        for _ in range(rng.randrange(1, 14)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 4, 7, 9]), rng.choice(["system", "user", "assistant", "tool", "", None, "user"]),
                         rng.choice(["Yes.", "no", "Why? ", "", None, " \t", "ends here!\n", "é 日本", "x" * 5000 + "."])))
    rows += [(99, 1, "user", "same.")] * 9 + [(98, 1, "user", "")] * 5 + [(97, None, None, None)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, conv string, at string")


def test_cut_conversations_equal_whole_ones(spark, odd):
    whole = _results(spark, odd, cr.RepairParams())
    assert _results(spark, odd, LONG) == whole
    assert _results(spark, odd, cr.RepairParams(whole_bytes=100, segment_turns=1)) == whole


def test_odd_rows(spark, odd):
    got = _results(spark, odd, cr.RepairParams())
    assert len(got) == 34
    assert got[99] == (0, 0, 8, 0, 8, 3 * 8 + 2, "KDDDDDDDDI", _digest([("user", "same."), ("assistant", "")]))
    assert got[98] == (0, 5, 0, 0, 4, 15, "DDDDD", _digest([]))
    assert got[97] == (0, 1, 0, 0, 0, 3, "D", _digest([]))
    assert cr.repair(odd.limit(0)).conversations.count() == 0


def test_hot_conversation_is_cut(spark):
    turns = spark.range(4000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.concat(F.lit("turn "), F.col("id").cast("string"), F.lit(".")).alias("text"))
    found = cr.repair(turns.where("turn != 2001"))
    row = found.conversations.collect()
    assert [(r.gaps, r.illegal, r.cost) for r in row] == [(1, 1, 2)]
    assert row[0].audit.count("I") == 1 and len(row[0].audit) == 4000 and found.long_messages.count() == 4000
