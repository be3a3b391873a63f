"""Conversation repair against a plain dynamic program over strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from alertsieve.llm import conversation_repair as R
from alertsieve.llm import queries as Q
from conftest import SF001

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    """(conv, turn, role, text) rows after the contract's damage, by conversation; none is left out."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        harm = zlib.crc32(name.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        kept += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def fault_names(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best(roles, faults):
    """(cost, audit, end roles) by the contract's words: the least (cost, audit) from every point."""
    after = {"": "s u", "s": "u", "u": "a", "a": "u"}
    n, inf = len(roles), (10**9, "")
    table = [dict.fromkeys(after, inf) for _ in range(n + 1)]
    table[n].update({"": (0, ""), "a": (0, "")})
    for i in range(n, -1, -1):
        for _ in range(4):
            for state in after:
                some = [table[i][state]]
                for new in "ua":
                    if new in after[state]:
                        c, x = table[i][new]
                        some.append((c + 2, "I" + x))
                if i < n:
                    c, x = table[i + 1][state]
                    some.append((c + 3, "D" + x))
                    if faults[i] not in ("blank", "duplicate"):
                        more = faults[i] == "truncated"
                        for new in after[state].split():
                            c, x = table[i + 1][new]
                            if roles[i] == new:
                                some.append((c + more, "K" + x))
                            if new in "ua":
                                some.append((c + 2 + more, "R" + x))
                table[i][state] = min(some)
    return table[0][""]


def repaired(rows, audit):
    out, at, names = [], 0, {"u": "user", "a": "assistant"}
    for e in audit:
        wanted = "a" if out and out[-1][0][:1] == "u" else "u"
        if e == "I":
            out.append((names[wanted], ""))
            continue
        _, role, text = rows[at]
        at += 1
        if e != "D":
            out.append((names[wanted] if e == "R" else role, text))
    assert at == len(rows)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return out


def expected(rows):
    out = {}
    for conv, kept in damage(rows).items():
        faults, roles = fault_names(kept), [r[1][:1] for r in kept]
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit = best(roles, faults)
        text = "\n".join(f"{r}:{x}" for r, x in repaired(kept, audit))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, conv string, gone int"


def run(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = Q.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def odd_conversations(seed):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", "", "  \t", "two words. ", None, "Yes.\n\n", " "]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "agent", "", None]
    rows = []
    for conv in [None, *range(150)]:
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 13, 30])):
            rows.append((conv, r.choice([None, *range(12)]), r.choice(roles), r.choice(texts)))
    return rows


def test_query_equals_dynamic_program(spark, tmp_path):
    rows = odd_conversations(3)
    assert run(spark, rows, tmp_path) == expected(rows)


def test_query_on_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in Q.op12_conversation_repair(spark, SF001).collect()}
    assert got == expected(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}


def test_dropped_conversation_keeps_its_name(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, [(gone, 0, "user", "Hello.")], tmp_path) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}


@pytest.mark.parametrize("block", [2, 5, 16])
def test_search_equals_dynamic_program(monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    r = random.Random(block)
    names = ["", "blank", "duplicate", "truncated"]
    for n in [*range(9)] * 40 + [40, 70]:
        kinds = [4 * r.choice([0, 1, 1, 2, 2, 3]) + r.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        got = R.search(bytes(kinds))
        assert got == best(["suat"[k >> 2] for k in kinds], [names[k & 3] for k in kinds])


def test_estimate_is_never_too_high():
    r = random.Random(1)
    for n in (0, 1, 15, 16, 17, 50):
        kinds = bytes(4 * r.choice([0, 1, 2, 3]) + r.choice([0, 1, 3]) for _ in range(n))
        for i in range(n + 1):
            got = R._estimate(kinds)[4 * i]
            assert got <= best(["suat"[k >> 2] for k in kinds[i:]], [["", "blank", "", "truncated"][k & 3] for k in kinds[i:]])[0]


def test_long_conversation():
    r = random.Random(4)
    kinds = [4 * (1 + i % 2) for i in range(6000)]
    for i in range(0, 6000, 7):
        kinds[i] = 4 * r.choice([0, 1, 2, 3]) + r.choice([0, 1, 2, 3])
    cost, audit = R.search(bytes(kinds))
    assert sum({"D": 3, "I": 2, "R": 2, "K": 0}[e] for e in audit) <= cost
    assert len(audit.replace("I", "")) == 6000


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "sum 3."), (2, 0, "assistant", "Well.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in R.repair_conversations(turns).collect())
    assert got == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "sum 3.", "R"),
                   (2, 0, "user", "", "I"), (2, 1, "assistant", "Well.", "K")]
    audits = {r.conv: (r.cost, r.audit) for r in R.audit_conversations(turns).collect()}
    assert audits == {1: (5, "KDR"), 2: (2, "IK")}


def test_one_shuffle_by_conversation(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    plan = R.audit_conversations(turns, gone=F.lit(False))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
