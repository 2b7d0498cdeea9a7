"""Repairs against a search over all states that keeps the least (cost, audit) of each."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from starmill.llm import turn_repair as R

BLANKS = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
KINDS = {"u": "user", "a": "assistant"}


def damaged(rows):
    for conv, turn, role, text in rows:
        conv_name, turn_name = (" " if x is None else x for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{conv_name}:{turn_name}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        for _ in range(2 if code == 3 else 1):
            yield conv, turn, role, text


def brute(rows, edits=R.Edits()):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation."""
    rows = sorted(rows, key=lambda r: (
        r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else (
            "truncated" if bare[-1] not in ".!?" else "")
        faults.append(fault)
        seen.add((role, text))
    best = {"": (0, "", ())}

    def offer(found, state, value):
        if state not in found or value < found[state]:
            found[state] = value

    def with_inserts(found):
        for _ in range(4):
            for state, (cost, audit, lines) in list(found.items()):
                role = "a" if state == "u" else "u"
                offer(found, NEXT[state, role],
                      (cost + edits.insert, audit + "I", lines + (f"{KINDS[role]}:",)))
        return found

    for (_, _, role, text), fault in zip(rows, faults):
        following = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            offer(following, state, (cost + edits.delete, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = edits.truncated if fault else 0
            if (kept := NEXT.get((state, role[:1]))) is not None:
                offer(following, kept, (cost + edits.keep + extra, audit + "K", lines + (f"{role}:{text}",)))
            for other in "ua":
                if (state, other) in NEXT:
                    offer(following, NEXT[state, other], (
                        cost + edits.rerole + extra, audit + "R", lines + (f"{KINDS[other]}:{text}",)))
        best = following
    best = with_inserts(best)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def expected(rows, edits=R.Edits()):
    kept = {}
    for row in damaged(rows):
        kept.setdefault(row[0], []).append(row)
    return {c: brute(kept[c], edits) if c in kept else NOTHING for c in {r[0] for r in rows}}


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def conversations(count, most, seed):
    rng = random.Random(seed)
    for conv in range(count):
        for turn in range(rng.randint(1, most)):
            if rng.random() < 0.07:
                continue
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "Ulla"])
            yield (conv, rng.choice([turn] * 8 + [None]), role,
                   rng.choice(["Yes.", "No!", "Well", "", " ", "so. ", "why?\n"])
                   + (str(rng.randint(0, 9)) + rng.choice(".x") if rng.random() < 0.6 else ""))


SCHEMA = "conv_id long, turn int, role string, text string"


def test_repairs_equal_brute_force(spark):
    rows = list(conversations(400, 14, 1))
    assert found(R.damaged_repairs(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


@pytest.mark.parametrize("costs", [(0, 3, 4, 1, 2), (1, 1, 9, 2, 0), (0, 2, 2, 2, 2)])
def test_other_costs_insert_too(costs):
    """The tables alone, over random symbols, where insertions are cheap."""
    edits, rng = R.Edits(*costs), random.Random(2)
    tables, inserted = R.Tables(edits), 0
    for _ in range(500):
        rows, codes = [], []
        for i in range(rng.randint(0, 11)):
            role = rng.choice(["system", "user", "assistant", "tool"])
            text = rng.choice([f"{i}.", f"{i}", ""])
            rows.append((0, i, role, text))
            codes.append("suat".index(role[0]) + (8 if not text else 0 if text[-1] == "." else 4))
        acts, state = tables.trace(R._symbols(np.array(codes, dtype=int)), 0, R.START)
        audit = "".join(a[0] for a in acts) + "I" * len(tables.inserts(state, edits.end)[0])
        assert audit == brute(rows, edits)[6], (rows, costs)
        inserted += "I" in audit
    assert inserted


def test_long_conversations_are_cut_in_chunks(spark, conf, monkeypatch):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(R, "CHUNK", 7)
    monkeypatch.setattr(R, "JOINED", 3)
    rng = random.Random(6)
    rows = [(conv, turn, rng.choice(["user", "assistant", "system", "assistant"]),
             rng.choice([f"{turn}.", "again.", f"cut {turn}", ""]))
            for conv, size in ((1, 200), (2, 3), (3, 50), (None, 90)) for turn in range(size)]
    got = found(R.damaged_repairs(spark.createDataFrame(rows, SCHEMA)))
    assert got == expected(rows)


def test_odd_rows(spark):
    text = "a long text. " * 20_000 + "end"
    rows = [(None, None, None, None), (1, None, None, None), (1, 2, "user", None), (2, 1, "user", text),
            (2, 2, "assistant", text + "."), (3, 1, "user", "Same."), (3, 1, "user", "Same."),
            (3, 1, "assistant", "é?"), (3, 2**31 - 1, "", "."), (4, -(2**31), "system", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(R.damaged_repairs(df)) == expected(rows)
    more = df.selectExpr("*", "1 file", "2 row", "3 pos", "4 chunk", "5 copy", "6 repair_file",
                         "7 Repair_Row", "8 code", "9 `last`", "10 `a.b`")
    assert found(R.damaged_repairs(more)) == expected(rows)
    assert R.damaged_repairs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lines_are_the_repaired_conversation(spark):
    rows = [(1, 1, "assistant", "First."), (1, 2, "user", "Second."), (1, 3, "assistant", "Third.")]
    lines = R.repaired_lines(R.turn_rows(spark.createDataFrame(rows, SCHEMA)))
    assert [r.line for r in lines.orderBy("pos").collect()] == ["user:Second.", "assistant:Third."]


@pytest.mark.skipif(not TESTDATA.exists(), reason="the given tables are not here")
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = found(entry.queries()["op11_turn_repair"](spark, str(TESTDATA)))
    assert got == expected(rows)
