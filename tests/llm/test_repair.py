"""Conversation repair against a search over all edits, rows that come in many batches, and awkward tables."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")
ROLES = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}


def searched(sequence):
    """Cheapest edits of a short sequence by uniform-cost search over (place, initials so far): (cost, edits, initials)."""
    queue, best = [(0, "", 0, "")], None
    while queue:
        cost, edits, at, initials = heapq.heappop(queue)
        if best is not None and cost > best[0]:
            return best
        if at == len(sequence) and LEGAL.fullmatch(initials) and (best is None or edits < best[1]):
            best = cost, edits, initials
        following = [(3, "I", at, r) for r in "ua"]
        if at < len(sequence):
            symbol = sequence[at]
            extra = 3 * symbol.isupper()
            following.append((4, "D", at + 1, ""))
            if symbol != "x":
                following += [(3 + extra, "R", at + 1, r) for r in "ua"]
                if symbol.lower() in "sua":
                    following.append((extra, "K", at + 1, symbol.lower()))
        for more, edit, then, role in following:
            now = initials + role
            if re.fullmatch(r"s?(ua)*u?", now):
                heapq.heappush(queue, (cost + more, edits + edit, then, now))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=repair.SYMBOLS, max_size=6))
def test_cheapest_edits(sequence):
    assert repair.cheapest(sequence) == searched(sequence)[:2]


def plainly(sequence):
    """The same by a table over rows, with texts in place of ropes."""
    ways = {0: (0, "")}
    inserted = {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1} | {(p, p): 0 for p in range(4)}
    for symbol in sequence:
        after = {}
        extra = 3 * symbol.isupper()
        for p, (cost, edits) in ways.items():
            for (a, b), n in inserted.items():
                if a == p:
                    steps = [(b, 4, "D")]
                    if symbol != "x":
                        steps += [(q, 3 + extra, "R") for r, q in repair.NEXT[b].items() if r != "s"] + [(q, extra, "K") for r, q in repair.NEXT[b].items() if r == symbol.lower()]
                    for q, more, edit in steps:
                        way = (cost + 3 * n + more, edits + "I" * n + edit)
                        after[q] = min(after.get(q, way), way)
        ways = after
    return min((cost + 3 * inserted[p, q], edits + "I" * inserted[p, q]) for p, (cost, edits) in ways.items() for q in (0, 3) if (p, q) in inserted)


def test_long_sequences():
    rnd = random.Random(2)
    for n in (50, 400, 3000):
        sequence = "".join(rnd.choices(repair.SYMBOLS, [1, 9, 9, 1, 1, 3, 3, 1, 3], k=n))
        assert repair.cheapest(sequence) == plainly(sequence)
    sequences = ["ua" * 200, "", "u" * 99, "sua", "x" * 50, "uAu"]
    grammar = repair.Grammar()
    for matrices, s in zip(repair.compressed(sequences, grammar), sequences):
        row = ((0, repair.Rope()), None, None, None)
        for m in matrices:
            row = repair.follow(row, m)
        assert repair.finished(row)[:2] == plainly(s) and len(matrices) <= 8
    made = len(grammar.rules)
    repair.compressed(sequences, grammar)
    assert len(grammar.rules) == made  # nothing is made twice


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="suax", max_size=30), max_size=8))
def test_rules_give_the_sequences_back(sequences):
    symbols = np.array([repair.SYMBOLS.index(c) for s in sequences for c in s], np.int64)
    held = [s for s in sequences if s]
    starts = np.cumsum([0, *map(len, held)])[:-1].astype(np.int64)
    left, first, rules = repair.repair_rules(symbols, starts)
    grow = lambda i: repair.SYMBOLS[i] if i < len(repair.SYMBOLS) else grow(rules[i - len(repair.SYMBOLS)][0]) + grow(rules[i - len(repair.SYMBOLS)][1])
    assert ["".join(map(grow, run.tolist())) for run in np.split(left, first[1:])] == (held or [""])
    inner = Counter()
    for run in np.split(left, first[1:]):
        run, at = run.tolist(), 0
        for a, b in zip(run, run[1:]):
            inner[a, b] += a != b
    assert all(n < 2 for n in inner.values())


def test_ropes_compare_like_texts():
    rnd = random.Random(5)
    ropes = [repair.Rope("")]
    for _ in range(300):
        ropes.append(rnd.choice(ropes[-20:]) + rnd.choice([repair.Rope(rnd.choice("DIKR")), *ropes[-20:]]))
        ropes[-1] = ropes[-1].flat() if rnd.random() < 0.1 else ropes[-1]
        if ropes[-1].length > 200:
            ropes.append(repair.Rope(rnd.choice("DIKR")))
    for _ in range(3000):
        a, b = rnd.choice(ropes), rnd.choice(ropes)
        assert (a < b) == (str(a) < str(b))


def expected(rows):
    """By conversation, from (conv, turn, role, text) after damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted([r[1:] for r in rows if r[0] == conv and r[4]], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, symbols = set(), Counter(), ""
        for turn, role, text, _ in own:
            words = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            symbols += "x" if fault in ("blank", "duplicate") else (role[:1] if role[:1] in ("s", "u", "a") else "o").upper() if fault else role[:1] if role[:1] in ("s", "u", "a") else "o"
        cost, audit = plainly(symbols)
        state, at, lines = 0, 0, []
        for edit in audit:
            if edit in "IR":
                role = "assistant" if state == 2 else "user"
                lines.append(f"{role}:{own[at][2] if edit == 'R' else ''}")
                state = 3 if state == 2 else 2
            elif edit == "K":
                lines.append(f"{own[at][1]}:{own[at][2]}")
                state = repair.NEXT[state][own[at][1][:1]]
            at += edit != "I"
        turns = {r[0] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        part = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", part(text)) if fate == 2 else part(text)
        out += [(conv, turn, "user" if fate == 4 else part(role), text, fate != 0)] * (2 if fate == 3 else 1)
    return out


@pytest.mark.parametrize("held", [10_000, 3])
def test_awkward_conversations(spark, held):
    rnd = random.Random(7)
    texts = ["Yes.", "No", "", " \t", "a\u2028", "Why?", "Why? \n", None, "é!", "x" * 300_000 + "."]
    rows = [(c, rnd.choice([None, *range(12)]), rnd.choice(["user", "assistant", "system", "tool", "", None, "User"]), rnd.choice(texts)) for c in [*range(60), None] for _ in range(rnd.randint(1, 9))]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"line {t % 40}.") for t in range(900)]  # one long conversation
    frame = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], "conv_id long, turn long, role string, text string, audit string, cost int, conv string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(held))
    try:
        found = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(repair.damaged(frame), there_col="there").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == expected(damage(rows))
    assert repair.repair_conversations(repair.damaged(frame.limit(0))).count() == 0


def test_other_names_and_kinds(spark):
    frame = spark.createDataFrame([("b", 1, "user", "Hi."), ("b", 2, "assistant", "Yes."), ("a", 5, "system", "x")], "thread string, n int, who string, said string")
    found = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(frame, "thread", "n", "who", "said").collect()}
    assert found["b"][5:7] == (0, "KK") and found["a"][5:7] == (4, "D") and found["a"][7] == hashlib.sha256(b"").hexdigest()
