"""Conversation structure repair: the cheapest edits that give a legal order of roles.

A row is one of nine symbols: its role's initial (s, u, a or another), whether its text is truncated,
or that it must go. An edited conversation is legal where its initials read `(s?(ua)+)?`, which a
machine with four states decides. Over a run of rows, the cheapest edits from each state to each state
form a min-plus matrix; its entries carry the edits as ropes, so that joining two runs joins two
matrices and copies no text. Re-Pair replaces the pair of neighbours that is most frequent in all
conversations of a batch by a new symbol, again and again; the matrix of a rule is made once, from the
matrices of its two sides, and serves every place and every conversation that holds the rule.

Ties go to the edits that are least as ASCII text. That choice can be made matrix by matrix: of two
edits of equal cost over the same rows and between the same states, neither is the beginning of the
other (the longer would hold more insertions and cost more).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST = INSERT_COST = TRUNCATED_COST = 3
DELETE_COST = 4
#: States: nothing yet, after s, after u, after a. NEXT[state][initial]: the state behind a row.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, LEGAL = 0, (0, 3)
STATES = range(4)
ROLE = {"u": "user", "a": "assistant"}
#: Symbols of rows: whole ones, truncated ones (capitals), and those that must go.
SYMBOLS = "suaoSUAOx"
BLANK = r"\A[\x20\x09-\x0D]*\z"
TRUNCATED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"

# Ropes. ---------------------------------------------------------------------------------------

_P, _B = (1 << 127) - 1, 0x5DEECE66D1B5A3C9


class Rope:
    """Text as a tree of joined pieces, with a length and a digest, so that equal stretches are skipped when ropes are compared."""

    __slots__ = ("left", "right", "text", "length", "digest", "power")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.length, self.power, self.digest = len(text), pow(_B, len(text), _P), 0
            for c in text:
                self.digest = (self.digest * _B + ord(c)) % _P
        else:
            self.length, self.power = left.length + right.length, left.power * right.power % _P
            self.digest = (left.digest * right.power + right.digest) % _P

    def __add__(self, other: Rope) -> Rope:
        if not self.length or not other.length:
            return other if not self.length else self
        return Rope("", self, other)

    def flat(self) -> Rope:
        """The same text as one piece."""
        if self.left is None:
            return self
        rope = object.__new__(Rope)
        rope.left = rope.right = None
        rope.text, rope.length, rope.digest, rope.power = str(self), self.length, self.digest, self.power
        return rope

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            rope = stack.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                stack += [rope.right, rope.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or a.length == b.length and a.digest == b.digest:
                continue
            if a.left is None and b.left is None:
                n = min(a.length, b.length)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                if a.length > n:
                    mine.append(Rope(a.text[n:]))
                if b.length > n:
                    theirs.append(Rope(b.text[n:]))
            elif b.left is None or a.left is not None and a.length >= b.length:
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                mine.append(a)
                theirs += [b.right, b.left]
        return not mine and bool(theirs)


# Matrices: from each state to each state (cost, rope), or None. ---------------------------------

Entry = tuple[int, Rope] | None
Matrix = tuple[tuple[Entry, ...], ...]


def least(a: Entry, b: Entry) -> Entry:
    """The cheaper of two entries; of equally cheap ones that with the lesser edits."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def times(a: Matrix, b: Matrix) -> Matrix:
    """The matrix of a run of rows that a matrix of its beginning and one of its rest give."""
    return tuple(follow(row, b) for row in a)


def follow(row: tuple[Entry, ...], b: Matrix) -> tuple[Entry, ...]:
    out: list[Entry] = [None] * 4
    for entry, rest in zip(row, b):
        if entry is not None:
            for q, more in enumerate(rest):
                if more is not None and (out[q] is None or entry[0] + more[0] <= out[q][0]):
                    out[q] = least(out[q], (entry[0] + more[0], entry[1] + more[1]))
    return tuple(out)


@lru_cache(1)
def insertions() -> Matrix:
    """Rows put in where there is none: the shortest way from state to state."""
    table = []
    for p in STATES:
        row: list[Entry] = [None] * 4
        row[p] = (0, Rope())
        state, n = p, 0
        for _ in range(3):
            state, n = (3 if state == 2 else 2), n + 1
            row[state] = least(row[state], (INSERT_COST * n, Rope(INSERT * n)))
        table.append(tuple(row))
    return tuple(table)


@lru_cache(None)
def matrix_of(symbol: str) -> Matrix:
    """One row, and what is put in before it."""
    extra = TRUNCATED_COST if symbol.isupper() else 0
    initial = symbol.lower()
    table: list[list[Entry]] = [[None] * 4 for _ in STATES]
    for p in STATES:
        table[p][p] = (DELETE_COST, Rope(DELETE))
        if symbol != "x":
            for role in ROLE:
                q = NEXT[p].get(role)
                if q is not None:
                    table[p][q] = least(table[p][q], (REROLE_COST + extra, Rope(REROLE)))
            q = NEXT[p].get(initial)
            if q is not None:
                table[p][q] = least(table[p][q], (extra, Rope(KEEP)))
    return times(insertions(), tuple(map(tuple, table)))


def edited_rows(state: int, edits: str, initials: str) -> Iterator[tuple[int | None, str | None]]:
    """(place of the row or None, new role or None for its own) of each row that is left, from a state on."""
    at = 0
    for edit in edits:
        if edit == INSERT or edit == REROLE:
            role = "a" if state == 2 else "u"
            yield (None if edit == INSERT else at), ROLE[role]
            state = NEXT[state][role]
        elif edit == KEEP:
            yield at, None
            state = NEXT[state][initials[at]]
        at += edit != INSERT


# Grammar. ---------------------------------------------------------------------------------------


class Grammar:
    """Matrices of rules, kept from batch to batch: a rule that comes again is not made again."""

    #: Rules kept; beyond, all are forgotten.
    KEPT = 1 << 14

    def __init__(self):
        self.rules: dict[tuple[int, int], tuple[Matrix, Matrix, Matrix]] = {}

    def rule(self, a: Matrix, b: Matrix) -> Matrix:
        key = (id(a), id(b))
        kept = self.rules.get(key)
        if kept is None:
            if len(self.rules) >= self.KEPT:
                self.rules.clear()
            kept = self.rules[key] = (a, b, times(a, b))  # a and b stay alive with their ids
        return kept[2]


def repair_rules(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Re-Pair over sequences that lie end to end: what is left of them, where they start in it, and the rules (from len(SYMBOLS) on).

    The most frequent pair of neighbours (the least of equally frequent ones) becomes a symbol, while one comes twice.
    Pairs do not cross from one sequence to the next; of a run of equal symbols every second pair counts.
    """
    rules: list[tuple[int, int]] = []
    symbols, first = symbols.astype(np.int64), np.zeros(len(symbols) + 1, bool)
    first[starts] = True
    first = first[: len(symbols)]
    while len(symbols) > 1:
        inside = ~first[1:]
        same = inside & (symbols[1:] == symbols[:-1])
        if same.any():  # of a run of equal symbols, the pairs at even distance from its start
            at = np.arange(len(same))
            before = np.concatenate([[False], same[:-1]])
            begin = np.maximum.accumulate(np.where(same & ~before, at, 0))
            inside &= ~(same & ((at - begin) % 2 == 1))
        width = len(SYMBOLS) + len(rules)
        pairs = np.where(inside, symbols[:-1] * width + symbols[1:], -1)
        found, counts = np.unique(pairs[inside], return_counts=True)
        if not len(found) or counts.max() < 2:
            break
        pair = found[counts.argmax()]
        rules.append((int(pair // width), int(pair % width)))
        at = np.flatnonzero(pairs == pair)
        symbols[at] = width
        left = np.ones(len(symbols), bool)
        left[at + 1] = False
        symbols, first = symbols[left], first[left]
    return symbols, np.flatnonzero(first), rules


def compressed(sequences: list[str], grammar: Grammar) -> list[list[Matrix]]:
    """Each sequence as few matrices in order; those of rules are made once for all sequences."""
    texts = "".join(sequences)
    codes = np.frombuffer(texts.encode("ascii"), np.uint8)
    symbols = np.array([SYMBOLS.find(chr(i)) for i in range(256)])[codes]
    sizes = np.array([len(s) for s in sequences], np.int64)
    held = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[held]
    left, first, rules = repair_rules(symbols, starts)
    matrices = [matrix_of(c) for c in SYMBOLS]
    for a, b in rules:
        matrices.append(grammar.rule(matrices[a], matrices[b]))
    out: list[list[Matrix]] = [[] for _ in sequences]
    for which, run in zip(held.tolist(), np.split(left, first[1:])):
        out[which] = [matrices[i] for i in run.tolist()]
    return out


def cheapest(sequence: str) -> tuple[int, str]:
    """Cost and edits of one whole conversation, given as symbols."""
    row = ((0, Rope()), None, None, None)
    for m in compressed([sequence], Grammar())[0]:
        row = follow(row, m)
    return finished(row)[:2]


def finished(row: tuple[Entry, ...]) -> tuple[int, str, int]:
    """Cost, edits and the state before the last insertions, of the cheapest way from these states to a legal end."""
    best, state = None, 0
    for p in STATES:
        if row[p] is not None:
            for q in LEGAL:
                more = insertions()[p][q]
                if more is not None:
                    entry = (row[p][0] + more[0], row[p][1] + more[1])
                    if best is None or least(best, entry) is entry:
                        best, state = entry, p
    return best[0], str(best[1]), state


# Conversations. ---------------------------------------------------------------------------------


class Conversation:
    """What is known of one conversation, whose rows come in runs: a run of any length adds to four ways only."""

    def __init__(self, key):
        self.key = key
        self.row: tuple[Entry, ...] = ((0, Rope()), None, None, None)
        self.texts: list = [hashlib.sha256(), None, None, None]
        self.empty = [True, None, None, None]
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last: str | None = None
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, turns: list, roles: list[str], texts: list[str], faults: list[str], matrices: list[Matrix]) -> None:
        for turn in turns:
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.high = self.turn = turn
                self.turns += 1
        initials = "".join([r[:1] or " " for r in roles])
        pairs = ([self.last] if self.last else []) + list(initials)
        self.counts["illegal"] += sum(a + b not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        self.last = pairs[-1] if pairs else self.last
        for fault in faults:
            if fault:
                self.counts[fault] += 1
        ways: list[tuple[tuple[Entry, ...], int]] = []
        for p in STATES:
            if self.row[p] is not None:
                row: tuple[Entry, ...] = tuple((0, Rope()) if q == p else None for q in STATES)
                for m in matrices:
                    row = follow(row, m)
                ways.append((row, p))
        after, came = [None] * 4, [None] * 4
        for row, p in ways:
            for q in STATES:
                if row[q] is not None:
                    part = row[q][1].flat()
                    entry = (self.row[p][0] + row[q][0], self.row[p][1] + part)
                    if after[q] is None or least(after[q], entry) is entry:
                        after[q], came[q] = entry, (p, part.text)
        texts_after, empty_after = [None] * 4, [None] * 4
        for q in STATES:
            if came[q] is not None:
                p, edits = came[q]
                texts_after[q], empty_after[q] = self.written(p, edits, initials, roles, texts)
        self.row = tuple(after)
        self.texts, self.empty = texts_after, empty_after

    def written(self, state: int, edits: str, initials: str, roles: list[str], texts: list[str]):
        """The digest of what stands at a state, with the rows that these edits leave behind it."""
        digest, empty = self.texts[state].copy(), self.empty[state]
        lines = [f"{role or roles[at]}:{'' if at is None else texts[at]}" for at, role in edited_rows(state, edits, initials)]
        if lines:
            digest.update((("" if empty else "\n") + "\n".join(lines)).encode())
        return digest, empty and not lines

    def result(self) -> list:
        cost, audit, state = finished(self.row)
        tail = audit[self.row[state][1].length :]
        digest, _ = self.written(state, tail, "", [], [])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        c = self.counts
        return [self.key, gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], cost, audit, digest.hexdigest()]


FAULTS = {"b": "blank", "d": "duplicate", "t": "truncated", "": ""}


def symbol_of(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == "truncated" else initial


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from rows sorted by conversation and place; a conversation may run over many batches."""
    grammar, now, names = Grammar(), None, [f.name for f in RESULT.fields]
    for batch in batches:
        kind = batch.schema.field("conv").type
        keys, turns, roles, texts = (batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text"))
        faults = [FAULTS[f] for f in batch.column("fault").to_pylist()]
        there = batch.column("there").to_pylist()
        runs = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        kept = [[i for i in range(a, b) if there[i]] for a, b in zip(runs, [*runs[1:], len(keys)])]
        done = []
        for at, rows, matrices in zip(runs, kept, compressed(["".join([symbol_of(roles[i], faults[i]) for i in rows]) for rows in kept], grammar)):
            if now is None or now.key != keys[at]:
                if now is not None:
                    done.append(now.result())
                now = Conversation(keys[at])
            if rows:
                now.add(*([column[i] for i in rows] for column in (turns, roles, texts, faults)), matrices)
        if done:
            yield as_batch(done, names, kind)
    if now is not None:
        yield as_batch([now.result()], names, kind)


RESULT = T.StructType([T.StructField(n, T.StringType() if n in ("audit", "repaired_sha256") else T.LongType()) for n in "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()])


def as_batch(rows: list[list], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.string() if n in ("audit", "repaired_sha256") else pa.int64() for n in names[1:]]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults, and `there`: false where a row was dropped (its conversation still counts).

    By crc32("conv_id:turn") % 20: 0 drops the row, 1 empties its text, 2 takes its [.!?] out, 3 repeats it, 4 makes its
    role user. A null role or text is one space, as is a null conv_id or turn in that key.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).cast("int")
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    role = F.when(fate == 4, "user").otherwise(part("role"))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fate != 0).alias("there"), F.when(fate == 3, 2).otherwise(1).alias("n"))
    return out.withColumn("n", F.explode(F.array_repeat(F.lit(0), F.col("n")))).drop("n")


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", there_col: str | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Rows are ordered by turn (nulls first), equal turns by role and text. A null conversation is one conversation; a null
    role or text is one space. Rows whose there_col is false stand for their conversation only. A row's first fault counts:
    blank (white space only), duplicate (same role and text as an earlier row), truncated (its last other character is not
    one of .!?). illegal: neighbours whose role initials are not su, ua or au. Edits: keep (0), set the role to user or
    assistant (3), delete (4; blank and duplicate rows must go), insert an empty row of user or assistant (3); a truncated
    row that stays adds 3. Of the cheapest edits that give initials `(s?(ua)+)?` those with the least text win. gaps: turns
    between the least and the greatest that no row has. repaired_sha256: of the lines role:text that the edits leave.
    A conversation without rows has zeros, no edits and the digest of nothing. Other columns are not read.

    One shuffle by conversation; a task streams its sorted rows and holds a batch of them, so that a conversation of any
    number of rows needs memory for its edits only (one letter a row). Its rows follow each other in one task, since
    the digest reads them in order.
    """
    own = lambda name: F.col(f"`{name}`")
    light = rows.select(
        own(conv_col).alias("conv"),
        own(turn_col).cast("long").alias("turn"),
        F.coalesce(own(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(own(text_col).cast("string"), F.lit(" ")).alias("text"),
        (own(there_col) if there_col else F.lit(True)).alias("there"),
    )
    dealt = light.repartition(shuffle_partitions(rows.sparkSession), "conv")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    seen = F.row_number().over(Window.partitionBy("conv", "there", "role", "text").orderBy(order[0]))
    fault = F.when(F.col("text").rlike(BLANK), "b").when(seen > 1, "d").when(F.col("text").rlike(TRUNCATED), "t").otherwise("")
    marked = dealt.withColumns({"seen": seen, "fault": fault}).sortWithinPartitions(F.col("conv").asc_nulls_first(), *order, "seen").drop("seen")
    result = T.StructType([T.StructField("conv_id", light.schema["conv"].dataType), *RESULT.fields[1:]])
    return marked.mapInArrow(repaired, result)
