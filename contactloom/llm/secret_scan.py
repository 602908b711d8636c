"""Secret scan with one deterministic automaton for all rules.

Every rule's regex, turned round, becomes a small nondeterministic automaton; their union, open at
any byte, is made deterministic by subset construction and minimised into one transition array.  A
text passes through that array once, from its last byte to its first, and after each byte the state
tells for which rules a match starts there.  From those places, and only there, the rule's own minimal
automaton reads on to the longest end; so spans are leftmost, longest and not overlapping by rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread


@dataclass(frozen=True)
class Rule:
    """``pattern``: literals, classes [...], groups (a|b), and ?, *, +, {n}.

    ``least``: least length in characters of the match, or where ``tail`` is set of what follows its head;
    the head ends before the first byte that completes the pattern.  Shorter matches are dropped, but what
    they cover is passed over.
    """

    kind: str
    pattern: str
    least: int = 0
    tail: bool = False
    any_case: bool = False


WORD = "[A-Za-z0-9+/_.=-]"
KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: The first three are the base rules; the others add spans.  Fixed values: prefixes of public key formats.
RULES = (
    Rule("assign", KEY + WORD + "+", 12, tail=True, any_case=True),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16}[0-9a-f]*"),
    Rule("github", "gh(p|o|u|s|r)_[A-Za-z0-9]+", 40),
    Rule("slack", "xox(b|a|p|r|s)-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", "(sk|rk)_live_[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)


class _Nfa:
    """Thompson construction of one regex at a time into shared states."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.on: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append([])
        return len(self.free) - 1

    def add(self, pattern: str, any_case: bool) -> tuple[int, int]:
        self.text, self.at, self.any_case = pattern, 0, any_case
        part = self._choice()
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} at {self.at}")
        return part

    def _choice(self) -> tuple[int, int]:
        begin, end = self.state(), self.state()
        while True:
            a, b = self._sequence()
            self.free[begin].append(a)
            self.free[b].append(end)
            if not self._eat("|"):
                return begin, end

    def _sequence(self) -> tuple[int, int]:
        begin = end = self.state()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            from_, make = self.at, self._atom
            a, b = make()
            if self._eat("{"):
                close = self.text.index("}", self.at)
                times, after = int(self.text[self.at : close]), close + 1
                for _ in range(times - 1):
                    self.at = from_
                    c, d = make()
                    self.free[b].append(c)
                    b = d
                self.at = after
            else:
                sign = self.text[self.at : self.at + 1]
                if sign and sign in "?*+":
                    self.at += 1
                    out = self.state()
                    self.free[b].append(out)
                    if sign in "*+":
                        self.free[b].append(a)
                    if sign in "?*":
                        self.free[a].append(out)
                    b = out
            self.free[end].append(a)
            end = b
        return begin, end

    def _atom(self) -> tuple[int, int]:
        if self._eat("("):
            part = self._choice()
            self._eat(")")
            return part
        if self._eat("["):
            chars: set[int] = set()
            while not self._eat("]"):
                low = self._char()
                high = self._char() if self.text[self.at] == "-" and self.text[self.at + 1] != "]" and self._eat("-") else low
                chars.update(range(low, high + 1))
        else:
            chars = {self._char()}
        if self.any_case:
            chars |= {c ^ 32 for c in chars if chr(c).isalpha()}
        a, b = self.state(), self.state()
        self.on[a].append((frozenset(chars), b))
        return a, b

    def turn(self) -> None:
        """Every edge the other way."""
        free: list[list[int]] = [[] for _ in self.free]
        on: list[list[tuple[frozenset[int], int]]] = [[] for _ in self.on]
        for s, (ways, steps) in enumerate(zip(self.free, self.on)):
            for t in ways:
                free[t].append(s)
            for chars, t in steps:
                on[t].append((chars, s))
        self.free, self.on = free, on

    def _char(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _eat(self, c: str) -> bool:
        found = self.text[self.at : self.at + 1] == c
        self.at += found
        return found


def automaton(patterns: list[tuple[str, bool]], anywhere: bool, backward: bool = False) -> tuple[list[int], list[int]]:
    """Transition array (state * 256 + byte to next state * 256) and accepted patterns of each state as a bitmask.

    ``anywhere``: a match may start at any byte; otherwise only at the first one, and state 0 is dead.
    ``backward``: bytes are read from the last to the first.
    The start is state 0 when ``anywhere``, else state 1.  States are those of the minimal automaton.
    """
    nfa = _Nfa()
    ends = {}
    begins = []
    for i, (p, any_case) in enumerate(patterns):
        a, b = nfa.add(p, any_case)[:: -1 if backward else 1]
        begins.append(a)
        ends[b] = ends.get(b, 0) | 1 << i
    if backward:
        nfa.turn()

    def closed(states) -> frozenset[int]:
        seen, left = set(states), list(states)
        while left:
            for t in nfa.free[left.pop()]:
                if t not in seen:
                    seen.add(t)
                    left.append(t)
        return frozenset(seen)

    # Bytes that no class tells apart share a column.
    classes = {c for on in nfa.on for c, _ in on}
    column_of: dict[tuple, int] = {}
    columns = [column_of.setdefault(tuple(b in c for c in classes), len(column_of)) for b in range(256)]
    sample = [columns.index(k) for k in range(len(column_of))]
    start = closed(begins)
    number = {start: 0} if anywhere else {frozenset(): 0, start: 1}
    order, table = list(number), []
    for current in order:
        row = []
        for b in sample:
            after = {t for s in current for c, t in nfa.on[s] if b in c}
            target = closed(after | set(begins)) if anywhere else closed(after)
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
    accepts = [0] * len(order)
    for k, states in enumerate(order):
        for s in states:
            accepts[k] |= ends.get(s, 0)
    # Moore's minimisation: split by what states accept, then by where they go, until nothing splits.
    group = [{a: i for i, a in enumerate(dict.fromkeys(accepts))}[a] for a in accepts]
    while True:
        marks = [(group[k], *[group[t] for t in row]) for k, row in enumerate(table)]
        split = {m: i for i, m in enumerate(dict.fromkeys(marks))}
        if len(split) == len(set(group)):
            break
        group = [split[m] for m in marks]
    first = {}
    for k, g in enumerate(group):
        first.setdefault(g, k)
    first = dict(sorted(first.items(), key=lambda item: accepts[item[1]] != 0))  # accepting states last
    renumber = {g: i for i, g in enumerate(first)}
    flat = [renumber[group[table[k][columns[b]]]] * 256 for k in first.values() for b in range(256)]
    return flat, [accepts[k] for k in first.values()]


def compiled(rules: tuple[Rule, ...]) -> tuple:
    """The arrays of the automaton that all rules share, read backward, and of each rule's own."""
    patterns = [(r.pattern, r.any_case) for r in rules]
    return automaton(patterns, anywhere=True, backward=True), [automaton([p], anywhere=False) for p in patterns]


class Scanner:
    """All rules' automata; ``spans(text)`` are (kind, start, end) in code points, in order of start, then rule."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, arrays: tuple | None = None) -> None:
        self.rules, self.arrays = rules, arrays or compiled(rules)
        (self.step, self.accepts), self.each = self.arrays
        self.first = 256 * next(k for k, a in enumerate(self.accepts) if a)
        self.sets = list(dict.fromkeys([0, *self.accepts]))  # sets of rules that matches of one place can belong to, as bitmasks
        if len(self.sets) > 256:
            raise ValueError("these rules start together in more than 255 ways; scan for them in two parts")
        self.set_of = [self.sets.index(a) for a in self.accepts]
        self.starts_of = [bytes(n < len(self.sets) and self.sets[n] >> k & 1 for n in range(256)) for k in range(len(self.rules))]

    def starts(self, data: bytes) -> bytearray:
        """A byte for each place: 0, or the number of the set of rules with a match that starts there; one pass over the bytes through one array.

        Empty where nothing matches.  A byte a place is all that a text takes, however many matches may start in it.
        """
        step, first, of, last, state, marks = self.step, self.first, self.set_of, len(data) - 1, 0, bytearray()
        for i, b in enumerate(reversed(data)):
            state = step[state + b]
            if state >= first:
                if not marks:
                    marks = bytearray(len(data))
                marks[last - i] = of[state >> 8]
        return marks

    def _rule_spans(self, k: int, starts: bytes, data: bytes) -> list[tuple[int, int]]:
        """Byte spans of a rule whose matches start where ``starts`` isn't 0: leftmost, longest, not overlapping; too short ones are then left out."""
        step, accepts = self.each[k]
        tail, least = self.rules[k].tail, self.rules[k].least
        out, after, n = [], 0, len(data)
        while (at := starts.find(1, after)) >= 0:
            state, i, after = 256, at, at + 1
            while i < n and (state := step[state + data[i]]):
                i += 1
                if accepts[state >> 8]:
                    after = i
            if after - at - (self._head(k, data, at) if tail else 0) >= least:
                out.append((at, after))
        return out

    def _head(self, k: int, data: bytes, at: int) -> int:
        """Bytes of a match before its tail group, which starts at the first byte that completes the pattern."""
        step, accepts = self.each[k]
        state, i = 256, at
        while True:
            state = step[state + data[i]]
            i += 1
            if accepts[state >> 8]:
                return i - 1 - at

    def spans(self, data: bytes) -> list[tuple[str, int, int]]:
        starts = self.starts(data)
        if not starts:
            return []
        seen = [m for n, m in enumerate(self.sets) if n and n in starts]
        hits = []
        for k in range(len(self.rules)):
            if any(m >> k & 1 for m in seen):
                hits += [(a, k, b) for a, b in self._rule_spans(k, starts.translate(self.starts_of[k]), data)]
        out, byte, point = [], 0, 0
        for a, k, b in sorted(hits):
            point += len(data[byte:a].decode())
            byte = a
            out.append((self.rules[k].kind, point, point + b - a))
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found array<struct<kind, start, end>>) for every row: all spans in order of start, then rule.

    Offsets are code points of the whole text, ends exclusive.  Null and empty texts have none;
    repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
    """
    arrays = docs.sparkSession.sparkContext.broadcast(compiled(rules))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = Scanner(rules, arrays.value).spans
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t or b"")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, SPANS)], ["doc_id", "found"])

    return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary"))).mapInArrow(rows, "doc_id long, found array<struct<kind:string,start:int,end:int>>")


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs``, all rows and columns, with every span of ``text_col`` replaced by ``[kind]``; overlapping spans go as one.

    A null text stays null and an empty one empty; repeated rows stay; an empty table stays empty; columns of
    any names stay as they are.
    """
    arrays = docs.sparkSession.sparkContext.broadcast(compiled(rules))

    def cleaned(scanner: Scanner, text: str) -> str:
        out, at = [], 0
        for kind, start, end in scanner.spans(text.encode()):
            if start >= at:
                out += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    @F.pandas_udf("string")
    def without(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(rules, arrays.value)
        for texts in batches:
            yield texts.map(lambda t: cleaned(scanner, t), na_action="ignore")

    return docs.withColumn(text_col, without(F.col(text_col)))
