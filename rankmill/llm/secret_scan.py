"""Secret scan with one combined deterministic automaton.

Every rule's regular expression is compiled on its own: a Thompson automaton, then a deterministic
one by subset construction whose states keep the starts of matches apart in order of age, so that it
finds leftmost-longest matches and restarts behind each. The rules' automata are then run as one
product, which is minimised by partition refinement and laid out as a flat transition array over
byte classes. One pass over the bytes of a text runs all rules; entering an event state means that
matches have just ended. The start of a match is found by running its rule from the place where the
automaton last left its initial state.

Rules must be such that a live match stays accepting (`closed`), which is checked when they are
compiled: then a match ends exactly where its rule's automaton stops.

Null text is empty. Rows are judged one by one; the operator is a narrow projection. Offsets are code
points. Spans of different kinds may overlap, spans of one kind never do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import ship_package, text_of

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]+"""


class Rule(NamedTuple):
    kind: str
    pattern: str
    accepts: Callable[[bytes], bool]
    any_case: str = ""  # the part of the pattern whose letters stand for both cases


def _assigned(match: bytes) -> bool:
    """At least 12 characters of value behind the first `:` or `=`."""
    at = next(i for i, b in enumerate(match) if b in b":=") + 1
    value = match[at:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= 12


def _at_least(n: int) -> Callable[[bytes], bool]:
    return lambda match: len(match) >= n


BASE = ("assign", "access", "hex")
# fixed values: the three base rules, then public token formats
RULES = (
    Rule("assign", ASSIGN, _assigned, "(password|passwd|secret|token|api_?key)"),
    Rule("access", r"AKIA[A-Z0-9]+", _at_least(18)),
    # short runs are no match of the sixteen-fold pattern either; so they cause no events
    Rule("hex", "[0-9a-f]" * 15 + "[0-9a-f]+", _at_least(16)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", _at_least(40)),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]+", _at_least(20)),
    Rule("google", r"AIza[A-Za-z0-9_-]+", _at_least(39)),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", _at_least(24)),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", _at_least(1)),
)


# -- one rule -----------------------------------------------------------------------------


class Nfa:
    """Thompson automaton: `eps[s]` and `on[s]` = (set of bytes, next state)."""

    def __init__(self, rule: Rule):
        self.eps: list[list[int]] = []
        self.on: list[tuple[frozenset[int], int] | None] = []
        self.text, self.at = rule.pattern, 0
        self.folded = len(rule.any_case) if rule.pattern.startswith(rule.any_case) else 0
        self.first, self.last = self._choice()
        if self.at != len(self.text):
            raise ValueError(f"unbalanced pattern: {self.text}")

    def _state(self) -> int:
        self.eps.append([])
        self.on.append(None)
        return len(self.eps) - 1

    def _choice(self) -> tuple[int, int]:
        first, last = self._state(), self._state()
        while True:
            a, b = self._sequence()
            self.eps[first].append(a)
            self.eps[b].append(last)
            if self.text[self.at : self.at + 1] != "|":
                return first, last
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        first = last = self._state()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            a, b = self._repeated()
            self.eps[last].append(a)
            last = b
        return first, last

    def _repeated(self) -> tuple[int, int]:
        a, b = self._atom()
        sign = self.text[self.at : self.at + 1]
        if sign and sign in "?*+":
            self.at += 1
            first, last = self._state(), self._state()
            self.eps[first].append(a)
            self.eps[b].append(last)
            if sign != "+":
                self.eps[first].append(last)
            if sign != "?":
                self.eps[b].append(a)
            return first, last
        return a, b

    def _atom(self) -> tuple[int, int]:
        sign = self.text[self.at]
        if sign == "(":
            self.at += 1
            pair = self._choice()
            self.at += 1
            return pair
        letters = self._class() if sign == "[" else self._literal()
        a, b = self._state(), self._state()
        self.on[a] = (letters, b)
        return a, b

    def _literal(self) -> frozenset[int]:
        fold = self.at < self.folded
        if self.text[self.at] == "\\":
            self.at += 1
        letter = self.text[self.at]
        self.at += 1
        return frozenset(map(ord, {letter, letter.lower(), letter.upper()} if fold else {letter}))

    def _class(self) -> frozenset[int]:
        end = self.text.index("]", self.at)
        body, letters = self.text[self.at + 1 : end], set()
        self.at, i = end + 1, 0
        while i < len(body):
            if body[i + 1 : i + 2] == "-" and i + 2 < len(body):
                letters.update(range(ord(body[i]), ord(body[i + 2]) + 1))
                i += 3
            else:
                letters.add(ord(body[i]))
                i += 1
        return frozenset(letters)

    def closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.eps[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(s for s in seen if self.on[s] or s == self.last)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({self.on[s][1] for s in states if self.on[s] and byte in self.on[s][0]})


class Searcher:
    """Leftmost-longest search for one rule.

    A state lists sets of NFA states, oldest match start first. `step` gives the next state and
    whether the match that was accepting has ended before this byte.
    """

    def __init__(self, rule: Rule):
        self.nfa = Nfa(rule)
        self.fresh = self.nfa.closure({self.nfa.first})
        self.initial: tuple[frozenset[int], ...] = ()

    def _advance(self, state: tuple[frozenset[int], ...], byte: int) -> tuple[frozenset[int], ...]:
        groups, seen = [], set()
        matched = bool(state) and self.nfa.last in state[0]
        for group in state if matched else (*state, self.fresh):
            group = self.nfa.step(group, byte) - seen
            if group:
                seen |= group
                groups.append(group)
                if self.nfa.last in group:  # younger starts lose to an older match
                    return tuple(groups)
        return tuple(groups)

    def step(self, state: tuple[frozenset[int], ...], byte: int) -> tuple[tuple[frozenset[int], ...], bool]:
        accepting = bool(state) and self.nfa.last in state[0]
        after = self._advance(state, byte)
        if accepting and not (after and self.nfa.last in after[0]):
            if after:
                raise ValueError(f"a match of {self.nfa.text} can stop accepting and go on")
            return self._advance((), byte), True
        if after and not accepting and self.nfa.last in frozenset().union(*after[1:]):
            raise ValueError(f"matches of {self.nfa.text} from two starts would overlap")
        return after, False

    def compiled(self, samples: list[int]) -> tuple[list[list[tuple[int, bool]]], list[bool]]:
        """The reachable states as numbers: (next, ended) by byte class, and which are accepting."""
        number, order, table = {self.initial: 0}, [self.initial], []
        for state in order:
            row = []
            for byte in samples:
                nxt, ended = self.step(state, byte)
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append((number[nxt], ended))
            table.append(row)
        return table, [bool(s) and self.nfa.last in s[0] for s in order]

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at `start`, or -1."""
        states, end = self.fresh, -1
        for i in range(start, len(data)):
            states = self._anchored(states, data[i])
            if not states:
                break
            if self.nfa.last in states:
                end = i + 1
        return end

    @lru_cache(maxsize=None)  # noqa: B019 - one searcher per rule and process
    def _anchored(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.nfa.step(states, byte)


# -- all rules ----------------------------------------------------------------------------


class Automaton:
    """The minimised product of all rules as a flat array.

    Row `s` of `table` has one entry per byte class: the row start of the next state. Rows from
    `events` on are entered when matches have ended; `ended[row]` has the numbers of their rules.
    """

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.searchers = [Searcher(rule) for rule in rules]
        alphabet = [s for x in self.searchers for s in {on[0] for on in x.nfa.on if on}]
        signature = {b: tuple(b in s for s in alphabet) for b in range(256)}
        classes = {sign: k for k, sign in enumerate(dict.fromkeys(signature.values()))}
        self.class_of = bytes(classes[signature[b]] for b in range(256))
        samples = [self.class_of.index(k) for k in range(len(classes))]
        self._lay_out(*self._minimised(*self._product([s.compiled(samples) for s in self.searchers])))

    @staticmethod
    def _product(parts: list[tuple[list[list[tuple[int, bool]]], list[bool]]]) -> tuple[list[list[int]], list[tuple]]:
        """Reachable product states; a mark holds the rules just ended and those accepting."""
        start = ((0,) * len(parts), ())
        number, order, table = {start: 0}, [start], []
        for states, _ in order:
            row = []
            for moved in zip(*(part[0][s] for part, s in zip(parts, states, strict=True)), strict=True):
                nxt = (tuple(m[0] for m in moved), tuple(k for k, m in enumerate(moved) if m[1]))
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append(number[nxt])
            table.append(row)
        alive = [tuple(k for k, s in enumerate(states) if parts[k][1][s]) for states, _ in order]
        return table, [(ended, live, n == 0) for n, ((_, ended), live) in enumerate(zip(order, alive, strict=True))]

    @staticmethod
    def _minimised(table: list[list[int]], marks: list[tuple]) -> tuple[list[list[int]], list[tuple]]:
        names = {m: k for k, m in enumerate(dict.fromkeys(marks))}
        block = [names[m] for m in marks]
        while True:
            signs = [(block[s], *(block[t] for t in row)) for s, row in enumerate(table)]
            names = {sign: k for k, sign in enumerate(dict.fromkeys(signs))}
            if len(names) == len(set(block)):
                break
            block = [names[sign] for sign in signs]
        first = {b: s for s, b in reversed(list(enumerate(block)))}
        ids = {b: k for k, b in enumerate(sorted(first, key=lambda b: first[b]))}
        rows = sorted(first, key=lambda b: ids[b])
        return [[ids[block[t]] for t in table[first[b]]] for b in rows], [marks[first[b]] for b in rows]

    def _lay_out(self, table: list[list[int]], marks: list[tuple]) -> None:
        order = sorted(range(len(table)), key=lambda s: (bool(marks[s][0]), s))
        place = {s: k for k, s in enumerate(order)}
        width = 1
        while width < len(table[0]):
            width *= 2
        self.width, self.states = width, len(table)
        row_start = [n * width for n in range(len(table))]  # one object per state keeps the array small
        self.table = [0] * (width * len(table))
        for s in order:
            for k, t in enumerate(table[s]):
                self.table[place[s] * width + k] = row_start[place[t]]
        self.events = width * sum(not marks[s][0] for s in order)
        self.ended = {place[s] * width: marks[s][0] for s in order}
        self.alive = {place[s] * width: marks[s][1] for s in order}

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) of all matches in byte offsets, accepted or not."""
        table, events, found = self.table, self.events, []
        left = [0] * len(self.rules)  # where the search for each rule's next match may begin
        calm = 0  # the last place at which the automaton was in its initial state
        state = 0
        for i, k in enumerate(data.translate(self.class_of)):
            state = table[state + k]
            if state >= events:
                for rule in self.ended[state]:
                    found.append((rule, self._start(rule, data, max(left[rule], calm), i), i))
                    left[rule] = i
            elif not state:
                calm = i + 1
        for rule in self.alive[state]:
            found.append((rule, self._start(rule, data, max(left[rule], calm), len(data)), len(data)))
        return found

    def _start(self, rule: int, data: bytes, begin: int, end: int) -> int:
        longest = self.searchers[rule].longest
        return next(s for s in range(begin, end) if longest(data, s) == end)


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton()


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind as listed."""
    data = text.encode("utf-8", "surrogatepass")
    scanner = automaton()
    found = [m for m in scanner.matches(data) if scanner.rules[m[0]].accepts(data[m[1] : m[2]])]
    found.sort(key=lambda m: (m[1], m[0]))
    if len(data) == len(text):
        return [(scanner.rules[r].kind, s, e) for r, s, e in found]
    spans, at, points = [], 0, 0
    for r, s, e in found:
        points += len(data[at:s].decode("utf-8", "surrogatepass"))
        at = s
        spans.append((scanner.rules[r].kind, points, points + e - s))  # matches are ASCII
    return spans


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans) per row of `docs`; span lists as text."""

    ship_package(docs.sparkSession)

    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base string, spans string")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                spans = secret_spans(text)
                base = [s for s in spans if s[0] in BASE]
                counts = [sum(s[0] == kind for s in base) for kind in BASE]
                rows.append((*counts, *(",".join(f"{k}:{a}:{b}" for k, a, b in some) for some in (base, spans))))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return docs.select("doc_id", scanned(text_of()).alias("s")).select("doc_id", "s.*")
