"""Regular expressions as transition arrays: subset construction, minimisation, and one pass over bytes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

NEW = -1
LANE = 512
LONG = 16 * LANE
# Pieces of a long lane that run together, and how many bytes before a piece tell its possible states.
PIECES, WINDOW = 1024, 64
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}


class Positions:
    """The position automaton of an expression over bytes: which bytes each position takes, which
    positions can be the first or the last, and which can follow each.

    Expressions have ASCII characters, escapes, classes, groups, ``|``, ``?``, ``*`` and ``+``.
    """

    def __init__(self, expression: str):
        self.text, self.at = expression, 0
        self.takes: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        nullable, self.first, self.last = self._alternatives()
        if self.at < len(expression):
            raise ValueError(f"')' without '(' in {expression!r}")
        if nullable:
            raise ValueError(f"{expression!r} matches the empty text")

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _next(self) -> str:
        if self.at >= len(self.text):
            raise ValueError(f"{self.text!r} ends too early")
        self.at += 1
        return self.text[self.at - 1]

    def _alternatives(self):
        nullable, first, last = self._sequence()
        while self._peek() == "|":
            self.at += 1
            n, f, e = self._sequence()
            nullable, first, last = nullable or n, first | f, last | e
        return nullable, first, last

    def _sequence(self):
        nullable, first, last = True, set(), set()
        while self._peek() not in ("", "|", ")"):
            n, f, e = self._repeated()
            for p in last:
                self.follow[p] |= f
            first = first | f if nullable else first
            last = last | e if n else e
            nullable = nullable and n
        return nullable, first, last

    def _repeated(self):
        nullable, first, last = self._atom()
        while self._peek() in ("?", "*", "+") and self._peek():
            sign = self._next()
            if sign != "?":
                for p in last:
                    self.follow[p] |= first
            nullable = nullable or sign != "+"
        return nullable, first, last

    def _atom(self):
        sign = self._next()
        if sign == "(":
            found = self._alternatives()
            if self._next() != ")":
                raise ValueError(f"'(' without ')' in {self.text!r}")
            return found
        if sign in "?*+{":
            raise ValueError(f"nothing to repeat in {self.text!r}")
        taken = self._class() if sign == "[" else {self._byte(sign)}
        self.takes.append(frozenset(taken))
        self.follow.append(set())
        return False, {len(self.takes) - 1}, {len(self.takes) - 1}

    def _byte(self, sign: str) -> int:
        if sign == "\\":
            sign = self._next()
            if sign == "x":
                return int(self._next() + self._next(), 16)
            sign = _ESCAPES.get(sign, sign)
        if ord(sign) > 127:
            raise ValueError(f"{sign!r} is no ASCII character")
        return ord(sign)

    def _class(self) -> set[int]:
        negated = self._peek() == "^"
        self.at += negated
        taken: set[int] = set()
        while (sign := self._next()) != "]":
            low = high = self._byte(sign)
            if self._peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.at += 1
                high = self._byte(self._next())
            taken |= set(range(low, high + 1))
        return set(range(256)) - taken if negated else taken


@dataclass
class Table:
    """A deterministic automaton over byte classes; state 0 is the start."""

    targets: list[list[int]]  # per state and class
    origins: list[list[tuple[int, ...]]]  # which attempt each attempt of the target goes on from
    accepts: list[bool]


def searcher(expression: str, classes: list[int]) -> Table:
    """The minimal automaton that looks for an expression's leftmost longest matches, one after another.

    A state of the subset construction is a list of position sets: the attempts under way, by their
    start, the earliest first; a position that an earlier attempt holds isn't needed in a later one.
    A match ends where its attempt dies. So an attempt that accepts must accept until it dies and be
    the earliest; expressions for which that isn't so are refused.
    """
    nfa = Positions(expression)

    def refuse(why: str):
        raise ValueError(f"{expression!r} can't be searched in one pass: {why}")

    def step(state: tuple[frozenset[int], ...], byte: int):
        pending = bool(state) and not nfa.last.isdisjoint(state[0])
        out, origins, seen = [], [], set()
        for i, attempt in enumerate([*state, None]):
            ahead = nfa.first if attempt is None else set().union(*[nfa.follow[p] for p in attempt])
            found = frozenset(q for q in ahead if byte in nfa.takes[q]) - seen
            if not found:
                continue
            accepts = not nfa.last.isdisjoint(found)
            if accepts and out:
                refuse("a later start may be accepted first")
            if pending and attempt is None and accepts:
                refuse("a match may touch the next one")
            if pending and attempt is not None and not accepts:
                refuse("a match may go on without being one")
            out.append(found)
            origins.append(NEW if attempt is None else i)
            seen |= found
            if accepts:
                break
        return tuple(out), tuple(origins)

    sample = {c: byte for byte, c in enumerate(classes)}
    number: dict[tuple, int] = {(): 0}
    states, targets, origins = [()], [], []
    for state in states:
        row = [step(state, sample[c]) for c in range(len(sample))]
        for target, _ in row:
            if target not in number:
                number[target] = len(states)
                states.append(target)
        targets.append([number[t] for t, _ in row])
        origins.append([o for _, o in row])
    accepts = [bool(s) and not nfa.last.isdisjoint(s[0]) for s in states]
    return _minimal(Table(targets, origins, accepts))


def _minimal(table: Table) -> Table:
    """States that behave alike become one: parts are split until all members of a part go on alike."""
    part = [int(a) for a in table.accepts]
    while True:
        kinds: dict[tuple, int] = {}
        found = [
            kinds.setdefault((part[s], *[part[t] for t in row], *table.origins[s]), len(kinds))
            for s, row in enumerate(table.targets)
        ]
        if len(kinds) == len(set(part)):
            break
        part = found
    part = found  # numbered by first appearance, so the start is 0
    first = [part.index(p) for p in range(len(kinds))]
    return Table(
        [[part[t] for t in table.targets[s]] for s in first], [table.origins[s] for s in first],
        [table.accepts[s] for s in first],
    )


def byte_classes(expressions: Iterable[str]) -> list[int]:
    """Per byte its class: bytes that no expression tells apart are one."""
    taken = [t for e in expressions for t in Positions(e).takes]
    kinds: dict[tuple, int] = {}
    return [kinds.setdefault(tuple(byte in t for t in taken), len(kinds)) for byte in range(256)]


class Scanner:
    """All expressions in one automaton, as arrays.

    Its states are the reachable combinations of the expressions' states. As each of those is minimal
    and seen on its own, no two combinations are alike, so the combination is minimal, too.
    """

    def __init__(self, expressions: list[str]):
        classes = byte_classes(expressions)
        self.tables = [searcher(e, classes) for e in expressions]
        n = max(classes) + 1
        number = {(0,) * len(expressions): 0}
        self.states = [*number]  # which state of each expression
        targets = []
        for state in self.states:
            row = []
            for c in range(n):
                target = tuple(t.targets[s][c] for t, s in zip(self.tables, state, strict=True))
                if target not in number:
                    number[target] = len(self.states)
                    self.states.append(target)
                row.append(number[target])
            targets.append([*row, 0])  # the last class is the end of a text
        self.width = n + 1
        self.classes = np.array(classes, dtype=np.uint8 if n < 256 else np.int32)
        table = np.array(targets, dtype=np.int32)
        # States are kept as the place of their row, so a step is one addition and one look-up.
        self.targets = (table * self.width).ravel()
        self.accepting = [
            np.repeat(np.array([t.accepts[state[i]] for state in self.states]), self.width)
            for i, t in enumerate(self.tables)
        ]
        # Where a class leads to one state from everywhere, texts may be cut behind it.
        self.fixed = (table == table[0]).all(axis=0)
        self.ending = (table == 0).all(axis=0)
        # Per class the states that it can lead to.
        self.after = [np.unique(column) * self.width for column in table.T]

    def trace(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The classes of the bytes of all texts, each with an end behind it; the automaton's state
        after each of them; and where each text begins."""
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        symbols = np.full(int(sizes.sum()), self.width - 1, dtype=self.classes.dtype)
        for begin, text in zip(begins.tolist(), texts, strict=True):
            symbols[begin : begin + len(text)] = self.classes[text]
        return symbols, self._states(symbols), begins

    def _states(self, symbols: np.ndarray) -> np.ndarray:
        """One state vector passes over all lanes at once. A lane begins behind a byte that leads to
        one state from everywhere; a stretch without such bytes is cut anywhere, and its lanes run
        from every state that the bytes before leave possible, of which one turns out to be right."""
        out = np.zeros(len(symbols), dtype=np.int32)
        if not len(symbols):
            return out
        cuts = np.flatnonzero(self.fixed[symbols]) + 1
        near = np.searchsorted(cuts, np.arange(LANE, len(symbols), LANE))
        begins = np.unique(np.concatenate([[0], cuts[near[near < len(cuts)]]]))
        begins = begins[begins < len(symbols)]
        ends = np.append(begins[1:], len(symbols))
        known = np.zeros(len(begins), dtype=np.int32)
        known[1:] = self.targets[symbols[begins[1:] - 1]]  # row 0 of a column that is the same in all rows
        long = ends - begins > LONG
        self._run(symbols, begins[~long], ends[~long], known[~long], out, None)
        for begin, end, state in zip(begins[long].tolist(), ends[long].tolist(), known[long].tolist(), strict=True):
            self._stretch(symbols, begin, end, state, out)
        return out

    def _run(self, symbols, begins, ends, state, out, keep) -> np.ndarray:
        """Pass over lanes from their states; states go to ``out`` by place, or for each lane to ``keep``.
        Returns the last states."""
        order = np.argsort(begins - ends, kind="stable")
        at, state = begins[order], state[order].copy()
        sizes = (ends - begins)[order]
        active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0] if len(sizes) else 0), side="right")
        for t, k in enumerate(active.tolist()):
            here = at[:k] + t
            now = self.targets[state[:k] + symbols[here]]
            state[:k] = now
            if keep is None:
                out[here] = now
            else:
                keep[order[:k], t] = now
        last = np.empty_like(state)
        last[order] = state
        return last

    def _stretch(self, symbols, begin, end, state, out) -> None:
        """A long lane in pieces, some at a time."""
        for part in range(begin, end, PIECES * LANE):
            begins = np.arange(part, min(part + PIECES * LANE, end), LANE)
            lanes = [np.array([state], dtype=np.int32)]
            for at in begins[1:].tolist():
                before = symbols[at - WINDOW : at].tolist()
                possible = self.after[before[0]]
                for symbol in before[1:]:
                    if len(possible) > 1:
                        possible = np.unique(possible)
                    possible = self.targets[possible + symbol]
                possible = np.unique(possible)
                lanes.append(possible)
            owners = np.repeat(np.arange(len(begins)), [len(p) for p in lanes])
            starts = np.concatenate(lanes)
            ends = np.minimum(begins[owners] + LANE, end)
            keep = np.zeros((len(owners), LANE), dtype=np.int32)
            last = self._run(symbols, begins[owners], ends, starts, out, keep)
            for i, at in enumerate(begins.tolist()):
                lane = int(np.flatnonzero((owners == i) & (starts == state))[0])
                out[at : ends[lane]] = keep[lane, : ends[lane] - at]
                state = last[lane]

    def pieces(self, text: np.ndarray, size: int = 1 << 20) -> list[tuple[int, np.ndarray]]:
        """A text in pieces, each with its place, cut behind bytes at which every attempt ends, so that
        no match is cut. A piece is longer than ``size`` only where there is no such byte."""
        if len(text) <= size:
            return [(0, text)]
        ends = np.flatnonzero(self.ending[self.classes[text]]) + 1
        near = np.searchsorted(ends, np.arange(size, len(text), size))
        cuts = np.unique(ends[near[near < len(ends)]]).tolist()
        return [(a, text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def matches(self, symbols: np.ndarray, states: np.ndarray, which: int, least: int) -> list[tuple[int, int]]:
        """Begin and end of each match of an expression that is accepted over its last ``least`` bytes or
        more, by place in the traced bytes."""
        hits = np.flatnonzero(self.accepting[which][states])
        if not len(hits):
            return []
        breaks = np.flatnonzero(np.diff(hits) != 1)
        lows = hits[np.concatenate([[0], breaks + 1])]
        highs = hits[np.append(breaks, len(hits) - 1)]
        enough = highs - lows + 1 >= least
        return [
            (self._begin(symbols, states, which, low), high + 1)
            for low, high in zip(lows[enough].tolist(), highs[enough].tolist(), strict=True)
        ]

    def _begin(self, symbols: np.ndarray, states: np.ndarray, which: int, at: int) -> int:
        """Where the attempt began that is the earliest after the byte at a place."""
        table, attempt = self.tables[which], 0
        while True:
            before = self.states[states[at - 1] // self.width][which] if at else 0
            attempt = table.origins[before][symbols[at]][attempt]
            if attempt == NEW:
                return at
            at -= 1
