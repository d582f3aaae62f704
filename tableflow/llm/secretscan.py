"""Secrets in texts: all rules in one automaton, which passes over the bytes once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.automaton import Scanner
from tableflow.llm.text import chunks


class Rule(NamedTuple):
    """A secret is ``head`` and then ``tail`` as often as it goes, at least ``least`` times. A match with
    fewer is none, but its text isn't searched again."""

    kind: str
    head: str
    tail: str
    least: int

    @property
    def expression(self) -> str:
        return f"{self.head}{self.tail}+"


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


BASE = (
    Rule("assign", _any_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?""",
         "[A-Za-z0-9+/_.=-]", 6),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
)
# Public formats of keys and tokens.
MORE = (
    Rule("github", "gh[oprsu]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abeprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("stripe", "[rs]k_live_", "[A-Za-z0-9]", 16),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 10),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY----", "-", 1),
    Rule("bearer", _any_case("bearer") + r"\x20+", "[A-Za-z0-9._~+/-]", 20),
)

SPANS = "array<struct<kind:string,start:long,end:long>>"
_FIELDS = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def spans(scanner: Scanner, rules: tuple[Rule, ...], texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Per text its secrets as begin, number of the rule and end, in this order; places count characters."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    parts = [(row, at, piece) for row, text in enumerate(texts) for at, piece in scanner.pieces(text)]
    for group in _grouped(parts, 1 << 20):
        symbols, states, begins = scanner.trace([piece for _, _, piece in group])
        for which, rule in enumerate(rules):
            for low, high in scanner.matches(symbols, states, which, rule.least):
                part = int(np.searchsorted(begins, low, side="right")) - 1
                row, at, _ = group[part]
                shift = at - int(begins[part])
                found[row].append((low + shift, which, high + shift))
    for row, text in enumerate(texts):
        if found[row]:
            characters = np.zeros(len(text) + 1, dtype=np.int64)
            np.cumsum((text & 0xC0) != 0x80, out=characters[1:])
            found[row] = [(int(characters[a]), k, int(characters[b])) for a, k, b in sorted(found[row])]
    return found


def _grouped(parts: list[tuple[int, int, np.ndarray]], size: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    group, held = [], 0
    for part in parts:
        if group and held + len(part[2]) > size:
            yield group
            group, held = [], 0
        group.append(part)
        held += len(part[2])
    if group:
        yield group


def find_secrets(spark: SparkSession, text: Column, rules: tuple[Rule, ...] = BASE + MORE) -> Column:
    """Column: the spans of all secrets in whole texts, by start and then in the order of the rules.

    Each rule is searched on its own, leftmost matches first, the longest at each place, and matches of
    one rule don't overlap; those of different rules may. Places count characters, the end is
    exclusive. Null and empty texts have no spans; repeated rows get equal ones; an empty table gives an
    empty one. No other column is looked at. The automaton, whose size depends on the rules alone, is
    compiled once and broadcast. Long texts pass in pieces of a megabyte, cut where no match can go on;
    only a stretch without such a byte (of letters and spaces, say) is held whole, at about 30 bytes a byte.
    """
    shared = spark.sparkContext.broadcast(Scanner([r.expression for r in rules]))
    names = [r.kind for r in rules]

    @F.arrow_udf(SPANS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            out = []
            for _, data, begins in chunks(values):
                texts = [data[a:b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
                out += [
                    [{"kind": names[k], "start": a, "end": b} for a, k, b in row]
                    for row in spans(shared.value, rules, texts)
                ]
            yield pa.array(out, type=pa.list_(_FIELDS))

    return found(text)
