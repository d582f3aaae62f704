"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.rows import stored
from tableflow.llm.text import ALPHANUMERIC, Words, chunks, mix, prefix_hashes, span_hashes

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Small closed classes in the corpus's languages; insults are learned from labels.
CLASSES = {
    TARGET: "you your yours yourself u he she they them him her "
            "tu te toi vous du dich dir ihr euch sie usted ustedes ti",
    NEGATION: "not no never nobody isn aren don doesn didn wasn won cannot without "
              "pas jamais ne sans nicht kein keine nie ohne sin nunca jamás",
    REPORT: "said says say saying called calls wrote writes claimed quote quoted according "
            "dit disait écrit sagte sagt schrieb dijo dice escribió",
    THREAT: "tuer tuerai frapper frapperai brûler brûlerai étrangler étranglerai "
            "töten töte umbringen schlagen schlage verbrennen verbrenne erwürgen "
            "matar mataré golpear golpearé quemar quemaré estrangular",
}
THREAT_VERBS = "kill murder hurt harm destroy beat shoot stab burn hang strangle choke punch smash slaughter rape"
FACTORS = {"negated": 0.2, "reported": 0.5, "aimed": 1.5}
PREFIXES = (4, 5, 6)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".,;:!?\n|()"]] = True


# ---- the grammar -------------------------------------------------------------------------------

class Transducer:
    """States, a start, and a step from (state, symbol) to (state, symbol). Symbols are a token class with the
    marks that earlier transducers have put on it."""

    def __init__(self, start, step):
        self.start, self.step = start, step


def _countdown(opener: int, length: int, mark: str) -> Transducer:
    """Marks insults and threats that come within ``length`` tokens of the opener, in the direction of reading."""

    def step(left, symbol):
        kind, marks = symbol
        out = (kind, marks | {mark}) if left and kind in (INSULT, THREAT) else symbol
        return (length if kind == opener else max(0, left - 1)), out

    return Transducer(0, step)


def _after(opener: int, mark: str) -> Transducer:
    """Marks insults and threats anywhere after the opener in the clause."""

    def step(seen, symbol):
        kind, marks = symbol
        out = (kind, marks | {mark}) if seen and kind in (INSULT, THREAT) else symbol
        return seen or kind == opener, out

    return Transducer(False, step)


def _scorer(kind: int, needs: str | None) -> Transducer:
    """Turns a marked symbol of its kind into a weight; ``needs`` is a mark it can't do without."""

    def step(state, symbol):
        if isinstance(symbol, float) or symbol[0] != kind or (needs and needs not in symbol[1]):
            return state, symbol
        weight = 1.0
        for mark in symbol[1]:
            weight *= FACTORS[mark]
        return state, weight

    return Transducer(0, step)


# A token class without a mark, or with the one that the reading from the end puts on it.
SYMBOLS = [(kind, marks) for marks in (frozenset(), frozenset({"aimed"})) for kind in range(6)]


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list]]:
    """One automaton that runs the transducers in a cascade: tables of the next state and of what comes out,
    by state and symbol (their places in ``SYMBOLS``). Only states that can be reached are built."""
    states = [tuple(p.start for p in parts)]
    number = {states[0]: 0}
    follow, outputs = [], []
    for state in states:  # grows meanwhile
        to, out = [], []
        for symbol in SYMBOLS:
            after = []
            for part, s in zip(parts, state, strict=True):
                s, symbol = part.step(s, symbol)
                after.append(s)
            key = tuple(after)
            if key not in number:
                number[key] = len(states)
                states.append(key)
            to.append(number[key])
            out.append(symbol)
        follow.append(to)
        outputs.append(out)
    return follow, outputs


def lookahead() -> tuple[list[list[int]], list[list[int]]]:
    """Read from the end of a clause: what a target follows within four tokens is aimed. Gives places in ``SYMBOLS``."""
    follow, outputs = compose(_countdown(TARGET, 4, "aimed"))
    return follow, [[SYMBOLS.index(symbol) for symbol in row] for row in outputs]


def grammar() -> tuple[list[list[int]], list[list[float]]]:
    """Read from the start, after ``lookahead``: insults count where they stand, more if aimed at somebody before
    or after them, less if denied or only reported; threats count only if aimed."""
    follow, outputs = compose(
        _countdown(NEGATION, 3, "negated"), _after(REPORT, "reported"), _countdown(TARGET, 4, "aimed"),
        _scorer(INSULT, None), _scorer(THREAT, "aimed"),
    )
    return follow, [[out if isinstance(out, float) else 0.0 for out in row] for row in outputs]


# ---- features ----------------------------------------------------------------------------------

def _keys(words: Words) -> list[np.ndarray]:
    """Lexicon keys of every word: the whole word, and its first bytes."""
    sums = prefix_hashes(words.bytes)
    keys = [words.hashes]
    for size in PREFIXES:
        ends = np.minimum(words.starts + size, words.ends)
        key = span_hashes(sums, words.starts, ends) ^ np.uint64(size)
        key[words.ends - words.starts < size] = 0
        keys.append(key)
    return keys


def _forms(verb: str) -> list[str]:
    """The forms of an English verb by the rules of spelling: both with and without a doubled last letter."""
    stem = verb.removesuffix("e")
    doubled = [stem + stem[-1] + end for end in ("ed", "ing")] if verb == stem else []
    return [verb, f"{verb}s", f"{stem}ed", f"{stem}es", f"{stem}ing", *doubled]


def _fixed() -> tuple[np.ndarray, np.ndarray]:
    keys, kinds = [], []
    english = " ".join(form for verb in THREAT_VERBS.split() for form in _forms(verb))
    for kind, text in CLASSES.items():
        text = f"{text} {english}" if kind == THREAT else text
        for rows, data, begins in chunks(pa.array([text])):
            words = Words(rows, data, begins, ALPHANUMERIC)
            keys += words.hashes.tolist()
            kinds += [kind] * len(words.hashes)
    order = np.argsort(np.array(keys, dtype=np.uint64))
    return np.array(keys, dtype=np.uint64)[order], np.array(kinds)[order]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


class Grammar:
    """The composed grammar with an insult lexicon: sorted keys and their weights."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        self.keys, self.weights = keys, weights
        self.fixed = _fixed()
        self.follow, self.out = grammar()
        self.back, self.marked = lookahead()

    def features(self, rows: int, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Per row, as log1p: total weight of matched clauses, their number, the greatest one, and the
        total for the text's length."""
        words = Words(rows, data, begins, ALPHANUMERIC)
        weight = np.zeros(len(words.hashes))
        for key in _keys(words):
            np.maximum(weight, _lookup(self.keys, self.weights, key, 0.0), out=weight)
        kinds = _lookup(*self.fixed, words.hashes, OTHER)
        threat = kinds == THREAT
        kinds = np.where((weight > 0) & ~threat, INSULT, kinds)
        weight = np.where(threat, np.maximum(weight, 1.0), weight)
        # Clauses: the number of clause ends before a word, counted over the chunk, and its row.
        ends = np.cumsum(_ENDS[data]) if len(data) else np.zeros(0, dtype=np.int64)
        clause = ends[words.starts] if len(words.starts) else np.zeros(0, dtype=np.int64)
        out = np.zeros((rows, 4))
        hits = np.flatnonzero((kinds == INSULT) | threat)
        done = -1
        for i in hits.tolist():
            if i <= done:
                continue
            row, here = words.row[i], clause[i]
            a = i
            while a > words.bounds[row] and clause[a - 1] == here:
                a -= 1
            b = i + 1
            while b < words.bounds[row + 1] and clause[b] == here:
                b += 1
            done, state, total, symbols = b - 1, 0, 0.0, []
            for kind in kinds[a:b][::-1].tolist():
                symbols.append(self.marked[state][kind])
                state = self.back[state][kind]
            state = 0
            for symbol, w in zip(reversed(symbols), weight[a:b].tolist(), strict=True):
                total += self.out[state][symbol] * w
                state = self.follow[state][symbol]
            if total > 0:
                out[row, 0] += total
                out[row, 1] += 1
                out[row, 2] = max(out[row, 2], total)
        out[:, 3] = out[:, 0] / np.log(3.0 + words.counts)
        return np.log1p(out)


# ---- learning ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Lexicon keys with weights, and the coefficients of the features, the constant last."""

    keys: np.ndarray
    lexicon: np.ndarray
    coefficients: np.ndarray

    def score(self, docs: DataFrame, text: Column) -> Column:
        """Column: probability, 0 to 1, that a text is toxic; null texts count as empty."""
        shared = docs.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = shared.value
            matcher = Grammar(model.keys, model.lexicon)
            for texts in batches:
                found = [matcher.features(*c) for c in chunks(texts)]
                x = np.concatenate(found) if found else np.zeros((0, 4))
                z = np.clip(x @ model.coefficients[:-1] + model.coefficients[-1], -30, 30)
                yield pa.array(1 / (1 + np.exp(-z)))

        return compute(text)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, train: Column, doc_id: str, text: str, label: str, size: int
) -> tuple[DataFrame, float]:
    """At most ``size`` toxic and three times as many clean rows of those where ``train`` holds, in
    the order of a hash of the id, with their texts; and the share of toxic rows among all of them."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("toxic")).where(train)
    rows = rows.where("toxic in (0, 1)").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    share = rows.agg(F.avg("toxic")).first()[0]
    mixed = F.xxhash64("id", F.lit("sample"))
    picked = [
        rows.where(F.col("toxic") == k).orderBy(mixed, "id").limit(n) for k, n in ((1, size), (0, 3 * size))
    ]
    picked = F.broadcast(picked[0].union(picked[1]))  # at most 4 * size ids
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2))
    found = texts.join(picked, "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    return found.withColumn("half", half), share


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, context, half, toxic, n). For each toxic document one occurrence of each key, that with
    the least hash of the word before, so that near copies of a document give equal rows; for clean
    documents the number of documents that have the key."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        half = batch.column("half").to_numpy(zero_copy_only=False).astype(np.int64)
        base = 0
        for rows, data, begins in chunks(batch.column("text")):
            words = Words(rows, data, begins, ALPHANUMERIC)
            before = np.zeros(len(words.hashes), dtype=np.uint64)
            before[1:] = mix(words.hashes[:-1])
            keys = _keys(words)
            key, row = np.concatenate(keys), np.tile(words.row, len(keys))
            context = np.tile(before, len(keys))
            order = np.lexsort((context, key, row))
            key, row, context = key[order], row[order], context[order]
            first = np.ones(len(key), dtype=bool)
            first[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            first &= key != 0
            key, row, context = key[first], row[first] + base, context[first]
            bad = toxic[row]
            for k in (0, 1):
                clean, n = np.unique(key[~bad & (half[row] == k)], return_counts=True)
                yield _rows(clean, np.zeros(len(clean), np.uint64), k, False, n)
                mine = bad & (half[row] == k)
                yield _rows(key[mine], context[mine], k, True, np.ones(mine.sum(), np.int64))
            base += rows


def _rows(key, context, half: int, toxic: bool, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), pa.array(np.full(len(key), half, np.int32)),
         pa.array(np.full(len(key), toxic)), pa.array(n.astype(np.int64))],
        ["key", "context", "half", "toxic", "n"],
    )


class Counts:
    """How many toxic and clean documents of each half of the sample hold each key."""

    def __init__(self, sample: DataFrame):
        found = sample.select("text", "toxic", "half").mapInArrow(
            _occurrences, "key long, context long, half int, toxic boolean, n long"
        )
        once = found.groupBy("key", "context", "half", "toxic").agg(F.sum("n").alias("n"))
        sums = {
            f"{name}{k}": F.sum(F.when((F.col("half") == k) & (F.col("toxic") == toxic), n).otherwise(0))
            for k in (0, 1) for name, toxic, n in (("t", True, F.lit(1)), ("c", False, F.col("n")))
        }
        table = once.groupBy("key").agg(*(v.alias(c) for c, v in sums.items())).where("t0 + t1 >= 3")
        self.table = stored(sample.sparkSession, table, "keys")
        self.docs = {(r.half, r.toxic): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}

    def lexicon(self, halves: tuple[int, ...], most: int, bound: float = 1.5) -> tuple[np.ndarray, np.ndarray]:
        """Keys that toxic documents hold far more often: log ratio of the shares of toxic and clean
        documents, less 1.64 standard errors, at least ``bound``; the ``most`` heaviest ones."""
        toxic, clean = (sum(self.docs.get((k, y), 0) for k in halves) for y in (1, 0))
        if not toxic or not clean:
            return np.zeros(0, dtype=np.uint64), np.zeros(0)
        t, c = (sum((F.col(f"{x}{k}") for k in halves), F.lit(0.5)) for x in "tc")
        weight = F.log(t / toxic) - F.log(c / clean) - 1.64 * F.sqrt(1 / t + 1 / c)
        table = self.table.withColumn("weight", weight).where((F.col("weight") >= bound) & (t >= 3))
        rows = table.orderBy(F.desc("weight"), "key").limit(most).collect()
        keys = np.array([r.key for r in rows], dtype=np.int64).view(np.uint64)
        order = np.argsort(keys)
        return keys[order], np.array([r.weight for r in rows])[order]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (s - y) + ridge * w
        hessian = (x * (s * (1 - s))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", sample: int = 2000, most: int = 2000,
) -> Model:
    """The model learned from the labels of rows where ``train`` (a condition on ``doc_id``) holds.

    A bounded sample (``sample`` toxic and three times as many clean rows at most) gives the
    lexicon, the ``most`` heaviest keys. Rows that repeat count as often as they stand in the sample, but
    a word after the same word is counted once among toxic ones; ties of weight go by key. The coefficients of the grammar's features come from the same rows, each half measured
    with a lexicon of the other half, so that words of a single document don't count as signs. The
    constant is then moved to the share of toxic rows among all training labels. Nothing but text
    and label is used. Without labels of both kinds the score is the share of toxic rows (one half
    without any).
    """
    rows, share = labelled_sample(docs, labels, train, doc_id, text, label, sample)
    rows = stored(docs.sparkSession, rows, "sample")
    prior = 0.5 if share is None else min(max(share, 1e-3), 1 - 1e-3)
    counts = Counts(rows)
    found = [_measured(rows.where(F.col("half") == k), *counts.lexicon((1 - k,), most)) for k in (0, 1)]
    x, y = (np.concatenate(c) for c in zip(*found, strict=True))
    keys, lexicon = counts.lexicon((0, 1), most)
    if len(set(y.tolist())) < 2:
        return Model(keys, lexicon, np.array([0, 0, 0, 0, np.log(prior / (1 - prior))]))
    coefficients = _logistic(x, y)
    coefficients[-1] += np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))
    return Model(keys, lexicon, coefficients)


def _measured(rows: DataFrame, keys: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a part of the bounded sample."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Grammar(keys, lexicon)
        for batch in batches:
            found = [matcher.features(*c) for c in chunks(batch.column("text"))]
            if found:
                x = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[:, i]) for i in range(4)), batch.column("toxic")],
                    ["a", "b", "c", "d", "toxic"],
                )

    table = rows.select("text", "toxic").mapInArrow(
        measure, "a double, b double, c double, d double, toxic int"
    ).toArrow()
    x = np.column_stack([table[c].to_numpy() for c in "abcd"]).reshape(-1, 4)
    return x, table["toxic"].to_numpy().astype(float)
