"""Quality classifier by positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.rows import stored
from tableflow.llm.text import SPACED, Words, chunks

FEATURES = (
    "length", "shortness", "symbols", "digits", "capitals", "stops", "non_ascii", "spaces", "line_feeds",
    "word_length", "odd_words", "symbol_words", "distinct", "top_word", "adjacent", "repeated_grams",
)
N = len(FEATURES) + 1  # with the constant
_CLASS = np.zeros(256, dtype=np.uint8)
for _k, _chars in enumerate(("#*$%&|<>@^~=_{}[]\\/", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                             ".,;:!?", "", " \t\r\x0b\x0c", "\n"), start=1):
    _CLASS[[ord(c) for c in _chars]] = _k
_CLASS[128:] = 5


def _features(rows: int, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    words = Words(rows, data, begins, SPACED)
    size = np.maximum(np.diff(begins), 1)
    n = np.maximum(words.counts, 1)
    row_of = np.repeat(np.arange(rows), np.diff(begins))
    kinds = np.bincount(row_of * 8 + _CLASS[data], minlength=8 * rows).reshape(rows, 8)
    lengths = words.ends - words.starts
    symbols = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(_CLASS[data] == 1, out=symbols[1:])
    plain = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum((_CLASS[data] == 0) | (_CLASS[data] == 3) | (_CLASS[data] == 5), out=plain[1:])
    h, row = words.hashes, words.row
    # Frequencies of words and grams within each row: sorted together with the row.
    distinct, top = _frequencies(h, row, rows)
    grams, whole = words.grams(3)
    gram_row = row[: len(grams)][whole]
    distinct_grams, _ = _frequencies(grams[whole], gram_row, rows)
    n_grams = np.maximum(np.bincount(gram_row, minlength=rows), 1)
    adjacent = np.zeros(len(h))
    adjacent[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    share = np.sqrt(kinds / size[:, None])
    return np.column_stack([
        np.log1p(words.counts), 1 / (1 + words.counts), share[:, 1], share[:, 2], share[:, 3],
        share[:, 4], share[:, 5], share[:, 6], share[:, 7], words.total(lengths) / n,
        np.sqrt(words.total(plain[words.ends] == plain[words.starts]) / n),
        np.sqrt(words.total(symbols[words.ends] > symbols[words.starts]) / n),
        distinct / n, np.sqrt(top / n), np.sqrt(words.total(adjacent) / n),
        np.sqrt(1 - np.minimum(distinct_grams, n_grams) / n_grams) * (np.bincount(gram_row, minlength=rows) > 0),
    ])


def _frequencies(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the number of distinct hashes and the count of the most frequent one."""
    if not len(h):
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]))
    counts = np.diff(np.append(first, len(h)))
    top = np.zeros(rows)
    np.maximum.at(top, row[first], counts)
    return np.bincount(row[first], minlength=rows), top


def features(text: Column) -> Column:
    """Column: array of the numbers in ``FEATURES``, of a whole text; a null is an empty text."""

    @F.arrow_udf("array<double>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [_features(*c) for c in chunks(texts)]
            flat = np.concatenate(found).ravel() if found else np.zeros(0)
            offsets = np.arange(0, len(flat) + 1, N - 1, dtype=np.int32)
            yield pa.ListArray.from_arrays(offsets, flat)

    return compute(text)


@dataclass(frozen=True)
class Model:
    """A linear score of standardised features, the class prior, and the number of rounds."""

    weights: tuple[float, ...]  # of the raw features, the constant last
    prior: float
    rounds: int

    def score(self, x: Column) -> Column:
        """Probability, 0 to 1, that the row is of the positive class."""
        z = F.lit(self.weights[-1])
        for i, w in enumerate(self.weights[:-1]):
            z = z + F.lit(w) * x[i]
        # Within the range where the exponential neither overflows nor rounds the score to 1.
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def _moments(table: DataFrame, weights: np.ndarray, center: np.ndarray, scale: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over all rows: for the positives and the unlabelled, numbers, losses, gradients and the
    unlabelled's Hessian, and histograms of the score. Tasks add up in numpy, and Spark adds the
    tasks' sums, so a few hundred numbers reach the driver whatever the input."""
    triangle = np.triu_indices(N)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 + 2 * N + len(triangle[0]) + 2 * BINS)
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            x = np.ones((batch.num_rows, N))
            x[:, :-1] = (flat.reshape(-1, N - 1) - center) / scale
            positive = batch.column("positive").to_numpy(zero_copy_only=False)
            z = np.clip(x @ weights, -30, 30)
            s = 1 / (1 + np.exp(-z))
            as_negative = np.logaddexp(0, z)  # loss if taken for a negative
            bins = np.minimum((s * BINS).astype(int), BINS - 1)
            total += np.concatenate([
                [positive.sum(), len(s), as_negative[positive].sum(), as_negative.sum()],
                x[positive].sum(axis=0), (x * s[:, None]).sum(axis=0),
                ((x * (s * (1 - s))[:, None]).T @ x)[triangle],
                np.bincount(bins[positive], minlength=BINS), np.bincount(bins, minlength=BINS),
            ])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"]
        )

    sums = table.select("x", "positive").mapInArrow(add_up, "i int, v double")
    rows = sums.groupBy("i").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(4 + 2 * N + len(triangle[0]) + 2 * BINS)
    for r in rows:
        v[r.i] = r.v
    parts = np.split(v, np.cumsum([4, N, N, len(triangle[0]), BINS]))
    hessian = np.zeros((N, N))
    hessian[triangle] = parts[3]
    hessian = hessian + np.triu(hessian, 1).T
    return {"sums": parts[0], "xp": parts[1], "sxu": parts[2], "hessian": hessian, "hp": parts[4], "hu": parts[5]}


BINS = 200


def estimated_prior(hp: np.ndarray, hu: np.ndarray) -> float:
    """Share of positives among the unlabelled, by the best bin: above any score, unlabelled mass over
    positive mass is at least the prior, and close to it where hardly any negatives score so high.
    The least of these ratios counts, each raised by its sampling error."""
    p, u = np.cumsum(hp[::-1]), np.cumsum(hu[::-1])
    n_p, n_u = max(p[-1], 1), max(u[-1], 1)
    error = np.sqrt(np.log(4 * BINS) / (2 * n_p)) + np.sqrt(np.log(4 * BINS) / (2 * n_u))
    use = p > 0
    ratios = (u[use] / n_u + error) / (p[use] / n_p)
    lowest = int(np.argmin(ratios)) if len(ratios) else 0
    if not len(ratios):
        return 0.5
    return float(np.clip((u[use] / n_u)[lowest] / (p[use] / n_p)[lowest], 0.02, 0.98))


def fit(table: DataFrame, rounds: int = 12, priors: int = 3, ridge: float = 1e-3) -> Model:
    """The model of a table of ``x`` (features) and ``positive`` (trusted positive, else unlabelled).

    The risk is that of positive-unlabelled learning with the logistic loss: with the class prior p,
    p E+[l(z)] + max(0, E[l(-z)] - p E+[l(-z)]). All rows count as unlabelled, the positives among
    them; no negative label is used. As l(z) - l(-z) = -z, the risk is convex while the second term is
    positive, and Newton steps over sums of all rows minimise it. Where a step would make that
    term negative, it is halved, so the non-negative risk is never left. The prior is estimated from
    the scores (see :func:`estimated_prior`), and the model is fitted again with it.

    Every round reads all rows, with no sample. Without positives every score is 0.5.
    """
    base = table.agg(
        F.count("*"),
        *(f(F.col("x")[i]) for i in range(N - 1) for f in (F.avg, F.stddev_pop)),
    ).first()
    if not base[0]:
        return Model((0.0,) * N, 0.5, 0)
    center = np.array([base[1 + 2 * i] or 0.0 for i in range(N - 1)])
    scale = np.array([base[2 + 2 * i] or 0.0 for i in range(N - 1)])
    scale[scale < 1e-9] = 1.0
    weights, prior, done = np.zeros(N), 0.5, 0
    for k in range(priors + 1):
        weights = np.zeros(N)
        accepted, step = None, None
        for _ in range(rounds):
            m = _moments(table, weights, center, scale)
            done += 1
            n_p, n_u, neg_p, neg_u = m["sums"]
            if not n_p:
                return Model((0.0,) * N, 0.5, done)
            negative = neg_u / n_u - prior * neg_p / n_p
            risk = -prior * (m["xp"] @ weights) / n_p + neg_u / n_u + ridge / 2 * weights @ weights
            if accepted is not None and (negative < 0 or risk > accepted[0] + 1e-12):
                step = step / 2
                if np.abs(step).max() < 1e-3:
                    weights, m = accepted[1], accepted[2]
                    break
                weights = accepted[1] + step
                continue
            if accepted is not None and accepted[0] - risk < 1e-5:
                break
            accepted = (risk, weights, m)
            penalty = ridge * np.eye(N)
            gradient = -prior * m["xp"] / n_p + m["sxu"] / n_u + ridge * weights
            step = -np.linalg.solve(m["hessian"] / n_u + penalty, gradient)
            weights = weights + step
        else:
            weights, m = accepted[1], accepted[2]
        if k == priors:
            break
        found = estimated_prior(m["hp"], m["hu"])
        if abs(found - prior) < 0.005:
            break
        prior = found
    raw = weights[:-1] / scale
    return Model((*raw.tolist(), float(weights[-1] - raw @ center)), prior, done)


def featured(
    docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """``id``, ``x`` and ``positive`` of every document, stored. Trusted positives are the documents
    whose label is 1 on rows where ``train`` (a condition on ``doc_id``) holds; what else the
    labels say is not looked at. Null ids and labels are no positives, and an id is positive if
    any of its label rows is."""
    spark = docs.sparkSession
    positives = labels.select("doc_id", label).where(train).where(F.col(label) == 1)
    positives = positives.select(F.col("doc_id").alias("id"), F.lit(True).alias("marked")).distinct()
    rows = docs.select(F.col(doc_id).alias("id"), features(F.col(text)).alias("x"))
    rows = rows.join(positives, "id", "left")
    return stored(spark, rows.select("id", "x", F.coalesce("marked", F.lit(False)).alias("positive")), "features")
