import numpy as np
import pyarrow as pa
import pytest
from common import clashing, table, texts
from test_quality import auc

from pyspark.sql import functions as F
from tableflow.llm import toxicity
from tableflow.llm.queries import op10_toxicity
from tableflow.llm.text import ALPHANUMERIC, Words, chunks


def matcher(*insults):
    words = Words(*next(chunks(pa.array([" ".join(insults)]))), ALPHANUMERIC)
    keys = np.sort(words.hashes)
    return toxicity.Grammar(keys, np.ones(len(keys)))


def weight(text, grammar=matcher("idiot", "moron")):
    found = np.expm1(grammar.features(*next(chunks(pa.array([text])))))
    return round(float(found[0, 0]), 6)


def test_clauses_are_scored_by_the_composed_grammar():
    assert weight("what a lovely day") == 0
    assert weight("an idiot here") == 1.0
    assert weight("you are an IDIOT") == 1.5
    assert weight("you are not an idiot") == pytest.approx(0.3)
    assert weight("they said you are an idiot") == 0.75
    assert weight("they said you are not an idiot") == pytest.approx(0.15)
    assert weight("he said. idiot") == 1.0  # another clause
    assert weight("not today, moron") == 1.0
    assert weight("idiot moron") == 2.0
    assert weight("kill time") == 0  # a threat without a target
    assert weight("I will kill you") == 1.5  # the target comes after
    assert weight("you I kill") == 1.5 and weight("you I kill you") == 1.5
    assert weight("I am going to murder you tonight") == weight("they keep stabbing him") == 1.5
    assert weight("I will not hurt you") == pytest.approx(0.3)
    assert weight("she said I will strangle him") == 0.75
    assert weight("kill time. you see") == 0  # the target is in another clause
    assert weight("kill one two three four you") == 0  # too far
    assert weight("idiot that you are") == 1.5
    assert weight("") == 0 and weight(".,;") == 0


def test_composition_runs_the_cascade():
    follow, out = toxicity.grammar()
    assert len(follow) == len(out) and all(len(r) == len(toxicity.SYMBOLS) for r in follow)
    assert all(0 <= s < len(follow) for r in follow for s in r)
    state = follow[0][toxicity.NEGATION]
    assert out[state][toxicity.INSULT] == toxicity.FACTORS["negated"]


def by_rules(kinds):
    """A clause's weight by looking around each token, with no automaton."""
    total = 0.0
    for i, kind in enumerate(kinds):
        near = kinds[max(0, i - 4):i] + kinds[i + 1:i + 5]
        if kind in (toxicity.INSULT, toxicity.THREAT):
            factor = toxicity.FACTORS["aimed"] if toxicity.TARGET in near else float(kind == toxicity.INSULT)
            if toxicity.NEGATION in kinds[max(0, i - 3):i]:
                factor *= toxicity.FACTORS["negated"]
            if toxicity.REPORT in kinds[:i]:
                factor *= toxicity.FACTORS["reported"]
            total += factor
    return total


def test_the_grammar_equals_rules_applied_to_each_token():
    word = {
        toxicity.OTHER: "table", toxicity.INSULT: "moron", toxicity.THREAT: "kill", toxicity.TARGET: "you",
        toxicity.NEGATION: "not", toxicity.REPORT: "said",
    }
    rng = np.random.default_rng(7)
    for _ in range(300):
        clauses = [rng.integers(0, 6, rng.integers(0, 14)).tolist() for _ in range(rng.integers(1, 4))]
        text = ". ".join(" ".join(word[k] for k in c) for c in clauses)
        assert weight(text) == pytest.approx(sum(map(by_rules, clauses)), abs=1e-5), text


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    out = op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    return out.toPandas()


def test_held_out_accuracy(scored):
    import zlib

    held = scored[scored.held_out & scored.toxic.notna()]
    assert len(held) > 80
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.8
    assert (held.predicted == held.toxic).mean() > 0.93
    assert scored.score.between(0, 1).all() and len(scored) == 1000
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(scored.doc_id, scored.held_out, strict=True))


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    values = [*texts(), *["you idiot. you moron"] * 30, *["a calm day by the sea"] * 30]
    docs = table(spark, values)
    n = len(texts())
    labels = spark.createDataFrame(
        [(i, 1, int(n <= i < n + 30)) for i in range(len(values))] + [(None, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    train = F.lit(True)
    other = clashing(docs, "score", "toxic", "key", "half", "id")
    model = toxicity.fit(other, labels, train)
    found = [r.s for r in other.union(other).select(model.score(docs, F.col("text")).alias("s")).collect()]
    assert len(found) == 2 * len(values) and all(0 <= s <= 1 for s in found)
    nothing = toxicity.fit(docs, labels.limit(0), train)
    assert {r.s for r in docs.select(nothing.score(docs, F.col("text")).alias("s")).collect()} == {0.5}
    model = toxicity.fit(docs.limit(0), labels, train)
    assert docs.limit(0).select(model.score(docs, F.col("text"))).count() == 0


def test_held_out_labels_are_not_looked_at(spark):
    docs = table(spark, [*["you idiot. you moron"] * 30, *["a calm day by the sea"] * 30])
    rows = [(i, 1, int(i < 30)) for i in range(60)]
    train = F.col("doc_id") % 2 == 0
    models = [
        toxicity.fit(docs, spark.createDataFrame(r, "doc_id long, quality int, toxic int"), train)
        for r in (rows, [(i, q, t if i % 2 == 0 else 1 - t) for i, q, t in rows])
    ]
    assert np.array_equal(models[0].coefficients, models[1].coefficients)
