from collections import Counter

from common import SPACES, clashing, table, texts

from pyspark.sql import functions as F
from tableflow.llm.queries import op8_quality_rules
from tableflow.llm.rules import base_rules, quality_rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute_force(text):
    text = text or ""
    words = SPACES.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if SPACES.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_base_rules_equal_brute_force(spark):
    values = [*texts(), "a b c d e f a b c d e g", "# | a$\n# | a$\n\n\n x", "a b c d e " * 3, "1 2 3 4 5 6 " * 9]
    rows = base_rules(table(spark, values)).select("doc_id", *NAMES).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: brute_force(t) for i, t in enumerate(values)}


def test_ratio_tells_trusted_text_from_the_rest(spark):
    good = [f"the cat number {i} sat on the mat and looked at the {i} dogs in the garden" for i in range(60)]
    bad = [f"$$ buy {i} now ## click {i} ** cheap || pills {i} && win %% {i} cash >> now" for i in range(60)]
    docs = table(spark, good + bad)
    target = docs.where("doc_id < 30").select(F.col("doc_id").alias("id"))
    rows = {r.doc_id: r for r in quality_rules(docs, target, buckets=500).collect()}
    assert all(rows[i].kept for i in range(60)) and not any(rows[i].kept for i in range(60, 120))
    again = {r.doc_id: r.ratio for r in quality_rules(docs.repartition(7), target, buckets=500).collect()}
    assert again == {i: r.ratio for i, r in rows.items()}


def test_no_trusted_rows_no_rows_repeats_and_clashing_columns(spark):
    docs = table(spark, texts(copies=3))
    none = docs.limit(0).select(F.col("doc_id").alias("id"))
    rows = quality_rules(clashing(docs, "ratio", "kept", "bucket", "t", "g", "raw"), none).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert quality_rules(docs.limit(0), none).count() == 0
    twice = docs.union(docs)
    target = twice.where("doc_id in (10, 12)").select(F.col("doc_id").alias("id"))
    found = quality_rules(twice, target).groupBy("doc_id").agg(F.count_distinct("ratio", "kept").alias("n"))
    assert {r.n for r in found.collect()} == {1}
    assert twice.count() == quality_rules(twice, target).count()


def test_query_is_native_and_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    df = op8_quality_rules(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
    values = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id: tuple(r[c] for c in NAMES) for r in df.collect()}
    assert found == {i: brute_force(t) for i, t in values.items()}
