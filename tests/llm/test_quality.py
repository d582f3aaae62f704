import numpy as np
import pytest
from common import clashing, table, texts

from pyspark.sql import functions as F
from tableflow.llm import quality
from tableflow.llm.queries import op4_quality_classifier
from tableflow.llm.text import fold

LABELS = "doc_id long, quality int, toxic int"


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for s in set(scores):
        same = scores == s
        ranks[same] = ranks[same].mean()
    n = truth.sum()
    return (ranks[truth == 1].sum() - n * (n + 1) / 2) / (n * (len(truth) - n))


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    out = op4_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    return out.toPandas()


def test_held_out_accuracy(scored):
    held = scored[scored.held_out & scored.quality.notna()]
    assert len(held) > 80
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97
    assert (held.predicted == held.quality).mean() > 0.93
    assert scored.score.between(0, 1).all() and len(scored) == 1000


def test_folds_are_by_checksum(scored):
    import zlib

    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(scored.doc_id, scored.held_out, strict=True))


def test_the_best_bin_gives_the_prior():
    g = np.random.default_rng(0)
    for prior in (0.3, 0.87):
        positive = np.histogram(g.beta(6, 2, 50_000), quality.BINS, (0, 1))[0]
        mixed = np.concatenate([g.beta(6, 2, int(prior * 50_000)), g.beta(2, 6, int((1 - prior) * 50_000))])
        unlabelled = np.histogram(mixed, quality.BINS, (0, 1))[0]
        assert abs(quality.estimated_prior(positive, unlabelled) - prior) < 0.05


def test_negative_and_held_out_labels_are_not_looked_at(spark):
    docs = table(spark, texts())
    labels = [(i, int(i % 3 > 0), 0) for i in range(30)]
    changed = [(i, q if q == 1 and i % 2 else 0, 0) for i, q, _ in labels]  # held out rows turned to 0
    train = F.col("doc_id") % 2 == 1
    found = [
        quality.fit(quality.featured(docs, spark.createDataFrame(rows, LABELS), train)).weights
        for rows in (labels, changed, [r for r in changed if r[1]])
    ]
    assert np.allclose(found[0], found[1], atol=1e-9) and np.allclose(found[0], found[2], atol=1e-9)


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    values = texts()
    docs = table(spark, values)
    labels = spark.createDataFrame([(0, 1, 0), (10, 1, 1), (10, 0, 0), (None, 1, 0), (12, None, None), (10, 1, 1)], LABELS)
    train = fold(F.col("doc_id"), 3) != 5
    rows = quality.featured(clashing(docs, "x", "positive", "id", "marked"), labels, train)
    assert rows.count() == len(values) and rows.where("positive").count() == 2
    model = quality.fit(rows)
    scores = [r.s for r in rows.select(model.score(F.col("x")).alias("s")).collect()]
    assert all(0 <= s <= 1 for s in scores)
    none = quality.featured(docs, labels.limit(0), train)
    assert {r.s for r in none.select(quality.fit(none).score(F.col("x")).alias("s")).collect()} == {0.5}
    empty = quality.featured(docs.limit(0), labels, train)
    assert quality.fit(empty).rounds == 0 and empty.count() == 0


def test_features_of_a_row_don_t_depend_on_its_neighbours(spark):
    values = texts()
    one = table(spark, values).repartition(1).sortWithinPartitions("doc_id")
    many = table(spark, values).repartition(20)
    found = [
        {r.doc_id: tuple(r.x) for r in df.select("doc_id", quality.features(F.col("text")).alias("x")).collect()}
        for df in (one, many)
    ]
    assert found[0] == found[1]
