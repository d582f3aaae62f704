"""Each stage of the pipeline against a brute-force version, on all rows of the smallest tables."""

import sys
from pathlib import Path

import numpy as np
import pytest
from common import SPACES
from test_linedup import brute_force as removed_lines
from test_packing import check as check_bins
from test_simhash import similar_groups
from test_winnowing import brute_force as overlaps

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402
from tableflow.llm import quality  # noqa: E402
from tableflow.llm.rows import stored  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """The input, then the table after each stage."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        out.append(stored(spark, stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(spark, tables):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "packing"]
    for df in tables[1:-1]:
        assert df.dtypes == tables[0].dtypes
    counts = [df.count() for df in tables[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 50


def test_quality_stage_keeps_what_the_model_accepts(spark, tables):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.featured(tables[0], labels, pipeline.fold(pipeline.F.col("doc_id"), 3) != 1)
    model = quality.fit(rows)
    x = {r.id: np.array(r.x) for r in rows.collect()}
    weights = np.array(model.weights)
    accepted = {i for i, v in x.items() if v @ weights[:-1] + weights[-1] >= 0}
    assert set(texts(tables[1])) == accepted
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(bad & accepted) <= 0.2 * len(bad) and len(good - accepted) <= 0.25 * len(good)  # 200 documents


def test_line_stage_equals_brute_force(tables):
    before, after = texts(tables[1]), texts(tables[2])
    ids = sorted(before)
    expected = {}
    for i, gone in zip(ids, removed_lines([(i, before[i]) for i in ids], 5, 50), strict=True):
        left = "\n".join(x for k, x in enumerate(before[i].split("\n")) if k not in set(gone))
        if not gone or SPACES.search(left):
            expected[i] = left
    assert after == expected and after != before
    assert all(r.n_chars == len(r.text) for r in tables[2].collect())


def test_near_duplicate_stage_keeps_one_of_each_group(tables):
    before = texts(tables[2])
    ids = sorted(before)
    least = similar_groups([before[i] for i in ids], ids)
    assert set(texts(tables[3])) == set(least.values()) and len(tables[3].columns) == len(tables[2].columns)


def test_benchmark_stage_drops_what_overlaps(spark, tables):
    before = texts(tables[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = sorted(before)
    clean = {i for i, o in zip(ids, overlaps([before[i] for i in ids], items), strict=True) if not o[1]}
    assert set(texts(tables[4])) == clean and len(clean) < len(ids)


def test_packing_stage_packs_every_word(tables):
    docs = tables[4].collect()
    index = {d.doc_id: k for k, d in enumerate(sorted(docs, key=lambda d: d.doc_id))}
    rows = [_Row(r, index[r.doc_id]) for r in tables[5].collect()]
    ordered = sorted(docs, key=lambda d: d.doc_id)
    check_bins(rows, [d.text for d in ordered], 2048, dict(enumerate(d.source for d in ordered)))


class _Row:
    """A packed row whose document is numbered in order."""

    def __init__(self, row, number):
        for name in ("bin", "slot", "part", "start", "n_tokens", "source", "cluster"):
            setattr(self, name, row[name])
        self.doc_id = number


def test_run_gives_the_last_stage(spark, tables):
    assert sorted(map(repr, pipeline.run(spark, SF).collect())) == sorted(map(repr, tables[-1].collect()))


def test_awkward_rows_go_through_every_stage(spark, tmp_path):
    rows = [(0, None, "en", "a", 0), (1, "", "en", None, 0), (None, "x y z", None, "a", 5), (3, " ", "en", "b", 1),
            (4, "word " * 5000, "en", "c", 25000), (4, "word " * 5000, "en", "c", 25000)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    docs = spark.createDataFrame(rows, schema).withColumn("score", pipeline.F.lit("taken"))
    for df in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            df = stored(spark, stage(spark, df, SF), name)
        assert set(df.columns) >= {"bin", "doc_id", "n_tokens"}
