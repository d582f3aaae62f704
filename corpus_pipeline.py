"""Documents to training sequences: five stages, each written as Parquet and read by the next.

All stages take rows with the columns of documents and more; columns named like results of an operator are
kept as they are. A null text counts as an empty one, a null id as the greatest; rows that repeat are rows
of their own unless a stage says otherwise; no rows give no rows. Texts are read whole, a row at a time beyond
half a megabyte, so one text needs up to about 100 times its bytes in a worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import linedup, packing, quality, similar, winnowing
from tableflow.llm.rows import stored
from tableflow.llm.text import fold


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5; the classifier is fitted on the stage's input. Rows of
    equal texts have equal scores; an empty text has one, too, and stays or goes by it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.featured(docs, labels, fold(F.col("doc_id"), 3) != 1)
    model = quality.fit(rows)
    return docs.where(model.score(quality.features(F.col("text"))) >= 0.5)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line blocks of an earlier one; those left without a word go. Earlier is the
    smaller id, then the text; rows equal in both are one document and get one result. Documents that
    lose nothing stay, empty ones as well."""
    out = linedup.remove_repeated_blocks(docs)
    left = (F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\f\r")) != "")
    return out.where(left).withColumn("n_chars", _chars(docs)).select(docs.columns)


def _chars(docs: DataFrame):
    return F.char_length("text").cast(docs.schema["n_chars"].dataType)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity from 0.8. It is the one
    with the least id, then the least hash of the text; of equal rows one stays. Texts without words are
    one group."""
    return similar.one_of_each(docs, size=5, similarity=0.8).select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item; an item of fewer words is one window,
    and one without words hits nothing."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = winnowing.mark_overlap(docs, benchmark, out="__overlap")
    return marked.where("__overlap.n_hit = 0").select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each part of each document lies in the training sequences. Equal rows are packed as
    rows of their own, and a text without tokens has no part."""
    return packing.best_fit(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

# Fitted scores, alignment and packing have no SQL counterpart; tests compare each stage with a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = stored(spark, stage(spark, rows, sf_dir), name)
    return rows
