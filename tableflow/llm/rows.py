"""Row keys and stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.session import scratch_dir

LAST = (1 << 63) - 1


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows with ``__id`` and ``__version``, which together name a row up to equal ids and texts:
    the id with nulls as the greatest number, and a hash of the text. Results that are computed from
    a few columns find their way back to the rows by them. Input columns of these names are replaced.
    """
    return docs.withColumns({
        "__id": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)),
        "__version": F.xxhash64(F.coalesce(text, F.lit(""))),
    })


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: computed once, and safe from the
    loss of executors."""
    folder = scratch_dir(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
