"""File listings as tables: one row per file, no content read."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions.columns import base_name
from tableflow.sources.storage import empty_files
from tableflow.specs import glob_pattern


def manifest(
    spark: SparkSession, path: str, glob: str = "*", recursive: bool = False
) -> DataFrame:
    """Files under ``path`` whose name matches ``glob``.

    ``uri`` is the form the scans report in their ``_metadata``, so a manifest can be joined to rows.
    Files without a byte are listed too; they are found by a listing on the driver.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select(
            "path",
            F.col("_metadata.file_path").alias("uri"),
            base_name("path").alias("name"),
            F.col("length"),
            F.col("modificationTime").alias("modified_at"),
        )
    )
    empty = [
        (file, file, at / 1000) for file, at in empty_files(spark, path, recursive)
        if re.search(glob_pattern(glob), file.rsplit("/", 1)[-1])
    ]
    if not empty:
        return listed
    rows = spark.createDataFrame(empty, "path string, uri string, at double").select(
        "path", "uri", base_name("path").alias("name"), F.lit(0).cast("long").alias("length"),
        F.timestamp_millis(F.round(F.col("at") * 1000).cast("long")).alias("modified_at"),
    )
    return listed.unionByName(rows)


def manifest_of(
    spark: SparkSession, path: str, globs: Iterable[str], recursive: bool = False
) -> DataFrame:
    """The files matching any of several patterns, each listed once."""
    listings = [manifest(spark, path, glob, recursive) for glob in globs]
    if not listings:
        raise ValueError("at least one file pattern is needed")
    return reduce(DataFrame.unionByName, listings).dropDuplicates(["path"])
