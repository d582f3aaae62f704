"""Consume files once: a ledger of what has been loaded instead of moving files away."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableflow.session import scratch_dir
from tableflow.sources.files import read_batch
from tableflow.sources.manifest import manifest
from tableflow.sources.storage import has_files
from tableflow.sources.tables import empty_table

LEDGER_SCHEMA = "path string, uri string, modified_at timestamp"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not has_files(spark, path):
        return empty_table(spark, LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not loaded yet. A file delivered again under its old name is new."""
    return files.join(ledger.select("path", "modified_at"), ["path", "modified_at"], "left_anti")


def record_files(files: DataFrame, path: str) -> None:
    """Append to the ledger, after the load has succeeded."""
    files.select("path", "uri", "modified_at").write.mode("append").parquet(path)


def read_pending(
    spark: SparkSession,
    fmt: str,
    path: str,
    ledger_path: str,
    schema: StructType | None = None,
    glob: str = "*",
    options: Mapping[str, str] | None = None,
    columns: Mapping[str, Column] | str | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of the files not loaded yet (None if there are none) and the list of these files.

    The folder is scanned by the name pattern and by the age of the oldest pending file, which
    reaches the listing; rows of files that are not pending are dropped by a semi-join on the file
    they come from. Names are never taken as patterns, however many files there are.
    ``columns`` are added where the files are read, so they may tell where a row came from; a
    string names one that gets the name of the file.
    """
    if isinstance(columns, str):
        columns = {columns: F.col("_metadata.file_name")}
    pending = pending_files(manifest(spark, path, glob), read_ledger(spark, ledger_path))
    # The list is written down first: what is loaded now must be what is recorded later, whatever
    # arrives in between.
    listing = scratch_dir(spark, "pending-files")
    pending.write.parquet(listing)
    taken = spark.read.schema(pending.schema).parquet(listing)
    # The bound is in whole seconds, takes files that are newer, and is read in the reader's zone.
    zoned = any(name.lower() == "timezone" for name in options or {})
    margin = F.expr("interval 27 hours" if zoned else "interval 1 second")
    oldest = F.date_format(F.min("modified_at") - margin, "yyyy-MM-dd'T'HH:mm:ss")
    after = taken.agg(oldest).first()[0]
    if after is None:
        return None, taken
    rows = read_batch(spark, fmt, path, schema, glob, {**(options or {}), "modifiedAfter": after})
    source = {"__uri": F.col("_metadata.file_path"), "__modified_at": F.col("_metadata.file_modification_time")}
    listed = taken.select(F.col("uri").alias("__uri"), F.col("modified_at").alias("__modified_at"))
    rows = rows.withColumns({**(columns or {}), **source}).join(listed, ["__uri", "__modified_at"], "left_semi")
    return rows.drop("__uri", "__modified_at"), taken
