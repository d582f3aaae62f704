"""File writers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions.columns import quoted
from tableflow.sources.files import EXACT_TIMESTAMPS, combined_options, storage_format
from tableflow.sources.storage import delete_folders, exists, partition_folder
from tableflow.specs import as_names


# Where a table keeps which of its folders hold rows of which source file.
_FOLDERS = "_folders"


def save_mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def clustered(df: DataFrame, partition_by: str | Iterable[str]) -> DataFrame:
    """Bring the rows of a table partition together before they are written.

    Without this every task writes a file into every partition. The rebalance splits a partition
    that holds a large share of the rows over several tasks and joins small ones, by measured size.
    """
    parts = as_names(partition_by)
    return df.hint("rebalance", *parts) if parts else df


def write_files(
    df: DataFrame,
    fmt: str,
    path: str,
    partition_by: str | Iterable[str] = (),
    overwrite: bool = False,
    options: Mapping[str, str] | None = None,
    cluster: bool = True,
) -> None:
    """Write a table as files, in hive-style folders if partitioned.

    ``cluster=False`` skips the shuffle where all rows go to one folder anyway, as in a load that
    is partitioned by its execution date. Text formats keep microseconds unless told otherwise.
    """
    parts = as_names(partition_by)
    fmt = storage_format(df.sparkSession, fmt)
    exact = EXACT_TIMESTAMPS if fmt in ("csv", "json") else {}
    (
        (clustered(df, parts) if cluster else df)
        .write.format(fmt)
        .mode(save_mode(overwrite))
        .options(**combined_options(exact, options or {}))
        .partitionBy(*parts)
        .save(path)
    )


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: str | Iterable[str], cluster: bool = True
) -> None:
    """Replace exactly the partitions that occur in ``df``; others stay as they are.

    Spark writes beside the table and moves folders in when the job commits, so ``df`` may read
    the partitions it replaces.
    """
    parts = as_names(partition_by)
    (
        (clustered(df, parts) if cluster else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def replace_files(
    spark: SparkSession, rows: DataFrame | None, names: Iterable[str], path: str, partition_by: Iterable[str], name_column: str
) -> None:
    """Make ``rows`` all that a table holds of some source files, whose names are its last partition.

    Which folders each file has rows in is kept beside the table, in a folder that readers ignore, so folders
    that a file has no rows in any more are deleted without looking for them; a file without any
    rows keeps an entry that says so. Folders are deleted after the new rows are in place and the entries are
    written last, so a run that fails is repeated. The driver holds the folders of these files alone.
    """
    parts, names = (*as_names(partition_by), name_column), sorted(set(names))
    if not names:
        return
    before = _folders_of(spark, path, names)
    after: dict[str, set[str]] = {name: set() for name in names}
    if rows is not None:
        values = F.array(*[quoted(p).cast("string") for p in parts]).alias("values")
        for (value,) in rows.select(values).distinct().collect():
            named = partition_folder(spark, "", zip(parts, value, strict=True)).lstrip("/")
            after[value[-1]].add(named)
        if any(after.values()):
            overwrite_partitions(rows, path, parts)
    gone = {f for name in names for f in before[name] - after[name]}
    delete_folders(spark, [f"{path.rstrip('/')}/{folder}" for folder in sorted(gone)])
    entries = [(folder, name) for name in names for folder in (sorted(after[name]) or [None])]
    listed = spark.createDataFrame(entries, "folder string, file string").coalesce(1)
    overwrite_partitions(listed, f"{path}/{_FOLDERS}", "file", cluster=False)


def _folders_of(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, set[str]]:
    """Per name the folders of a table that hold rows of the file, as they were kept."""
    root, found = f"{path}/{_FOLDERS}", {name: set() for name in names}
    kept = [f for f in (partition_folder(spark, root, [("file", name)]) for name in names) if exists(spark, f)]
    if kept:
        listed = spark.read.schema("folder string, file string").option("basePath", root).parquet(*kept)
        for row in listed.where("folder is not null").collect():
            found[row["file"]].add(row["folder"])
    return found


def insert_overwrite(
    df: DataFrame, fmt: str, path: str, partition_by: str | Iterable[str] = ()
) -> None:
    """Insert without looking at keys, replacing the table; duplicates are kept."""
    write_files(df, fmt, path, partition_by, overwrite=True)
