"""Keyed, mutable tables on plain Parquet folders, or on a table format when its jar is there.

An upsert or merge reads and rewrites only the partitions it touches. Their folders follow from
the partition values, so no row is read and nothing else is listed to find them; the driver holds
one short text per touched partition, less than Spark's own listing of it. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from tableflow.functions.columns import all_quoted, quoted
from tableflow.operators.merge import as_inserted, deduplicated, merged, stored_matches
from tableflow.operators.evolution import evolved, in_stored_types, named_like, spelled
from tableflow.operators.upsert import upsert
from tableflow.session import stored_once
from tableflow.sinks.files import clustered, overwrite_partitions
from tableflow.sinks.keyfilters import files_to_search, key_bounds, renew
from tableflow.sinks.formats import delta_create_sql, delta_merge_sql, hudi_options, native_format
from tableflow.sources.storage import (
    delete_folders, exists, has_files, partition_folder, replace_snapshot, restore_interrupted,
)
from tableflow.sources.tables import (
    empty_table, read_folders, read_if_present, save_schema, saved_schema, table_schema,
)
from tableflow.specs import as_names

# Fixed value: the folder name that stands for a null.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def as_stored(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """The batch with partition values as a table gives them back: an empty text and the name of the
    null folder are null, and minus zero is zero."""
    changed = {}
    for p in parts:
        kind, value = df.schema[p].dataType, quoted(p)
        if isinstance(kind, StringType):
            changed[p] = F.when(~value.isin("", _NULL_PARTITION), value)
        elif isinstance(kind, (DoubleType, FloatType)):
            changed[p] = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return df.withColumns(changed) if changed else df


def _as_text(parts: tuple[str, ...]) -> Column:
    """The partition values as Spark names folders by them."""
    return F.array(*[quoted(p).cast("string") for p in parts])


def _folders(
    spark: SparkSession, path: str, parts: tuple[str, ...], values: Iterable[tuple]
) -> dict[tuple, str]:
    """Folder of each partition, of those that exist."""
    named = {v: partition_folder(spark, path, zip(parts, v, strict=True)) for v in values}
    return {v: folder for v, folder in named.items() if exists(spark, folder)}


def _partitions(df: DataFrame, parts: tuple[str, ...]) -> set[tuple]:
    return {tuple(r[0]) for r in df.select(_as_text(parts).alias("v")).distinct().collect()}


def _check_owned(spark: SparkSession, path: str) -> None:
    """Refuse a table whose files are listed by an append stream's log: rewrites would not show."""
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by an append stream and cannot be changed by key")
    restore_interrupted(spark, path)


def _write_snapshot(df: DataFrame, path: str, parts: tuple[str, ...]) -> None:
    clustered(df, parts).write.partitionBy(*parts).parquet(path)


def _keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    if saved_schema(spark, path) != schema:
        save_schema(spark, path, schema)


def upsert_into(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    key: str | Iterable[str],
    order: str | Iterable[str] = (),
    partition_by: str | Iterable[str] = (),
    fmt: str = "parquet",
    compare_with_stored: bool = False,
    schema: StructType | None = None,
    one_partition: bool = False,
) -> None:
    """Upsert a batch into the table at ``path``, creating it if need be.

    Running it again with the same batch changes nothing, so a failed run is simply repeated.
    The batch is read more than once, so one that is costly to compute should be stored first.
    Columns the table has keep its types; new ones are added. ``schema``, if known, saves looking
    at the footers of a table that another writer made. A batch whose rows all have the same
    partition values, such as an execution date, is ``one_partition``: neither the search for
    its partitions nor the shuffle by partition is needed.
    """
    key, order, parts = as_names(key), as_names(order), as_names(partition_by)
    if native_format(spark, fmt, "hudi"):
        table = path.rstrip("/").rsplit("/", 1)[-1]
        options = hudi_options(table, key, order, parts, "upsert", compare_with_stored)
        updates.write.format("hudi").options(**options).mode("append").save(path)
        return
    _check_owned(spark, path)
    known = saved_schema(spark, path) or schema or table_schema(spark, path, updates.schema, parts)
    if known is not None:
        updates = named_like(updates, known)
        key, order, parts = (spelled(names, known) for names in (key, order, parts))
    updates = as_stored(updates, parts)
    if known is not None:
        updates = as_stored(in_stored_types(updates, known), parts)
    columns = evolved(known, updates.schema) if known is not None else updates.schema
    if not parts:
        stored = read_if_present(spark, path, updates.schema, parts, known)
        result = upsert(stored, updates, key, order, (), compare_with_stored)
        replace_snapshot(spark, path, lambda staging: _write_snapshot(result, staging, parts))
        _keep_schema(spark, path, columns)
        return
    touched = _partitions(updates.limit(1) if one_partition else updates, parts)
    if not touched:
        return
    folders = list(_folders(spark, path, parts, touched).values())
    stored = read_folders(spark, path, known, folders) if folders else None
    result = upsert(stored, updates, key, order, parts, compare_with_stored)
    _keep_schema(spark, path, columns)  # before the rows: a column no file has yet reads as null
    overwrite_partitions(result, path, parts, cluster=not one_partition)


def _within(df: DataFrame, key: tuple[str, ...]) -> Column:
    """That a row's key lies between the least and the greatest of the batch, as literals, so that it
    reaches the statistics of the stored files."""
    tests = []
    for k, (low, high) in key_bounds(df, key).items():
        if low is None:  # no key at all: nothing matches
            return F.lit(False)
        kind = df.schema[k].dataType
        tests.append(quoted(k).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return reduce(and_, tests, F.lit(True))


def _searched(
    spark: SparkSession, path: str, known: StructType, batch: DataFrame, key: tuple[str, ...],
    parts: tuple[str, ...], key_filters: bool,
) -> DataFrame:
    """The rows among which a batch's keys are searched: those of files that may hold one."""
    files = files_to_search(spark, path, known, batch, key, parts) if key_filters else None
    if files is not None and not files:
        return empty_table(spark, known)
    return read_folders(spark, path, known, files or ()).where(_within(batch, key))


def merge_into(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    key: str | Iterable[str],
    partition_by: str | Iterable[str] = (),
    fmt: str = "parquet",
    schema: StructType | None = None,
    on_duplicate: str = "error",
    order: str | Iterable[str] = (),
    key_filters: bool = False,
) -> None:
    """Merge a batch into the table at ``path``, creating it with ``schema`` if there is none.

    A matched row takes the batch's partition values too, so it may move to another folder; the
    partitions it leaves are rewritten as well, and no others. With ``key_filters`` the table keeps a
    filter per data file (see ``keyfilters``), asked before its keys are searched and renewed with what
    is rewritten: for small batches of scattered keys into tables of many files.
    """
    key, order, parts = as_names(key), as_names(order), as_names(partition_by)
    if native_format(spark, fmt, "delta"):
        batch = deduplicated(updates, key, on_duplicate, order)
        _delta_merge(spark, batch, path, key, parts, schema)
        return
    _check_owned(spark, path)
    known = table_schema(spark, path, schema or updates.schema, parts)
    if known is not None:
        updates = named_like(updates, known)
        key, order, parts = (spelled(names, known) for names in (key, order, parts))
    updates = as_stored(updates, parts)
    if known is None:
        like = schema or updates.schema
        first = as_stored(as_inserted(deduplicated(updates, key, on_duplicate, order), like), parts)
        replace_snapshot(spark, path, lambda staging: _write_snapshot(first, staging, parts))
        _keep_schema(spark, path, first.schema)
        if key_filters and has_files(spark, path):
            renew(spark, path, first.schema, key, parts, [path])
        return
    updates = as_stored(in_stored_types(updates, known), parts)
    batch = deduplicated(updates, key, on_duplicate, order)
    unique = on_duplicate != "error"
    # A merge goes over its batch and over the matched keys several times: both are computed once.
    with stored_once(spark, batch, "batch") as batch:
        # Keys of the whole table are searched, but only where the batch's range of keys can be.
        keys = _searched(spark, path, known, batch, key, parts, key_filters)
        with stored_once(spark, stored_matches(keys, batch, key, parts), "hits") as found:
            if not parts:
                result = merged(read_folders(spark, path, known), batch, found, key, unique)
                replace_snapshot(spark, path, lambda staging: _write_snapshot(result, staging, ()))
                _keep_schema(spark, path, result.schema)
                if key_filters:
                    renew(spark, path, result.schema, key)
            else:
                _merge_partitions(spark, path, known, batch, found, key, parts, unique, key_filters)


def _merge_partitions(
    spark: SparkSession, path: str, known: StructType, batch: DataFrame, found: DataFrame,
    key: tuple[str, ...], parts: tuple[str, ...], unique: bool, key_filters: bool,
) -> None:
    """Rewrite the partitions that have matched keys or get rows of the batch."""
    touched = _partitions(
        found.select(*all_quoted(parts)).union(batch.select(*all_quoted(parts))), parts
    )
    if not touched:  # an empty batch
        return
    # Partitions outside hold no matching key, so they cannot change.
    folders = _folders(spark, path, parts, touched)
    target = empty_table(spark, known)
    if folders:
        target = read_folders(spark, path, known, list(folders.values()))
    hits = found.select(*all_quoted(key)).distinct()
    result = merged(target, batch, hits, key, unique)
    _keep_schema(spark, path, result.schema)
    written = Observation("written partitions")
    overwrite_partitions(
        result.observe(written, F.collect_set(F.struct(_as_text(parts))).alias("ids")), path, parts
    )
    kept = {tuple(row[0]) for row in written.get["ids"]}
    delete_folders(spark, [folder for v, folder in folders.items() if v not in kept])
    if key_filters:
        rewritten = list(_folders(spark, path, parts, kept).values())
        renew(spark, path, result.schema, key, parts, rewritten, [v for v in folders if v not in kept])


def _delta_merge(spark, updates, path, key, parts, schema) -> None:
    """The same through the table format's own MERGE."""
    spark.sql(delta_create_sql(path, (schema or updates.schema).toDDL(), parts))
    updates.createOrReplaceTempView("tableflow_updates")
    setting = "spark.databricks.delta.schema.autoMerge.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        spark.sql(delta_merge_sql(path, "tableflow_updates", key))
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
