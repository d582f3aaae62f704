"""Stored tables as DataFrames and as SQL relations."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tableflow.sources.files import storage_format
from tableflow.sources.storage import has_files, read_text, write_text


def read_table(
    spark: SparkSession, fmt: str, path: str, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.format(storage_format(spark, fmt))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def stored_table(
    spark: SparkSession,
    fmt: str,
    path: str,
    like: StructType,
    partition_by: Sequence[str] = (),
    evolving: bool = True,
) -> DataFrame:
    """A table to which rows of the schema ``like`` were written.

    Text files carry no types and folder names only guess at them, so those come from ``like``.
    A table that is not ``evolving`` has these columns and no others, and no footer is read; nor is
    one for a keyed table, which keeps its schema beside its rows.
    """
    actual = storage_format(spark, fmt)
    if actual != "parquet":
        return read_table(spark, fmt, path, like if actual in ("csv", "json") else None)
    table = read_if_present(spark, path, like, partition_by, None if evolving else like)
    return table if table is not None else empty_table(spark, like)


def register_tables(spark: SparkSession, fmt: str, paths: Mapping[str, str]) -> None:
    """Name stored tables for SQL."""
    for name, path in paths.items():
        read_table(spark, fmt, path).createOrReplaceTempView(name)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)


def names_table(spark: SparkSession, column: str, names: Iterable[str]) -> DataFrame:
    """A list of names given by the caller as one column, of a size the planner knows."""
    # One literal, however many names, which the planner folds into an array.
    literal = F.from_json(F.lit(json.dumps([*dict.fromkeys(names)])), "array<string>")
    return spark.range(0, 1, 1, 1).select(F.explode(literal).alias(column))


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows of a schema, in a form the optimizer knows to be empty and drops from a union."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    nothing = spark.range(0, 1, 1, 1).where(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


_SCHEMA_FILE = "_schema.json"


def saved_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema kept beside a keyed table, if it has one."""
    text = read_text(spark, f"{path}/{_SCHEMA_FILE}")
    return StructType.fromJson(json.loads(text)) if text else None


def save_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    write_text(spark, f"{path}/{_SCHEMA_FILE}", schema.json())


def table_schema(
    spark: SparkSession, path: str, like: StructType, partition_by: Sequence[str] = ()
) -> StructType | None:
    """All columns of a stored Parquet table, or None when there is none yet.

    Keyed tables keep their schema beside their rows. For others the footers are merged in a
    distributed pass. Partition columns then have the types of ``like``: Spark would read a stored
    string such as ``01`` or ``2015-01-01`` back as a number or a date.
    """
    if not has_files(spark, path):
        return None
    saved = saved_schema(spark, path)
    if saved is not None:
        return saved
    found = spark.read.option("basePath", path).option("mergeSchema", True).parquet(path).schema
    typed = [
        like[f.name].dataType if f.name in partition_by and f.name in like.names else f.dataType
        for f in found.fields
    ]
    return StructType([StructField(f.name, t) for f, t in zip(found.fields, typed, strict=True)])


def read_folders(
    spark: SparkSession, path: str, schema: StructType, folders: Sequence[str] = ()
) -> DataFrame:
    """A table, or some of its folders, of a known schema: no footer is read, nothing else listed."""
    return spark.read.option("basePath", path).schema(schema).parquet(*(folders or [path]))


def read_if_present(
    spark: SparkSession,
    path: str,
    like: StructType,
    partition_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> DataFrame | None:
    """A stored Parquet table, or None when there is none yet. A given ``schema`` is taken as it is."""
    schema = schema or table_schema(spark, path, like, partition_by)
    if schema is None or not has_files(spark, path):
        return None
    return read_folders(spark, path, schema)
