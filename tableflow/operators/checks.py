"""Did the data, or the files, of a day arrive? Verdicts are DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableflow.functions.columns import all_quoted, first_token, on_date, tagged
from tableflow.sources.tables import empty_table, names_table


def union_chunks(
    spark: SparkSession, chunks: Iterable[DataFrame], schema: StructType | str
) -> DataFrame:
    """All chunks one below the other; no chunk at all gives an empty table of ``schema``.

    The empty relation is typed, so that it cannot widen or narrow the columns of the chunks.
    """
    return reduce(DataFrame.unionByName, chunks, empty_table(spark, schema))


def data_received(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    date_column: str,
    date: dt.date,
    entities: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of the date per expected entity: ``(entity, rows, received)``.

    Each scan reads the date column only, with the comparison pushed down; counting is partial
    before the shuffle. An entity without a table counts as not received.
    """
    expected = list(entities if entities is not None else tables)
    chunks = [
        tagged(on_date(df, date_column, date), "entity", name).select("entity")
        for name, df in tables.items()
    ]
    counts = (
        union_chunks(spark, chunks, "entity string")
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    wanted = names_table(spark, "entity", expected)
    return wanted.join(counts, "entity", "left").select(
        "entity",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        (F.coalesce("rows", F.lit(0)) > 0).alias("received"),
    )


def all_true(checks: DataFrame, column: str, name: str) -> DataFrame:
    """One row: does ``column`` hold everywhere? Nothing to check is not a pass."""
    return checks.agg(F.coalesce(F.bool_and(column), F.lit(False)).alias(name))


def files_present(
    spark: SparkSession, files: DataFrame, prefixes: Iterable[str] | DataFrame
) -> DataFrame:
    """Files per expected name prefix: ``(prefix, files, present)``.

    A name may begin with several prefixes and then counts for each. Prefixes are given as a list or as
    a column ``prefix``. Of each name only the beginnings of the lengths that prefixes have are
    looked up, by an equi-join, so the cost is names times lengths, whatever the number of prefixes;
    those that are none are dropped before anything is counted.
    """
    if isinstance(prefixes, DataFrame):
        wanted = prefixes.select("prefix").where("prefix is not null").distinct()
        lengths = sorted(r[0] for r in wanted.select(F.length("prefix")).distinct().collect())
    else:
        listed = list(dict.fromkeys(prefixes))
        wanted, lengths = names_table(spark, "prefix", listed), sorted({len(p) for p in listed})
    if not lengths:
        return empty_table(spark, "prefix string, files bigint, present boolean")
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("name"))
    beginnings = files.select("name", F.explode(fitting).alias("n")).select(
        F.col("name").substr(F.lit(1), F.col("n")).alias("prefix")
    )
    found = beginnings.join(wanted, "prefix", "left_semi").groupBy("prefix").agg(
        F.count(F.lit(1)).alias("files")
    )
    files_found = F.coalesce("files", F.lit(0))
    return wanted.join(found, "prefix", "left").select(
        "prefix", files_found.alias("files"), (files_found > 0).alias("present")
    )


def prefixes_exact(spark: SparkSession, files: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Expected against found name prefixes: ``(prefix, expected, found, matches)``.

    The set is exact when every row matches: nothing missing and nothing unexpected.
    """
    wanted = names_table(spark, "prefix", prefixes).withColumn("expected", F.lit(True))
    found = (
        files.select(first_token("name").alias("prefix")).distinct().withColumn("found", F.lit(True))
    )
    both = wanted.join(found, "prefix", "full_outer").select(
        "prefix",
        F.coalesce("expected", F.lit(False)).alias("expected"),
        F.coalesce("found", F.lit(False)).alias("found"),
    )
    return both.withColumn("matches", F.col("expected") & F.col("found"))


def key_coverage(
    df: DataFrame, key: str, day: str, expected: int, approximate: bool = False
) -> DataFrame:
    """Distinct (key, day) pairs against an expected total: ``(found, expected, complete)``.

    A row whose key or day is null counts for no pair.
    """
    parts = all_quoted((key, day))
    if approximate:
        whole = reduce(and_, [p.isNotNull() for p in parts])
        found = F.approx_count_distinct(F.when(whole, F.struct(*parts)))
    else:
        found = F.count_distinct(*parts)
    return df.agg(found.alias("found")).select(
        "found",
        F.lit(expected).cast("bigint").alias("expected"),
        (F.col("found") >= expected).alias("complete"),
    )
