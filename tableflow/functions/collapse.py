"""Collapse the rows of a group into one, taking the first non-null value of every column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tableflow.functions.columns import all_quoted, comparable, is_orderable, quoted
from tableflow.specs import as_names


def first_non_null(
    df: DataFrame,
    keys: str | Iterable[str],
    order: str | Iterable[str],
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """One row per group; null is the only empty value, so ``""`` counts.

    The order is an argument of the aggregate (nulls first) rather than a sort before it: a sort
    does not survive the shuffle, and as an argument it combines on the map side, so a group
    holding a third of the rows costs no more than any other. Rows that tie on the order yield
    the smaller value.
    """
    keys, order = as_names(keys), as_names(order)
    columns = [c for c in (columns or df.columns) if c not in keys]
    first = [_first(c, df.schema[c].dataType, order).alias(c) for c in columns]
    return df.groupBy(*all_quoted(keys)).agg(*first)


def _first(column: str, kind: DataType, order: tuple[str, ...]) -> Column:
    value = quoted(column)
    rank = F.struct(*all_quoted(order), comparable(value, kind).alias("__value"))
    rank = F.when(value.isNotNull(), rank)
    if is_orderable(kind):
        return F.min(rank).getField("__value")
    return F.min_by(value, rank)  # rows without a rank don't count


def first_non_null_sql(
    table: str,
    columns: Iterable[str],
    keys: str | Iterable[str],
    order: str | Iterable[str],
) -> str:
    """The same aggregate as SQL text, for users who register views."""
    keys, order = as_names(keys), as_names(order)
    first = [
        f"(min(CASE WHEN `{c}` IS NOT NULL THEN named_struct("
        + "".join(f"'o{i}', `{o}`, " for i, o in enumerate(order))
        + f"'v', `{c}`) END)).v AS `{c}`"
        for c in columns
        if c not in keys
    ]
    grouping = ", ".join(f"`{k}`" for k in keys)
    return f"SELECT {grouping}, {', '.join(first)} FROM `{table}` GROUP BY {grouping}"
