"""Small column helpers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, MapType, StringType, StructType, VariantType,
)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def all_quoted(names: Iterable[str]) -> list[Column]:
    return [quoted(n) for n in names]


def is_orderable(kind: DataType) -> bool:
    """Whether Spark can compare values of a type."""
    if isinstance(kind, ArrayType):
        return is_orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(is_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def comparable(column: Column, kind: DataType) -> Column:
    """The column, or its JSON text where values of its type can't be compared (the entries of a map
    in the order they are stored)."""
    return column if is_orderable(kind) else F.to_json(F.struct(column.alias("v")))


def base_name(path: str | Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def first_token(name: str | Column, separator: str = "_") -> Column:
    """What stands before the first separator, the whole name if there is none."""
    return F.substring_index(name, separator, 1)


def tagged(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def on_date(df: DataFrame, column: str, date: dt.date) -> DataFrame:
    """Rows whose column, named at run time, equals a date.

    The literal takes the column's type, so the comparison reaches the scan and a string column
    is never cast row by row. A timestamp equals a date at midnight.
    """
    is_text = isinstance(df.schema[column].dataType, StringType)
    literal = F.lit(date.isoformat()) if is_text else F.lit(date)
    return df.select(quoted(column)).where(quoted(column) == literal)
