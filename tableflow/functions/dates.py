"""Execution-date columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_lit(date: dt.date) -> Column:
    """The execution date as a calendar date (never a week-based year)."""
    return F.lit(date)


def parsed_date_lit(text: str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.lit(text), pattern)


def with_load_date(df: DataFrame, date: dt.date) -> DataFrame:
    """Set ``year``, ``month``, ``day``, replacing columns of these names in the input."""
    return _date_parts(df, date, "")


def with_execution_date(df: DataFrame, date: dt.date) -> DataFrame:
    """Add ``execution_year/month/day``; the record's own ``year/month/day`` stay."""
    return _date_parts(df, date, "execution_")


def _date_parts(df: DataFrame, date: dt.date, prefix: str) -> DataFrame:
    literal = date_lit(date)
    return df.withColumns(
        {
            f"{prefix}year": F.year(literal).cast("int"),
            f"{prefix}month": F.month(literal).cast("int"),
            f"{prefix}day": F.dayofmonth(literal).cast("int"),
        }
    )
