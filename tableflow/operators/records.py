"""Records of delimited files that go over several lines, put together from lines read in splits."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def line_place() -> dict[str, Column]:
    """Where a line stands, to be read with it: its file, its split of the file, its place in the split."""
    return {
        "__file": F.col("_metadata.file_path"),
        "__split": F.col("_metadata.file_block_start"),
        "__place": F.monotonically_increasing_id(),
    }


def _odd_quotes(line: Column, quote: str, escape: str) -> Column:
    """1 if the line holds an odd number of quotes that open or close a value."""
    if escape and escape != quote:
        line = F.regexp_replace(line, f"{re.escape(escape)}.", "")
    return (F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))) % 2


def whole_records(lines: DataFrame, quote: str = '"', escape: str = "\\") -> DataFrame:
    """``(value, file_name)`` per record, from lines with ``value``, ``file_name`` and ``line_place``.

    A line begins a record if an even number of quotes stands before it in its file. That is known per
    split (one row each) by adding up the parities of the splits before, then per line within the split,
    so no task holds more of a file than a split. What a split begins with, if it belongs to a
    record of an earlier one, is brought to that record. Lines of a record are joined by the
    line feed they were split at; a carriage return at a record's end is taken off.

    Quotes must stand around values or be doubled or escaped within them. A quote that is never closed
    makes the rest of its file one record, as it does in a scan.
    """
    split = ["__file", "__split"]
    lines = lines.withColumn("__odd", _odd_quotes(F.col("value"), quote, escape))
    parities = lines.groupBy(*split).agg(F.sum("__odd").alias("__odds"))
    earlier = Window.partitionBy("__file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("__odds").over(earlier), F.lit(0)) % 2
    lines = lines.join(parities.select(*split, within.alias("__within")), split)

    here = Window.partitionBy(*split).orderBy("__place")
    before = F.coalesce(F.sum("__odd").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("__begin", F.when((F.col("__within") + before) % 2 == 0, F.col("__place")))
    begin = F.last("__begin", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0))
    pieces = lines.withColumn("__begin", begin).groupBy(*split, "file_name", "__begin")
    pieces = pieces.agg(_joined("__place", "value").alias("value"))

    # A split's first piece without a beginning goes to the last record begun in the splits before it. Only
    # such pieces and these records are moved again.
    last = pieces.groupBy(*split).agg(
        F.max("__begin").alias("__last"), F.max(F.col("__begin").isNull()).alias("__headless")
    )
    owner = F.last(F.when(F.col("__last").isNotNull(), F.struct("__split", "__last")), ignorenulls=True)
    owners = last.withColumn("__owner", owner.over(earlier)).where("__headless").select(*split, "__owner")
    owned = owners.select("__file", F.col("__owner.__split").alias("__split"), F.col("__owner.__last").alias("__owned"))
    # Joined by the split alone, since pieces lie by it already; what is owned is the last record begun in its split.
    begun = pieces.where("__begin is not null").join(owned.distinct(), split, "left")
    whole = begun.where("__owned is null or __begin < __owned")
    mine = F.struct(F.col("__split"), F.col("__begin").alias("__last"))
    begun = begun.where("__begin >= __owned").withColumn("__owner", mine).drop("__owned")
    rest = pieces.where("__begin is null").join(owners, split)
    over = begun.unionByName(rest.select(*begun.columns)).groupBy("__file", "file_name", "__owner")
    found = whole.select("value", "file_name").union(
        over.agg(_joined("__split", "value").alias("value")).select("value", "file_name")
    )
    return found.select(F.regexp_replace("value", "\r$", "").alias("value"), "file_name")


def _joined(place: str, text: str) -> Column:
    """The texts of a group in the order of their places, with line feeds between."""
    ordered = F.array_sort(F.collect_list(F.struct(place, text)))
    return F.array_join(F.transform(ordered, lambda p: p[text]), "\n")
