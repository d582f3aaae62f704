"""Keep the newest row of every key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.functions.columns import all_quoted, comparable, is_orderable, quoted
from tableflow.specs import as_names


def latest_per_key(
    df: DataFrame, key: str | Iterable[str], order: str | Iterable[str] = ()
) -> DataFrame:
    """The row with the greatest ``order`` per key; nulls sort lowest.

    ``max`` over a struct of (order, remaining columns) needs one shuffle, combines on the map
    side (a hot key leaves each task as a single row) and settles ties the same way on every run.
    """
    key, order = as_names(key), as_names(order)
    order = [c for c in order if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    if not order and not rest:
        return df.dropDuplicates(list(key))
    # Payloads that can't be compared (maps) are carried along, and their text settles ties.
    carried = [c for c in rest if not is_orderable(df.schema[c].dataType)]
    rank = F.struct(
        *all_quoted(order), *[comparable(quoted(c), df.schema[c].dataType).alias(c) for c in rest]
    )
    if carried:
        payload = F.struct(*all_quoted([*order, *rest]))
        newest = F.max_by(payload, rank).alias("__newest")
    else:
        newest = F.max(rank).alias("__newest")
    found = df.groupBy(*all_quoted(key)).agg(newest)
    fields = [F.col("__newest").getField(c).alias(c) for c in [*order, *rest]]
    return found.select(*all_quoted(key), *fields).select(*all_quoted(df.columns))
