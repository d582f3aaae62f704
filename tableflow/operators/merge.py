"""MERGE: update every matched row, insert every row without a match."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tableflow.functions.columns import all_quoted, quoted
from tableflow.operators.evolution import evolved, fitted, in_schema, named_like, overlaid, spelled
from tableflow.operators.latest import latest_per_key
from tableflow.specs import as_names


def _equal(key: tuple[str, ...], prefix: str) -> Column:
    return reduce(and_, [quoted(k) == quoted(f"{prefix}{k}") for k in key])


def _prefixed(df: DataFrame, key: tuple[str, ...], prefix: str) -> list[Column]:
    return [quoted(k).alias(f"{prefix}{k}") for k in key]


def stored_matches(
    target: DataFrame,
    updates: DataFrame,
    key: str | Iterable[str],
    columns: str | Iterable[str] = (),
) -> DataFrame:
    """Distinct keys (and further columns) of ``target`` whose key occurs in ``updates``.

    Distinct comes first, so a hot key leaves each task as one row. Where the batch is small enough
    to broadcast, Spark moves the semi-join below it and only matching keys are shuffled.
    """
    key = as_names(key)
    stored = target.select(*all_quoted(dict.fromkeys(key + as_names(columns)))).distinct()
    batch = updates.select(*_prefixed(updates, key, "__upd_"))
    return stored.join(batch, _equal(key, "__upd_"), "left_semi")


def _has_key(key: tuple[str, ...]) -> Column:
    return reduce(and_, [quoted(k).isNotNull() for k in key])


def _newest(updates: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Newest row per key; rows without a key are left alone.

    The rebalance gives the join below a shuffle of its own, without which AQE could not split a
    hot key on the table's side.
    """
    keyed = latest_per_key(updates.where(_has_key(key)), key, order).hint("rebalance")
    return keyed.unionByName(updates.where(~_has_key(key)))


def _no_rows_or_fail(updates: DataFrame, hits: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """No rows, or a failed job if several updates claim one stored key.

    Both sides are counted in one aggregate, partial before its shuffle. The failure is part of a
    comparison with the counts, so the optimizer cannot move it to where unmatched keys pass.
    """
    claims = (
        updates.select(*all_quoted(key), F.lit(1).alias("__claims"), F.lit(0).alias("__stored"))
        .unionByName(
            hits.select(*all_quoted(key), F.lit(0).alias("__claims"), F.lit(1).alias("__stored"))
        )
        .where(_has_key(key))
        .groupBy(*all_quoted(key))
        .agg(F.sum("__claims").alias("__claims"), F.sum("__stored").alias("__stored"))
    )
    message = F.concat(F.lit("several updates for the row with key "), F.to_json(F.struct(*all_quoted(key))))
    allowed = F.when(
        (F.col("__stored") > 0) & (F.col("__claims") > 1), F.raise_error(message).cast("bigint")
    ).otherwise(F.col("__claims"))
    return claims.where(F.col("__claims") != allowed)


def deduplicated(
    updates: DataFrame, key: tuple[str, ...], on_duplicate: str, order: str | Iterable[str]
) -> DataFrame:
    """The batch as it is to be merged; with "error" it stays, and repeats are found later."""
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate is 'error' or 'latest', not '{on_duplicate}'")
    return updates if on_duplicate == "error" else _newest(updates, key, as_names(order))


def as_inserted(updates: DataFrame, stored: StructType) -> DataFrame:
    """Rows of a batch as they are inserted: the table's columns and types, then new columns."""
    return in_schema(updates, evolved(stored, updates.schema))


def merge(
    target: DataFrame,
    updates: DataFrame,
    key: str | Iterable[str],
    on_duplicate: str = "error",
    order: str | Iterable[str] = (),
) -> DataFrame:
    """The table after the merge.

    * A null key matches nothing: the stored row stays and the incoming one is inserted.
    * Several incoming rows for one stored row are ambiguous; the job fails when that happens,
      unless ``on_duplicate="latest"`` picks the newest by ``order`` first. Rows that match nothing
      are all inserted.
    * Columns and struct fields are matched by name, as the session tells names apart. Those the
      updates lack keep their stored value; those the table lacks are added, null on rows the
      batch does not touch. Arrays and maps are replaced as a whole.
    """
    key = spelled(as_names(key), target.schema)
    updates = named_like(updates, target.schema)
    updates = deduplicated(updates, key, on_duplicate, spelled(as_names(order), updates.schema))
    hits = stored_matches(target, updates, key)
    return merged(target, updates, hits, key, unique=on_duplicate != "error")


def merged(
    target: DataFrame, updates: DataFrame, hits: DataFrame, key: tuple[str, ...], unique: bool
) -> DataFrame:
    """The table after a merge whose matched stored keys (``hits``, distinct) are known, so that the table
    is read once. A batch that isn't known to be ``unique`` is searched for ambiguous keys."""
    source, stored = updates.schema, target.schema

    incoming = updates.select(
        *_prefixed(updates, key, "__upd_"), F.struct(*all_quoted(updates.columns)).alias("__new")
    )
    joined = target.join(incoming, _equal(key, "__upd_"), "left")

    def after_update(field: StructField) -> Column:
        name, kind = field.name, field.dataType
        if name not in stored.names:
            return F.col("__new").getField(name).alias(name)
        before = fitted(quoted(name), stored[name].dataType, kind)
        if name not in source.names:
            return before.alias(name)
        new = overlaid(
            F.col("__new").getField(name), quoted(name), source[name].dataType, stored[name].dataType, kind
        )
        return F.when(F.col("__new").isNotNull(), new).otherwise(before).alias(name)

    # Only stored keys the batch mentions can prevent an insert, so the other side of this
    # anti-join is never larger than the batch.
    unmatched = updates.join(
        hits.select(*_prefixed(hits, key, "__old_")), _equal(key, "__old_"), "left_anti"
    )
    inserted = as_inserted(unmatched, stored)
    result = joined.select(*[after_update(f) for f in evolved(stored, source).fields]).unionByName(inserted)
    if not unique:
        clash = _no_rows_or_fail(updates, hits, key)
        result = result.unionByName(
            clash.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema])
        )
    return result
