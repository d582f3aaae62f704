"""Upsert with pre-combine: newest incoming row per key and partition replaces the stored one."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.functions.columns import quoted
from tableflow.operators.evolution import evolved, in_schema, in_stored_types, spelled
from tableflow.operators.latest import latest_per_key
from tableflow.specs import as_names


def with_required_key(df: DataFrame, key: Iterable[str]) -> DataFrame:
    """Fail the job on a null record key: such rows could never be replaced and would pile up."""
    nullable = [k for k in key if df.schema[k].nullable]
    return df.withColumns(
        {
            k: F.when(
                quoted(k).isNull(), F.raise_error(F.lit(f"record key '{k}' is null"))
            ).otherwise(quoted(k))
            for k in nullable
        }
    )


def upsert(
    target: DataFrame | None,
    updates: DataFrame,
    key: str | Iterable[str],
    order: str | Iterable[str] = (),
    partition_by: str | Iterable[str] = (),
    compare_with_stored: bool = False,
) -> DataFrame:
    """The table after the upsert. A record is identified by its key *and* partition.

    The incoming row wins over the stored one; with ``compare_with_stored`` it wins only if its
    order is not smaller. Columns and struct fields are matched by name. Those one side lacks are null
    there; those both have keep the table's type, and a value it can't hold fails the job.
    """
    like = target.schema if target is not None else updates.schema
    key, order, parts = (spelled(as_names(n), like) for n in (key, order, partition_by))
    if target is not None:
        updates = in_stored_types(updates, target.schema)
        schema = evolved(target.schema, updates.schema)
        target, updates = in_schema(target, schema), in_schema(updates, schema)
    identity = key + tuple(p for p in parts if p not in key)
    updates = with_required_key(updates, key)
    if target is None:
        return latest_per_key(updates, identity, order)
    if compare_with_stored:
        both = target.withColumn("__incoming", F.lit(0)).unionByName(
            updates.withColumn("__incoming", F.lit(1))
        )
        return latest_per_key(both, identity, (*order, "__incoming")).drop("__incoming")
    incoming = latest_per_key(updates, identity, order)
    replaced = incoming.select(*[quoted(c).alias(f"__new_{c}") for c in identity])
    # A null partition value is still a partition, hence the null-safe comparison there.
    same = reduce(
        and_,
        [
            quoted(c) == quoted(f"__new_{c}") if c in key else quoted(c).eqNullSafe(quoted(f"__new_{c}"))
            for c in identity
        ],
    )
    kept = target.join(replaced, same, "left_anti")
    return kept.unionByName(incoming)
