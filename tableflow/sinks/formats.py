"""Options of the table formats, as plain values, and what a format can't be asked for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from tableflow.sources.files import storage_format
from tableflow.specs import as_names


def native_format(spark: SparkSession, fmt: str, wanted: str) -> bool:
    """Whether a keyed write goes through the format's own writer.

    Without its jar a keyed format is kept as Parquet and this library's writers serve it. With
    the jar only ``wanted`` has a native path here; another format is refused rather than
    written to as if it were Parquet.
    """
    actual = storage_format(spark, fmt)
    if actual in ("delta", "hudi") and actual != wanted:
        raise ValueError(f"a {fmt} table is not written by this operation, use one of {wanted}")
    return actual == wanted


def hudi_options(
    table: str,
    key: str | Iterable[str],
    order: str | Iterable[str] = (),
    partition_by: str | Iterable[str] = (),
    operation: str = "upsert",
    compare_with_stored: bool = False,
) -> dict[str, str]:
    """Writer options of a keyed table.

    Fixed values: option, generator and payload names are the format's. Several key or partition
    columns need the generator for them. By default the incoming row wins; the event-time payload
    keeps a stored row of greater order.
    """
    key, order, parts = as_names(key), as_names(order), as_names(partition_by)
    if not key:
        raise ValueError(f"table '{table}' needs a record key")
    if compare_with_stored and not order:
        raise ValueError(f"table '{table}' needs an order to compare by")
    if not parts:
        generator = "NonpartitionedKeyGenerator"
    elif len(key) == 1 and len(parts) == 1:
        generator = "SimpleKeyGenerator"
    else:
        generator = "ComplexKeyGenerator"
    payload = "DefaultHoodieRecordPayload" if compare_with_stored else "OverwriteWithLatestAvroPayload"
    options = {
        "hoodie.table.name": table,
        "hoodie.datasource.write.operation": operation,
        "hoodie.datasource.write.recordkey.field": ",".join(key),
        "hoodie.datasource.write.partitionpath.field": ",".join(parts),
        "hoodie.datasource.write.keygenerator.class": f"org.apache.hudi.keygen.{generator}",
        "hoodie.datasource.write.payload.class": f"org.apache.hudi.common.model.{payload}",
        "hoodie.datasource.write.hive_style_partitioning": "true",
    }
    if order:
        options["hoodie.datasource.write.precombine.field"] = ",".join(order)
    return options


def delta_merge_sql(path: str, view: str, key: str | Iterable[str]) -> str:
    """The MERGE statement of a batch, given as a view, into a table."""
    same = " AND ".join(f"target.`{k}` = updates.`{k}`" for k in as_names(key))
    return (
        f"MERGE INTO delta.`{path}` AS target USING {view} AS updates ON {same} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def delta_create_sql(path: str, columns: str, partition_by: str | Iterable[str] = ()) -> str:
    parts = ", ".join(f"`{p}`" for p in as_names(partition_by))
    partitioned = f" PARTITIONED BY ({parts})" if parts else ""
    return f"CREATE TABLE IF NOT EXISTS delta.`{path}` ({columns}) USING delta{partitioned}"
