"""Structured Streaming loads, each run to the end of what has been delivered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tableflow.catalog.maintenance import SAME_YEAR, YEAR, upserted_lines
from tableflow.catalog.registry import (
    LINE_KEY, LINE_ORDER, arriving_lines, deliver, deliver_named, new_job, query, save_schema, stored_lines, table,
)
from tableflow.plans.jobs import ingest_keyed, stream_files, stream_globs
from tableflow.plans.jobs import land_check_stream as land_and_stream
from tableflow.plans.jobs import stream_then_check as stream_and_check
from tableflow.sinks.files import write_files
from tableflow.sources.files import EXACT_TIMESTAMPS
from tableflow.specs import EntitySpec

STAMPED = "2024 as year, 2 as month, 1 as day"
BY_DATE = ("year", "month", "day")


@query(f"select *, {STAMPED} from events")
def stream_append(spark, sf_dir):
    """CSV files streamed into a partitioned table; a second run finds nothing new."""
    events = table(spark, sf_dir, "events")
    job = new_job(
        spark, "stream_append", [EntitySpec("events", "*.csv")], partition_by=BY_DATE,
        reader_options=EXACT_TIMESTAMPS,
    )
    save_schema(spark, events, job.schema_path, "events")
    write_files(events, "csv", job.input_dir)
    stream_files(spark, job)
    return stream_files(spark, job)["events"]


@query(
    f"""
    select 'orders' as entity, *, {STAMPED} from orders
    union all by name
    select 'customer' as entity, *, {STAMPED} from customer
    """
)
def stream_globs_concurrently(spark, sf_dir):
    """Two entities, each by a pattern over folders, streamed at the same time."""
    job = new_job(
        spark, "stream_globs_concurrently",
        [EntitySpec("orders", "orders/*.json"), EntitySpec("customer", "cust*/*.json")],
        input_format="json", partition_by=BY_DATE, reader_options=EXACT_TIMESTAMPS,
    )
    for name in ("orders", "customer"):
        rows = table(spark, sf_dir, name)
        save_schema(spark, rows, job.schema_path, name)
        deliver(rows, job.input_path, job.ctx, name, "json")
    tables = stream_globs(spark, job)
    return _by_name(tables)


@query(f"select *, {STAMPED} from customer")
def stream_archive(spark, sf_dir):
    """Sources are archived behind the stream: two deliveries, three runs, every row once."""
    customer = table(spark, sf_dir, "customer")
    job = new_job(
        spark, "stream_archive", [EntitySpec("customer", "*.parquet")], input_format="parquet",
        partition_by=BY_DATE, archive_sources=True,
    )
    save_schema(spark, customer, job.schema_path, "customer")
    in_credit = F.col("c_acctbal") >= 0
    customer.where(in_credit).write.parquet(job.input_dir)
    stream_files(spark, job)
    customer.where(~in_credit).write.mode("append").parquet(job.input_dir)
    stream_files(spark, job)
    return stream_files(spark, job)["customer"]


def _keyed_lines(spark, sf_dir, name, batch):
    """Two deliveries of line items into a keyed table, by the same job in either mode."""
    job = new_job(
        spark, name, [EntitySpec("lineitem", "lineitem/*.parquet", LINE_KEY, LINE_ORDER)],
        input_format="parquet", output_format="hudi", partition_by=("ship_year",),
    )
    for rows, mode in (
        (stored_lines(spark, sf_dir), "overwrite" if batch else "append"),
        (arriving_lines(spark, sf_dir), "overwrite" if batch else "append"),
    ):
        rows = rows.withColumn("ship_year", F.year("l_shipdate"))
        save_schema(spark, rows, job.schema_path, "lineitem")
        rows.write.mode(mode).parquet(f"{job.input_dir}/lineitem")
        result = ingest_keyed(spark, job, batch)["lineitem"]
    return result


_KEYED = (
    f"select *, {YEAR} as ship_year, 2024 as execution_year, 2 as execution_month, "
    f"1 as execution_day from ({upserted_lines(', year(l_shipdate)', SAME_YEAR)})"
)


@query(_KEYED)
def stream_upsert(spark, sf_dir):
    """Micro-batches upserted into a keyed table; the second run takes only new files."""
    return _keyed_lines(spark, sf_dir, "stream_upsert", batch=False)


@query(_KEYED)
def batch_upsert(spark, sf_dir):
    """The same job over the same deliveries in batch mode."""
    return _keyed_lines(spark, sf_dir, "batch_upsert", batch=True)


@query(
    """
    select 'orders' as entity, count(*) as rows, count(*) > 0 as received from orders
    union all
    select 'supplier', count(*), count(*) > 0 from supplier
    """
)
def stream_then_check(spark, sf_dir):
    """Stream a delivery, then count what each entity has for the day."""
    job = new_job(
        spark, "stream_then_check",
        [EntitySpec("orders", "*.snappy.parquet"), EntitySpec("supplier", "*.gz.parquet")],
        input_format="parquet", partition_by=BY_DATE,
    )
    for name, compression in (("orders", "snappy"), ("supplier", "gzip")):
        rows = table(spark, sf_dir, name)
        save_schema(spark, rows, job.schema_path, name)
        rows.write.mode("append").option("compression", compression).parquet(job.input_dir)
    counts, _ = stream_and_check(spark, job)
    return counts


@query(
    f"""
    select 'customer' as entity, *, {STAMPED} from customer
    union all by name
    select 'part' as entity, *, {STAMPED} from part
    """
)
def land_check_stream(spark, sf_dir):
    """Delivered files landed line by line, required to be complete, parsed and streamed into tables.
    The first delivery has some of the rows; the second has all, in files of the same names."""
    job = new_job(
        spark, "land_check_stream",
        [EntitySpec("customer", "customer_*.csv"), EntitySpec("part", "p{art,iece}_[0-9]*.csv")],
        partition_by=BY_DATE,
    )
    delivery, headers = job.input_dir, {}
    for run, rows_of in enumerate(({"customer": "c_acctbal >= 0", "part": "p_size > 25"}, {})):
        for name in ("customer", "part"):
            rows = table(spark, sf_dir, name)
            save_schema(spark, rows, job.schema_path, name)
            headers[name] = ",".join(rows.columns)
            written = f"{job.input_path}/written/{name}{run}"
            some = rows.where(rows_of.get(name, "true")).repartition(3)
            some.write.option("header", True).csv(written)
            deliver_named(spark, written, delivery, f"{name}_", ".csv")
        tables = land_and_stream(spark, delivery, f"{job.output_path}/landing", job, headers)
    return _by_name(tables)


@query(
    """
    select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
    where c_acctbal >= 0 and c_mktsegment <> 'BUILDING'
    """
)
def land_again_with_fewer_rows(spark, sf_dir):
    """Files delivered again under their names with fewer rows and none of one segment, by which the
    table is partitioned: the segment's old rows go as well."""
    job = new_job(
        spark, "land_again", [EntitySpec("customer", "customer_*.csv")], partition_by=("c_mktsegment",)
    )
    rows = table(spark, sf_dir, "customer")
    save_schema(spark, rows, job.schema_path, "customer")
    headers = {"customer": ",".join(rows.columns)}
    for run, kept in enumerate(("true", "c_acctbal >= 0 and c_mktsegment <> 'BUILDING'")):
        written = f"{job.input_path}/written/{run}"
        rows.where(kept).repartition(3).write.option("header", True).csv(written)
        deliver_named(spark, written, job.input_dir, "customer_", ".csv")
        tables = land_and_stream(spark, job.input_dir, f"{job.output_path}/landing", job, headers)
    return tables["customer"].select(rows.columns)


def _by_name(tables):
    """The tables one below the other, each with its own columns."""
    chunks = [df.withColumn("entity", F.lit(name)).drop("file_name") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)
