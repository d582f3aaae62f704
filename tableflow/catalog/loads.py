"""Scans, file writers, date columns, batch loads and consume-once."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from tableflow.catalog.registry import (
    DAY_ONE, DAY_TWO, EARLY_AND_LATE, LATE, deliver_named, early_orders, late_orders, matching,
    new_job, query, save_schema, table,
)
from tableflow.functions.columns import tagged
from tableflow.functions.dates import with_execution_date, with_load_date
from tableflow.operators.checks import union_chunks
from tableflow.plans.jobs import load_files
from tableflow.session import scratch_dir
from tableflow.sinks.files import insert_overwrite, overwrite_partitions, write_files
from tableflow.sinks.ledger import read_pending, record_files
from tableflow.sources.files import EXACT_TIMESTAMPS, read_batch
from tableflow.sources.schemas import load_schema
from tableflow.sources.tables import stored_table
from tableflow.specs import EntitySpec, JobContext, entity_glob


@query("select *, 2024 as year, 2 as month, 1 as day from events")
def execution_date_columns(spark, sf_dir):
    """Year, month and day of the load."""
    return with_load_date(table(spark, sf_dir, "events"), DAY_ONE)


@query("select * exclude (o_orderstatus), 2024 as year, 2 as month, 1 as day from orders")
def load_date_replaces(spark, sf_dir):
    """A record's own ``year`` gives way to the load's."""
    orders = table(spark, sf_dir, "orders").drop("o_orderstatus")
    return with_load_date(orders.withColumn("year", F.year("o_orderdate")), DAY_ONE)


@query(
    "select *, cast(year(o_orderdate) as int) as year, 2024 as execution_year, "
    "2 as execution_month, 1 as execution_day from orders"
)
def record_year_kept(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return with_execution_date(orders, DAY_ONE)


@query(
    "select cast(p_partkey as int) as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice "
    "from part"
)
def inferred_scan(spark, sf_dir):
    """CSV with a header, types inferred, files chosen by name among others in the folder."""
    folder = scratch_dir(spark, "inferred_scan")
    part = table(spark, sf_dir, "part")
    write_files(part, "csv", folder, options={"header": "true"})
    part.write.mode("append").json(folder)
    return read_batch(spark, "csv", folder, None, "*.csv", {"header": "true", "inferSchema": "no"})


@query("select * from customer")
def schema_file_scan(spark, sf_dir):
    """Schema from a file, files from a pattern in the path."""
    folder = scratch_dir(spark, "schema_file_scan")
    customer = table(spark, sf_dir, "customer")
    save_schema(spark, customer, f"{folder}/schema", "customer")
    write_files(customer, "json", f"{folder}/in/customer_1")
    schema = load_schema(spark, f"{folder}/schema", "customer")
    return read_batch(spark, "json", f"{folder}/in/customer_*/*.json", schema)


def _round_trip(spark, sf_dir, fmt):
    folder = scratch_dir(spark, f"{fmt}_roundtrip")
    events = table(spark, sf_dir, "events")
    write_files(events, fmt, folder)
    return read_batch(spark, fmt, folder, events.schema, None, EXACT_TIMESTAMPS)


@query("select * from events")
def csv_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "csv")


@query("select * from events")
def json_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "json")


@query(
    "select *, cast(month(ts) as int) as month, cast(day(ts) as int) as day from events"
)
def partition_roundtrip(spark, sf_dir):
    """Hive-style folders by month and day."""
    folder = scratch_dir(spark, "partition_roundtrip")
    events = table(spark, sf_dir, "events").withColumns(
        {"month": F.month("ts"), "day": F.dayofmonth("ts")}
    )
    write_files(events, "parquet", folder, ("month", "day"))
    return stored_table(spark, "parquet", folder, events.schema, ("month", "day"), evolving=False)


@query("select * from lineitem")
def insert_keeps_duplicates(spark, sf_dir):
    """Insert into a partitioned table, replacing it; repeated keys stay."""
    folder = scratch_dir(spark, "insert_keeps_duplicates")
    lines = table(spark, sf_dir, "lineitem")
    insert_overwrite(lines, "parquet", folder, "l_returnflag")
    insert_overwrite(lines, "parquet", folder, "l_returnflag")
    return spark.read.schema(lines.schema).parquet(folder)


@query(
    "select event_id, ts, user_id, event_type, "
    "case when event_type in ('error', 'click') then value + 100 else value end as value, props "
    "from events"
)
def replaced_partitions(spark, sf_dir):
    """Rewrite two partitions of a table from their own rows; the others are not touched."""
    folder = scratch_dir(spark, "replaced_partitions")
    events = table(spark, sf_dir, "events")
    write_files(events, "parquet", folder, "event_type")
    stored = spark.read.schema(events.schema).parquet(folder)
    changed = stored.where(F.col("event_type").isin("error", "click"))
    overwrite_partitions(changed.withColumn("value", F.col("value") + 100), folder, "event_type")
    return spark.read.schema(events.schema).parquet(folder)


@query("select *, 2024 as year, 2 as month, 1 as day from orders")
def file_to_table(spark, sf_dir):
    """Load delivered CSV files into a table partitioned by the load date."""
    orders = table(spark, sf_dir, "orders")
    job = new_job(
        spark, "file_to_table", [EntitySpec("orders", "*.csv")],
        partition_by=("year", "month", "day"), reader_options=EXACT_TIMESTAMPS,
    )
    save_schema(spark, orders, job.schema_path, "orders")
    write_files(orders, "csv", job.input_dir)
    return load_files(spark, job)["orders"]


@query(
    f"""{EARLY_AND_LATE}
    select *, 2024 as year, 2 as month, 2 as day from late
    union all
    select *, 2024 as year, 2 as month, 1 as day from early
    where o_orderkey not in (select o_orderkey from late)
    """
)
def file_to_merged_table(spark, sf_dir):
    """Two days of deliveries merged by key; updated rows move to the second day's partition."""
    orders = table(spark, sf_dir, "orders")
    first = new_job(
        spark, "file_to_merged_table", [EntitySpec("orders", "*.csv", "o_orderkey")],
        output_format="delta", partition_by=("year", "month", "day"),
        reader_options=EXACT_TIMESTAMPS,
    )
    second = dataclasses.replace(first, ctx=JobContext(first.ctx.job_id, DAY_TWO))
    save_schema(spark, orders, first.schema_path, "orders")
    write_files(early_orders(spark, sf_dir), "csv", first.input_dir)
    write_files(late_orders(spark, sf_dir), "csv", second.input_dir)
    load_files(spark, first)
    return load_files(spark, second)["orders"]


@query(
    "select *, case when o_orderdate < timestamp '1999-01-01' then 1 else 2 end as load_run "
    "from orders"
)
def pending_files(spark, sf_dir):
    """Two deliveries, three runs: each run takes the files no run before it has recorded."""
    folder = scratch_dir(spark, "pending_files")
    inbox, ledger, loaded = f"{folder}/in", f"{folder}/ledger", f"{folder}/table"
    orders = table(spark, sf_dir, "orders")
    first = matching(orders, "o_orderdate < timestamp '1999-01-01'")
    deliveries = [first, matching(orders, LATE), None]
    for run, delivery in enumerate(deliveries, start=1):
        if delivery is not None:
            delivery.write.mode("append").parquet(inbox)
        rows, files = read_pending(spark, "parquet", inbox, ledger, orders.schema, "*.parquet")
        if rows is not None:
            rows.withColumn("load_run", F.lit(run)).write.mode("append").parquet(loaded)
            record_files(files, ledger)
    return spark.read.parquet(loaded)


@query(
    "select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus, "
    "case when o_orderdate < timestamp '1999-01-01' then 1 else 2 end as load_run from orders"
)
def pending_in_dated_folders(spark, sf_dir):
    """The same from hive-style input folders, whose values are columns."""
    folder = scratch_dir(spark, "pending_in_dated_folders")
    inbox, ledger, loaded = f"{folder}/in", f"{folder}/ledger", f"{folder}/table"
    orders = table(spark, sf_dir, "orders")
    first = matching(orders, "o_orderdate < timestamp '1999-01-01'")
    for run, delivery in enumerate([first, matching(orders, LATE), None], start=1):
        if delivery is not None:
            delivery.write.mode("append").partitionBy("o_orderstatus").parquet(inbox)
        rows, files = read_pending(spark, "parquet", inbox, ledger, orders.schema, "*.parquet")
        if rows is not None:
            rows.withColumn("load_run", F.lit(run)).write.mode("append").parquet(loaded)
            record_files(files, ledger)
    return spark.read.parquet(loaded)


@query("select *, 2024 as year, 2 as month, 1 as day from supplier")
def dated_delivery(spark, sf_dir):
    """Files found by the naming rule of a daily delivery, beside those of another day."""
    supplier = table(spark, sf_dir, "supplier")
    job = new_job(
        spark, "dated_delivery", [EntitySpec("supplier", entity_glob("supplier", DAY_ONE, "json"))],
        input_format="json", partition_by=("year", "month", "day"),
    )
    save_schema(spark, supplier, job.schema_path, "supplier")
    for day in (DAY_ONE, DAY_TWO):
        supplier.write.json(f"{job.input_path}/written/{day}")
        deliver_named(spark, f"{job.input_path}/written/{day}", job.input_dir, "supplier_", f"_{day}.json")
    return load_files(spark, job)["supplier"]


@query(
    """
    select 'customer' as entity, c_custkey as id, c_name as name, c_acctbal as balance,
           2024 as year, 2 as month, 1 as day from customer
    union all
    select 'supplier', s_suppkey, s_name, s_acctbal, 2024, 2, 1 from supplier
    """
)
def entities_in_one_pass(spark, sf_dir):
    """Two entities of one delivery, told apart by file name, loaded with the same settings."""
    job = new_job(
        spark, "entities_in_one_pass",
        [EntitySpec("customer", "*.json"), EntitySpec("supplier", "*.json.gz")],
        input_format="json", partition_by=("year", "month", "day"),
    )
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    save_schema(spark, customer, job.schema_path, "customer")
    save_schema(spark, supplier, job.schema_path, "supplier")
    customer.write.json(job.input_dir)
    supplier.write.mode("append").option("compression", "gzip").json(job.input_dir)
    loaded = load_files(spark, job)
    chunks = [
        tagged(loaded[name], "entity", name).select(
            "entity", F.col(f"{p}key").alias("id"), F.col(f"{p[0]}_name").alias("name"),
            F.col(f"{p[0]}_acctbal").alias("balance"), "year", "month", "day",
        )
        for name, p in (("customer", "c_cust"), ("supplier", "s_supp"))
    ]
    return union_chunks(spark, chunks, chunks[0].schema)
