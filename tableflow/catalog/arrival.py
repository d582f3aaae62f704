"""Checks that data and files arrived, raw landing and listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tableflow.catalog.registry import DAY_ONE, deliver_named, query, table
from tableflow.functions.dates import parsed_date_lit
from tableflow.operators.checks import all_true, data_received, key_coverage, prefixes_exact
from tableflow.operators.checks import files_present as check_files_present
from tableflow.plans.jobs import check_data, check_files
from tableflow.session import scratch_dir
from tableflow.sinks.files import clustered, write_files
from tableflow.sinks.landing import (
    land_files, land_lines, landed_files, landed_lines, landed_records,
)
from tableflow.sources.manifest import manifest, manifest_of
from tableflow.specs import EntitySpec, JobContext

ARRIVAL_DAY = dt.date(1999, 4, 14)
LANDING = JobContext("landing", DAY_ONE)

_RECEIVED = """
    select w.entity, count(d.entity) as rows, count(d.entity) > 0 as received
    from (values ('orders'), ('lineitem'), ('events'), ('payments')) w(entity)
    left join (
        select 'orders' as entity from orders where o_orderdate = timestamp '1999-04-14'
        union all
        select 'lineitem' from lineitem where l_shipdate = timestamp '1999-04-14'
        union all
        select 'events' from events where ts = timestamp '1999-04-14'
    ) d on w.entity = d.entity
    group by w.entity
"""


def _received(spark, sf_dir):
    tables = {
        name: table(spark, sf_dir, name).select(F.col(column).alias("date"))
        for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    }
    return data_received(
        spark, tables, "date", ARRIVAL_DAY, ("orders", "lineitem", "events", "payments")
    )


@query(_RECEIVED)
def data_received_counts(spark, sf_dir):
    """Rows of a day in each expected table."""
    return _received(spark, sf_dir)


@query(f"select bool_and(received) as all_received from ({_RECEIVED})")
def data_received_verdict(spark, sf_dir):
    return all_true(_received(spark, sf_dir), "received", "all_received")


@query(
    """
    select w.entity, count(d.entity) as rows, count(d.entity) > 0 as received
    from (values ('orders'), ('lineitem')) w(entity)
    left join (
        select 'orders' as entity from orders where o_orderdate = timestamp '2024-02-01'
        union all
        select 'lineitem' from lineitem where l_shipdate = timestamp '2024-02-01'
    ) d on w.entity = d.entity
    group by w.entity
    """
)
def stored_data_not_received(spark, sf_dir):
    """The check as a job over stored tables, on a day none of them has rows for."""
    root = scratch_dir(spark, "stored_data_not_received")
    for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        rows = table(spark, sf_dir, name).withColumn("date", F.to_date(column))
        rows.write.parquet(f"{LANDING.job_dir(root)}/{name}")
    return check_data(spark, LANDING, root, ("orders", "lineitem"), "date")


@query(
    """
    select w.entity, count(d.entity) as rows, count(d.entity) > 0 as received
    from (values ('orders'), ('lineitem')) w(entity)
    left join (
        select 'orders' as entity from orders where cast(o_orderdate as date) = date '1999-04-14'
        union all
        select 'lineitem' from lineitem where cast(l_shipdate as date) = date '1999-04-14'
    ) d on w.entity = d.entity
    group by w.entity
    """
)
def stored_data_received(spark, sf_dir):
    """The same job on a day with rows, given as text."""
    root = scratch_dir(spark, "stored_data_received")
    day = spark.range(1).select(parsed_date_lit("14.04.1999", "dd.MM.yyyy")).first()[0]
    ctx = JobContext("landing", day)
    for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        rows = table(spark, sf_dir, name).withColumn("date", F.to_date(column))
        rows.write.parquet(f"{ctx.job_dir(root)}/{name}")
    return check_data(spark, ctx, root, ("orders", "lineitem"), "date")


@query(
    """
    select coalesce(w.prefix, f.prefix) as prefix, w.prefix is not null as expected,
           f.prefix is not null as found, w.prefix is not null and f.prefix is not null as matches
    from (values ('view'), ('purchase'), ('refund')) w(prefix)
    full join (select distinct event_type as prefix from events) f on w.prefix = f.prefix
    """
)
def delivered_files_exact(spark, sf_dir):
    """The check as a job that allows no other files: one delivered file per kind of event."""
    root = scratch_dir(spark, "delivered_files_exact")
    events, day = table(spark, sf_dir, "events"), LANDING.dated_dir(root)
    events.write.partitionBy("event_type").json(f"{root}/kinds")
    for kind in sorted(r[0] for r in events.select("event_type").distinct().collect()):
        deliver_named(spark, f"{root}/kinds/event_type={kind}", day, f"{kind}_", ".json")
    return check_files(spark, LANDING, root, ("view", "purchase", "refund"), "*.json", exact=True)


@query(
    """
    select 'part-' as prefix, count(*) > 0 as present from orders
    union all
    select 'orders-', false
    """
)
def delivered_files_present(spark, sf_dir):
    """The check as a job over a delivery folder; Spark names its files ``part-``."""
    root = scratch_dir(spark, "delivered_files_present")
    write_files(table(spark, sf_dir, "orders"), "csv", LANDING.dated_dir(root))
    found = check_files(spark, LANDING, root, ("part-", "orders-"), "*.csv")
    return found.select("prefix", "present")


@query(
    "select count(distinct (o_custkey, month(o_orderdate))) as found, cast(1000 as bigint) as expected, "
    "count(distinct (o_custkey, month(o_orderdate))) >= 1000 as complete from orders"
)
def key_coverage_orders(spark, sf_dir):
    """Distinct key and month against an expected total."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    return key_coverage(orders, "o_custkey", "month", 1000)


_LINE = "event_id || ',' || user_id || ',' || event_type"
_FILE = "event_type || '_' || strftime(ts, '%Y-%m-%d') || '.csv'"


def _event_lines(spark, sf_dir):
    """Events as text lines of one file per type and day."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws(",", "event_id", "user_id", "event_type").alias("value"),
        F.concat(
            "event_type", F.lit("_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")
        ).alias("file_name"),
    )


def _landed(spark, sf_dir, name):
    folder = scratch_dir(spark, name)
    land_lines(clustered(_event_lines(spark, sf_dir), "file_name"), folder, LANDING)
    return folder


@query(
    """
    select p.prefix, count(distinct strftime(e.ts, '%Y-%m-%d')) as files,
           count(e.event_id) > 0 as present
    from (values ('view_'), ('purchase_'), ('login_')) p(prefix)
    left join events e on e.event_type || '_' = p.prefix
    group by p.prefix
    """
)
def files_present(spark, sf_dir):
    """Landed files per expected prefix, one of which never arrives."""
    files = landed_files(spark, _landed(spark, sf_dir, "files_present"), LANDING)
    return check_files_present(spark, files, ("view_", "purchase_", "login_"))


@query(
    """
    select coalesce(w.prefix, f.event_type) as prefix, w.prefix is not null as expected,
           f.event_type is not null as found,
           w.prefix is not null and f.event_type is not null as matches
    from (values ('view'), ('purchase'), ('login')) w(prefix)
    full join (select distinct event_type from events) f on w.prefix = f.event_type
    """
)
def prefixes_expected(spark, sf_dir):
    """Expected against landed prefixes, both ways."""
    files = landed_files(spark, _landed(spark, sf_dir, "prefixes_expected"), LANDING)
    return prefixes_exact(spark, files, ("view", "purchase", "login"))


@query(
    f"""
    select {_FILE} as file_name, cast(sum(strlen({_LINE}) + 1) as bigint) as bytes
    from events group by {_FILE}
    """
)
def file_manifest(spark, sf_dir):
    """Sizes of landed files from a listing by two overlapping patterns, without reading them."""
    folder = _landed(spark, sf_dir, "file_manifest")
    files = manifest_of(spark, folder, ("*.txt", "part-*"), recursive=True)
    landed_name = F.regexp_extract("path", "file_name=([^/]+)/", 1)
    return files.groupBy(landed_name.alias("file_name")).agg(F.sum("length").alias("bytes"))


@query(
    f"""
    select case when event_type = 'error' then {_LINE} || ',again' else {_LINE} end as value,
           {_FILE} as file_name
    from events
    """
)
def raw_landing(spark, sf_dir):
    """Files landed a second time replace themselves and nothing else."""
    folder = _landed(spark, sf_dir, "raw_landing")
    again = _event_lines(spark, sf_dir).where(F.col("value").endswith(",error"))
    again = again.withColumn("value", F.concat("value", F.lit(",again")))
    land_lines(clustered(again, "file_name"), folder, LANDING)
    return landed_lines(spark, folder, LANDING)


@query(f"select {_LINE} as value from events")
def files_landed(spark, sf_dir):
    """Delivered files, picked by pattern, copied line by line; twice is the same as once."""
    folder = scratch_dir(spark, "files_landed")
    lines = _event_lines(spark, sf_dir).select("value")
    lines.write.text(f"{folder}/in")
    lines.write.mode("append").json(f"{folder}/in")  # no pattern takes these
    for ledger in (None, f"{folder}/ledger", f"{folder}/ledger"):
        land_files(
            spark, f"{folder}/in", ("*.txt", "part-0*.t{x,s}t"), f"{folder}/landing", LANDING, ledger
        )
    names = manifest(spark, f"{folder}/in").select(F.col("name").alias("file_name"))
    lines = landed_lines(spark, f"{folder}/landing", LANDING)
    return lines.join(names, "file_name", "left_semi").select("value")


@query("select doc_id, source, text from documents")
def landed_records_over_lines(spark, sf_dir):
    """Values with line breaks: files cut into splits anywhere, landed as lines, parsed as whole records."""
    folder = scratch_dir(spark, "landed_records_over_lines")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    csv = {"quoteAll": "true", "escape": '"', "emptyValue": "", "nullValue": "\\N", "multiLine": "true"}
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    documents.write.options(**csv, **spaces).csv(f"{folder}/in")
    land_files(spark, f"{folder}/in", ["part-*.csv"], f"{folder}/landing", LANDING, options=csv)
    records = landed_lines(spark, f"{folder}/landing", LANDING, options=csv)
    return landed_records(records, EntitySpec("part", "part-*"), documents.schema, None, csv)
