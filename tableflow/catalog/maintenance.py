"""Newest row per key, upsert, merge and first non-null."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.catalog.registry import (
    ARRIVING, EARLY, EARLY_AND_LATE, LATE, LINE_KEY, LINE_ORDER, STORED, arriving_lines, early_orders,
    late_orders, matching, newest_lines, query, stored_lines, table,
)
from tableflow.functions.collapse import first_non_null, first_non_null_sql
from tableflow.operators.latest import latest_per_key
from tableflow.operators.merge import merge
from tableflow.operators.upsert import upsert
from tableflow.session import scratch_dir
from tableflow.sinks.keyed import merge_into, upsert_into
from tableflow.sources.tables import stored_table

YEAR = "cast(year(l_shipdate) as int)"


def _with_year(lines):
    return lines.withColumn("ship_year", F.year("l_shipdate"))


def upserted_lines(extra_key: str = "", same_year: str = "") -> str:
    return f"""
    with incoming as ({newest_lines(ARRIVING, extra_key)}),
         stored as ({newest_lines(STORED, extra_key)})
    select * from incoming
    union all
    select * from stored s where not exists (
        select 1 from incoming i
        where i.l_orderkey = s.l_orderkey and i.l_linenumber = s.l_linenumber {same_year})
    """


SAME_YEAR = "and year(i.l_shipdate) = year(s.l_shipdate)"


@query(newest_lines("true"))
def latest_per_key_lines(spark, sf_dir):
    """The newest line item per key: a feed with many rows per key."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


@query(upserted_lines())
def upsert_precombine(spark, sf_dir):
    stored = latest_per_key(stored_lines(spark, sf_dir), LINE_KEY, LINE_ORDER)
    return upsert(stored, arriving_lines(spark, sf_dir), LINE_KEY, LINE_ORDER)


@query(f"select *, {YEAR} as ship_year from ({upserted_lines(', year(l_shipdate)', SAME_YEAR)})")
def upsert_partition_scoped(spark, sf_dir):
    """A record is identified by its key within its partition."""
    stored = _with_year(stored_lines(spark, sf_dir))
    return upsert(
        latest_per_key(stored, (*LINE_KEY, "ship_year"), LINE_ORDER),
        _with_year(arriving_lines(spark, sf_dir)), LINE_KEY, LINE_ORDER, "ship_year",
    )


@query(newest_lines("true"))
def upsert_keeps_newer_stored(spark, sf_dir):
    """Older rows arrive after newer ones were stored: the stored row wins."""
    stored = latest_per_key(arriving_lines(spark, sf_dir), LINE_KEY, LINE_ORDER)
    late = stored_lines(spark, sf_dir)
    return upsert(stored, late, LINE_KEY, LINE_ORDER, compare_with_stored=True)


@query(f"select *, {YEAR} as ship_year from ({upserted_lines(', year(l_shipdate)', SAME_YEAR)})")
def upsert_into_table(spark, sf_dir):
    """The same through a stored table: only the partitions the batch touches are rewritten."""
    path = scratch_dir(spark, "upsert_into_table")
    for batch in (stored_lines(spark, sf_dir), arriving_lines(spark, sf_dir)):
        rows = _with_year(batch)
        upsert_into(spark, rows, path, LINE_KEY, LINE_ORDER, "ship_year", schema=rows.schema)
    return stored_table(spark, "parquet", path, rows.schema, ("ship_year",), evolving=False)


@query(upserted_lines())
def upsert_into_snapshot(spark, sf_dir):
    """A keyed table without partitions: a new snapshot replaces the old one."""
    path = scratch_dir(spark, "upsert_into_snapshot")
    for batch in (stored_lines(spark, sf_dir), arriving_lines(spark, sf_dir)):
        upsert_into(spark, batch, path, LINE_KEY, LINE_ORDER, schema=batch.schema)
    return spark.read.schema(batch.schema).parquet(path)


@query(
    f"""{EARLY_AND_LATE}
    select * from late
    union all
    select * from early where o_orderkey not in (select o_orderkey from late)
    """
)
def merge_update_insert(spark, sf_dir):
    return merge(early_orders(spark, sf_dir), late_orders(spark, sf_dir), "o_orderkey")


@query(
    f"""{EARLY_AND_LATE}
    select coalesce(l.o_orderkey, e.o_orderkey) as o_orderkey,
           case when l.o_orderkey is not null then l.o_custkey else e.o_custkey end as o_custkey,
           e.o_orderstatus as o_orderstatus,
           case when l.o_orderkey is not null then l.o_totalprice else e.o_totalprice end
               as o_totalprice,
           case when l.o_orderkey is not null then l.o_orderdate else e.o_orderdate end
               as o_orderdate,
           case when l.o_orderkey is not null then l.o_orderpriority else e.o_orderpriority end
               as o_orderpriority,
           case when l.o_orderkey is not null then cast(year(l.o_orderdate) as int) end
               as order_year
    from early e full join late l on e.o_orderkey = l.o_orderkey
    """
)
def merge_evolving_schema(spark, sf_dir):
    """The batch lacks one column of the table and brings another."""
    late = late_orders(spark, sf_dir).withColumn("order_year", F.year("o_orderdate"))
    return merge(early_orders(spark, sf_dir), late.drop("o_orderstatus"), "o_orderkey")


@query(
    """
    select case when c_mktsegment = 'BUILDING' then null else c_custkey end as customer_key,
           c_name, c_nationkey,
           case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_acctbal
                else c_acctbal + 1 end as c_acctbal,
           c_mktsegment
    from customer
    union all
    select case when c_mktsegment = 'MACHINERY' then null else c_custkey end,
           c_name, c_nationkey, c_acctbal + 1, c_mktsegment
    from customer where c_mktsegment in ('BUILDING', 'MACHINERY')
    """
)
def merge_null_keys(spark, sf_dir):
    """A large share of the keys is null on both sides; null matches nothing."""
    customer = table(spark, sf_dir, "customer")

    def keyed_without(segment, raise_by):
        key = F.when(F.col("c_mktsegment") != segment, F.col("c_custkey"))
        return customer.select(
            key.alias("customer_key"), "c_name", "c_nationkey",
            (F.col("c_acctbal") + raise_by).alias("c_acctbal"), "c_mktsegment",
        )

    return merge(keyed_without("BUILDING", 0), keyed_without("MACHINERY", 1), "customer_key")


@query(
    """
    select l.l_partkey as part_key, l.l_orderkey, l.l_linenumber,
           coalesce(p.p_retailprice, l.l_extendedprice) as price, p.p_name as part_name
    from lineitem l left join part p on l.l_partkey = p.p_partkey
    union all
    select p_partkey, null, null, p_retailprice, p_name from part
    where p_partkey not in (select l_partkey from lineitem)
    """
)
def merge_many_rows_per_key(spark, sf_dir):
    """A table that repeats its key: every stored row of a matched key is updated."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_key"), "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").alias("price"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"), F.col("p_retailprice").alias("price"),
        F.col("p_name").alias("part_name"),
    )
    return merge(lines, parts, "part_key")


@query(upserted_lines())
def merge_newest(spark, sf_dir):
    """A batch that repeats its keys, merged by its newest rows."""
    stored = latest_per_key(stored_lines(spark, sf_dir), LINE_KEY, LINE_ORDER)
    return merge(stored, arriving_lines(spark, sf_dir), LINE_KEY, "latest", LINE_ORDER)


@query(
    f"""{EARLY_AND_LATE}
    select *, cast(year(o_orderdate) as int) + 1 as load_year from late
    union all
    select *, cast(year(o_orderdate) as int) as load_year from early
    where o_orderkey not in (select o_orderkey from late)
    """
)
def merge_into_table(spark, sf_dir):
    """A stored table partitioned by a column the batch changes: rows move between folders."""
    path = scratch_dir(spark, "merge_into_table")
    early = early_orders(spark, sf_dir).withColumn("load_year", F.year("o_orderdate"))
    late = late_orders(spark, sf_dir).withColumn("load_year", F.year("o_orderdate") + 1)
    for batch in (early, late):
        merge_into(spark, batch, path, "o_orderkey", "load_year", schema=early.schema)
    return stored_table(spark, "parquet", path, early.schema, ("load_year",), evolving=False)


@query(
    f"""{EARLY_AND_LATE}
    select *, cast(year(o_orderdate) * 100 + month(o_orderdate) as int) as order_month from late
    union all
    select *, cast(year(o_orderdate) * 100 + month(o_orderdate) as int) from early
    where o_orderkey not in (select o_orderkey from late)
    """
)
def merge_into_many_partitions(spark, sf_dir):
    """A table with a folder per month, merged twice with the same batch."""
    path = scratch_dir(spark, "merge_into_many_partitions")
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int")
    early, late = (
        df(spark, sf_dir).withColumn("order_month", month) for df in (early_orders, late_orders)
    )
    for batch in (early, late, late):
        merge_into(spark, batch, path, "o_orderkey", "order_month", schema=early.schema)
    return stored_table(spark, "parquet", path, early.schema, ("order_month",), evolving=False)


@query(
    f"""{EARLY_AND_LATE},
    large as (select * from late where o_totalprice > 300000)
    select *, cast(year(o_orderdate) * 100 + month(o_orderdate) as int) as order_month from large
    union all
    select *, cast(year(o_orderdate) * 100 + month(o_orderdate) as int) from early
    where o_orderkey not in (select o_orderkey from large)
    """
)
def merge_with_key_filters(spark, sf_dir):
    """A batch of scattered keys: only files whose filter may hold one of them are searched."""
    path = scratch_dir(spark, "merge_with_key_filters")
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int")
    early, late = (
        df(spark, sf_dir).withColumn("order_month", month) for df in (early_orders, late_orders)
    )
    for batch in (early, late.where("o_totalprice > 300000")):
        merge_into(spark, batch, path, "o_orderkey", "order_month", schema=early.schema, key_filters=True)
    return stored_table(spark, "parquet", path, early.schema, ("order_month",), evolving=False)


_SEGMENT = (
    "case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then '' "
    "when 'FURNITURE' then '__HIVE_DEFAULT_PARTITION__' else c_mktsegment end"
)


@query(
    """
    select c_custkey, c_name, c_nationkey, c_acctbal + 3 as c_acctbal,
           case when c_mktsegment not in ('BUILDING', 'MACHINERY', 'FURNITURE') then c_mktsegment end as segment
    from customer
    """
)
def null_like_partitions(spark, sf_dir):
    """Partition values that share the folder of null: no row is lost by upserts and merges."""
    path = scratch_dir(spark, "null_like_partitions")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.expr(_SEGMENT).alias("segment")
    )
    some = F.col("c_nationkey") < 12
    raised = [customer.withColumn("c_acctbal", F.col("c_acctbal") + i) for i in range(4)]
    upsert_into(spark, raised[1].where(some), path, "c_custkey", "c_acctbal", "segment")
    upsert_into(spark, raised[2].where(~some), path, "c_custkey", "c_acctbal", "segment")
    merge_into(spark, raised[3].where(some), path, "c_custkey", "segment")
    merge_into(spark, raised[3].where(~some), path, "c_custkey", "segment")
    return stored_table(spark, "parquet", path, customer.schema, ("segment",))


@query(
    """
    select cast(p_partkey as bigint) as p_partkey, p_brand, cast(p_size as int) as p_size,
           case when p_size <= 15 then p_retailprice end as p_retailprice
    from part
    """
)
def upsert_wider_types(spark, sf_dir):
    """A batch with a wider type and a new column, then the first batch's columns again."""
    path = scratch_dir(spark, "upsert_wider_types")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.col("p_size").cast("int").alias("p_size"), "p_retailprice"
    )
    key = ("p_partkey", "p_size", "p_brand")
    upsert_into(spark, part.where("p_size <= 35").drop("p_retailprice"), path, *key)
    wider = part.where("p_size <= 15").withColumn("p_size", F.col("p_size").cast("bigint"))
    upsert_into(spark, wider, path, *key)
    upsert_into(spark, part.where("p_size > 35").drop("p_retailprice"), path, *key)
    return stored_table(spark, "parquet", path, part.schema, ("p_brand",))


@query(
    """
    select user_id, ts, event_id, props as prop, value as amount, event_type as kind
    from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events)
    where r = 1
    """
)
def latest_with_maps(spark, sf_dir):
    """Newest event per user, with a map among its columns and a dot in a name."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", F.create_map(F.lit("props"), F.col("props")).alias("more.texts"),
        F.create_map(F.col("event_type"), F.col("value")).alias("amounts"),
    )
    newest = latest_per_key(events, "user_id", ("ts", "event_id"))
    return newest.select(
        "user_id", "ts", "event_id", F.col("`more.texts`")["props"].alias("prop"),
        F.map_values("amounts")[0].alias("amount"), F.map_keys("amounts")[0].alias("kind"),
    )


@query(
    """
    select user_id, first(event_type order by ts, event_id) filter (where event_type <> 'view') as kind,
           first(value order by ts, event_id) filter (where event_type <> 'view') as amount
    from events group by user_id
    """
)
def first_non_null_maps(spark, sf_dir):
    """The first map per user; the values can't be compared, the order can."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.when(
        F.col("event_type") != "view", F.create_map("event_type", "value")
    ).alias("a.mounts"))
    first = first_non_null(events, "user_id", ("ts", "event_id"), ["a.mounts"])
    return first.select(
        "user_id", F.map_keys("`a.mounts`")[0].alias("kind"), F.map_values("`a.mounts`")[0].alias("amount")
    )


_SPARSE_EVENTS = """
    select user_id, ts, event_id,
           case when event_type = 'purchase' then value end as purchase_value,
           case when event_type = 'error' then event_id end as error_id,
           case when event_type = 'click' then props end as click_props
    from events
"""


@query(
    f"""
    select user_id, min(ts) as ts, first(event_id order by ts, event_id) as event_id,
           first(purchase_value order by ts, event_id) filter (where purchase_value is not null)
               as purchase_value,
           first(error_id order by ts, event_id) filter (where error_id is not null) as error_id,
           first(click_props order by ts, event_id) filter (where click_props is not null)
               as click_props
    from ({_SPARSE_EVENTS}) group by user_id
    """
)
def first_non_null_events(spark, sf_dir):
    """Per user, the first value of each kind."""
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    return first_non_null(spark.sql(_SPARSE_EVENTS), "user_id", ("ts", "event_id"))


@query(
    """
    select l_orderkey,
           first(l_suppkey order by l_shipdate, l_partkey) filter (where l_suppkey is not null)
               as l_suppkey,
           first(returned order by l_shipdate, l_partkey) filter (where returned is not null)
               as returned,
           first(discounted order by l_shipdate, l_partkey) filter (where discounted is not null)
               as discounted
    from (select l_orderkey, l_shipdate, l_partkey, l_suppkey,
                 nullif(l_returnflag, 'N') as returned, nullif(l_discount, 0) as discounted
          from lineitem)
    group by l_orderkey
    """
)
def first_non_null_as_sql(spark, sf_dir):
    """The same as SQL text over a named table."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_partkey", "l_suppkey",
        F.nullif("l_returnflag", F.lit("N")).alias("returned"),
        F.nullif("l_discount", F.lit(0.0)).alias("discounted"),
    )
    lines.createOrReplaceTempView("sparse_lines")
    return spark.sql(
        first_non_null_sql(
            "sparse_lines", ("l_suppkey", "returned", "discounted"), "l_orderkey",
            ("l_shipdate", "l_partkey"),
        )
    )


# Orders as JSON-like records: what is stored, and a batch whose struct has its fields in another order,
# one less and one more, whose type for the price is narrower, and whose key is in upper case.
_NESTED_SQL = f"""
    with stored as (select * from orders where {EARLY}), batch as (select * from orders where {LATE})
    select coalesce(s.o_orderkey, b.o_orderkey) as o_orderkey,
           case when b.o_orderkey is null then s.o_custkey else {{custkey}} end as custkey,
           case when b.o_orderkey is null then s.o_totalprice else floor(b.o_totalprice) end as price,
           case when b.o_orderkey is not null then b.o_orderpriority end as priority,
           case when b.o_orderkey is null then s.o_orderstatus else b.o_orderpriority end as first_value,
           cast(case when b.o_orderkey is null then 1 else 2 end as integer) as n_values,
           case when b.o_orderkey is not null then 'late' end as first_note
    from stored s full join batch b on s.o_orderkey = b.o_orderkey
"""


def _nested_tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    entry = lambda value, **more: F.struct(*[c.alias(n) for n, c in more.items()], value.alias("value"))
    stored = matching(orders, EARLY).select(
        "o_orderkey", F.struct(F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price")).alias("details"),
        F.array(entry(F.col("o_orderstatus"))).alias("log"),
    )
    batch = matching(orders, LATE).select(
        F.col("o_orderkey").alias("O_ORDERKEY"),
        F.struct(F.col("o_orderpriority").alias("priority"), F.floor("o_totalprice").alias("PRICE")).alias("details"),
        F.array(
            entry(F.col("o_orderpriority"), note=F.lit("late")), entry(F.lit("end"), note=F.lit(None).cast("string"))
        ).alias("log"),
    )
    return stored, batch


def _nested_columns(df):
    return df.select(
        "o_orderkey", "details.custkey", "details.price", "details.priority",
        F.col("log")[0]["value"].alias("first_value"), F.size("log").alias("n_values"), F.col("log")[0]["note"].alias("first_note"),
    )


@query(_NESTED_SQL.format(custkey="s.o_custkey"))
def merge_nested_columns(spark, sf_dir):
    """Structs and arrays of structs by name: fields that the batch lacks keep their stored value."""
    stored, batch = _nested_tables(spark, sf_dir)
    path = scratch_dir(spark, "merge_nested_columns")
    merge_into(spark, stored, path, "o_orderkey")
    merge_into(spark, batch, path, "o_orderkey")
    return _nested_columns(stored_table(spark, "parquet", path, stored.schema))


@query(_NESTED_SQL.format(custkey="null"))
def upsert_nested_columns(spark, sf_dir):
    """The same as an upsert, where the new row takes the place of the stored one."""
    stored, batch = _nested_tables(spark, sf_dir)
    path = scratch_dir(spark, "upsert_nested_columns")
    upsert_into(spark, stored, path, "o_orderkey")
    upsert_into(spark, batch, path, "o_orderkey")
    return _nested_columns(stored_table(spark, "parquet", path, stored.schema))
