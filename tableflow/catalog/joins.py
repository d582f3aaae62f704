"""SQL joins of named tables, saved joins, and SQL handed through unchanged."""

from __future__ import annotations

from tableflow.catalog.registry import (
    DAY_ONE, LINE_KEY, LINE_ORDER, deliver, new_job, newest_lines, query, save_schema, table,
)
from tableflow.operators.latest import latest_per_key
from tableflow.operators.sqljoin import join_tables
from tableflow.plans.jobs import ingest_then_join as ingest_and_join
from tableflow.plans.jobs import join_to_table
from tableflow.session import scratch_dir
from tableflow.specs import EntitySpec, JobContext, TableSpec

LINES_WITH_PARTS = (
    "select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, l_quantity, p.p_name, "
    "p.p_retailprice from lineitem l, part p where l.l_partkey == p.p_partkey"
)


def _as_is(sql: str, *tables: str):
    """A query whose text is the same for both engines."""

    def run(spark, sf_dir):
        return join_tables(spark, {t: table(spark, sf_dir, t) for t in tables}, sql)

    return run, sql


def _register(name: str, sql: str, *tables: str) -> None:
    run, text = _as_is(sql, *tables)
    run.__name__ = name
    query(text)(run)


_register("comma_join", LINES_WITH_PARTS, "lineitem", "part")
_register(
    "sql_left_join",
    "select c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice "
    "from customer c left join orders o on c.c_custkey = o.o_custkey and o.o_orderstatus = 'P'",
    "customer", "orders",
)
_register(
    "sql_semi_join",
    "select p_partkey, p_name from part p where exists "
    "(select 1 from lineitem l where l.l_partkey = p.p_partkey and l.l_returnflag = 'R')",
    "part", "lineitem",
)
_register(
    "sql_anti_join",
    "select o_orderkey, o_orderdate from orders o where not exists "
    "(select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_discount > 0.05)",
    "orders", "lineitem",
)
_register(
    "sql_theta_join",
    "select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_size "
    "from lineitem l join part p on l.l_partkey = p.p_partkey and l.l_quantity < p.p_size",
    "lineitem", "part",
)
_register(
    "sql_rollup",
    "select r.r_name, n.n_name, count(*) as customers, max(c.c_acctbal) as largest_balance "
    "from customer c join nation n on c.c_nationkey = n.n_nationkey "
    "join region r on n.n_regionkey = r.r_regionkey group by rollup (r.r_name, n.n_name)",
    "customer", "nation", "region",
)
_register(
    "sql_window_except",
    "select o_custkey, o_orderkey from (select o_custkey, o_orderkey, row_number() over "
    "(partition by o_custkey order by o_orderdate desc, o_orderkey desc) as recency from orders) "
    "where recency <= 3 except select o_custkey, o_orderkey from orders where o_orderstatus = 'F'",
    "orders",
)


@query(
    f"select *, 2024 as execution_year, 2 as execution_month, 1 as execution_day "
    f"from ({LINES_WITH_PARTS})"
)
def join_save_reload(spark, sf_dir):
    """Join stored tables, save the result as a partitioned table, read it back."""
    root = scratch_dir(spark, "join_save_reload")
    ctx = JobContext("join_save_reload", DAY_ONE)
    for name in ("lineitem", "part"):
        table(spark, sf_dir, name).write.parquet(f"{ctx.job_dir(root)}/{name}")
    return join_to_table(
        spark, ctx, root, f"{root}/joined", ("lineitem", "part"), LINES_WITH_PARTS,
        TableSpec("lines_with_parts", LINE_KEY, "l_shipdate"),
        ("execution_year", "execution_month", "execution_day"),
    )


@query(
    f"""
    with newest as ({newest_lines("true")})
    select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, l.l_quantity, p.p_name,
           p.p_retailprice, 2024 as execution_year, 2 as execution_month, 1 as execution_day
    from newest l, part p where l.l_partkey = p.p_partkey
    """
)
def ingest_then_join(spark, sf_dir):
    """Deliveries into two keyed tables, then these joined into a third."""
    job = new_job(
        spark, "ingest_then_join",
        [
            EntitySpec("lineitem", "lineitem/*.parquet", LINE_KEY, LINE_ORDER),
            EntitySpec("part", "part/*.parquet", "p_partkey"),
        ],
        input_format="parquet", output_format="hudi",
        partition_by=("execution_year", "execution_month", "execution_day"),
    )
    for name in ("lineitem", "part"):
        rows = table(spark, sf_dir, name)
        save_schema(spark, rows, job.schema_path, name)
        deliver(rows, job.input_path, job.ctx, name, "parquet")
    return ingest_and_join(
        spark, job, LINES_WITH_PARTS, TableSpec("lines_with_parts", LINE_KEY, "l_shipdate")
    )


@query(
    f"""
    with newest as ({newest_lines("true")})
    select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate,
           case when l.l_linenumber = 1 then l.l_quantity + 1 else l.l_quantity end as l_quantity,
           p.p_name, p.p_retailprice, 2024 as execution_year, 2 as execution_month, 1 as execution_day
    from newest l, part p where l.l_partkey = p.p_partkey
    """
)
def join_upserted(spark, sf_dir):
    """A join saved as a keyed table, then part of it joined again and upserted."""
    root = scratch_dir(spark, "join_upserted")
    ctx = JobContext("join_upserted", DAY_ONE)
    lines = latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)
    lines.write.parquet(f"{ctx.job_dir(root)}/lineitem")
    table(spark, sf_dir, "part").write.parquet(f"{ctx.job_dir(root)}/part")

    def join(query):
        return join_to_table(
            spark, ctx, root, f"{root}/joined", ("lineitem", "part"), query,
            TableSpec("lines_with_parts", LINE_KEY, "l_shipdate"), "execution_year", upsert=True,
        )

    join(LINES_WITH_PARTS)
    raised = LINES_WITH_PARTS.replace("l_quantity", "l_quantity + 1 as l_quantity")
    return join(f"{raised} and l.l_linenumber = 1")
