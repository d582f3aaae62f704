"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.session import scratch_dir
from tableflow.sinks.files import write_files
from tableflow.sources.storage import delete_folders, entries, make_folder, rename
from tableflow.specs import EntitySpec, JobContext, LoadJob

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY_ONE = dt.date(2024, 2, 1)
DAY_TWO = dt.date(2024, 2, 2)

# The line items split into what is stored and what arrives later; together they are all rows.
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate", "l_partkey")
STORED = "l_shipdate < timestamp '1999-07-01'"
ARRIVING = "l_shipdate >= timestamp '1999-07-01'"

# Orders split with an overlap: the early ones are stored, the late ones update and insert.
EARLY = "o_orderdate < timestamp '2000-01-01'"
LATE = "o_orderdate >= timestamp '1999-01-01'"
EARLY_AND_LATE = f"""
    with early as (select * from orders where {EARLY}),
         late as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 as o_totalprice,
                         o_orderdate, o_orderpriority from orders where {LATE})
"""

LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_LINE_NEWEST = (
    "l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, "
    "l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc"
)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matching(df: DataFrame, condition: str) -> DataFrame:
    """Rows that meet a condition of the SQL below. The tables' timestamps have no time zone, and
    with literals of the same kind the condition reaches the scan."""
    return df.where(condition.replace("timestamp '", "timestamp_ntz '"))


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching(table(spark, sf_dir, "lineitem"), STORED)


def arriving_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching(table(spark, sf_dir, "lineitem"), ARRIVING)


def early_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching(table(spark, sf_dir, "orders"), EARLY)


def late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the last years at a higher price; a year of them is among the early ones too."""
    late = matching(table(spark, sf_dir, "orders"), LATE)
    return late.withColumn("o_totalprice", F.col("o_totalprice") + 1000)


def newest_lines(condition: str, extra_key: str = "") -> str:
    """SQL for the newest line item per key among those that meet a condition."""
    key = "l_orderkey, l_linenumber" + extra_key
    return (
        f"select {LINE_COLUMNS} from (select *, row_number() over (partition by {key} "
        f"order by {_LINE_NEWEST}) as rank_in_key from lineitem where {condition}) "
        "where rank_in_key = 1"
    )


def deliver(df: DataFrame, root: str, ctx: JobContext, entity: str, fmt: str = "csv") -> None:
    """Put a table's rows as files where a job looks for an entity's delivery."""
    write_files(df, fmt, f"{ctx.dated_dir(root)}/{entity}", overwrite=True)


def deliver_named(spark: SparkSession, written: str, folder: str, stem: str, ending: str) -> None:
    """Move the files of a written folder into another, named by a stem and a number."""
    make_folder(spark, folder)
    for i, name in enumerate(sorted(n for n in entries(spark, written) if n.startswith("part-"))):
        delete_folders(spark, [f"{folder}/{stem}{i}{ending}"])
        rename(spark, f"{written}/{name}", f"{folder}/{stem}{i}{ending}")


def save_schema(spark: SparkSession, df: DataFrame, root: str, entity: str) -> None:
    text = spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(f"{root}/{entity}.json")


def new_job(
    spark: SparkSession, name: str, entities: list[EntitySpec], day: dt.date = DAY_ONE, **settings
) -> LoadJob:
    """A job over fresh folders of the shared scratch space."""
    root = scratch_dir(spark, name)
    return LoadJob(
        JobContext(name, day), f"{root}/in", f"{root}/out", tuple(entities),
        schema_path=f"{root}/schema", **settings,
    )
