"""Join named tables with the user's own SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def join_tables(spark: SparkSession, tables: Mapping[str, DataFrame], query: str) -> DataFrame:
    """Name each table and run the query as it is.

    Anything Spark SQL knows is reachable; the optimizer turns comma joins into equi-joins, prunes
    columns and picks the join strategy from measured sizes.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)
