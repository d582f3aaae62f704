"""The jobs a user calls. Each reads, transforms and writes; tables are returned as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from contextlib import nullcontext
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableflow.functions.dates import with_execution_date, with_load_date
from tableflow.operators.checks import all_true, data_received, files_present, prefixes_exact
from tableflow.operators.sqljoin import join_tables
from tableflow.session import stored_once
from tableflow.sinks.files import replace_files, write_files
from tableflow.sinks.formats import hudi_options
from tableflow.sinks.keyed import merge_into, upsert_into
from tableflow.sinks.landing import land_files, landed_files, landed_lines, landed_names, landed_records
from tableflow.sinks.ledger import read_pending, record_files
from tableflow.sources.files import read_batch, read_stream
from tableflow.sources.manifest import manifest
from tableflow.sources.schemas import load_schema
from tableflow.sources.storage import has_files
from tableflow.sources.tables import read_table, stored_table
from tableflow.specs import EntitySpec, JobContext, LoadJob, TableSpec, as_names, glob_pattern
from tableflow.streaming.queries import (
    append_stream, archive_options, await_all, replace_stream, start_all, upsert_stream,
)

# Columns with one value per run. A write partitioned by these alone goes to one folder, so there
# is nothing to bring together before it.
_LOAD_DATE = {"year", "month", "day"}
_EXECUTION_DATE = {"execution_year", "execution_month", "execution_day"}


def _stored(
    spark: SparkSession, job: LoadJob, schemas: Mapping[str, StructType], evolving: bool
) -> dict[str, DataFrame]:
    return {
        e.name: stored_table(
            spark, job.output_format, job.table_path(e), schemas[e.name], job.partition_by, evolving
        )
        for e in job.entities
        if e.name in schemas
    }


# --- files to tables, batch ---------------------------------------------------------------------


def load_files(spark: SparkSession, job: LoadJob) -> dict[str, DataFrame]:
    """Load each entity's files of the day into its table, stamped with the load date.

    With a keyed ``delta`` table the batch is merged; any other table is written whole, failing if
    it is there already unless the job overwrites. With a ledger only files not loaded before are
    read; an entity without new files is left alone and not returned. The schema file, if there is
    one, is used for reading; otherwise the schema is inferred.
    """
    schemas = {}
    for entity in job.entities:
        schema = load_schema(spark, job.schema_path, entity.name) if job.schema_path else None
        ledger = f"{job.ledger_path}/{entity.name}" if job.ledger_path else None
        if ledger:
            rows, files = read_pending(
                spark, job.input_format, job.input_dir, ledger, schema, entity.glob,
                job.reader_options,
            )
            if rows is None:
                continue
        else:
            rows = read_batch(
                spark, job.input_format, job.input_dir, schema, entity.glob, job.reader_options
            )
        rows = with_load_date(rows, job.ctx.execution_date)
        schemas[entity.name] = rows.schema
        if job.output_format == "delta" and entity.key:
            merge_into(
                spark, rows, job.table_path(entity), entity.key, job.partition_by,
                job.output_format, rows.schema,
            )
        else:
            write_files(
                rows, job.output_format, job.table_path(entity), job.partition_by, job.overwrite,
                cluster=not set(job.partition_by) <= _LOAD_DATE,
            )
        if ledger:
            record_files(files, ledger)
    return _stored(spark, job, schemas, evolving=job.output_format == "delta")


# --- files to tables, streaming -----------------------------------------------------------------


def stream_files(spark: SparkSession, job: LoadJob) -> dict[str, DataFrame]:
    """Stream each entity's files into its table, one concurrent query per entity.

    Appends only. The checkpoint makes every file count once, so no ledger is needed.
    """
    archive = archive_options(job.input_path, job.ctx) if job.archive_sources else {}
    streams = {
        entity: read_stream(
            spark, job.input_format, job.input_dir,
            load_schema(spark, job.schema_path, entity.name), entity.glob,
            {**job.reader_options, **archive}, entity.name,
        )
        for entity in job.entities
    }
    return _append_all(spark, job, streams)


def stream_globs(spark: SparkSession, job: LoadJob) -> dict[str, DataFrame]:
    """As ``stream_files``, with each entity's pattern as part of the path, so it may span folders."""
    streams = {
        entity: read_stream(
            spark, job.input_format, f"{job.input_dir}/{entity.glob}",
            load_schema(spark, job.schema_path, entity.name), None, job.reader_options, entity.name,
        )
        for entity in job.entities
    }
    return _append_all(spark, job, streams)


def _append_all(
    spark: SparkSession, job: LoadJob, streams: Mapping[EntitySpec, DataFrame]
) -> dict[str, DataFrame]:
    """Stamp and start every stream, then wait for all of them."""
    stamped = {e: with_load_date(df, job.ctx.execution_date) for e, df in streams.items()}
    await_all(
        start_all(
            partial(
                append_stream, df, job.output_format, job.table_path(e), job.partition_by,
                job.trigger_interval_ms,
            )
            for e, df in stamped.items()
        )
    )
    return _stored(spark, job, {e.name: df.schema for e, df in stamped.items()}, evolving=False)


# --- keyed ingest, batch or streaming -----------------------------------------------------------


def ingest_keyed(
    spark: SparkSession, job: LoadJob, batch: bool, compare_with_stored: bool = False
) -> dict[str, DataFrame]:
    """Upsert each entity's files into its keyed table, stamped with execution columns.

    The same transform serves both modes: only the reader and the writer differ.
    """
    loads, schemas = [], {}
    one_partition = bool(job.partition_by) and set(job.partition_by) <= _EXECUTION_DATE
    for entity in job.entities:
        schema = load_schema(spark, job.schema_path, entity.name)
        path = f"{job.input_dir}/{entity.glob}"
        if batch:
            rows = read_batch(spark, job.input_format, path, schema, None, job.reader_options)
        else:
            rows = read_stream(
                spark, job.input_format, path, schema, None, job.reader_options, entity.name
            )
        rows = with_execution_date(rows, job.ctx.execution_date)
        schemas[entity.name] = rows.schema
        loads.append((entity, rows))
    if batch:
        for entity, rows in loads:
            # An upsert goes over its batch several times: parse text only once.
            with _parsed_once(spark, job, rows, entity.name) as parsed:
                upsert_into(
                    spark, parsed, job.table_path(entity), entity.key, entity.order, job.partition_by,
                    job.output_format, compare_with_stored, one_partition=one_partition,
                )
    else:
        await_all(
            start_all(
                partial(
                    upsert_stream, rows, job.table_path(entity), entity.key, entity.order,
                    job.partition_by, job.trigger_interval_ms, job.output_format,
                    compare_with_stored, one_partition,
                )
                for entity, rows in loads
            )
        )
    return _stored(spark, job, schemas, evolving=True)


def _parsed_once(spark: SparkSession, job: LoadJob, rows: DataFrame, name: str):
    is_text = job.input_format in ("csv", "json")
    return stored_once(spark, rows, name) if is_text else nullcontext(rows)


# --- join ---------------------------------------------------------------------------------------


def join_to_table(
    spark: SparkSession,
    ctx: JobContext,
    input_path: str,
    output_path: str,
    tables: Iterable[str],
    query: str,
    result: TableSpec,
    partition_by: str | Iterable[str] = (),
    input_format: str = "parquet",
    output_format: str = "parquet",
    overwrite: bool = False,
    upsert: bool = False,
    schemas: Mapping[str, StructType] | None = None,
) -> DataFrame:
    """Join stored tables by SQL and save the result as the table ``<output>/<result.name>``.

    The result replaces the table if ``overwrite``, is upserted into it if ``upsert``, and
    otherwise must not be there yet. ``schemas`` gives the types of partition columns where folder
    names would not tell them.
    """
    named = {
        t: read_table(spark, input_format, f"{ctx.job_dir(input_path)}/{t}", (schemas or {}).get(t))
        for t in tables
    }
    rows = with_execution_date(join_tables(spark, named, query), ctx.execution_date)
    path, parts = f"{output_path}/{result.name}", as_names(partition_by)
    one_partition = bool(parts) and set(parts) <= _EXECUTION_DATE
    if upsert:
        # An upsert goes over its batch several times: run the join only once.
        with stored_once(spark, rows, result.name) as batch:
            upsert_into(
                spark, batch, path, result.key, result.order, parts, output_format,
                one_partition=one_partition,
            )
    else:
        options = None
        if output_format == "hudi":
            options = hudi_options(result.name, result.key, result.order, parts, "bulk_insert")
        write_files(rows, output_format, path, parts, overwrite, options, cluster=not one_partition)
    return stored_table(spark, output_format, path, rows.schema, parts, evolving=upsert)


def ingest_then_join(
    spark: SparkSession,
    job: LoadJob,
    query: str,
    result: TableSpec,
    partition_by: str | Iterable[str] = (),
) -> DataFrame:
    """Ingest every entity into its keyed table, then join these tables into another."""
    tables = ingest_keyed(spark, job, batch=True)
    return join_to_table(
        spark, job.ctx, job.output_path, job.output_path, list(tables), query, result,
        as_names(partition_by) or job.partition_by, job.output_format, job.output_format,
        overwrite=True, schemas={name: df.schema for name, df in tables.items()},
    )


# --- checks -------------------------------------------------------------------------------------


def check_data(
    spark: SparkSession,
    ctx: JobContext,
    input_path: str,
    entities: Iterable[str],
    date_column: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Rows of the execution date in each entity's table: ``(entity, rows, received)``."""
    entities = list(entities)
    tables = {e: read_table(spark, fmt, f"{ctx.job_dir(input_path)}/{e}") for e in entities}
    return data_received(spark, tables, date_column, ctx.execution_date, entities)


def check_files(
    spark: SparkSession,
    ctx: JobContext,
    input_path: str,
    prefixes: Iterable[str],
    glob: str = "*",
    exact: bool = False,
) -> DataFrame:
    """Files of the execution date against expected name prefixes.

    ``exact`` demands that no other prefix was delivered.
    """
    files = manifest(spark, ctx.dated_dir(input_path), glob)
    check = prefixes_exact if exact else files_present
    return check(spark, files, prefixes)


def stream_then_check(
    spark: SparkSession, job: LoadJob, date_columns: Iterable[str] = ("year", "month", "day")
) -> tuple[DataFrame, bool]:
    """Stream the day's files, then tell whether every entity has rows of the day.

    Streamed tables carry the day in their load-date columns.
    """
    tables = stream_files(spark, job)
    year, month, day = as_names(date_columns)
    dated = {
        name: df.select(F.make_date(year, month, day).alias("date")) for name, df in tables.items()
    }
    counts = data_received(spark, dated, "date", job.ctx.execution_date)
    return counts, all_true(counts, "received", "all_received").first()["all_received"]


def land_check_stream(
    spark: SparkSession,
    delivery_path: str,
    landing_path: str,
    job: LoadJob,
    headers: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Land the delivered files, require one per entity, then stream the landed lines into tables.

    A delivered file is landed once, so running the job again adds nothing.
    """
    ledger = job.ledger_path or f"{landing_path}/_landed"
    globs = [e.glob for e in job.entities]
    land_files(spark, delivery_path, globs, landing_path, job.ctx, ledger, job.reader_options)
    return stream_landed(spark, landing_path, job, headers)


def stream_landed(
    spark: SparkSession,
    landing_path: str,
    job: LoadJob,
    headers: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Stream the day's landed lines into tables, or nothing while an entity's file is missing.

    A file landed again replaces its rows: tables have the column ``file_name`` for that, as the
    last partition. The first run after a change brings the table up to date.
    """
    if not has_files(spark, landing_path):
        return {}
    files = landed_files(spark, landing_path, job.ctx)
    check = files_present(spark, files, [f"{e.name}_" for e in job.entities])
    if not all_true(check, "present", "all_present").first()["all_present"]:
        return {}
    parts = (*job.partition_by, "file_name")

    def records(entity: EntitySpec, schema: StructType, names: list[str] | None = None) -> DataFrame:
        parsed = landed_records(
            landed_lines(spark, landing_path, job.ctx, names, job.reader_options), entity, schema,
            (headers or {}).get(entity.name), job.reader_options, with_name=True,
        )
        return with_load_date(parsed, job.ctx.execution_date)

    schemas = {e: load_schema(spark, job.schema_path, e.name) for e in job.entities}
    # All plans are made before the first stream starts, so that a bad one starts none.
    columns = {e: records(e, schema).schema for e, schema in schemas.items()}
    streams = {e: landed_names(spark, landing_path, job.ctx, e) for e in job.entities}
    await_all(
        start_all(
            partial(
                replace_stream, names, partial(records, e, schemas[e]), job.table_path(e), "file_name",
                job.partition_by, job.trigger_interval_ms,
            )
            for e, names in streams.items()
        )
    )
    _drop_emptied(spark, job, files)
    return {
        e.name: stored_table(spark, job.output_format, job.table_path(e), columns[e], parts, evolving=False)
        for e in job.entities
    }


def _drop_emptied(spark: SparkSession, job: LoadJob, files: DataFrame) -> None:
    """Take out the rows of files that have been landed again without a byte: no stream tells of those."""
    empty = [row["name"] for row in files.where("length = 0").collect()]
    for entity in job.entities:
        names = [n for n in empty if re.search(glob_pattern(entity.glob), n)]
        replace_files(spark, None, names, job.table_path(entity), job.partition_by, "file_name")
