"""Raw landing: delivered text files kept line by line under job, date and file name."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableflow.operators.records import line_place, whole_records
from tableflow.sinks.ledger import read_pending, record_files
from tableflow.sources.manifest import manifest
from tableflow.sources.storage import (
    delete_folders, empty_files, partition_folder, partition_value, write_text,
)
from tableflow.sources.tables import names_table
from tableflow.specs import EntitySpec, JobContext, glob_pattern

LINE = StructType().add("value", "string")
# Behind each record that may go over several lines: ASCII's record separator and a line feed.
RECORD_END = "\x1e\n"


def _day_folder(landing_path: str, ctx: JobContext) -> str:
    return f"{landing_path}/job_id={ctx.job_id}/execution_date={ctx.execution_date.isoformat()}"


def _over_lines(options: Mapping[str, str] | None) -> dict[str, str] | None:
    """Quote and escape of CSV options that allow records over several lines; None for any other."""
    given = {k.lower(): str(v) for k, v in (options or {}).items()}
    if given.get("multiline", "").lower() != "true":
        return None
    return {"quote": given.get("quote", '"'), "escape": given.get("escape", "\\")}


def land_files(
    spark: SparkSession,
    input_path: str,
    globs: Iterable[str],
    landing_path: str,
    ctx: JobContext,
    ledger_path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Copy the lines of matching files to ``<landing>/job_id=/execution_date=/file_name=``.

    With ``multiLine`` among the CSV ``options`` whole records are landed, each with ``RECORD_END`` behind it;
    a record that holds it fails the job.

    Landing a file again replaces that file's lines only; with a ledger, files landed before are
    left alone. A file without lines lands as an empty file. A large file is split over tasks like
    any text scan, so one delivery of any size is no single task's work.
    """
    patterns = list(dict.fromkeys(globs))
    pattern = patterns[0] if len(patterns) == 1 else "{" + ",".join(patterns) + "}"
    taken, quoting = None, _over_lines(options)
    columns = {"file_name": F.col("_metadata.file_name"), **(line_place() if quoting else {})}
    reading = {"lineSep": "\n"} if quoting else {}
    if ledger_path:
        lines, taken = read_pending(
            spark, "text", input_path, ledger_path, LINE, pattern, reading, columns=columns
        )
        if lines is None and not taken.head(1):
            return
    else:
        lines = spark.read.options(**reading).option("pathGlobFilter", pattern).text(input_path)
        lines = lines.select("value", *[c.alias(name) for name, c in columns.items()])
    if lines is not None:
        # A split's records come from one task, so there are no more parts than splits, and no need to deal them.
        land_lines(whole_records(lines, **quoting) if quoting else lines, landing_path, ctx, options)
    files = taken if taken is not None else manifest(spark, input_path, pattern)
    for row in files.where("length = 0").select("name").toLocalIterator():
        _land_empty(spark, landing_path, ctx, row["name"])
    if taken is not None:
        record_files(taken, ledger_path)


def _land_empty(spark: SparkSession, landing_path: str, ctx: JobContext, name: str) -> None:
    """A file without lines in place of whatever was landed under its name."""
    folder = partition_folder(spark, _day_folder(landing_path, ctx), [("file_name", name)])
    delete_folders(spark, [folder])
    write_text(spark, f"{folder}/part-empty", "")


def land_lines(
    lines: DataFrame, landing_path: str, ctx: JobContext, options: Mapping[str, str] | None = None
) -> None:
    """Land lines, or with ``multiLine`` records, given as ``value`` and ``file_name``."""
    end = "\n"
    if _over_lines(options):
        end, marked = RECORD_END, F.contains("value", F.lit(RECORD_END))
        refused = F.raise_error(F.lit("a record holds the mark of a record's end"))
        lines = lines.withColumn("value", F.when(marked, refused).otherwise(F.col("value")))
    (
        lines.select(
            "value",
            F.lit(ctx.job_id).alias("job_id"),
            F.lit(ctx.execution_date.isoformat()).alias("execution_date"),
            "file_name",
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("job_id", "execution_date", "file_name")
        .text(landing_path, lineSep=end)
    )


def landed_lines(
    spark: SparkSession, landing_path: str, ctx: JobContext, names: Iterable[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Landed lines of one job and date, or of some of its files; no other folder is listed.

    With ``multiLine`` among the CSV ``options``, which then were given to ``land_files`` as well, a row is
    a record with its line breaks.
    """
    day = _day_folder(landing_path, ctx)
    folders = [day] if names is None else [partition_folder(spark, day, [("file_name", n)]) for n in names]
    reader = spark.read.format("text").schema("value string, file_name string").option("basePath", day)
    if _over_lines(options):
        reader = reader.option("lineSep", RECORD_END)
    return reader.load(folders)


def landed_names(spark: SparkSession, landing_path: str, ctx: JobContext, entity: EntitySpec) -> DataFrame:
    """Stream of the names of an entity's files that have been landed, or landed again, since the last time."""
    day = spark.readStream.format("text").schema("value string, file_name string").load(_day_folder(landing_path, ctx))
    return day.where(F.col("file_name").rlike(glob_pattern(entity.glob))).select("file_name")


def landed_files(spark: SparkSession, landing_path: str, ctx: JobContext) -> DataFrame:
    """Names and sizes of the files landed for a job and date, from a listing: no line is read."""
    folder = _day_folder(landing_path, ctx)
    listed = (
        spark.read.format("binaryFile")
        .schema(
            "path string, modificationTime timestamp, length bigint, content binary, "
            "file_name string"
        )
        .load(folder)
        .select(F.col("file_name").alias("name"), "length")
    )
    empty = [
        (partition_value(spark, file.split("/")[-2]),) for file, _ in empty_files(spark, folder)
    ]
    if empty:
        nothing = names_table(spark, "name", [name for name, in empty])
        listed = listed.unionByName(nothing.withColumn("length", F.lit(0).cast("long")))
    return listed.groupBy("name").agg(F.sum("length").alias("length"))


def landed_records(
    lines: DataFrame,
    entity: EntitySpec,
    schema: StructType,
    header: str | None = None,
    options: Mapping[str, str] | None = None,
    with_name: bool = False,
) -> DataFrame:
    """Parse an entity's landed CSV lines; ``with_name`` keeps the column ``file_name``.

    Lines of one file may lie in several parts, so a header is recognised by its text and not by
    its position; pass it as it stands in the files. Blank lines are skipped, as in a CSV scan.
    Records over several lines must be whole in ``lines``, as ``landed_lines`` gives them.
    """
    wanted = lines.where(F.col("file_name").rlike(glob_pattern(entity.glob)) & (F.trim("value") != ""))
    if header is not None:
        wanted = wanted.where(F.col("value") != header)
    parsed = F.from_csv("value", schema.simpleString(), dict(options or {}))
    name = ["file_name"] if with_name else []
    return wanted.select(parsed.alias("record"), *name).select("record.*", *name)
