"""Batch and streaming file scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tableflow.specs import KEYED_FORMATS, check_format

# Text formats cut timestamps to milliseconds unless told otherwise.
EXACT_TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


_available: dict[tuple[str, str], bool] = {}


def source_available(spark: SparkSession, name: str) -> bool:
    """Whether the session's class path has a data source of this name; asked once per application."""
    known = (spark.conf.get("spark.app.id"), name)
    if known not in _available:
        try:
            spark.read.format(name).schema("probe int").load([])
            _available[known] = True
        except Exception as error:  # a source may resolve and still refuse an empty path list
            _available[known] = "DATA_SOURCE_NOT_FOUND" not in str(error)
    return _available[known]


def storage_format(spark: SparkSession, name: str) -> str:
    """The format to store a table in: keyed formats fall back to Parquet without their jar.

    Raw lines (``text``) are read for landing but are no table format a job may name.
    """
    if name == "text":
        return name
    check_format(name)
    if name in KEYED_FORMATS and not source_available(spark, name):
        return "parquet"
    return name


def combined_options(user: Mapping[str, str] | None, job: Mapping[str, str]) -> dict[str, str]:
    """The job's own options win over the user's; option names ignore case, as in Spark."""
    fixed = {name.lower() for name in job}
    kept = {k: v for k, v in (user or {}).items() if k.lower() not in fixed}
    return {**kept, **job}


def read_batch(
    spark: SparkSession,
    fmt: str,
    path: str | Sequence[str],
    schema: StructType | None = None,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan files; without a schema it is inferred, which costs one more pass over text files.

    ``glob`` filters file names. A glob that spans folders belongs in ``path``.
    """
    job = {}
    if glob:
        job["pathGlobFilter"] = glob
    if schema is None:
        job["inferSchema"] = "true"
    reader = spark.read.format(storage_format(spark, fmt)).options(**combined_options(options, job))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def read_stream(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: StructType | None,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    entity: str = "",
) -> DataFrame:
    """Unbounded scan of a folder. A stream never infers its schema."""
    if schema is None:
        raise ValueError(f"no schema given for the stream of entity '{entity}'; streams do not infer one")
    job = {"pathGlobFilter": glob} if glob else {}
    return (
        spark.readStream.format(storage_format(spark, fmt))
        .options(**combined_options(options, job))
        .schema(schema)
        .load(path)
    )
