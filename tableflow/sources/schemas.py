"""Schema files: Spark's own JSON form of a ``StructType``, one file per entity."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def load_schema(spark: SparkSession, schema_path: str | None, entity: str) -> StructType:
    """Read ``<schema_path>/<entity>.json`` from any file system Spark can read."""
    if not schema_path:
        raise ValueError(f"a schema path is required to load entity '{entity}'")
    file = f"{schema_path}/{entity}.json"
    try:
        text = spark.read.text(file, wholetext=True).first()
    except AnalysisException as error:
        raise ValueError(f"no schema for entity '{entity}' at {file}") from error
    if text is None:
        raise ValueError(f"the schema file of entity '{entity}' at {file} is empty")
    return StructType.fromJson(json.loads(text[0]))
