"""Session defaults for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tableflow.sources.storage import delete_folders

_local_roots: dict[str, str] = {}


def local_session(app: str, cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: executors of a cluster
    cannot see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tableflow-")
    return _local_roots[app]


@contextmanager
def stored_once(spark: SparkSession, df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Rows written to the scratch folder and read back while the block runs.

    For results that are costly to compute and used several times: a lost executor costs a file
    read, not the computation.
    """
    folder = scratch_dir(spark, name)
    df.write.parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        delete_folders(spark, [folder])


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the scratch folder. Queries and operators that
    return a table keep the stored tables it reads, so this is for the end of a job."""
    delete_folders(spark, [f"{scratch_root(spark)}/tableflow/{spark.conf.get('spark.app.id')}"])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run; all of an application's folders share one parent."""
    app = spark.conf.get("spark.app.id")
    return f"{scratch_root(spark)}/tableflow/{app}/{name}-{uuid.uuid4().hex}"
