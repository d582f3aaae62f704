"""Streaming sinks, triggers and waiting."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tableflow.sinks.files import replace_files
from tableflow.sinks.keyed import upsert_into
from tableflow.sources.files import storage_format
from tableflow.specs import JobContext, as_names


def trigger_of(interval_ms: int) -> dict[str, object]:
    """Negative: process what is there, then stop. Otherwise one micro-batch per interval."""
    if interval_ms < 0:
        return {"availableNow": True}
    return {"processingTime": f"{interval_ms} milliseconds"}


def checkpoint_of(table_path: str, swapped: bool = False) -> str:
    """Progress is kept inside the table's folder, where readers ignore it; beside it for a table
    that is ``swapped`` as a whole while the stream runs."""
    return f"{table_path}__checkpoints" if swapped else f"{table_path}/_checkpoints"


def start_all(starts: Iterable[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start queries one after another; if one can't start, those before it are stopped."""
    started: list[StreamingQuery] = []
    try:
        for start in starts:
            started.append(start())
    except BaseException:
        for query in started:
            query.stop()
        raise
    return started


def archive_options(input_path: str, ctx: JobContext) -> dict[str, str]:
    """Let the file source archive what it has read; Spark does so one run later."""
    return {
        "cleanSource": "archive",
        "sourceArchiveDir": ctx.dated_dir(f"{input_path}/archive"),
    }


def append_stream(
    df: DataFrame,
    fmt: str,
    table_path: str,
    partition_by: str | Iterable[str] = (),
    interval_ms: int = -1,
) -> StreamingQuery:
    """Append every new file's rows exactly once."""
    return (
        df.writeStream.outputMode("append")
        .format(storage_format(df.sparkSession, fmt))
        .option("checkpointLocation", checkpoint_of(table_path))
        .partitionBy(*as_names(partition_by))
        .trigger(**trigger_of(interval_ms))
        .start(table_path)
    )


def upsert_stream(
    df: DataFrame,
    table_path: str,
    key: str | Iterable[str],
    order: str | Iterable[str],
    partition_by: str | Iterable[str],
    interval_ms: int = -1,
    fmt: str = "parquet",
    compare_with_stored: bool = False,
    one_partition: bool = False,
) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table.

    A micro-batch may be replayed after a failure; the upsert of the same rows changes nothing.
    """
    parts = as_names(partition_by)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_into(
            batch.sparkSession, batch, table_path, key, order, parts, fmt, compare_with_stored,
            one_partition=one_partition,
        )

    return (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_of(table_path, swapped=not parts))
        .trigger(**trigger_of(interval_ms))
        .foreachBatch(upsert_batch)
        .start()
    )


def replace_stream(
    names: DataFrame,
    contents: Callable[[list[str]], DataFrame],
    table_path: str,
    name_column: str,
    partition_by: str | Iterable[str] = (),
    interval_ms: int = -1,
) -> StreamingQuery:
    """Keep a table equal to files that may be delivered again under their names.

    A micro-batch only tells which names have news, in the one column ``name_column``, whether or not a
    row comes of them: ``contents`` gives all current rows of these names, and they are then all that
    the table has of them. So a file that came in two parts, or a second time with other lines or with
    none that count, is in the table once, as it is now.
    """
    def replace(batch: DataFrame, batch_id: int) -> None:
        found = [row[0] for row in batch.select(name_column).distinct().collect()]
        if found:
            replace_files(batch.sparkSession, contents(found), found, table_path, partition_by, name_column)

    return (
        names.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_of(table_path))
        .trigger(**trigger_of(interval_ms))
        .foreachBatch(replace)
        .start()
    )


def await_all(queries: Iterable[StreamingQuery], poll_seconds: float = 0.2) -> None:
    """Wait until all queries have ended; the first failure stops the others and is raised."""
    running = list(queries)
    while running:
        for query in list(running):
            if query.isActive:
                continue
            error = query.exception()
            if error is not None:
                for other in running:
                    other.stop()
                raise error
            running.remove(query)
        if running:
            time.sleep(poll_seconds)
