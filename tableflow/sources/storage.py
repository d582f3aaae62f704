"""Folder and small-file operations on whatever file system a path is on (never table data)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def entries(spark: SparkSession, path: str) -> Iterator[str]:
    """Names in a folder, one after another as the file system gives them."""
    fs, p = _hadoop(spark, path)
    statuses = fs.listStatusIterator(p)
    while statuses.hasNext():
        yield statuses.next().getPath().getName()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)


def _is_hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything a reader would look at, from its top level alone."""
    return exists(spark, path) and any(not _is_hidden(n) for n in entries(spark, path))


def empty_files(spark: SparkSession, path: str, recursive: bool = False) -> list[tuple[str, int]]:
    """(path, modification time in milliseconds) of the files without a byte, which Spark's scans
    leave out. Without ``recursive`` only hive-style folders are gone into, as scans do."""
    fs, p = _hadoop(spark, path)
    out = []
    folders = []

    def seen(status) -> None:
        if status.isDirectory():
            folders.append(status.getPath())
        elif status.getLen() == 0:
            out.append((status.getPath().toString(), status.getModificationTime()))

    for root in fs.globStatus(p) or ():
        seen(root)
    while folders:
        inside = fs.listStatusIterator(folders.pop())
        while inside.hasNext():
            status = inside.next()
            name = status.getPath().getName()
            entered = recursive or "=" in name or not status.isDirectory()
            if entered and not _is_hidden(name):
                seen(status)
    return out


def partition_value(spark: SparkSession, folder: str) -> str:
    """The value in a partition folder's name."""
    named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return named.unescapePathName(folder.partition("=")[2])


def rename(spark: SparkSession, source: str, destination: str) -> None:
    fs, src = _hadoop(spark, source)
    _, dst = _hadoop(spark, destination)
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {destination}")


def delete_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small file, or None if there is none."""
    if not exists(spark, path):
        return None
    fs, p = _hadoop(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place, then move it there."""
    fs, p = _hadoop(spark, path)
    folder, _, name = path.rpartition("/")
    _, temporary = _hadoop(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(temporary, p):
        raise OSError(f"could not write {path}")


def partition_folder(spark: SparkSession, path: str, values: Iterable[tuple[str, str | None]]) -> str:
    """Where Spark keeps the rows with these partition values (name, value as text)."""
    named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path.rstrip("/"), *(named.getPartitionPathString(n, v) for n, v in values)])


def restore_interrupted(spark: SparkSession, path: str) -> None:
    """Put the previous snapshot back if a swap stopped between its renames."""
    previous = f"{path}__previous"
    if exists(spark, path) or not exists(spark, previous):
        return
    parent, _, name = path.rstrip("/").rpartition("/")
    for entry in list(entries(spark, parent)):
        if entry.startswith(f"{name}__staging_"):
            _move_hidden(spark, f"{parent}/{entry}", previous)
            delete_folders(spark, [f"{parent}/{entry}"])
    rename(spark, previous, path)


def _move_hidden(spark: SparkSession, source: str, destination: str) -> None:
    """Move what readers ignore, such as a stream's progress or the table's schema."""
    for name in list(entries(spark, source)):
        if _is_hidden(name) and name != "_SUCCESS" and not name.endswith(".crc"):
            if not exists(spark, f"{destination}/{name}"):
                rename(spark, f"{source}/{name}", f"{destination}/{name}")


def replace_snapshot(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a whole new snapshot beside the table, then swap the folders.

    The new snapshot may read the old one; what readers ignore moves over. A write that fails
    leaves no copy behind. One writer at a time; a reader may miss the table between the renames,
    and on object stores a rename is a copy - use a table format there.
    """
    staging, previous = f"{path}__staging_{uuid.uuid4().hex}", f"{path}__previous"
    try:
        write(staging)
    except BaseException:
        delete_folders(spark, [staging])
        raise
    if exists(spark, path):
        delete_folders(spark, [previous])
        rename(spark, path, previous)
        _move_hidden(spark, previous, staging)
    rename(spark, staging, path)
    delete_folders(spark, [previous])
