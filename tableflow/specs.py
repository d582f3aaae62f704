"""Plain descriptions of entities, tables and jobs."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

# The format names a job may use.
FORMATS = ("csv", "json", "parquet", "delta", "hudi")

# Formats whose tables are keyed and mutable.
KEYED_FORMATS = ("delta", "hudi")


def as_names(names: str | Iterable[str] | None) -> tuple[str, ...]:
    """Accept one column name, several, or none."""
    if names is None:
        return ()
    return (names,) if isinstance(names, str) else tuple(names)


def check_format(name: str) -> str:
    if name not in FORMATS:
        raise ValueError(f"unknown file format '{name}', expected one of {', '.join(FORMATS)}")
    return name


def entity_glob(name: str, date: dt.date, extension: str = "csv") -> str:
    """File-name convention of a daily delivery: every file of the day is input."""
    return f"{name}_*{date.isoformat()}.{extension}"


def glob_pattern(glob: str) -> str:
    """A file pattern as a regular expression of the whole name.

    ``*`` and ``?`` stand for any characters and one character, ``[a-c]``, ``[^a]`` and ``[!a]`` for one of
    a set or outside it, ``{x,y}`` for alternatives, and a backslash takes away such meaning.
    """
    out, depth, at = [], 0, 0
    while at < len(glob):
        c = glob[at]
        at += 1
        if c == "\\" and at < len(glob):
            out.append(re.escape(glob[at]))
            at += 1
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in glob[at + 1 :]:
            end = glob.index("]", at + 1)
            members = glob[at:end]
            outside = members[0] in "!^"
            members = members[1:] if outside else members
            escaped = re.sub(r"([\\\[\]&^])", r"\\\1", members)
            out.append(f"[{'^' if outside else ''}{escaped}]")
            at = end + 1
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
    if depth:
        raise ValueError(f"a brace is open in the file pattern '{glob}'")
    return f"^{''.join(out)}$"


@dataclass(frozen=True)
class EntitySpec:
    """A named dataset: which files hold it, what identifies a row, which row is newer.

    ``key`` and ``order`` may name several columns; ``order`` stays empty unless given.
    """

    name: str
    glob: str
    key: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "key", as_names(self.key))
        object.__setattr__(self, "order", as_names(self.order))


@dataclass(frozen=True)
class TableSpec:
    """A keyed result table."""

    name: str
    key: tuple[str, ...]
    order: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "key", as_names(self.key))
        object.__setattr__(self, "order", as_names(self.order))


@dataclass(frozen=True)
class JobContext:
    """Job id and execution date; both are part of the directory layout."""

    job_id: str
    execution_date: dt.date

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", self.job_id):
            raise ValueError(f"job id '{self.job_id}' names a folder: letters, digits, _ . - only")

    def dated_dir(self, root: str) -> str:
        return f"{root}/{self.job_id}/{self.execution_date.isoformat()}"

    def job_dir(self, root: str) -> str:
        return f"{root}/{self.job_id}"


@dataclass(frozen=True)
class LoadJob:
    """Settings shared by the batch, streaming and keyed loaders.

    ``trigger_interval_ms`` below zero means "take what is there, then stop".
    ``ledger_path`` turns on consume-once for batch loads; ``archive_sources`` lets the
    streaming file source archive what it has read.
    """

    ctx: JobContext
    input_path: str
    output_path: str
    entities: tuple[EntitySpec, ...]
    input_format: str = "csv"
    output_format: str = "parquet"
    reader_options: Mapping[str, str] = field(default_factory=dict)
    schema_path: str | None = None
    partition_by: tuple[str, ...] = ()
    overwrite: bool = False
    ledger_path: str | None = None
    archive_sources: bool = False
    trigger_interval_ms: int = -1

    def __post_init__(self):
        check_format(self.input_format)
        check_format(self.output_format)
        object.__setattr__(self, "entities", tuple(self.entities))
        object.__setattr__(self, "partition_by", as_names(self.partition_by))

    @property
    def input_dir(self) -> str:
        return self.ctx.dated_dir(self.input_path)

    def table_path(self, entity: EntitySpec) -> str:
        return f"{self.ctx.job_dir(self.output_path)}/{entity.name}"
