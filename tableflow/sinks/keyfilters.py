"""Key filters: which data files of a keyed table may hold a key, told without opening them.

Beside the table, in a folder that readers ignore, two tables say per data file how its keys are
bounded and which bits their hashes set (a Bloom filter of 64-bit words, one row per word that has a
bit set; four bits a key in one word, two to four keys a word). They are partitioned as the table is, and a merge renews those of the
partitions it rewrites. A file without an entry, because another writer made it or a run stopped
before the entries were written, is always searched, and entries of files that are gone are ignored; so
filters never change a result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tableflow.functions.columns import all_quoted, is_orderable, quoted
from tableflow.session import stored_once
from tableflow.sinks.files import overwrite_partitions
from tableflow.sources.storage import delete_folders, has_files, partition_folder
from tableflow.sources.tables import read_folders

KEYS_PER_WORD = 4


def _folder(path: str, key: tuple[str, ...], table: str) -> str:
    return "/".join([path.rstrip("/"), "_key_filters", ",".join(key), table])


def _ranged(schema: StructType, key: tuple[str, ...]) -> list[str]:
    return [k for k in key if is_orderable(schema[k].dataType)]


def key_bounds(df: DataFrame, key: tuple[str, ...]) -> dict[str, tuple]:
    """Least and greatest value of each key column that has an order."""
    ranged = _ranged(df.schema, key)
    if not ranged:
        return {}
    found = df.agg(*[f(quoted(k)) for k in ranged for f in (F.min, F.max)]).first()
    return {k: (found[2 * i], found[2 * i + 1]) for i, k in enumerate(ranged)}


def _hash(key: tuple[str, ...]) -> Column:
    """Hash of a key, null if a part of it is, as such keys match nothing."""
    return F.when(reduce(and_, [quoted(k).isNotNull() for k in key]), F.xxhash64(*all_quoted(key)))


def _word(words: str) -> Column:
    return F.col("__hash").bitwiseAND(F.col(words) - 1)


def _mask() -> Column:
    """The four bits of a key within its word, from parts of the hash that don't choose the word."""
    bits = (f"shiftleft(1L, cast(shiftrightunsigned(__hash, {at}) & 63L as int))" for at in (40, 46, 52, 58))
    return F.expr(" | ".join(bits))


def _file_fields(schema: StructType, key: tuple[str, ...]) -> list[StructField]:
    bounds = StructType().add("hash", "long")
    for i, k in enumerate(_ranged(schema, key)):
        bounds.add(f"k{i}", schema[k].dataType)
    own = StructType().add("__file", "string").add("__keys", "long").add("__words", "long")
    return [*own.fields, StructField("__low", bounds), StructField("__high", bounds)]


_BITS = StructType().add("__file", "string").add("__words", "long").add("__word", "long").add("__bits", "long")


def _read(spark: SparkSession, folder: str, fields: Iterable[StructField], schema: StructType, parts: Sequence[str]) -> DataFrame:
    return read_folders(spark, folder, StructType([*fields, *(schema[p] for p in parts)]))


def _write(df: DataFrame, folder: str, parts: tuple[str, ...]) -> None:
    if parts:
        overwrite_partitions(df, folder, parts)
    else:
        df.write.mode("overwrite").parquet(folder)


def renew(
    spark: SparkSession, path: str, schema: StructType, key: tuple[str, ...], parts: tuple[str, ...] = (),
    folders: Sequence[str] = (), emptied: Iterable[tuple] = (),
) -> None:
    """Make the entries of the files in ``folders`` (of all files without) anew and delete those of ``emptied``
    partitions. Only key columns are read. Bits are combined before their shuffle by file and word,
    so a large file or a hot key is spread over tasks."""
    headers, bits = (_folder(path, key, t) for t in ("files", "bits"))
    gone = [partition_folder(spark, t, zip(parts, v, strict=True)) for v in emptied for t in (headers, bits)]
    delete_folders(spark, gone)
    if parts and not folders:
        return
    table = read_folders(spark, path, schema, folders)
    rows = table.select(
        *all_quoted(dict.fromkeys((*key, *parts))), F.col("_metadata.file_path").alias("__file"), _hash(key).alias("__hash"),
    )
    bounded = {"hash": F.col("__hash")} | {f"k{i}": quoted(k) for i, k in enumerate(_ranged(schema, key))}
    has_key = F.col("__hash").isNotNull()
    ends = [
        F.struct(*[f(F.when(has_key, c)).alias(n) for n, c in bounded.items()]).alias(end)
        for f, end in ((F.min, "__low"), (F.max, "__high"))
    ]
    found = rows.groupBy("__file", *all_quoted(parts)).agg(F.approx_count_distinct("__hash").alias("__keys"), *ends)
    needed = F.greatest(F.col("__keys"), F.lit(1)) / KEYS_PER_WORD
    words = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(needed)), F.lit(0))).cast("long")
    found = found.withColumn("__words", words).select(*[f.name for f in _file_fields(schema, key)], *all_quoted(parts))
    with stored_once(spark, found, "key-filters") as found:
        sized = rows.where("__hash is not null").join(found.select("__file", "__words"), "__file")
        kept = (
            sized.select("__file", "__words", _word("__words").alias("__word"), _mask().alias("__mask"), *all_quoted(parts))
            .groupBy("__file", "__words", "__word", *all_quoted(parts))
            .agg(F.bit_or("__mask").alias("__bits"))
        )
        # Bits first: a file counts as known by its header.
        _write(kept.select("__file", "__words", "__word", "__bits", *all_quoted(parts)), bits, parts)
        _write(found, headers, parts)


def files_to_search(
    spark: SparkSession, path: str, schema: StructType, batch: DataFrame, key: tuple[str, ...], parts: tuple[str, ...] = ()
) -> list[str] | None:
    """The data files that may hold a key of ``batch``, which has the table's types, or None for all of them.

    Files are ruled out by their bounds, then by their bits, in a join on the word of a hash. That tests each
    key of the batch once a file within its bounds. A batch for which these are more tests than these
    files have keys is answered with None: searching the keys themselves costs less then. The driver
    gets the names of the files to search, fewer than what Spark's listing of the table holds.
    """
    headers, bits = (_folder(path, key, t) for t in ("files", "bits"))
    if not has_files(spark, headers):
        return None
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listing.select(F.col("_metadata.file_path").alias("__file"))
    known = listed.join(_read(spark, headers, _file_fields(schema, key), schema, parts), "__file", "left")
    bounds = key_bounds(batch.where(_hash(key).isNotNull()), key)
    within = F.lit(True)
    for i, (k, (low, high)) in enumerate(bounds.items()):
        if low is None:  # no key at all: nothing matches
            return []
        low, high = (F.lit(v).cast(schema[k].dataType) for v in (low, high))
        within &= (F.col(f"__low.k{i}") <= high) & (F.col(f"__high.k{i}") >= low)
    fields = ["__file", "__keys", "__words"]
    with stored_once(spark, known.where(F.col("__words").isNull() | within).select(*fields), "files-within") as near:
        total = near.agg(F.count("__words"), F.sum("__keys"), F.collect_set("__words")).first()
        hashes = batch.select(_hash(key).alias("__hash")).where("__hash is not null").distinct()
        if hashes.count() * total[0] > (total[1] or 0):
            return None
        maybe = near.where("__words is null").select("__file")
        if total[0]:
            # Sizes are powers of two, so there are few.
            sizes = F.explode(F.array(*[F.lit(w).cast("long") for w in sorted(total[2])]))
            probes = hashes.select("__hash", sizes.alias("__words"))
            probes = probes.select("__words", _word("__words").alias("__word"), _mask().alias("__mask"))
            own = _read(spark, bits, _BITS.fields, schema, parts).join(near.select("__file"), "__file", "left_semi")
            hit = own.join(probes, ["__words", "__word"]).where(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"))
            maybe = maybe.union(hit.select("__file")).distinct()
        return sorted(unquote(name) for name, in maybe.collect())
