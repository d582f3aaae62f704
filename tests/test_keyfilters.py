"""Key filters: merges search fewer files and give the same rows."""

import pytest
from pyspark.sql import functions as F

from tableflow.sinks.keyed import _searched, merge_into, upsert_into
from tableflow.sinks.keyfilters import files_to_search
from tableflow.sources.tables import literal_table, saved_schema


def _scattered(spark, rows, folders):
    """Keys from 0 to twice ``rows``, even ones alone, scattered over folders that all span the whole range."""
    return spark.range(rows).select(
        (F.col("id") * 2).alias("id"), F.pmod(F.xxhash64("id"), F.lit(folders)).alias("p"), F.lit(0).alias("v"),
    )


def _same(spark, one, two):
    return [sorted(map(repr, spark.read.schema(saved_schema(spark, p)).parquet(p).collect())) for p in (one, two)]


def test_only_files_that_may_hold_a_key_are_searched(spark, tmp_path):
    path, table = str(tmp_path / "t"), _scattered(spark, 20_000, 40)
    merge_into(spark, table, path, "id", "p", key_filters=True)
    known = saved_schema(spark, path)
    batch = table.where("id in (200, 30000)").withColumn("v", F.lit(1))
    files = files_to_search(spark, path, known, batch, ("id",), ("p",))
    holding = batch.select("p").distinct().count()
    assert holding <= len(files) <= 5 and len(spark.read.parquet(path).inputFiles()) >= 40
    searched = _searched(spark, path, known, batch, ("id",), ("p",), True)
    assert len(searched.inputFiles()) == len(files) and searched.where("id in (200, 30000)").count() == 2
    absent = spark.range(201, 30_001, 2_000).select("id", F.lit(0).cast("long").alias("p"), F.lit(1).alias("v"))
    vain = files_to_search(spark, path, known, absent, ("id",), ("p",))
    assert len(vain) <= 24  # of 40 files and 15 keys each of which is found in vain in less than two of a hundred
    outside = spark.range(50_000, 50_010).select("id", F.lit(0).cast("long").alias("p"), F.lit(1).alias("v"))
    assert files_to_search(spark, path, known, outside, ("id",), ("p",)) == []
    merge_into(spark, batch.unionByName(absent), path, "id", "p", key_filters=True)
    result = spark.read.parquet(path)
    assert result.where("v = 1").count() == 17 and result.count() == 20_015


def test_a_batch_of_many_keys_searches_the_keys_themselves(spark, tmp_path):
    path, table = str(tmp_path / "t"), _scattered(spark, 2_000, 10)
    merge_into(spark, table, path, "id", "p", key_filters=True)
    assert files_to_search(spark, path, saved_schema(spark, path), table, ("id",), ("p",)) is None
    merge_into(spark, table.withColumn("v", F.lit(1)), path, "id", "p", key_filters=True)
    assert spark.read.parquet(path).agg(F.sum("v"), F.count("*")).first() == (2_000, 2_000)


def test_files_without_an_entry_are_searched_and_stale_entries_ignored(spark, tmp_path):
    path, table = str(tmp_path / "t"), _scattered(spark, 4_000, 8)
    merge_into(spark, table, path, "id", "p", key_filters=True)
    # Another writer rewrites one partition; its entries tell of files that are gone.
    upsert_into(spark, literal_table(spark, [(1, 3, 5)], "id long, p long, v int"), path, "id", (), "p")
    batch = literal_table(spark, [(1, 3, 6)], "id long, p long, v int")
    files = files_to_search(spark, path, saved_schema(spark, path), batch, ("id",), ("p",))
    assert any("/p=3/" in f for f in files)
    merge_into(spark, batch, path, "id", "p", key_filters=True)
    result = spark.read.parquet(path)
    assert result.where("id = 1").select("p", "v").collect() == [(3, 6)] and result.count() == 4_001


def test_an_emptied_partition_loses_its_entries(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, p string, v int"
    merge_into(spark, literal_table(spark, [(1, "a b/%", 0), (2, "c", 0)], ddl), path, "id", "p", key_filters=True)
    merge_into(spark, literal_table(spark, [(1, "c", 1)], ddl), path, "id", "p", key_filters=True)
    for entries in ("files", "bits"):
        kept = [f.name for f in (tmp_path / "t" / "_key_filters" / "id" / entries).iterdir() if f.is_dir()]
        assert kept == ["p=c"]
    assert sorted(spark.read.parquet(path).select("id", "p", "v").collect()) == [(1, "c", 1), (2, "c", 0)]


@pytest.mark.parametrize("parts", [(), ("p",), ("p", "q")])
def test_the_same_rows_with_and_without_filters(spark, tmp_path, parts):
    """Null keys, keys of several columns, signed zeros, values that folder names escape, rows that move, repeats."""
    ddl = "id double, name string, p string, q int, v int"
    first = [(float(i % 7), f"n {i}", ["x", "y z", "a=b/c%", None, ""][i % 5], i % 2, 0) for i in range(60)]
    first += [(None, "n", "x", 0, 0), (0.0, "zero", "x", 1, 0), (float("nan"), "n", "y z", 1, 0), (3.0, None, "x", 0, 0)]
    batches = [
        [(3.0, "n 3", "y z", 1, 1), (-0.0, "zero", "x", 1, 1), (None, "n", "x", 0, 1), (9.0, "new", "x", 0, 1)],
        [(float("nan"), "n", None, 1, 2), (9.0, "new", "other", 0, 2), (6.0, "n 6", "", 1, 2)],
        [],
        [(3.0, None, "x", 0, 3)],
    ]
    paths = [str(tmp_path / n) for n in ("with", "without")]
    for rows in (first, *batches):
        for path, filters in zip(paths, (True, False), strict=True):
            merge_into(spark, literal_table(spark, rows, ddl), path, ("id", "name"), parts, key_filters=filters)
        one, two = _same(spark, *paths)
        assert one == two
    assert len(one) == 64 + 3


def test_a_table_without_rows_and_keys_of_another_merge(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, other int, v int"
    merge_into(spark, literal_table(spark, [], ddl), path, "id", key_filters=True)
    merge_into(spark, literal_table(spark, [(1, 10, 0), (2, 20, 0)], ddl), path, "id", key_filters=True)
    # Filters of one key tell nothing of another; it gets its own.
    merge_into(spark, literal_table(spark, [(5, 20, 1)], ddl), path, "other", key_filters=True)
    merge_into(spark, literal_table(spark, [(5, 30, 2)], ddl), path, "id", key_filters=True)
    assert sorted(spark.read.parquet(path).select("id", "other", "v").collect()) == [(1, 10, 0), (5, 30, 2)]
