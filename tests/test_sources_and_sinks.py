import datetime as dt
import os
import re
import shutil
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from generator import generated_items, generated_orders
from tableflow.sinks import formats
from tableflow.sinks.files import insert_overwrite, overwrite_partitions, save_mode, write_files
from tableflow.sinks.formats import delta_create_sql, delta_merge_sql, hudi_options, native_format
from tableflow.sinks.keyed import merge_into, upsert_into
from tableflow.sinks.landing import land_files, landed_files, landed_lines, landed_records
from tableflow.sinks.ledger import read_pending, record_files
from tableflow.sources.storage import empty_files, exists, replace_snapshot, restore_interrupted
from tableflow.sources.files import (
    EXACT_TIMESTAMPS, combined_options, read_batch, read_stream, source_available, storage_format,
)
from tableflow.sources.manifest import manifest, manifest_of
from tableflow.sources.schemas import load_schema
from tableflow.sources.tables import (
    literal_table, read_folders, read_if_present, read_table, register_tables, saved_schema, table_schema,
)
from tableflow.specs import EntitySpec, JobContext, LoadJob, check_format, entity_glob, glob_pattern

# The rows of the insert sample.
INSERTED = [
    ("100", "2015-01-01", "2015-01-01T13:51:39.340396Z"),
    ("101", "2015-01-01", "2015-01-01T12:14:58.597216Z"),
    ("102", "2015-01-01", "2015-01-01T13:51:40.417052Z"),
    ("103", "2015-01-01", "2015-01-01T13:51:40.519832Z"),
    ("104", "2015-01-02", "2015-01-01T12:15:00.512679Z"),
    ("105", "2015-01-02", "2015-01-01T13:51:42.248818Z"),
]
INSERTED_DDL = "id string, creation_date string, last_update_time string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_specs(ctx):
    entity = EntitySpec("items", "items_*.csv", "itemId", "last_update_time")
    assert entity.key == ("itemId",) and entity.order == ("last_update_time",)
    assert EntitySpec("items", "*").order == ()
    job = LoadJob(ctx, "/in", "/out", (entity,))
    assert job.input_dir == "/in/shop/2021-06-21" and job.table_path(entity) == "/out/shop/items"
    assert entity_glob("items", ctx.execution_date) == "items_*2021-06-21.csv"
    with pytest.raises(ValueError, match="names a folder"):
        JobContext("a/b", ctx.execution_date)
    with pytest.raises(ValueError, match="unknown file format 'xml'"):
        check_format("xml")
    with pytest.raises(ValueError):
        LoadJob(ctx, "/in", "/out", (entity,), output_format="xml")


def test_formats_resolve_or_fall_back(spark):
    assert source_available(spark, "parquet") and not source_available(spark, "no_such_source")
    assert storage_format(spark, "csv") == "csv"
    for keyed_format in ("delta", "hudi"):
        expected = keyed_format if source_available(spark, keyed_format) else "parquet"
        assert storage_format(spark, keyed_format) == expected


def test_job_options_win(spark):
    assert combined_options({"INFERSCHEMA": "false", "header": "true"}, {"inferSchema": "true"}) == {
        "header": "true", "inferSchema": "true",
    }


def test_batch_scan_infers_filters_names_and_pads(spark, delivery, ctx):
    day = ctx.dated_dir(str(delivery / "in"))
    items = read_batch(spark, "csv", day, None, "items_*.csv", {"header": "true"})
    assert rows(items) == [(1, "bucket", 5), (2, "cup", 1), (3, "t-shirt", 2)]
    schema = load_schema(spark, str(delivery / "schema"), "items")
    typed = read_batch(spark, "csv", f"{day}/items_*.csv", schema, None, {"header": "true"})
    assert rows(typed, "itemId", "name", "price", "execution_day") == [
        (1, "bucket", 5.0, None), (2, "cup", 1.0, None), (3, "t-shirt", 2.0, None),
    ]


def test_a_malformed_field_becomes_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x\noops,y\n")
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("id int, v string")
    assert rows(read_batch(spark, "csv", str(tmp_path), schema)) == [(None, "y"), (1, "x")]


def test_schema_files(spark, delivery):
    schema = load_schema(spark, str(delivery / "schema"), "customers")
    assert schema.names == ["customerId", "name", "country", "year", "month", "day"]
    with pytest.raises(ValueError, match="entity 'nothing'"):
        load_schema(spark, str(delivery / "schema"), "nothing")
    with pytest.raises(ValueError, match="entity 'items'"):
        load_schema(spark, None, "items")
    with pytest.raises(ValueError, match="entity 'items'"):
        read_stream(spark, "csv", str(delivery), None, entity="items")


def test_sql_relations(spark, tmp_path):
    literal_table(spark, [(1,)], "id int").write.parquet(str(tmp_path / "t"))
    register_tables(spark, "parquet", {"some_table": str(tmp_path / "t")})
    assert rows(spark.sql("select id + 1 from some_table")) == [(2,)]


def test_manifest_lists_each_file_once(spark, delivery, ctx):
    day = ctx.dated_dir(str(delivery / "in"))
    listed = manifest(spark, day, "*.csv")
    assert rows(listed, "name") == [(f"{n}_2021-06-21.csv",) for n in ("customers", "items", "orders")]
    assert listed.where("length > 0 and modified_at is not null").count() == 3
    assert manifest_of(spark, day, ["items_*", "*.csv"]).count() == 3


def test_writers_keep_microseconds(spark, tmp_path):
    df = literal_table(
        spark, [(1, dt.datetime(2024, 1, 1, 0, 0, 0, 123456))], "id int, ts timestamp_ntz"
    )
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / fmt)
        write_files(df, fmt, path)
        assert rows(read_batch(spark, fmt, path, df.schema, None, EXACT_TIMESTAMPS)) == rows(df)


def test_save_modes(spark, tmp_path):
    df = literal_table(spark, [(1,)], "id int")
    write_files(df, "parquet", str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        write_files(df, "parquet", str(tmp_path / "t"))
    write_files(df, "parquet", str(tmp_path / "t"), overwrite=True)
    assert save_mode(False) == "errorifexists"


def test_partitioned_write_prunes_and_clusters(spark, tmp_path):
    path = str(tmp_path / "t")
    write_files(spark.range(1000).selectExpr("id", "id % 7 as part"), "parquet", path, "part")
    day = spark.read.parquet(path).where("part = 3")
    assert day.count() == 143 and "PartitionFilters: [isnotnull(part" in plan_of(day)
    assert len(list(Path(path).glob("part=3/*.parquet"))) == 1


def test_insert_overwrite_keeps_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = literal_table(spark, INSERTED + INSERTED[:1], INSERTED_DDL)
    for _ in range(2):
        insert_overwrite(df, "hudi", path, "creation_date")
    stored = read_if_present(spark, path, df.schema, ("creation_date",))
    assert rows(stored, *df.columns) == sorted(INSERTED + INSERTED[:1])


def test_dynamic_overwrite_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_files(spark.range(100).selectExpr("id", "id % 5 as part"), "parquet", path, "part")
    change = spark.read.parquet(path).where("part = 2").withColumn("id", F.col("id") + 1000)
    overwrite_partitions(change, path, "part")
    stored = spark.read.parquet(path)
    assert stored.count() == 100 and stored.where("id >= 1000").count() == 20


DDL = "id int, day string, o int, v string"


def test_upsert_into_creates_then_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = literal_table(spark, [(1, "01", 1, "a"), (2, "01", 1, "a"), (3, "2015-01-02", 1, "a"),
                                  (4, None, 1, "a")], DDL)
    upsert_into(spark, first, path, "id", "o", "day")
    before = {p.name for p in Path(path).glob("day=2015-01-02/*.parquet")}
    batch = literal_table(spark, [(2, "01", 2, "b"), (2, "01", 3, "c"), (9, "01", 1, "b"), (4, None, 2, "b")], DDL)
    expected = [(1, "01", 1, "a"), (2, "01", 3, "c"), (3, "2015-01-02", 1, "a"), (4, None, 2, "b"), (9, "01", 1, "b")]
    for _ in range(2):  # the same batch again changes nothing
        upsert_into(spark, batch, path, "id", "o", "day")
        stored = read_if_present(spark, path, first.schema, ("day",))
        assert rows(stored, "id", "day", "o", "v") == expected
    assert {p.name for p in Path(path).glob("day=2015-01-02/*.parquet")} == before


def test_upsert_into_without_partitions_swaps_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_into(spark, literal_table(spark, [(1, 1, "a"), (2, 1, "a")], "id int, o int, v string"), path, "id", "o")
    upsert_into(spark, literal_table(spark, [(2, 2, "b", 7)], "id int, o int, v string, extra int"), path, "id", "o")
    assert rows(spark.read.parquet(path)) == [(1, 1, "a", None), (2, 2, "b", 7)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_evolved_columns_survive_a_later_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_into(spark, literal_table(spark, [(1, "x", 1)], "id int, day string, o int"), path, "id", "o", "day")
    upsert_into(spark, literal_table(spark, [(2, "y", 1, 5)], "id int, day string, o int, extra int"), path, "id", "o", "day")
    upsert_into(spark, literal_table(spark, [(3, "y", 1)], "id int, day string, o int"), path, "id", "o", "day")
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(stored, "id", "day", "extra") == [(1, "x", None), (2, "y", 5), (3, "y", None)]


def test_merge_into_moves_rows_between_partitions(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, day string, v string"
    first = literal_table(spark, [(1, "a b/c", "x"), (2, "d", "x"), (3, "d", "x"), (4, "e", "x")], ddl)
    merge_into(spark, first, path, "id", "day", schema=first.schema)
    untouched = {p.name for p in Path(path).glob("day=e/*.parquet")}
    # Row 1 leaves the only row of its partition; row 2 leaves a partition that keeps row 3.
    batch = literal_table(spark, [(1, "f", "y"), (2, "f", "y"), (5, "f", "y")], ddl)
    for _ in range(2):
        merge_into(spark, batch, path, "id", "day")
        assert rows(spark.read.parquet(path), "id", "day", "v") == [
            (1, "f", "y"), (2, "f", "y"), (3, "d", "x"), (4, "e", "x"), (5, "f", "y"),
        ]
    assert not [p for p in Path(path).iterdir() if p.name.startswith("day=a")]
    assert {p.name for p in Path(path).glob("day=e/*.parquet")} == untouched


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, day string, v string"
    first = literal_table(spark, [(1, "a", "x")], ddl)
    empty = literal_table(spark, [], ddl)
    merge_into(spark, first, path, "id", "day")
    merge_into(spark, empty, path, "id", "day")
    for one_partition in (False, True):
        upsert_into(spark, empty, path, "id", "v", "day", one_partition=one_partition)
    assert rows(spark.read.parquet(path), "id", "day", "v") == [(1, "a", "x")]


def test_a_batch_of_one_partition(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, day string, v int"
    for batch in ([(1, "a", 1), (2, "a", 1)], [(2, "a", 2), (3, "a", 2)], [(1, "b", 3)]):
        upsert_into(spark, literal_table(spark, batch, ddl), path, "id", "v", "day", one_partition=True)
    assert rows(spark.read.parquet(path), "id", "day", "v") == [
        (1, "a", 1), (1, "b", 3), (2, "a", 2), (3, "a", 2),
    ]


def test_a_streams_table_is_not_rewritten_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    (tmp_path / "t" / "_spark_metadata").mkdir(parents=True)
    batch = literal_table(spark, [(1, "a")], "id int, day string")
    for write in (upsert_into, merge_into):
        with pytest.raises(ValueError, match="append stream"):
            write(spark, batch, path, "id", partition_by="day")


def test_merge_into_creates_the_table_with_its_schema(spark, tmp_path):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("id int, v string, later int")
    merge_into(spark, literal_table(spark, [(1, "a")], "id int, v string"), str(tmp_path / "t"), "id", schema=schema)
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [(1, "a", None)]


def test_an_interrupted_swap_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_snapshot(spark, path, lambda p: spark.range(3).write.parquet(p))
    shutil.move(path, f"{path}__previous")
    restore_interrupted(spark, path)
    assert exists(spark, path) and spark.read.parquet(path).count() == 3


def test_ledger_loads_every_file_once(spark, tmp_path):
    inbox, book = tmp_path / "in", str(tmp_path / "ledger")
    inbox.mkdir()
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("id int")

    def load():
        loaded, files = read_pending(spark, "csv", str(inbox), book, schema, "*.csv")
        result = rows(loaded) if loaded is not None else None
        if loaded is not None:
            record_files(files, book)
        return result

    (inbox / "a.csv").write_text("1\n")
    (inbox / "b with space.csv").write_text("2\n")
    assert load() == [(1,), (2,)]
    assert load() is None
    (inbox / "c.csv").write_text("3\n")
    assert load() == [(3,)]
    import os
    (inbox / "a.csv").write_text("4\n")  # delivered again under its old name
    os.utime(inbox / "a.csv", (2_000_000_000, 2_000_000_000))
    assert load() == [(4,)]
    assert load() is None


def test_landing_replaces_only_files_landed_again(spark, delivery, ctx, tmp_path):
    day, landing = Path(ctx.dated_dir(str(delivery / "in"))), str(tmp_path / "landing")
    land_files(spark, str(day), ["items_*", "orders_*"], landing, ctx)
    (day / "items_2021-06-21.csv").write_text("itemId,name,price\n7,\"a, b\",1.5\n\n")
    land_files(spark, str(day), ["items_*"], landing, ctx)
    assert rows(landed_files(spark, landing, ctx), "name") == [("items_2021-06-21.csv",), ("orders_2021-06-21.csv",)]
    lines = landed_lines(spark, landing, ctx)
    assert lines.count() == 4 + 3  # the blank line is landed too
    schema = load_schema(spark, str(delivery / "schema"), "items")
    items = landed_records(lines, EntitySpec("items", "items_*"), schema, "itemId,name,price")
    assert rows(items, "itemId", "name", "price") == [(7, "a, b", 1.5)]


def test_generated_records_stay_in_range_and_repeat(spark):
    base = spark.range(5000)
    orders = generated_orders(base, "id", 1_600_000_000_000)
    low, high = orders.selectExpr(
        "struct(min(orderId), min(customerId), min(itemId), min(quantity), min(day), min(year), min(month))",
        "struct(max(orderId), max(customerId), max(itemId), max(quantity), max(day), max(year), max(month))",
    ).first()
    assert tuple(low) == (1, 1, 1, 2, 20, 2021, 7) and high[:6] == (1000, 100, 1000, 20, 25, 2021)
    assert orders.count() == 5000 and orders.select("orderId").distinct().count() <= 1000
    items = generated_items(base, "id", 0)
    assert items.where("not (name rlike '^[A-Za-z]{10}$') or price < 0.1 or price > 50.0").count() == 0
    assert rows(generated_items(base.repartition(3), "id", 0)) == rows(items)


def test_read_table_uses_the_fallback_format(spark, tmp_path):
    insert_overwrite(spark.range(3), "delta", str(tmp_path / "t"))
    assert read_table(spark, "delta", str(tmp_path / "t")).count() == 3


def test_names_are_no_patterns_for_the_ledger(spark, tmp_path):
    inbox, book = tmp_path / "in", str(tmp_path / "ledger")
    inbox.mkdir()
    (inbox / "o1.csv").write_text("plain\n")
    (inbox / "o[1].csv").write_text("brackets\n")
    loaded, files = read_pending(spark, "csv", str(inbox), book, StructType.fromDDL("v string"), "*.csv")
    assert rows(loaded) == [("brackets",), ("plain",)] and files.count() == 2


def test_the_ledger_keeps_folder_values_and_the_files_age(spark, tmp_path):
    inbox, book = tmp_path / "in", str(tmp_path / "ledger")
    for k, day in enumerate(("a", "b")):
        (inbox / f"day={day}").mkdir(parents=True)
        (inbox / f"day={day}" / "x.csv").write_text(f"{k}\n")
    options = {"timeZone": "Asia/Tokyo"}
    loaded, files = read_pending(spark, "csv", str(inbox), book, None, "*.csv", options, "name")
    assert rows(loaded, "_c0", "day", "name") == [(0, "a", "x.csv"), (1, "b", "x.csv")]
    record_files(files, book)
    (inbox / "day=b" / "y.csv").write_text("5\n")
    loaded, _ = read_pending(spark, "csv", str(inbox), book, None, "*.csv", options)
    assert rows(loaded, "_c0", "day") == [(5, "b")]


@pytest.mark.parametrize("write", ["upsert", "merge"])
def test_partition_values_of_the_null_folder_lose_no_row(spark, tmp_path, write):
    path, ddl = str(tmp_path / "t"), "id int, day string, v int"

    def put(batch):
        if write == "upsert":
            upsert_into(spark, literal_table(spark, batch, ddl), path, "id", "v", "day")
        else:
            merge_into(spark, literal_table(spark, batch, ddl), path, "id", "day")

    put([(1, None, 1), (2, None, 1), (3, "x", 1)])
    put([(4, "", 2)])
    put([(5, "__HIVE_DEFAULT_PARTITION__", 3), (1, "", 3)])
    assert rows(read_if_present(spark, path, StructType.fromDDL(ddl), ("day",)), "id", "day", "v") == [
        (1, None, 3), (2, None, 1), (3, "x", 1), (4, None, 2), (5, None, 3),
    ]


def test_minus_zero_is_the_partition_of_zero(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, p double, v int"
    for batch in ([(1, 0.0, 1), (2, -0.0, 1)], [(3, -0.0, 2), (1, -0.0, 2)]):
        upsert_into(spark, literal_table(spark, batch, ddl), path, "id", "v", "p")
    merge_into(spark, literal_table(spark, [(2, -0.0, 5)], ddl), path, "id", "p")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, 2), (2, 5), (3, 2)]


def test_odd_partition_values_find_their_folders(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, day string, at timestamp, v int"
    odd = ["a/b", "a b", "[x]", "{y}", "100%", "é:ü", "a=b", "01", "A", "a", "x*", "q?", "'", '"', "#", "\\", "^"]
    rows_in = [(i, d, dt.datetime(2020, 1, 1, 1, 2, 3, 4500), 1) for i, d in enumerate(odd)]
    for v in (1, 2):
        batch = literal_table(spark, [(*r[:3], v) for r in rows_in], ddl)
        upsert_into(spark, batch, path, "id", "v", ("day", "at"))
    merge_into(spark, literal_table(spark, [(*r[:3], 3) for r in rows_in], ddl), path, "id", ("day", "at"))
    assert rows(read_if_present(spark, path, StructType.fromDDL(ddl)), "id", "day", "v") == [
        (i, d, 3) for i, d in enumerate(odd)
    ]


def test_the_tables_types_stay_and_values_that_do_not_fit_fail(spark, tmp_path):
    for name, parts in (("p", ("day",)), ("u", ())):
        path = str(tmp_path / name)
        upsert_into(spark, literal_table(spark, [(1, "x", 1)], "id int, day string, v int"), path, "id", "v", parts)
        wide = literal_table(spark, [(2, "y", 7, "n")], "id bigint, day string, v bigint, extra string")
        upsert_into(spark, wide, path, "id", "v", parts)
        lost = literal_table(spark, [(3, "z", 2**40)], "id int, day string, v bigint")
        with pytest.raises(Exception, match="doesn't fit"):
            upsert_into(spark, lost, path, "id", "v", parts)
        upsert_into(spark, literal_table(spark, [(1, "x", 9)], "id int, day string, v int"), path, "id", "v", parts)
        stored = read_if_present(spark, path, wide.schema, parts)
        assert stored.schema["id"].dataType.simpleString() == "int"
        assert rows(stored, "id", "v", "extra") == [(1, 9, None), (2, 7, "n")]
        assert rows(spark.read.option("mergeSchema", True).parquet(path), "id", "v") == [(1, 9), (2, 7)]


def test_progress_and_schema_survive_every_write(spark, tmp_path):
    for name, parts in (("p", ("day",)), ("u", ())):
        path = str(tmp_path / name)
        batch = literal_table(spark, [(1, "x"), (2, "y")], "id int, day string")
        (tmp_path / name / "_checkpoints").mkdir(parents=True)
        for write in (merge_into, upsert_into, merge_into):
            write(spark, batch, path, "id", partition_by=parts)
            assert (tmp_path / name / "_checkpoints").exists()
            assert (tmp_path / name / "_schema.json").exists()
        assert spark.read.parquet(path).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["p", "u"]


def test_a_failed_snapshot_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_into(spark, literal_table(spark, [(1, 1)], "id int, v int"), path, "id")
    with pytest.raises(Exception, match="is null"):
        upsert_into(spark, literal_table(spark, [(None, 1)], "id int, v int"), path, "id")
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and rows(spark.read.parquet(path)) == [(1, 1)]


def test_an_interrupted_swap_keeps_the_progress(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_snapshot(spark, path, lambda p: spark.range(3).write.parquet(p))
    shutil.move(path, f"{path}__previous")
    (tmp_path / "t__staging_1" / "_checkpoints").mkdir(parents=True)
    restore_interrupted(spark, path)
    assert (tmp_path / "t" / "_checkpoints").exists() and not (tmp_path / "t__staging_1").exists()


def test_jobs_of_an_upsert_do_not_grow_with_the_table(spark, tmp_path):
    """No listing of the whole table, no pass over footers or rows to find folders."""
    path, ddl = str(tmp_path / "t"), "id int, day string, v int"
    many = literal_table(spark, [(i, f"d{i % 40}", 1) for i in range(80)], ddl)
    upsert_into(spark, many, path, "id", "v", "day")

    def jobs(batch):
        spark.sparkContext.setJobGroup("counted", "")
        upsert_into(spark, literal_table(spark, batch, ddl), path, "id", "v", "day")
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    assert jobs([(1, "d1", 2)]) <= 8
    plan = read_folders(spark, path, many.schema, [f"{path}/day=d1"])
    assert len(plan.inputFiles()) < len(spark.read.parquet(path).inputFiles())


@pytest.mark.parametrize(("glob", "matching", "other"), [
    ("orders_{a,b}.csv", ["orders_a.csv", "orders_b.csv"], ["orders_c.csv", "orders_{a,b}.csv"]),
    ("o[0-9]?.c*", ["o12.csv", "o9x.c"], ["ox1.csv", "o1.csv"]),
    ("o[!0-9].csv", ["ox.csv"], ["o1.csv"]),
    ("o[^a].csv", ["ob.csv"], ["oa.csv"]),
    ("a.b+c\\*", ["a.b+c*"], ["a.b+cd", "aXb+c*"]),
    ("{x,y[12]}_{p,q}", ["x_p", "y2_q"], ["y_p", "y3_q"]),
])
def test_file_patterns_as_the_listing_reads_them(spark, tmp_path, glob, matching, other):
    for name in [*matching, *other]:
        (tmp_path / name).write_text("")
    assert {r.name for r in manifest(spark, str(tmp_path), glob).collect()} == set(matching)
    assert all(re.search(glob_pattern(glob), n) for n in matching)
    assert not any(re.search(glob_pattern(glob), n) for n in other)


def test_landing_of_empty_files_and_of_files_emptied_later(spark, tmp_path, ctx):
    inbox, landing = tmp_path / "in", str(tmp_path / "landing")
    inbox.mkdir()
    (inbox / "a.csv").write_text("1\n2\n")
    (inbox / "b.csv").write_text("")
    book = str(tmp_path / "ledger")
    land_files(spark, str(inbox), ["*.csv"], landing, ctx, book)
    assert rows(landed_files(spark, landing, ctx)) == [("a.csv", 4), ("b.csv", 0)]
    (inbox / "a.csv").write_text("")
    os.utime(inbox / "a.csv", (2_000_000_000, 2_000_000_000))
    land_files(spark, str(inbox), ["*.csv"], landing, ctx, book)
    assert rows(landed_files(spark, landing, ctx)) == [("a.csv", 0), ("b.csv", 0)]
    assert landed_lines(spark, landing, ctx).count() == 0
    (inbox / "b.csv").write_text("3\n")
    land_files(spark, str(inbox), ["b.csv"], landing, ctx)
    assert rows(landed_lines(spark, landing, ctx), "value", "file_name") == [("3", "b.csv")]


def test_hudi_options():
    one = hudi_options("t", "id", "ts", "day")
    assert one["hoodie.datasource.write.keygenerator.class"].endswith("SimpleKeyGenerator")
    assert one["hoodie.table.name"] == "t" and one["hoodie.datasource.write.operation"] == "upsert"
    assert one["hoodie.datasource.write.payload.class"].endswith("OverwriteWithLatestAvroPayload")
    two = hudi_options("t", ("a", "b"), "ts", ("y", "m"), "bulk_insert", compare_with_stored=True)
    assert two["hoodie.datasource.write.recordkey.field"] == "a,b"
    assert two["hoodie.datasource.write.partitionpath.field"] == "y,m"
    assert two["hoodie.datasource.write.keygenerator.class"].endswith("ComplexKeyGenerator")
    assert two["hoodie.datasource.write.payload.class"].endswith("DefaultHoodieRecordPayload")
    none = hudi_options("t", "id")
    assert none["hoodie.datasource.write.keygenerator.class"].endswith("NonpartitionedKeyGenerator")
    assert "hoodie.datasource.write.precombine.field" not in none
    with pytest.raises(ValueError):
        hudi_options("t", ())
    with pytest.raises(ValueError):
        hudi_options("t", "id", compare_with_stored=True)


def test_delta_statements():
    assert delta_merge_sql("/t", "u", ("a", "b")).count("target.`") == 2
    assert delta_create_sql("/t", "a int", ("y", "m")).endswith("PARTITIONED BY (`y`, `m`)")


def test_formats_without_a_native_path_are_refused(spark, tmp_path, monkeypatch):
    assert not native_format(spark, "hudi", "hudi") and not native_format(spark, "delta", "hudi")
    monkeypatch.setattr(formats, "storage_format", lambda _, name: name)  # as if the jars were there
    batch = literal_table(spark, [(1, "a")], "id int, day string")
    with pytest.raises(ValueError, match="delta"):
        upsert_into(spark, batch, str(tmp_path / "t"), "id", fmt="delta")
    with pytest.raises(ValueError, match="hudi"):
        merge_into(spark, batch, str(tmp_path / "t"), "id", fmt="hudi")
    assert not (tmp_path / "t").exists()


def test_a_saved_schema_is_taken_as_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_into(spark, literal_table(spark, [(1, "01")], "id int, day string"), path, "id", (), "day")
    assert saved_schema(spark, path) == StructType.fromDDL("id int, day string")
    assert table_schema(spark, path, StructType()) == saved_schema(spark, path)


def test_files_without_a_byte_are_found_where_scans_look(spark, tmp_path):
    for name in ("a", "d=1/b", "d=1/e=2/c", "deep/f", "d=1/deep/g", "_x/h", "d=1/.i", "_j"):
        file = tmp_path / "t" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("")
    (tmp_path / "t" / "full").write_text("x")
    root = f"{tmp_path}/t/"

    def found(**how):
        return sorted(path.split(root, 1)[1] for path, _ in empty_files(spark, root.rstrip("/"), **how))

    assert found() == ["a", "d=1/b", "d=1/e=2/c"]
    assert found(recursive=True) == ["a", "d=1/b", "d=1/deep/g", "d=1/e=2/c", "deep/f"]
    assert [p.split(root, 1)[1] for p, _ in empty_files(spark, f"{root}[ab]")] == ["a"]
    assert empty_files(spark, f"{root}nothing*") == []
