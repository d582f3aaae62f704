import dataclasses
import datetime as dt
import itertools
import os
import threading
import time
from functools import partial
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tableflow.plans.jobs import (
    check_data, check_files, ingest_keyed, ingest_then_join, join_to_table, land_check_stream,
    load_files, stream_files, stream_globs, stream_then_check,
)
from tableflow.operators.checks import all_true
from tableflow.sinks.landing import land_lines, landed_lines
from tableflow.specs import EntitySpec, JobContext, LoadJob, TableSpec, entity_glob
from tableflow.streaming.queries import (
    append_stream, archive_options, await_all, start_all, trigger_of, upsert_stream,
)

# Entities, keys and the join of the samples.
ENTITIES = ("items", "orders", "customers")
KEYS = {"items": "itemId", "orders": "orderId", "customers": "customerId"}
ORDER = {"items": "last_update_time", "orders": "last_update_time"}
JOIN = (
    "select o.orderId, o.customerId, o.itemId, quantity, o.year, o.month, o.day, "
    "o.last_update_time, o.execution_year, o.execution_month, o.execution_day, i.name, i.price "
    "from orders o, items i where o.itemId == i.itemId"
)
JOINED = [(1, 1, 1, 1, "bucket", 5.0), (2, 2, 2, 3, "cup", 1.0), (3, 2, 2, 5, "cup", 1.0)]
JOINED_COLUMNS = ("orderId", "customerId", "itemId", "quantity", "name", "price")


def load_job(delivery, ctx, names=ENTITIES, **changes):
    settings = dict(
        ctx=ctx, input_path=str(delivery / "in"), output_path=str(delivery / "out"),
        entities=tuple(
            EntitySpec(n, entity_glob(n, ctx.execution_date), KEYS[n], ORDER.get(n))
            for n in names
        ),
        reader_options={"header": "true"}, schema_path=str(delivery / "schema"),
        partition_by=("year", "month", "day"),
    )
    return LoadJob(**{**settings, **changes})


def add_file(delivery, ctx, name, text):
    (Path(ctx.dated_dir(str(delivery / "in"))) / name).write_text(text)


ITEM = "itemId,name,price,year,month,day,last_update_time\n"


def test_load_files_infers_and_stamps(spark, delivery, ctx):
    job = load_job(delivery, ctx, schema_path=None)
    tables = load_files(spark, job)
    assert set(tables) == set(ENTITIES)
    assert rows(tables["items"]) == [
        (1, "bucket", 5, 2021, 6, 21), (2, "cup", 1, 2021, 6, 21), (3, "t-shirt", 2, 2021, 6, 21),
    ]
    with pytest.raises(AnalysisException):
        load_files(spark, job)
    assert load_files(spark, dataclasses.replace(job, overwrite=True))["orders"].count() == 3


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_load_files_to_text_formats(spark, delivery, ctx, fmt):
    tables = load_files(spark, load_job(delivery, ctx, ["orders"], output_format=fmt))
    assert tables["orders"].count() == 3


def test_load_files_merges_into_a_keyed_table(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items"], output_format="delta", schema_path=None)
    load_files(spark, job)
    tomorrow = JobContext(ctx.job_id, ctx.execution_date + dt.timedelta(days=1))
    Path(tomorrow.dated_dir(str(delivery / "in"))).mkdir()
    add_file(delivery, tomorrow, "items_2021-06-22.csv", "itemId,name,price\n2,mug,3\n4,pen,1\n")
    later = dataclasses.replace(
        job, ctx=tomorrow, entities=(EntitySpec("items", "items_*2021-06-22.csv", "itemId"),)
    )
    expected = [
        (1, "bucket", 5, 21), (2, "mug", 3, 22), (3, "t-shirt", 2, 21), (4, "pen", 1, 22),
    ]
    for _ in range(2):
        assert rows(load_files(spark, later)["items"], "itemId", "name", "price", "day") == expected


def test_load_files_once_with_a_ledger(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items"], ledger_path=str(delivery / "ledger"), output_format="delta")
    assert load_files(spark, job)["items"].count() == 3
    add_file(delivery, ctx, "items_b_2021-06-21.csv", "itemId,name,price\n9,pen,1\n")
    assert load_files(spark, job)["items"].count() == 4
    assert load_files(spark, job) == {}


def test_stream_files_appends_each_file_once(spark, delivery, ctx):
    job = load_job(delivery, ctx)
    assert {n: t.count() for n, t in stream_files(spark, job).items()} == dict.fromkeys(ENTITIES, 3)
    tables = stream_files(spark, job)
    assert {n: t.count() for n, t in tables.items()} == dict.fromkeys(ENTITIES, 3)
    assert rows(tables["items"], "itemId", "year", "month", "day")[0] == (1, 2021, 6, 21)
    add_file(delivery, ctx, "items_b_2021-06-21.csv", "itemId,name,price\n1,again,1\n")
    assert stream_files(spark, job)["items"].count() == 4  # appended, not merged


def test_stream_globs_equals_stream_files(spark, delivery, ctx):
    by_name = stream_files(spark, load_job(delivery, ctx))
    by_glob = stream_globs(spark, load_job(delivery, ctx, output_path=str(delivery / "out2")))
    for name in ENTITIES:
        assert rows(by_name[name]) == rows(by_glob[name])


def test_stream_needs_a_schema(spark, delivery, ctx):
    with pytest.raises(ValueError, match="entity 'items'"):
        stream_files(spark, load_job(delivery, ctx, schema_path=None))


def test_stream_archives_its_sources(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items"], archive_sources=True)
    assert stream_files(spark, job)["items"].count() == 3
    for i in range(3):  # a file is archived in a later run than the one that read it
        add_file(delivery, ctx, f"items_{i}_2021-06-21.csv", f"itemId,name,price\n{10 + i},x,1\n")
        stream_files(spark, job)
    assert stream_files(spark, job)["items"].count() == 6
    archive = Path(archive_options(job.input_path, ctx)["sourceArchiveDir"])
    assert list(archive.rglob("items_2021-06-21.csv"))


@pytest.mark.parametrize("batch", [True, False])
def test_ingest_keyed(spark, delivery, ctx, batch):
    add_file(delivery, ctx, "items_b_2021-06-21.csv",
             ITEM + "1,old,1,2021,6,20,100\n1,new,2,2021,6,20,200\n1,other day,3,2021,6,19,300\n")
    job = load_job(
        delivery, ctx, ["items"], output_format="hudi",
        entities=(EntitySpec("items", "items_b_*.csv", "itemId", "last_update_time"),),
    )
    first = rows(ingest_keyed(spark, job, batch)["items"], "itemId", "name", "day", "execution_day")
    assert first == [(1, "new", 20, 21), (1, "other day", 19, 21)]
    # A later file, and a second run over files seen before.
    add_file(delivery, ctx, "items_b_2_2021-06-21.csv", ITEM + "1,newest,2,2021,6,20,150\n")
    kept = dataclasses.replace(
        job, entities=(EntitySpec("items", "items_b_2_*.csv" if batch else "items_b_*.csv", "itemId", "last_update_time"),)
    )
    second = rows(ingest_keyed(spark, kept, batch)["items"], "itemId", "name", "day")
    assert second == [(1, "newest", 20), (1, "other day", 19)]


def test_a_replayed_micro_batch_changes_nothing(spark, delivery, ctx):
    add_file(delivery, ctx, "items_b_2021-06-21.csv", ITEM + "1,a,1,2021,6,20,1\n1,b,2,2021,6,20,2\n")
    job = load_job(delivery, ctx, ["items"], output_format="hudi")
    before = rows(ingest_keyed(spark, job, batch=False)["items"])
    # As if the run had died after writing the table and before noting so.
    commits = Path(job.table_path(job.entities[0])) / "_checkpoints" / "commits"
    for file in [*commits.glob("0"), *commits.glob(".0.crc")]:
        file.unlink()
    assert rows(ingest_keyed(spark, job, batch=False)["items"]) == before
    assert (commits / "0").exists() and len(before) == 4


def test_batch_and_stream_give_the_same_table(spark, delivery, ctx):
    results = []
    for batch in (True, False):
        job = load_job(delivery, ctx, output_path=str(delivery / f"out_{batch}"))
        results.append({n: rows(t) for n, t in ingest_keyed(spark, job, batch).items()})
    assert results[0] == results[1]


def test_ingest_then_join(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items", "orders"])
    result = TableSpec("joined", "orderId", "last_update_time")
    for _ in range(2):
        joined = ingest_then_join(spark, job, JOIN, result)
        assert rows(joined, *JOINED_COLUMNS) == JOINED
    assert joined.select("execution_year", "execution_month", "execution_day").distinct().collect() == [(2021, 6, 21)]


def test_join_save_modes(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items", "orders"])
    ingest_keyed(spark, job, batch=True)
    out = str(delivery / "joins")

    def join(query, **how):
        return join_to_table(
            spark, ctx, job.output_path, out, ["items", "orders"], query,
            TableSpec("joined", "orderId", "quantity"), "execution_year", **how,
        )

    assert join(JOIN).count() == 3
    with pytest.raises(AnalysisException):
        join(JOIN)
    changed = JOIN.replace("quantity,", "quantity + 1 as quantity,") + " and o.orderId = 3"
    upserted = join(changed, upsert=True)
    assert rows(upserted, "orderId", "quantity") == [(1, 1), (2, 3), (3, 6)]
    assert rows(join(changed, overwrite=True), "orderId", "quantity") == [(3, 6)]


def test_check_data_reads_one_column(spark, tmp_path, ctx):
    for name, day in (("orders", "2021-06-21"), ("items", "2021-06-20")):
        spark.createDataFrame([(dt.date.fromisoformat(day), "x")], "date date, v string").write.parquet(
            f"{ctx.job_dir(str(tmp_path))}/{name}"
        )
    counts = check_data(spark, ctx, str(tmp_path), ["orders", "items"], "date")
    assert rows(counts) == [("items", 0, False), ("orders", 1, True)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date:date>" in plan and "EqualTo(date,2021-06-21)" in plan


def test_check_files(spark, delivery, ctx):
    def check(prefixes, exact=False):
        found = check_files(spark, ctx, str(delivery / "in"), prefixes, "*.csv", exact)
        return all_true(found, "matches" if exact else "present", "ok").first().ok

    assert check(["orders", "items"]) and not check(["orders", "suppliers"]) and not check([])
    assert check(ENTITIES, exact=True) and not check(["orders", "items"], exact=True)


def test_stream_then_check(spark, delivery, ctx):
    counts, received = stream_then_check(spark, load_job(delivery, ctx))
    assert received and counts.count() == 3
    add_file(delivery, ctx, "customers_2021-06-21.csv", "")
    empty = load_job(delivery, ctx, output_path=str(delivery / "out2"))
    counts, received = stream_then_check(spark, empty)
    assert not received and ("customers", 0, False) in rows(counts)


def test_land_check_stream(spark, delivery, ctx):
    job = load_job(delivery, ctx, reader_options={})
    incoming = ctx.dated_dir(str(delivery / "in"))
    headers = {
        "items": "itemId,name,price", "orders": "orderId,customerId,itemId,quantity",
        "customers": "customerId,name,country",
    }
    landing = str(delivery / "landing")
    for _ in range(2):
        tables = land_check_stream(spark, incoming, landing, job, headers)
    assert rows(tables["items"], "itemId", "name", "price") == [
        (1, "bucket", 5.0), (2, "cup", 1.0), (3, "t-shirt", 2.0),
    ]
    (Path(incoming) / "orders_2021-06-21.csv").unlink()
    assert land_check_stream(spark, incoming, str(delivery / "landing2"), job, headers) == {}


def test_triggers():
    assert trigger_of(-1) == {"availableNow": True}
    assert trigger_of(3000) == {"processingTime": "3000 milliseconds"}


def test_the_first_failure_is_raised_and_stops_the_rest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"v": 1}\n')
    source = spark.readStream.schema("v int").json(str(tmp_path / "in"))
    endless = append_stream(source, "parquet", str(tmp_path / "endless"), interval_ms=100)
    failing = append_stream(
        source.select(F.raise_error("broken").cast("int").alias("v")), "parquet", str(tmp_path / "failing")
    )
    with pytest.raises(StreamingQueryException, match="broken"):
        await_all([endless, failing])
    assert not endless.isActive


def test_streaming_upsert_into_a_table_without_partitions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema("k int, v int").json(str(tmp_path / "in"))
    for v in (1, 2):  # the progress lies outside the folder that each run swaps
        (tmp_path / "in" / f"{v}.json").write_text(f'{{"k": 1, "v": {v}}}\n{{"k": {v + 1}, "v": 0}}\n')
        await_all([upsert_stream(source, str(tmp_path / "t"), "k", "v", ())])
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [(1, 2), (2, 0), (3, 0)]


def test_no_stream_goes_on_after_a_start_failure(spark, delivery, ctx):
    job = load_job(delivery, ctx, trigger_interval_ms=100)
    (delivery / "schema" / "customers.json").unlink()
    for run in (stream_files, stream_globs, lambda s, j: ingest_keyed(s, j, batch=False)):
        with pytest.raises(ValueError, match="customers"):
            run(spark, job)
        assert spark.streams.active == []
    # A query that only fails when it is started.
    source = spark.readStream.schema("v int").json(str(delivery / "in"))
    starts = [
        partial(append_stream, source, "parquet", str(delivery / "t1"), interval_ms=100),
        partial(append_stream, source, "parquet", str(delivery / "t2"), "no_such_column", 100),
    ]
    with pytest.raises(AnalysisException):
        start_all(starts)
    assert spark.streams.active == []


def test_a_processing_time_job_sees_later_files(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items"], trigger_interval_ms=200)
    failures = []

    def run():
        try:
            stream_files(spark, job)
        except Exception as error:  # stopping a query ends the wait, nothing else does
            failures.append(error)

    thread = threading.Thread(target=run)
    thread.start()

    def until(count):
        path = job.table_path(job.entities[0])
        for _ in range(300):
            if Path(path, "_spark_metadata", "0").exists() and spark.read.parquet(path).count() == count:
                return True
            time.sleep(0.1)
        return False

    assert until(3)
    add_file(delivery, ctx, "items_b_2021-06-21.csv", "itemId,name,price\n9,late,1\n")
    assert until(4)
    for query in spark.streams.active:
        query.stop()
    thread.join(30)
    assert not thread.is_alive() and not failures


def test_a_file_landed_again_replaces_its_rows(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items"], reader_options={})
    incoming = Path(ctx.dated_dir(str(delivery / "in")))
    headers = {"items": "itemId,name,price"}
    landing = str(delivery / "landing")

    def run(text, at):
        file = incoming / "items_2021-06-21.csv"
        file.write_text(text)
        os.utime(file, (at, at))
        return land_check_stream(spark, str(incoming), landing, job, headers)["items"]

    base = 2_000_000_000
    assert rows(run("itemId,name,price\n1,a,1\n2,b,2\n", base), "itemId", "name") == [(1, "a"), (2, "b")]
    again = run("itemId,name,price\n1,a,1\n2,c,2\n3,d,3\n", base + 10)
    assert rows(again, "itemId", "name", "file_name") == [
        (1, "a", "items_2021-06-21.csv"), (2, "c", "items_2021-06-21.csv"), (3, "d", "items_2021-06-21.csv"),
    ]
    assert run("", base + 20).count() == 0
    assert run("itemId,name,price\n7,z,1\n", base + 30).count() == 1


def test_a_file_landed_again_leaves_no_old_rows(spark, delivery, ctx):
    """Only a header, blank lines, no byte, or rows of other partitions than before."""
    entity = EntitySpec("items", "items_*.csv", "itemId")
    job = load_job(delivery, ctx, reader_options={}, partition_by=("name", "day"), entities=(entity,))
    incoming = Path(ctx.dated_dir(str(delivery / "in")))
    landing, header, clock = str(delivery / "landing"), "itemId,name,price\n", itertools.count(2_000_000_000, 10)
    (incoming / "items_2021-06-21[2].csv").write_text(header + "9,a,1\n10,z,1\n")

    def run(text):
        file = incoming / "items_2021-06-21.csv"
        file.write_text(text)
        at = next(clock)
        os.utime(file, (at, at))
        table = land_check_stream(spark, str(incoming), landing, job, {"items": header.strip()})["items"]
        return rows(table, "itemId", "name")

    other = [(9, "a"), (10, "z")]
    assert run(header + "1,a,1\n2,b,2\n3,b,2\n") == [(1, "a"), (2, "b"), (3, "b"), *other]
    assert run(header + "2,b,2\n4,c,2\n") == [(2, "b"), (4, "c"), *other]
    assert run(header) == other
    assert run(header + "5,d,2\n") == [(5, "d"), *other]
    assert run("\n \n") == other
    assert run(header + "6,a,2\n") == sorted([(6, "a"), *other])
    assert run("") == other
    assert run(header + "7,a,2\n") == sorted([(7, "a"), *other])


def test_news_read_the_folders_of_their_files_alone(spark, tmp_path, ctx):
    lines = spark.createDataFrame([("x", f"a_{i}.csv") for i in range(5)], "value string, file_name string")
    land_lines(lines, str(tmp_path), ctx)
    plan = landed_lines(spark, str(tmp_path), ctx, ["a_3.csv"])
    assert rows(plan) == [("x", "a_3.csv")] and len(plan.inputFiles()) == 1


def test_landed_records_over_several_lines_reach_the_table(spark, delivery, ctx):
    job = load_job(delivery, ctx, ["items"], reader_options={"multiLine": "true", "escape": '"'})
    incoming = Path(ctx.dated_dir(str(delivery / "in")))
    (incoming / "items_2021-06-21.csv").write_text('itemId,name,price\n1,"two\nlines, ""quoted""",1\n2,b,2\n')
    table = land_check_stream(
        spark, str(incoming), str(delivery / "landing"), job, {"items": "itemId,name,price"}
    )["items"]
    assert rows(table, "itemId", "name") == [(1, 'two\nlines, "quoted"'), (2, "b")]
