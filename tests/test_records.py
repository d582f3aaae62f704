"""Records over several lines: landed in pieces, parsed as one scan of the whole file parses them."""

import csv
import random

import pytest
from conftest import rows

from pyspark.sql.types import StructType
from tableflow.operators.records import line_place, whole_records
from tableflow.sinks.landing import land_files, landed_files, landed_lines, landed_records
from tableflow.specs import EntitySpec

SCHEMA = StructType().add("id", "integer").add("a", "string").add("b", "string")
DOUBLED = {"multiLine": "true", "escape": '"'}
ESCAPED = {"multiLine": "true"}


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name in names:
        spark.conf.set(name, "250")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def written(path, options, end, seed, n=16):
    """A file of values with line breaks, quotes, separators and blank lines, some over many splits."""
    rng = random.Random(seed)
    parts = ["x", "two words", "\n", '"', ",", "\n\n", "é", "long " * 12, " \n"]
    with open(path, "w", newline="", encoding="utf-8") as file:
        doubled = "escape" in options
        out = csv.writer(
            file, lineterminator=end, doublequote=doubled, escapechar=None if doubled else "\\",
            quoting=csv.QUOTE_NONNUMERIC,
        )
        for i in range(n):
            out.writerow([i, *("v" + "".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in "ab")])


def landed(spark, inbox, landing, ctx, options, ledger=None):
    land_files(spark, inbox, ["*.csv"], landing, ctx, ledger, options)
    records = landed_lines(spark, landing, ctx, options=options)
    return landed_records(records, EntitySpec("a", "*.csv"), SCHEMA, None, options)


@pytest.mark.parametrize(
    "options, end, ledger", [(DOUBLED, "\n", True), (DOUBLED, "\r\n", False), (ESCAPED, "\n", False)],
    ids=["ledger", "crlf", "escaped"],
)
def test_landed_records_equal_a_scan_of_whole_files(spark, tmp_path, ctx, small_splits, options, end, ledger):
    inbox, landing = tmp_path / "in", str(tmp_path / "landing")
    inbox.mkdir()
    for i in range(3):
        written(inbox / f"f{i}.csv", options, end, i)
    (inbox / "empty.csv").write_text("")
    expected = spark.read.options(**options).schema(SCHEMA).csv(str(inbox))
    assert spark.read.text(str(inbox)).rdd.getNumPartitions() > 10
    book = str(tmp_path / "ledger") if ledger else None
    found = landed(spark, str(inbox), landing, ctx, options, book)
    assert rows(found) == rows(expected) and found.count() == 48
    assert len(rows(landed_files(spark, landing, ctx))) == 4
    again = landed(spark, str(inbox), landing, ctx, options, book)
    assert rows(again) == rows(expected)


def test_a_header_an_open_quote_and_a_file_of_one_record(spark, tmp_path, ctx, small_splits):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text('id,a,b\n1,x,"y\n\nz"\n\n2,"u' + "\nmore lines" * 20 + '",v\n')
    (inbox / "b.csv").write_text('id,a,b\n3,"never closed\n4,x,y\n')
    land_files(spark, str(inbox), ["*.csv"], str(tmp_path / "landing"), ctx, None, DOUBLED)
    records = landed_lines(spark, str(tmp_path / "landing"), ctx, options=DOUBLED)
    a = landed_records(records, EntitySpec("a", "a.csv"), SCHEMA, "id,a,b", DOUBLED)
    assert rows(a) == [(1, "x", "y\n\nz"), (2, "u" + "\nmore lines" * 20, "v")]
    b = records.where("file_name = 'b.csv'")
    assert rows(b, "value") == [('3,"never closed\n4,x,y',), ("id,a,b",)]


def test_a_record_that_holds_the_mark_is_refused(spark, tmp_path, ctx):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('1,"x\x1e\ny"\n')
    with pytest.raises(Exception, match="mark of a record's end"):
        land_files(spark, str(tmp_path / "in"), ["*.csv"], str(tmp_path / "landing"), ctx, None, DOUBLED)


def test_without_the_option_lines_are_rows_as_before(spark, tmp_path, ctx):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('1,"x\ny"\n')
    land_files(spark, str(tmp_path / "in"), ["*.csv"], str(tmp_path / "landing"), ctx)
    assert rows(landed_lines(spark, str(tmp_path / "landing"), ctx), "value") == [('1,"x',), ('y"',)]


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    lines = spark.read.text(str(tmp_path)).selectExpr("value", "_metadata.file_name")
    assert whole_records(lines.withColumns(line_place())).count() == 0
