import pytest

from pyspark.sql import functions as F
from tableflow.operators.merge import merge
from tableflow.operators.upsert import upsert
from tableflow.sinks.keyed import merge_into, upsert_into
from tableflow.sources.tables import stored_table

NESTED = "id int, s struct<a:int,b:bigint>, l array<struct<x:int,y:string>>, m map<string,struct<p:int,q:int>>"


@pytest.fixture
def nested(spark):
    return spark.createDataFrame(
        [(1, (10, 20), [(1, "one")], {"k": (1, 2)}), (2, (11, 21), None, None), (3, None, [], {})], NESTED
    )


def nested_rows(df):
    return {r["id"]: r.asDict(recursive=True) for r in df.collect()}


def test_struct_fields_are_matched_by_name(spark, nested):
    batch = spark.createDataFrame([(1, (99, 12), [("new", 7)])], "id int, s struct<b:bigint,a:int>, l array<struct<y:string,x:int>>")
    for out in (merge(nested, batch, "id"), upsert(nested, batch, "id")):
        row = nested_rows(out)[1]
        assert row["s"] == {"a": 12, "b": 99} and row["l"] == [{"x": 7, "y": "new"}]
    assert nested_rows(merge(nested, batch, "id"))[1]["m"] == {"k": {"p": 1, "q": 2}}
    assert nested_rows(upsert(nested, batch, "id"))[1]["m"] is None


def test_structs_with_fewer_and_more_fields(spark, nested):
    batch = spark.createDataFrame(
        [(1, (5, "n", (1,)), [(7, 1.5)]), (3, (6, None, None), None), (4, (7, "x", None), [])],
        "id int, s struct<b:int,c:string,d:struct<e:int>>, l array<struct<x:int,z:double>>",
    )
    merged_rows, upserted = (nested_rows(f(nested, batch, "id")) for f in (merge, upsert))
    assert merged_rows[1]["s"] == {"a": 10, "b": 5, "c": "n", "d": {"e": 1}}
    assert upserted[1]["s"] == {"a": None, "b": 5, "c": "n", "d": {"e": 1}}
    for rows in (merged_rows, upserted):
        assert rows[1]["l"] == [{"x": 7, "y": None, "z": 1.5}]
        assert rows[2]["s"] == {"a": 11, "b": 21, "c": None, "d": None}
        assert rows[3] == {"id": 3, "s": {"a": None, "b": 6, "c": None, "d": None}, "l": None, "m": rows[3]["m"]}
        assert rows[4]["s"] == {"a": None, "b": 7, "c": "x", "d": None} and rows[4]["l"] == []
    assert merge(nested, batch, "id").schema["s"].dataType.simpleString() == "struct<a:int,b:bigint,c:string,d:struct<e:int>>"


def test_maps_of_structs_and_null_structs(spark, nested):
    batch = spark.createDataFrame(
        [(1, None, {"j": (3, 4)}), (2, (1, 2), None)], "id int, s struct<a:int,b:bigint>, m map<string,struct<q:int,r:int>>"
    )
    rows = nested_rows(merge(nested, batch, "id"))
    assert rows[1]["s"] is None and rows[1]["m"] == {"j": {"p": None, "q": 3, "r": 4}} and rows[2]["m"] is None


def test_a_nested_value_that_does_not_fit_fails(spark, nested):
    batch = spark.createDataFrame([(1, [(2**40, "x")])], "id int, l array<struct<x:bigint,y:string>>")
    with pytest.raises(Exception, match="doesn't fit"):
        upsert(nested, batch, "id").collect()


def test_names_in_another_case_are_the_tables(spark, nested):
    batch = spark.createDataFrame([(1, (8,)), (9, (9,))], "ID int, S struct<B:int>")
    for out in (merge(nested, batch, "Id"), upsert(nested, batch, "ID")):
        assert out.columns == ["id", "s", "l", "m"]
        assert nested_rows(out)[1]["s"]["b"] == 8 and nested_rows(out)[9]["s"] == {"a": None, "b": 9}
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        out = merge(nested, batch.withColumnRenamed("ID", "id"), "id")
        assert out.columns == ["id", "s", "l", "m", "S"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_stored_tables_with_nested_evolution(spark, tmp_path, nested, parts):
    first = nested.withColumn("p", F.col("id") % 2)
    batch = spark.createDataFrame(
        [(1, (5, "n"), 1), (4, (7, None), 0)], "ID int, s struct<B:int,c:string>, P int"
    )
    for name, write in (("merge", merge_into), ("upsert", upsert_into)):
        path = str(tmp_path / name)
        write(spark, first, path, "id", partition_by=parts)
        write(spark, batch, path, "id", partition_by=parts)
        table = stored_table(spark, "parquet", path, first.schema, parts)
        rows = nested_rows(table)
        assert rows[1]["s"] == {"a": 10 if name == "merge" else None, "b": 5, "c": "n"}
        assert rows[2]["s"] == {"a": 11, "b": 21, "c": None} and rows[4]["s"] == {"a": None, "b": 7, "c": None}
        write(spark, first, path, "id", partition_by=parts)  # narrower again
        rows = nested_rows(stored_table(spark, "parquet", path, first.schema, parts))
        assert rows[1]["s"] == {"a": 10, "b": 20, "c": "n" if name == "merge" else None} and len(rows) == 4
