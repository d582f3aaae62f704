"""Hot keys and hot partitions: a third of the rows, or more, must not end in one task."""

import pytest
from pyspark.sql import functions as F

from tableflow.operators.checks import key_coverage
from tableflow.operators.latest import latest_per_key
from tableflow.operators.merge import merge, merged, stored_matches
from tableflow.sinks.files import write_files
from tableflow.sinks.keyed import _within, merge_into

SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    """Sizes at which a test's data counts as large."""
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def tables(small_partitions, tmp_path):
    spark = small_partitions
    # A third of the keys is null, a third is one value.
    spark.range(300_000).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as k", "id as v",
        "md5(string(id)) as s",
    ).repartition(8).write.parquet(str(tmp_path / "t"))
    spark.range(60_000).selectExpr("id as k", "-id as v", "'u' as s").write.parquet(str(tmp_path / "u"))
    return spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "u"))


@pytest.mark.parametrize("how", [{}, {"on_duplicate": "latest", "order": "v"}])
def test_merge_splits_hot_keys(tables, how):
    target, updates = tables
    merged = merge(target, updates, "k", **how).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), F.count("s").alias("s")
    )
    plan = final_plan(merged)
    assert "SortMergeJoin(skew=true) [k" in plan and "LeftOuter" in plan
    # Stored rows all stay; ids that are 2 modulo 3 match, 7 matches its many rows, the rest is new.
    matched = 60_000 // 3
    assert merged.first()["n"] == 300_000 + 60_000 - matched - 1


def nodes(df):
    """Operator names of the physical plan from the top, each with its depth."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [(len(line) - len(line.lstrip(" :+-")), line.strip(" :+-")) for line in lines]


def below(plan, text):
    """The operators under the first one that contains a text."""
    at = next(i for i, (_, node) in enumerate(plan) if text in node)
    depth = plan[at][0]
    under = []
    for level, node in plan[at + 1 :]:
        if level <= depth:
            break
        under.append(node)
    return under


def test_stored_keys_are_made_distinct_before_they_are_shuffled(tables):
    target, updates = tables
    under = below(nodes(stored_matches(target, updates, "k")), "LeftSemi")
    kinds = [node.split("(")[0].split(" ")[0] for node in under]
    shuffle = kinds.index("Exchange")
    assert "HashAggregate" in kinds[:shuffle] and kinds[shuffle + 1] == "HashAggregate"
    assert stored_matches(target, updates, "k").count() == 20_001


def test_a_small_batch_is_broadcast_to_the_stored_keys(tables):
    target, updates = tables
    target.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "50m")
    plan = nodes(stored_matches(target, updates, "k"))
    assert any("BroadcastHashJoin" in node and "LeftSemi" in node for _, node in plan)
    assert any("BroadcastHashJoin" in node for node in below(plan, "Exchange hashpartitioning"))


def test_a_hot_key_leaves_each_task_as_one_row(tables):
    target, _ = tables
    newest = latest_per_key(target, "k", "v")
    plan = final_plan(newest)
    assert plan.index("partial_max") > plan.index("Exchange")
    metrics = newest.where("k = 7").first()
    assert metrics["v"] == 299_998 and newest.count() == 100_000 + 2


def test_a_hot_partition_is_written_by_several_tasks(small_partitions, tmp_path):
    spark = small_partitions
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "case when id % 10 < 8 then 0 else id % 10 end as part", "md5(string(id)) as s"
    )
    write_files(rows, "parquet", str(tmp_path / "t"), "part")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("part=*")}
    assert files["part=0"] > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_coverage_counts_in_two_steps(tables):
    target, _ = tables
    assert final_plan(key_coverage(target, "k", "s", 1)).count("Exchange") == 2


def test_a_merge_with_known_matches_reads_the_table_once(tables, tmp_path):
    target, updates = tables
    spark = target.sparkSession
    stored_matches(target, updates, "k").write.parquet(str(tmp_path / "hits"))
    hits = spark.read.parquet(str(tmp_path / "hits"))
    result = merged(target, updates, hits, ("k",), unique=False)
    plan = final_plan(result)
    folder = str(tmp_path)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum(f"{folder}/t]" in line for line in scans) == 1
    assert sum(f"{folder}/u]" in line for line in scans) <= 3 and plan.count("Exchange hashpartitioning") <= 6
    assert sorted(map(repr, result.collect())) == sorted(map(repr, merge(target, updates, "k").collect()))


def test_a_merge_looks_for_keys_only_in_the_batchs_range(small_partitions, tmp_path):
    spark, path = small_partitions, str(tmp_path / "t")
    table = spark.range(1000).selectExpr("id", "string(id % 3) as p", "id as v")
    merge_into(spark, table, path, "id", "p")
    few = table.where("id between 10 and 12")
    condition = spark.read.schema(table.schema).parquet(path).where(_within(few, ("id",)))
    plan = final_plan(condition)
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThanOrEqual(id,12)" in plan
    merge_into(spark, few.withColumn("v", F.lit(-1).cast("long")), path, "id", "p")
    assert spark.read.parquet(path).where("v = -1").count() == 3 and spark.read.parquet(path).count() == 1000
