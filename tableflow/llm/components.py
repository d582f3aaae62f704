"""Connected components by least labels, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.rows import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): the least node it is connected to.
    Nodes are of any type that has an order.

    Each round a node takes the least label among its neighbours, then twice the label of its
    label, so paths shorten by a factor each round. Rounds are stored tables: lineage stays short
    and a lost executor costs a file read. Labels are combined before shuffles, and the joins keep
    both sides directly on their shuffles, so a node or root with very many edges can be split.
    """
    spark = edges.sparkSession
    both = stored(spark, edges.select("a", "b").union(edges.select("b", "a")).where("a <> b"), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
    labels, total = stored(spark, labels, "labels"), None
    while True:
        now = labels.agg(F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()[0]
        if now == total:  # the labels are as they were
            return labels
        total = now
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "root")
        labels = stored(
            spark, near.union(labels).groupBy("node").agg(F.min("root").alias("root")), "labels"
        )
        for _ in range(2):
            up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
            labels = stored(
                spark, labels.join(up, "root").select("node", F.col("up").alias("root")), "labels"
            )
