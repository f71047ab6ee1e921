"""Connected components by alternating stars: each step is a group-by and a join, none holds the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node (the larger ones, or the smaller ones and itself) to the least of them all."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else both.where("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    moved = around.join(least, "a")
    if large:
        linked = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        linked = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) of longs to (node, component): the least node that each node of an edge reaches."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    ends, before = store(ends, "edges"), None
    while True:
        state = ends.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
        ends = store(_star(_star(ends, large=True), large=False), "edges")
    roots = ends.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return ends.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
