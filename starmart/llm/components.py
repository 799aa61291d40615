"""Connected components of an edge table, as rounds of joins.

Alternates the two star operations of Kiveris et al. (Connected Components in
MapReduce and Beyond): neighbours are linked to the smallest node of their
neighbourhood until nothing changes. Every round is an aggregation with
map-side minima and a join that Spark may split where a node has many
neighbours; each round is written, so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import persist


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and comp (the smallest node of its component) for every node of
    ``edges`` (a, b: long) that is not itself the smallest."""
    now = persist(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges")
    mark = None
    while True:
        now = persist(_small_star(_large_star(now)), "edges")
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if (row["n"], row["s"]) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        mark = (row["n"], row["s"])
