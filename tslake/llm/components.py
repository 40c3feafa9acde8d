"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.files import remove, settled


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its
    smallest node. Edges may repeat and have either direction; an edge of a node
    to itself, or with a null, counts for nothing. Every round is written to the
    shared folder, the one before removed; a node of many edges is split by AQE's skewed joins.
    """
    spark = edges.sparkSession
    # edges from the larger to the smaller node
    old: list[str] = []
    now = settled(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name, old)
    size = _size(now)
    while True:
        # large star: every larger neighbour points at the smallest of the neighbourhood
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every node and its smaller neighbours point at the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        new: list[str] = []
        now = settled(spark, small.filter("a <> b").distinct(), name, new)
        remove(spark, old)
        old = new
        before, size = size, _size(now)
        if size == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
