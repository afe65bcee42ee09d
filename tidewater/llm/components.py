"""Connected components by alternating stars: union-find in joins and aggregations.

Each round turns every node's edges to the smallest node it knows (large star), then does so among the
smaller ones (small star), until the edges are stars: each around the smallest node of its component.
Aggregations combine before the shuffle, so a node with very many edges is one row of each task; joins
against it are split by AQE.  Each round's edges are a written table: lineage stays short and a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


#: Edges of a written part, about.
PART = 500_000


def _shape(edges: DataFrame) -> tuple[int, int]:
    """(edges, nodes that keep them from being stars: with two edges up, or with edges up and down)."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    crossed = F.when((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)), 1).otherwise(0)
    row = ends.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.coalesce(F.sum(crossed), F.lit(0)).alias("crossed")).first()
    return row.n, row.crossed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b): the smallest node that links lead to.

    Loops and edges with a null end are left out; repeated edges count once.
    """
    ordered = edges.where("a is not null and b is not null and a <> b")
    now = written(ordered.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n, crossed = _shape(now)
    while crossed:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: the larger neighbours of a node turn to the smallest one around it
        large = now.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node's smaller neighbours, and itself, turn to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = written(small.distinct().coalesce(-(-max(n, 1) // PART)))
        n, crossed = _shape(now)
    top = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(top)
