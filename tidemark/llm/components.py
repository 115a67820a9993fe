"""Connected components of a graph given as pairs, for graphs of any size and shape.

Large-star and small-star steps in turn (Kiveris et al., "Connected Components in MapReduce and Beyond").
Each step only takes minima by node and joins them back. A node with very many links is pre-aggregated in
every task, and its minimum is written before it is joined, so that both sides of the join are plain and its rows can be
split. Each round's pairs are written out too, which also cuts lineage.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import stage


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every neighbour greater than a node is linked to the least node around it."""
    both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """With pairs a > b: a node and its smaller neighbours are linked to the least of them."""
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of ``pairs`` (a, b): the component is its least node. Nodes are longs."""
    pairs = stage(pairs.select("a", "b").where("a <> b"), "pairs")
    before = None
    while (now := _state(pairs)) != before:
        before = now
        pairs = stage(_small_star(stage(_large_star(pairs), "pairs")), "pairs")
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
