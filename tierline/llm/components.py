"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import durable, in_few


def _least(near: DataFrame) -> DataFrame:
    """near (u, v): the least m of each u and its neighbours."""
    return near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _edges(pairs: DataFrame, rows: int) -> DataFrame:
    """Distinct pairs; a small table of them does not go through as many tasks as there are shuffle partitions."""
    return in_few(in_few(pairs.toDF("a", "b").where("a <> b"), rows).distinct(), rows)


def large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link the larger neighbours of each node to the least of the node and all its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _edges(both.where("v > u").join(_least(both), "u").select("v", "m"), rows)


def small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link each node and its smaller neighbours to the least of these."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = _least(near)
    return _edges(near.join(least, "u").select("v", "m").union(least.select("u", "m")), rows)


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of long ids, in either order and with repeats: (id, component) for each id that is not its component's.

    component is the least id reachable; links of an id to itself do not count. The two stars in turn end in one star a
    component, after a number of rounds that grows as the logarithm squared at most; each round is one job and one durable
    table. A node with very many links is a skewed join, which Spark splits; its links are never gathered.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = (edges.count(), None)
    while state[0]:
        edges = durable(small_star(large_star(edges, state[0]), state[0]))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
