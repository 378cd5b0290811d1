"""Connected components over an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; the state is written to the shared folder once a round, so a lost executor
costs a round at most and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailframe.session import materialize


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node go to its smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them; edges come with a > b."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b); the root is the smallest node reachable."""
    state = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, seen = materialize(state, "components"), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or mark[0] == 0:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen, state = mark, materialize(_small(_large(state)), "components")
