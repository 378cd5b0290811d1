"""Exact Ward trees: all mutual nearest pairs of clusters merge in one round.

Ward's linkage is reducible: a merge never brings its result nearer to a third cluster than both parts were. So pairs that are each
other's nearest may merge at once, and the tree is that of merging the globally nearest pair again and again. A round is one
join of clusters on neighbouring grid cells, one aggregate that finds each cluster's nearest, and one that keeps the mutual pairs;
clusters and merges of a round are written tables, and the driver holds a few numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe.operators.cluster import LABEL
from trailframe.session import materialize, scratch_path

#: Clusters that one cluster meets on average in the first round.
MEETS = 32
#: Halvings of the extent that are tried for the first cell side.
LEVELS = 24
#: The cell side doubles once a round merges less than this part of the clusters.
SLOW = 0.2
GRID = 3


def _cells(names: Sequence[str], side: Column | float) -> list[Column]:
    return [F.floor(F.col(c) / side).cast("long").alias(f"_cell{i}") for i, c in enumerate(names[:GRID])]


def _first_side(points: DataFrame, names: Sequence[str], extent: float) -> float:
    """The largest halving of the extent at which a point shares its cell with few others on average."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_level")
    cells = points.select(*names, levels).select("_level", *_cells(names, F.lit(extent) / F.pow(F.lit(2.0), "_level")))
    counts = cells.groupBy(*cells.columns).agg(F.count(F.lit(1)).alias("n"))
    met = counts.groupBy("_level").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("met")).collect()
    able = [r["_level"] for r in met if r["met"] <= MEETS]
    return extent / 2.0 ** (min(able) if able else LEVELS)


def _nearest(clusters: DataFrame, names: Sequence[str], side: float, least: float, everything: bool) -> DataFrame:
    """(id, n, x.., d2, lo, hi, sure): the nearest other cluster among the neighbouring cells.

    Outside of them every cluster is at least ``side`` away and weighs at least ``least``; ``sure`` says that none of those can be
    nearer. Pairs are ordered by distance, then by their ids, so equal distances leave no circle of nearest clusters.
    """
    cells = [f"_cell{i}" for i in range(min(GRID, len(names)))]
    held = clusters.select(F.col("id").alias("_id"), F.col("n").alias("_n"), *[F.col(c).alias(f"_{c}") for c in names], *_cells(names, side))
    around = F.array(*[F.struct(*[(cell + o).alias(c) for c, cell, o in zip(cells, _cells(names, side), offsets)])
                       for offsets in product((-1, 0, 1), repeat=len(cells))])
    pairs = clusters.withColumn("_at", F.explode(around)).select("id", "n", *names, "_at.*").join(held, cells).where("id <> _id")
    square = reduce(lambda t, c: t + (F.col(c) - F.col(f"_{c}")) * (F.col(c) - F.col(f"_{c}")), names, F.lit(0.0))
    pair = F.struct((square * (2 * F.col("n") * F.col("_n") / (F.col("n") + F.col("_n")))).alias("d2"),
                    F.least("id", "_id").alias("lo"), F.greatest("id", "_id").alias("hi"))
    best = pairs.groupBy("id").agg(F.min(pair).alias("_best"), F.first("n").alias("n"), *[F.first(c).alias(c) for c in names])
    beyond = 2 * F.col("n") * F.lit(least) / (F.col("n") + F.lit(least)) * F.lit(side * side * (1 - 1e-9))
    return best.select("id", "n", *names, "_best.*").withColumn("sure", F.lit(everything) | (F.col("d2") < beyond))


def ward_points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(id, n, x0..): the distinct points in ascending order with their row counts; rows with a null have none."""
    names = [f"x{i}" for i in range(len(features))]
    rows = df.select(*[F.col(f).cast("double").alias(c) for f, c in zip(features, names)]).dropna()
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n")).orderBy(*names)
    return materialize(counted.select(F.monotonically_increasing_id().alias("id"), "n", *names), "ward-points")


def ward_tree(points: DataFrame) -> DataFrame:
    """(child, parent, distance, size, round): one row per merge of ``ward_points``, in no particular order.

    A cluster is named by its smallest point; ``child`` joins ``parent``, and ``size`` counts rows. Fewer than two points make no merges.
    """
    names = [c for c in points.columns if c.startswith("x")]
    base, clusters, number, side = scratch_path(points.sparkSession, "ward-merges"), points, 0, None
    schema = "child long, parent long, distance double, size long, round int"
    while True:
        known = clusters.agg(F.count(F.lit(1)).alias("count"), F.min("n").alias("least"), *[
            (F.max(c) - F.min(c)).alias(c) for c in names]).first()
        if known["count"] < 2:
            break
        extent = max(known[c] for c in names[:GRID]) or 1.0
        side = side or _first_side(points, names, extent)
        best = _nearest(clusters, names, side, known["least"], side > extent)
        pairs = best.where("sure").groupBy("lo", "hi").agg(
            F.count(F.lit(1)).alias("_both"), F.max("d2").alias("d2"), F.sum("n").alias("n"),
            *[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in names]).where("_both = 2").drop("_both")
        pairs = materialize(pairs, "ward-pairs")
        merged = pairs.count()
        if merged:
            number += 1
            pairs.select(F.col("hi").alias("child"), F.col("lo").alias("parent"), F.sqrt("d2").alias("distance"),
                         F.col("n").cast("long").alias("size"), F.lit(number).alias("round")).write.mode("append").parquet(base)
            gone = pairs.select(F.explode(F.array("lo", "hi")).alias("id"))
            clusters = materialize(clusters.join(gone, "id", "left_anti").unionByName(
                pairs.select(F.col("lo").alias("id"), "n", *names)), "ward-clusters")
        if merged < SLOW * known["count"] and side <= extent:
            side *= 2
    if not number:
        return points.sparkSession.createDataFrame([], schema)
    return points.sparkSession.read.schema(schema).parquet(base)


def ward_labels(df: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    """All rows with the cluster of the exact Ward tree's cut into ``k``: 0 .. k - 1 by ascending smallest point, null for rows with a null.

    The k - 1 longest merges are undone; every other point then finds its root by doubling its step up the tree.
    """
    points = ward_points(df, features)
    names = [c for c in points.columns if c.startswith("x")]
    tree = ward_tree(points)
    undone = tree.orderBy(F.desc("distance"), F.desc("round"), "child").limit(k - 1).select("child")
    up = tree.join(F.broadcast(undone), "child", "left_anti").select(F.col("child").alias("id"), F.col("parent").alias("root"))
    while True:
        next_up = up.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        step = materialize(up.join(next_up, "root", "left").select(
            "id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "ward-roots")
        up = step.drop("_moved")
        if step.where("_moved").isEmpty():
            break
    placed = points.join(up, "id", "left").select(*names, F.coalesce("root", "id").alias("_root"))
    roots = [r["_root"] for r in placed.select("_root").distinct().orderBy("_root").collect()]  # at most k
    number = F.array_position(F.array(*[F.lit(r) for r in roots]).cast("array<bigint>"), F.col("_root")) - 1
    labels = placed.select(*[F.col(c).alias(f"_{c}") for c in names], number.cast("int").alias(LABEL))
    same = reduce(lambda t, p: t & p, [F.col(f).cast("double") == F.col(f"_{c}") for f, c in zip(features, names)])
    return df.drop(LABEL).join(labels, same, "left").drop(*[f"_{c}" for c in names])
