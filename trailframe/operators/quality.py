"""Cluster scores and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailframe.operators.cluster import LABEL

#: More clusters than this are refused: every row is compared with every cluster.
MAX_CLUSTERS = 10_000


def silhouette(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """One row (points, silhouette): mean silhouette of all rows under squared Euclidean distance.

    The mean squared distance of a row to a cluster follows from the cluster's mean and variance, so one aggregate per
    cluster and one expression per row give the exact score in linear time. It is another metric than the plain
    Euclidean silhouette, which needs all pairs. A row alone in its cluster scores 0, and so does a single cluster.
    """
    means = F.array(*[F.avg(f) for f in features])
    spread = reduce(lambda t, f: t + F.var_pop(f), features, F.lit(0.0))
    clusters = df.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"), means.alias("m"), spread.alias("v"))
    packed = clusters.agg(F.collect_list(F.struct("c", "n", "m", "v")).alias("_all"))
    point = F.array(*[F.col(f).cast("double") for f in features])
    gap = lambda e: F.aggregate(
        F.zip_with(F.col("_x"), e["m"], lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda t, v: t + v) + e["v"]
    every = F.when(F.size("_all") <= MAX_CLUSTERS, F.transform("_all", lambda e: F.struct(e["c"], e["n"], gap(e).alias("d"))))
    rows = df.select(F.col(label).alias("_c"), point.alias("_x")).join(F.broadcast(packed), F.lit(True)).select(
        "_c", F.coalesce(every, F.raise_error(F.lit(f"more than {MAX_CLUSTERS} clusters"))).alias("_d"))
    own = F.filter("_d", lambda e: e["c"].eqNullSafe(F.col("_c")))[0]
    other = F.array_min(F.transform(F.filter("_d", lambda e: ~e["c"].eqNullSafe(F.col("_c"))), lambda e: e["d"]))
    scored = rows.select(own["n"].alias("n"), own["d"].alias("d"), other.alias("b")).withColumn(
        "a", F.col("d") * F.col("n") / F.greatest(F.col("n") - 1, F.lit(1)))
    most = F.greatest("a", "b")
    score = F.when(F.col("b").isNull() | (F.col("n") == 1) | (most == 0), 0.0).otherwise((F.col("b") - F.col("a")) / most)
    return scored.agg(F.count(F.lit(1)).alias("points"), F.avg(score).alias("silhouette"))


def cluster_stats(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """(cluster_id, rows, <feature>_mean, <feature>_std) per cluster."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(f).alias(f"{f}_mean") for f in features],
        *[F.stddev_samp(f).alias(f"{f}_std") for f in features])


def cluster_report(df: DataFrame, features: Sequence[str], scored: Sequence[str] | None = None, label: str = LABEL) -> DataFrame:
    """Cluster statistics with the overall silhouette (of the ``scored`` features) next to them."""
    score = silhouette(df, scored or features, label).select("silhouette")
    return cluster_stats(df, features, label).join(F.broadcast(score), F.lit(True))
