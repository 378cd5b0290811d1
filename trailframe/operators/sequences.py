"""Sliding windows over whole trajectories, and cluster labels brought back to positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe.functions.columns import epoch_micros
from trailframe.operators.cluster import LABEL
from trailframe.operators.ordered import Ordered
from trailframe.operators.segments import renumber_segments

_ORDER = ["server_time", "device_time", "id"]


def sequence_windows(df: DataFrame, keys: list[str], features: Sequence[str], width: int,
                     order: list[str] = _ORDER, split: Column | None = None) -> DataFrame:
    """(keys, window, values): stride-1 windows of ``width`` positions over each whole trajectory.

    The width doesn't depend on the trajectory's length; a trajectory shorter than that has one window of all its rows.
    Every position is sent to the windows it belongs to, so a list holds at most ``width`` entries.
    """
    split = epoch_micros(F.col("server_time")) if split is None else split
    ordered = Ordered.open(df.select(*dict.fromkeys([*keys, *order, *features, "server_time"])), keys, order, split)
    placed = ordered.row_index("_at").group_total({"_n": F.count(F.lit(1))}).finish()
    low = F.greatest(F.col("_at") - (width - 1), F.lit(0))
    high = F.least(F.col("_at"), F.greatest(F.col("_n") - width, F.lit(0)))
    point = F.array(*[F.col(f).cast("double") for f in features])
    spread = placed.select(*keys, F.explode(F.sequence(low, high)).alias("window"), F.struct("_at", point.alias("v")).alias("_p"))
    return spread.groupBy(*keys, "window").agg(F.array_sort(F.collect_list("_p")).alias("_l")).select(
        *keys, "window", F.transform("_l", lambda e: e["v"]).alias("values"))


def label_positions(df: DataFrame, labelled: DataFrame, keys: list[str], renumber: bool = True) -> DataFrame:
    """Give every position its trajectory's cluster (one row per key in ``labelled``); positions without one are dropped.

    Segments are renumbered.
    """
    joined = df.join(labelled.select(*keys, LABEL), keys).select(*df.columns, LABEL)
    return renumber_segments(joined) if renumber and "timedelta_id" in df.columns else joined
