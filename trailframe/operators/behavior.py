"""Movement features over sliding row-count windows of each trajectory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.functions.columns import epoch_micros, rate_of_turn, safe_divide, sorted_quantile
from trailframe.operators.ordered import Ordered
from trailframe.operators.segments import ORDER

_RATES = tuple(S.BEHAVIOR_RATES)


def _window_list(first: Column, n: Column, row: Column, width: int, offset: int) -> Column:
    """Windows (numbered from 0) that hold ``row`` from the row after their ``first``-th on.

    Windows start every ``offset`` rows and stop with the first one that reaches the end of the trajectory.
    """
    last = F.when(n <= width, F.lit(0)).otherwise(F.ceil((n - width) / F.lit(float(offset)))).cast("long")
    low = F.greatest(F.lit(0).cast("long"), F.floor((row - width) / F.lit(float(offset))).cast("long") + 1)
    high = F.least(last, F.floor((row - first) / F.lit(float(offset))).cast("long"))
    return F.when(low <= high, F.sequence(low, high))


def _check(width: int, offset: int) -> None:
    if width < 2 or not 0 < offset <= width:
        raise ValueError("need width >= 2 and 0 < offset <= width")


def sliding_windows(pos_gen: DataFrame, keys: list[str], width: int = S.WINDOW_WIDTH,
                    offset: int | None = None) -> DataFrame:
    """Every position once per window it falls into: adds ``moving_window_id`` and ``row`` (index in the trajectory)."""
    offset = width // 2 if offset is None else offset
    _check(width, offset)
    ordered = Ordered.open(pos_gen, keys, ORDER, epoch_micros(F.col("server_time")))
    ordered = ordered.row_index("row").group_total({"_n": F.count(F.lit(1))})
    windows = _window_list(F.lit(0), F.col("_n"), F.col("row"), width, offset)
    return ordered.finish().withColumn(S.BEHAVIOR_WINDOW_ID, F.explode(windows)).drop("_n")


def movement_steps(pos_gen: DataFrame, keys: list[str], width: int = S.WINDOW_WIDTH,
                   offset: int | None = None) -> DataFrame:
    """One row per (window, consecutive pair of positions) with the four change rates.

    The position rates divide by the mean clock difference in nanoseconds; the turn rate of the first pair of a window
    is taken against 0.
    """
    offset = width // 2 if offset is None else offset
    _check(width, offset)
    narrow = pos_gen.select(*keys, "id", "server_time", "device_time", "latitude", "longitude", "speed")
    ordered = Ordered.open(narrow, keys, ORDER, epoch_micros(F.col("server_time")))
    ordered = ordered.with_columns({"_s": epoch_micros(F.col("server_time")), "_d": epoch_micros(F.col("device_time"))})
    ordered = ordered.row_index("_row").group_total({"_n": F.count(F.lit(1))})
    ordered = ordered.lag({"_ps": "_s", "_pd": "_d", "_plat": "latitude", "_plon": "longitude", "_pspeed": "speed"})
    ordered = ordered.with_columns({
        "_dt": ((F.col("_s") - F.col("_ps")) + (F.col("_d") - F.col("_pd"))) * F.lit(500.0),
        "_dlat": F.col("latitude") - F.col("_plat"),
        "_dlon": F.col("longitude") - F.col("_plon"),
    })
    ordered = ordered.with_columns({"_turn": rate_of_turn(F.col("_dlat"), F.col("_dlon"))})
    ordered = ordered.lag({"_pturn": "_turn"})
    window = F.col(S.BEHAVIOR_WINDOW_ID)
    steps = ordered.finish().withColumn(
        S.BEHAVIOR_WINDOW_ID, F.explode(_window_list(F.lit(1), F.col("_n"), F.col("_row"), width, offset)))
    return steps.select(
        *keys, window,
        safe_divide(F.col("_dlat"), F.col("_dt")).alias("f_delta_latitude"),
        safe_divide(F.col("_dlon"), F.col("_dt")).alias("f_delta_longitude"),
        (F.col("speed") - F.col("_pspeed")).alias("f_delta_s"),
        F.when(F.col("_row") == window * offset + 1, F.col("_turn"))
        .otherwise(F.col("_turn") - F.col("_pturn")).alias("f_delta_r"),
    )


def behavior_features(pos_gen: DataFrame, keys: list[str], width: int = S.WINDOW_WIDTH,
                      offset: int | None = None) -> DataFrame:
    """24 statistics of the change rates per (trajectory, window); missing statistics are 0.

    A window holds fewer than ``width`` steps, so the lists behind the quantiles are bounded.
    """
    steps = movement_steps(pos_gen, keys, width, offset)
    values = lambda rate: F.array_sort(F.collect_list(rate))
    grouped = steps.groupBy(*keys, S.BEHAVIOR_WINDOW_ID).agg(
        *[values(rate).alias(f"_{rate}") for rate in _RATES],
        *[F.avg(rate).alias(f"{rate}_mean") for rate in _RATES],
        *[F.max(rate).alias(f"{rate}_max") for rate in _RATES],
        *[F.min(rate).alias(f"{rate}_min") for rate in _RATES],
    )
    quantiles = {
        f"{rate}_{word}{int(q * 100)}": F.when(
            F.size(f"_{rate}") > 0, sorted_quantile(F.col(f"_{rate}"), q)
        )
        for rate, word in S.BEHAVIOR_RATES.items() for q in (0.75, 0.5, 0.25)
    }
    full = grouped.withColumns(quantiles)
    return full.select(
        *keys, S.BEHAVIOR_WINDOW_ID, *[F.coalesce(f, F.lit(0.0)).alias(f) for f in S.BEHAVIOR_FEATURES])
