"""Time gaps inside a rental, the time-gap segmentation, and dense renumbering of segments."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe.functions.columns import epoch_micros, micros_between
from trailframe.operators.ordered import Ordered, dense_index

ORDER = ("server_time", "device_time", "id")


def _open(pos_gen: DataFrame, keys: list[str]) -> Ordered:
    return Ordered.open(pos_gen, keys, ORDER, epoch_micros(F.col("server_time")))


def _with_gaps(ordered: Ordered) -> Ordered:
    """Microsecond gaps to the previous row on both clocks; the first row's gaps are 0."""
    lagged = ordered.lag({"_prev_server": "server_time", "_prev_device": "device_time"})
    gap = lambda now, prev: F.coalesce(micros_between(F.col(prev), F.col(now)), F.lit(0).cast("long"))
    return lagged.with_columns({
        "server_gap": gap("server_time", "_prev_server"), "device_gap": gap("device_time", "_prev_device"),
    })


def _mean_gap_ms() -> Column:
    """Mean of the two gaps, each cut to whole milliseconds first."""
    whole = lambda c: F.floor(F.col(c) / 1000.0)
    return (whole("server_gap") + whole("device_gap")) / 2.0


def time_gaps(pos_gen: DataFrame) -> DataFrame:
    """Add ``server_gap``, ``device_gap`` (microseconds) and ``time_gap`` (milliseconds)."""
    gaps = _with_gaps(_open(pos_gen, ["rental_id"])).with_columns({"time_gap": _mean_gap_ms()})
    return gaps.finish().drop("_prev_server", "_prev_device")


# Units of the interval text accepted for a threshold.
_UNIT_SECONDS = {
    "us": 1e-6, "ms": 1e-3, "s": 1.0, "sec": 1.0, "second": 1.0, "seconds": 1.0,
    "m": 60.0, "min": 60.0, "minute": 60.0, "minutes": 60.0,
    "h": 3600.0, "hour": 3600.0, "hours": 3600.0, "d": 86400.0, "day": 86400.0, "days": 86400.0,
}


def threshold_micros(value: int | float | str) -> int:
    """A gap threshold as a number of seconds, or text such as ``"10 minutes"`` or ``"90"`` (seconds)."""
    if isinstance(value, str):
        match = re.fullmatch(r"\s*([0-9.]+)\s*([a-z]*)\s*", value.lower())
        if not match or (match[2] and match[2] not in _UNIT_SECONDS):
            raise ValueError(f"not a duration: {value!r}")
        value = float(match[1]) * _UNIT_SECONDS[match[2] or "s"]
    return round(float(value) * 1_000_000)


def timedelta(pos_gen: DataFrame, threshold: int | float | str | None = None, mode: str = "runs") -> DataFrame:
    """Cut each rental at large time gaps: fills ``timedelta_id`` and ``time_gap``.

    A row is flagged when both clocks' gaps reach the threshold, which by default is, per rental and clock, the mean
    gap plus one sample standard deviation. ``mode="runs"`` numbers the runs of equal flags (a flagged row opens a run
    and the next unflagged row opens another); ``mode="split"`` opens one segment per flagged row.
    """
    if mode not in ("runs", "split"):
        raise ValueError(f"unknown mode {mode!r}")
    ordered = _with_gaps(_open(pos_gen, ["rental_id"]))
    if threshold is None:
        ordered = ordered.group_total({
            f"_{stat.__name__}_{clock}": stat(f"{clock}_gap")
            for clock in ("server", "device") for stat in (F.avg, F.stddev_samp)
        })
        ordered = ordered.with_columns({
            f"_{clock}_limit": F.col(f"_avg_{clock}") + F.coalesce(F.col(f"_stddev_samp_{clock}"), F.lit(0.0))
            for clock in ("server", "device")
        })
    else:
        limit = F.lit(float(threshold_micros(threshold)))
        ordered = ordered.with_columns({"_server_limit": limit, "_device_limit": limit})
    flag = (F.col("server_gap") >= F.col("_server_limit")) & (F.col("device_gap") >= F.col("_device_limit"))
    ordered = ordered.with_columns({"_flag": flag})
    if mode == "runs":
        ordered = ordered.lag({"_prev_flag": "_flag"})
        opens = F.when(F.col("_prev_flag").isNull() | (F.col("_prev_flag") != F.col("_flag")), 1).otherwise(0)
        ordered = ordered.running_sum({"_run": opens})
    else:
        ordered = ordered.running_sum({"_run": F.when(F.col("_flag"), 1).otherwise(0)})
        ordered = ordered.with_columns({"_run": F.col("_run") + 1})
    done = ordered.with_columns({"timedelta_id": F.col("_run").cast("long"), "time_gap": _mean_gap_ms()})
    return done.finish().select(*pos_gen.columns)


def renumber_segments(df: DataFrame) -> DataFrame:
    """Replace the per-rental ``timedelta_id`` by one dense number over all rentals, in (rental, segment) order.

    Only the distinct (rental, segment) pairs are numbered; the rows get their number by a key join. Rows without a
    segment stay and keep none.
    """
    pairs = df.select("rental_id", "timedelta_id").where("timedelta_id IS NOT NULL").distinct()
    numbered = dense_index(pairs, ["rental_id", "timedelta_id"], "_segment", F.col("rental_id")).select(
        F.col("rental_id").alias("_r"), F.col("timedelta_id").alias("_t"), "_segment")
    same = F.col("rental_id").eqNullSafe(F.col("_r")) & (F.col("timedelta_id") == F.col("_t"))
    return df.join(numbered, same, "left").withColumn("timedelta_id", F.col("_segment").cast("long")).select(*df.columns)
