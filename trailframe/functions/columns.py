"""Scalar expressions shared by the operators. All are built-in functions, so they stay in code generation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session time zone."""
    seconds = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return (
        F.unix_date(ts.cast("date")).cast("long") * F.lit(86_400_000_000)
        + F.hour(ts).cast("long") * F.lit(3_600_000_000) + F.minute(ts).cast("long") * F.lit(60_000_000) + seconds
    )


def micros_between(start: Column, stop: Column) -> Column:
    return epoch_micros(stop) - epoch_micros(start)


def epoch_seconds(ts: Column) -> Column:
    """Timestamp without zone to float seconds."""
    return epoch_micros(ts) / F.lit(1e6)


def parse_timestamp(text: Column) -> Column:
    return F.to_timestamp_ntz(text)


def safe_divide(a: Column, b: Column) -> Column:
    """``a / b``, null where the divisor is 0 (ANSI mode would raise)."""
    return F.when(b != 0, a / b)


def rate_of_turn(d_lat: Column, d_lon: Column) -> Column:
    """``atan(d_lon / d_lat)``; no movement turns by 0, a purely east-west move by a quarter turn."""
    half_pi = F.lit(math.pi / 2)
    return (
        F.when(d_lat != 0, F.atan(d_lon / d_lat))
        .when(d_lon > 0, half_pi).when(d_lon < 0, -half_pi)
        .when(d_lon == 0, F.lit(0.0)).otherwise(F.lit(0.0))
    )


def sq_distance(columns: Sequence[Column], centre: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for column, c in zip(columns, centre):
        diff = column - F.lit(float(c))
        total = total + diff * diff
    return total


def sorted_quantile(values: Column, q: float) -> Column:
    """Linear-interpolation quantile of a sorted array column."""
    position = (F.size(values) - 1) * F.lit(float(q))
    low = F.floor(position).cast("int")
    a = F.element_at(values, low + 1)
    b = F.element_at(values, F.least(low + 2, F.size(values)))
    return a + (b - a) * (position - low)


def hash_order(*columns: Column, seed: int) -> Column:
    """A reproducible pseudo-random order: the hex digest of the seed and the key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns]).cast("binary"))


def normal_quantile(p: Column) -> Column:
    """Inverse standard normal distribution by a rational approximation (absolute error below 4.5e-4)."""
    # Coefficients of formula 26.2.23 in Abramowitz and Stegun.
    c0, c1, c2 = 2.515517, 0.802853, 0.010328
    d1, d2, d3 = 1.432788, 0.189269, 0.001308
    tail = F.least(p, 1 - p)
    t = F.sqrt(F.lit(-2.0) * F.ln(tail))
    x = t - (c0 + c1 * t + c2 * t * t) / (1 + d1 * t + d2 * t * t + d3 * t * t * t)
    return F.when(p < 0.5, -x).otherwise(x)
