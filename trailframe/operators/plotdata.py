"""Tables behind the charts: bins, lines, map layers and point sets. Drawing them is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailframe.functions.columns import epoch_micros
from trailframe.operators.enrich import LIST_ROWS, in_parts
from trailframe.operators.profile import long_values
from trailframe.operators.regions import first_rentals, shift_for_map, with_region
from trailframe.operators.regress import Fit
from trailframe.session import materialize

BINS, TARGET_BINS, GRID = 50, 30, 50
_ORDER = ["server_time", "device_time", "id"]


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin from 0; the maximum belongs to the last bin, a constant column to bin 0."""
    width = (high - low) / bins
    at = F.when(width > 0, F.floor((value - low) / width)).otherwise(F.lit(0))
    return F.least(at, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, names: Sequence[str], bins: int = BINS, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, bin, low, high, count, density) of the non-empty bins.

    All groups of a column share the column's bin edges and its total, so densities add up to 1 over the groups.
    """
    values = long_values(df, names, by)
    ranges = values.groupBy("column").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    counted = values.join(F.broadcast(ranges), "column").withColumn(
        "bin", _bin(F.col("value"), F.col("_lo"), F.col("_hi"), bins))
    grouped = counted.groupBy(*by, "column", "bin", "_lo", "_hi", "_n").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return grouped.select(
        *by, "column", "bin", (F.col("_lo") + F.col("bin") * width).alias("low"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), "count",
        F.when(width > 0, F.col("count") / (F.col("_n") * width)).alias("density"))


def density_grid(df: DataFrame, x: str, y: str, grid: int = GRID) -> DataFrame:
    """(xi, yi, count) of the occupied cells of a ``grid`` x ``grid`` raster."""
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    ranges = pairs.agg(*[f(c).alias(f"_{n}{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))])
    located = pairs.join(F.broadcast(ranges), F.lit(True))
    return located.groupBy(*[_bin(F.col(c), F.col(f"_lo{c}"), F.col(f"_hi{c}"), grid).alias(f"{c}i") for c in ("x", "y")]).agg(
        F.count(F.lit(1)).alias("count"))


def kernel_density(df: DataFrame, x: str, y: str, grid: int = GRID) -> DataFrame:
    """(xi, yi, density): Gaussian kernel estimate on the raster, from binned counts.

    The kernel width follows the usual n^(-1/6) rule per axis. The kernel is a product of two, so the cells are spread
    along x first and along y second, which stays within grid^3 rows.
    """
    stats = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna().agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in
                                        (("lo", F.min), ("hi", F.max), ("sd", F.stddev_samp))]).first()
    out = density_grid(df, x, y, grid).withColumn("w", F.col("count").cast("double"))
    scale = float(stats["n"] or 1)
    for axis in ("x", "y"):
        step = ((stats[f"hi_{axis}"] or 0.0) - (stats[f"lo_{axis}"] or 0.0)) / grid
        reach = (stats[f"sd_{axis}"] or 0.0) * scale ** (-1.0 / 6.0)
        if not step or not reach:
            continue
        other = "yi" if axis == "x" else "xi"
        gap = (F.col("to") - F.col(f"{axis}i")) * F.lit(step / reach)
        weight = F.exp(-0.5 * gap * gap) / F.lit(reach * (2 * 3.141592653589793) ** 0.5)
        out = out.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))).groupBy(
            F.col("to").alias(f"{axis}i"), other).agg(F.sum(F.col("w") * weight).alias("w"))
    return out.select("xi", "yi", (F.col("w") / F.lit(scale)).alias("density"))


def joint_points(df: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    return df.select(x, y, *([hue] if hue else []))


def joint_marginals(df: DataFrame, x: str, y: str, hue: str | None = None, bins: int = BINS) -> DataFrame:
    """Step histograms of both axes, per hue value."""
    return histogram(df, [x, y], bins, [hue] if hue else [])


def polylines(df: DataFrame, keys: Sequence[str], x: str, y: str, label: str | None = None,
              order: Sequence[str] = _ORDER, split: Column | None = None, part_rows: int = LIST_ROWS) -> DataFrame:
    """(keys[, label], part, points): ordered point lists, one line per group and label value."""
    group = list(dict.fromkeys([*keys, *([label] if label else [])]))
    split = epoch_micros(F.col("server_time")) if split is None else split
    needed = list(dict.fromkeys([*group, *order, "server_time", x, y]))
    return in_parts(df.select(*needed), group, list(order), F.struct(x, y), "points", split, part_rows)


def label_lines_3d(df: DataFrame, keys: Sequence[str], x: str, y: str, label: str, **kw) -> DataFrame:
    """Lines split by label, with the label as the height of the line."""
    return polylines(df, keys, x, y, label, **kw).withColumn("z", F.col(label).cast("double"))


def facet_lines(df: DataFrame, rentals: int | None = None, **kw) -> DataFrame:
    """Lines per rental and segment, of all rentals or of the first so many."""
    shown = first_rentals(df, rentals)
    return polylines(shown, ["rental_id", "timedelta_id"], "longitude", "latitude", **kw)


def map_layer(df: DataFrame, label: str, hover: Sequence[str] = ("server_time", "speed"), shift: bool = True) -> DataFrame:
    """Scatter-map points with their label and hover columns."""
    moved = shift_for_map(df) if shift else df
    return moved.select(*dict.fromkeys(["latitude", "longitude", label, *hover]))


def map_centre(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def feature_target_points(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, x, target) for scatter charts of every feature."""
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("x")) for f in features])
    return df.select(F.explode(entries).alias("_e"), F.col(f"`{target}`").alias("target")).select("_e.feature", "_e.x", "target")


def regression_overlay(df: DataFrame, fit: Fit) -> DataFrame:
    """(feature, x, target, prediction, line): measured, predicted, and the feature's own regression line."""
    predicted = df.withColumn("prediction", fit.prediction())
    entries = F.array(*[
        F.struct(F.lit(f).alias("feature"), x.alias("x"), (x * F.lit(c) + F.lit(fit.bias)).alias("line"))
        for f, x, c in zip(fit.features, fit.scaled(), fit.coefficients)])
    return predicted.select(F.explode(entries).alias("_e"), F.col(fit.target).alias("target"), "prediction").select(
        "_e.feature", "_e.x", "target", "prediction", "_e.line")


def region_lines(df: DataFrame, keys: Sequence[str], label: str | None = None, only_north: bool = False,
                 rentals: int | None = None, **kw) -> DataFrame:
    """Lines of every region in one table. ``rentals`` previews the first so many rentals of each region."""
    located = with_region(df, only_north)
    if rentals is not None:
        ids = located.select("region", "rental_id").distinct().withColumn(
            "_rank", F.row_number().over(Window.partitionBy("region").orderBy("rental_id")))
        located = located.join(ids.where(F.col("_rank") <= rentals).drop("_rank"), ["region", "rental_id"], "left_semi")
    return polylines(located, ["region", *keys], "longitude", "latitude", label, **kw)


def cluster_lines(prepared: DataFrame, clusters: DataFrame, keys: Sequence[str], rentals: int | None = None,
                  row: Sequence[str] = ("rental_id", "pos_id")) -> DataFrame:
    """(scope, method, keys, cluster_id, part, points): clustered lines of every scope and method.

    ``prepared`` holds float-second times, ``clusters`` is the labelled output of a clustering run. The labelled rows are
    written once, as they are counted and then listed.
    """
    shown = first_rentals(prepared, rentals)
    order = ["server_time", "device_time", "pos_id"]
    needed = dict.fromkeys([*row, *keys, *order, "longitude", "latitude"])
    labelled = materialize(shown.select(*needed).join(clusters.select(*row, "scope", "method", "cluster_id"), list(row)), "lines")
    return polylines(labelled, ["scope", "method", *keys], "longitude", "latitude", "cluster_id",
                     order=order, split=F.col("server_time"))


def cluster_summary(prepared: DataFrame, clusters: DataFrame, features: Sequence[str],
                    row: Sequence[str] = ("rental_id", "pos_id")) -> DataFrame:
    """(scope, method, cluster_id, rows, means and deviations) for every scope and method."""
    return prepared.join(clusters, list(row)).groupBy("scope", "method", "cluster_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(f).alias(f"{f}_mean") for f in features],
        *[F.stddev_samp(f).alias(f"{f}_std") for f in features])
