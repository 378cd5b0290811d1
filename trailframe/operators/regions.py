"""Bounding boxes, cardinal regions and row-limited previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The boxes and the map shift of the published analysis.
POS_BOX = {"longitude": (8.0, 15.0), "latitude": (42.0, 45.0)}
RENTAL_BOX = {
    "longitude_start": (7.0, 15.0), "longitude_stop": (7.0, 15.0),
    "latitude_start": (42.0, 46.0), "latitude_stop": (42.0, 46.0),
}
MAP_SHIFT = {"latitude": 1.2, "longitude": -1.2}
PREVIEW_RENTALS = 100


def _strictly_inside(box: dict[str, tuple[float, float]]) -> Column:
    inside = F.lit(True)
    for name, (low, high) in box.items():
        inside = inside & (F.col(name) > low) & (F.col(name) < high)
    return inside


def filter_positions(df: DataFrame) -> DataFrame:
    return df.where(_strictly_inside(POS_BOX))


def filter_rentals(df: DataFrame) -> DataFrame:
    return df.where(_strictly_inside(RENTAL_BOX))


def region(only_north: bool = False) -> Column:
    """Cardinal region of a position, null outside all of them."""
    lat, lon = F.col("latitude"), F.col("longitude")
    north, south = (lat >= 43.0) & (lat < 44.3), lat < 43.0
    named = F.when(north & (lon >= 12.0), "N-E").when(north & (lon > 8.0) & (lon < 10.0), "N-W")
    if only_north:
        return named
    return named.when(south & (lon >= 13.0) & (lon < 14.2), "S-E").when(south & (lon > 11.7) & (lon < 13.0), "S-W")


def with_region(df: DataFrame, only_north: bool = False) -> DataFrame:
    """All regions in one frame: a ``region`` column, rows outside every region left out."""
    return df.withColumn("region", region(only_north)).where(F.col("region").isNotNull())


def first_rentals(df: DataFrame, n: int | None = None, force: bool = False) -> DataFrame:
    """Rows of the first ``n`` rental ids (a preview); ``force`` asks for the fixed preview size."""
    n = PREVIEW_RENTALS if force else n
    if n is None:
        return df
    ids = df.select("rental_id").distinct().orderBy("rental_id").limit(n)
    return df.join(ids, "rental_id", "left_semi").select(*df.columns)


def first_rows(df: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    return df if n is None else df.orderBy(*order).limit(n)


def shift_for_map(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name) + by for name, by in MAP_SHIFT.items()})
