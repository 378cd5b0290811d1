"""Trajectory views over the given star-schema tables, so every operator can run on them.

Positions come from ``events``, devices and users from ``customer``, rentals from the users seen in ``events``. The
DuckDB text in ``checks/`` defines the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailframe import schemas as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_residue(values: tuple[float, ...], key: str):
    column = F.col(key) % 4
    expr = F.when(column == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(column == i, F.lit(v))
    return expr


# The four city centres used for the views.
LATITUDES = (44.24, 43.86, 42.76, 42.48)
LONGITUDES = (12.19, 8.87, 13.94, 11.79)


def pos_from_events(events: DataFrame) -> DataFrame:
    jitter = lambda step: ((F.col("event_id") * step) % 1000 - 500) / F.lit(100000.0)
    return S.conform(events.select(
        F.col("event_id").alias("id"),
        (_by_residue(LATITUDES, "user_id") + jitter(37)).alias("latitude"),
        (_by_residue(LONGITUDES, "user_id") + jitter(53)).alias("longitude"),
        (F.col("value") / F.lit(10.0)).alias("speed"),
        F.col("ts").alias("server_time"),
        F.expr("ts - make_dt_interval(0, 0, 0, cast(event_id % 5 as decimal(18, 6)))").alias("device_time"),
        F.col("user_id").alias("device_id"),
    ), S.POS)


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos_from_events(table(spark, sf_dir, "events"))


def rental(spark: SparkSession, sf_dir: str) -> DataFrame:
    halves = table(spark, sf_dir, "events").select(
        "user_id", F.least(F.lit(1), F.floor((F.dayofmonth("ts") - 1) / 15)).cast("long").alias("half")).distinct()
    shifted = lambda text: F.expr(f"TIMESTAMP_NTZ '{text}' + make_dt_interval(cast(15 * half as int), 0, 0, 0)")
    key = F.col("user_id") * 10 + F.col("half")
    return S.conform(halves.select(
        key.alias("id"), F.col("user_id").alias("device_id"), "user_id",
        (_by_residue(LATITUDES, "user_id") - F.lit(0.001)).alias("latitude_start"),
        (_by_residue(LONGITUDES, "user_id") - F.lit(0.001)).alias("longitude_start"),
        (_by_residue(LATITUDES, "user_id") + F.lit(0.001)).alias("latitude_stop"),
        (_by_residue(LONGITUDES, "user_id") + F.lit(0.001)).alias("longitude_stop"),
        shifted("2024-01-01 06:00:00").alias("start_time"), shifted("2024-01-15 18:00:00").alias("stop_time"),
        ((key % 50) / F.lit(10.0)).alias("km"),
    ), S.RENTAL)


def _thinned(spark: SparkSession, sf_dir: str, modulus: int) -> DataFrame:
    """Leave gaps in the id space, so that inner and semi joins have something to drop."""
    return table(spark, sf_dir, "customer").where(F.col("c_custkey") % modulus != modulus - 1).select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("km"))


def device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.conform(_thinned(spark, sf_dir, 13), S.DEVICE)


def usr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.conform(_thinned(spark, sf_dir, 17), S.USR)


def pos_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with every 97th one moved away, so that box and region filters drop rows."""
    moved = F.when(F.col("id") % 97 == 0, F.col("latitude") + 5.0).otherwise(F.col("latitude"))
    return pos(spark, sf_dir).withColumn("latitude", moved)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf_dir) for name, make in
            (("pos", pos), ("rental", rental), ("usr", usr), ("device", device))}
