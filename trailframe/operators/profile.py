"""Column profiles: counts, nulls, moments, exact quantiles, distinct values, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailframe.functions.columns import epoch_seconds
from trailframe.operators.ordered import Ordered
from trailframe.session import materialize

QUARTILES = (0.25, 0.5, 0.75)
#: Equal ranges between a column's extremes in the first pass over its values.
BUCKETS = 4096


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType))


def _numeric(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Columns as doubles; timestamps count as epoch seconds."""
    fields = {f.name: f for f in df.schema.fields}
    return [
        (epoch_seconds(F.col(f"`{n}`")) if _is_time(fields[n]) else F.col(f"`{n}`").cast("double")).alias(n)
        for n in names
    ]


def profiled_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) or _is_time(f)]


def long_values(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, value): one row per non-null value."""
    entries = F.array(*[F.struct(F.lit(n).alias("column"), c.alias("value")) for n, c in zip(names, _numeric(df, names))])
    return df.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.column", "_e.value").where("value IS NOT NULL")


def exact_quantiles(values: DataFrame, keys: Sequence[str], probabilities: Sequence[float] = QUARTILES,
                    value: str = "value") -> DataFrame:
    """(keys, q, quantile): linear-interpolation quantiles without gathering a group.

    Values are first counted (repeats collapse map-side) and the counts written once; a running count in value order then
    locates the one or two values each quantile lies between.
    """
    counted = materialize(values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w")), "value-counts")
    ordered = Ordered.open(counted, list(keys), [value], F.col(value)).running_sum({"_upto": F.col("_w")})
    ordered = ordered.group_total({"_n": F.sum("_w")})
    ranked = ordered.finish().withColumn("_from", F.col("_upto") - F.col("_w"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    low = F.floor((F.col("_n") - 1) * F.col("q"))
    high = F.least(low + 1, F.col("_n") - 1)
    share = (F.col("_n") - 1) * F.col("q") - low
    holds = lambda rank: (F.col("_from") <= rank) & (rank < F.col("_upto"))
    picked = ranked.withColumn("q", wanted).where(holds(low) | holds(high)).groupBy(*keys, "q").agg(
        F.max(F.when(holds(low), F.col(value))).alias("_a"),
        F.max(F.when(holds(high), F.col(value))).alias("_b"),
        F.max(share).alias("_share"),
    )
    return picked.select(*keys, "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias("quantile"))


def refined_quantiles(numeric: DataFrame, columns: int, by: Sequence[str], bounds: DataFrame,
                      probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """(by, column number, q, quantile) of the columns v0, v1, ..., exact, in two passes that don't shuffle values.

    ``bounds`` holds min0, max0, ... per group. The first pass counts each column's values in ``BUCKETS`` equal ranges, which
    combine before the shuffle. The second one counts the values in the few ranges that hold a wanted rank; a column whose values
    crowd into one range has its repeats counted there, as ``exact_quantiles`` does. Groups with a null key are left out.
    """
    meet = lambda left, right: left.join(right, list(by)) if by else left.join(F.broadcast(right), F.lit(True))
    held = meet(numeric, bounds.select(*by, *[f"{s}{i}" for i in range(columns) for s in ("min", "max")]))
    value = lambda i: F.col(f"v{i}")

    def bucket(i: int) -> Column:
        share = F.try_divide(value(i) - F.col(f"min{i}"), F.col(f"max{i}") - F.col(f"min{i}"))
        return F.coalesce(F.least(F.floor(F.nanvl(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)), F.lit(0)).cast("int")

    entries = F.array(*[F.when(value(i).isNotNull(), F.struct(F.lit(i).alias("_i"), bucket(i).alias("_bucket"))) for i in range(columns)])
    counts = held.select(*by, F.explode(entries).alias("_e")).where("_e IS NOT NULL").select(*by, "_e.*").groupBy(
        *by, "_i", "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*by, "_i")  # BUCKETS rows at most
    upto = F.sum("_c").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"_before": upto - F.col("_c"), "_n": F.sum("_c").over(group)})
    low = lambda p: F.floor((F.col("_n") - 1) * F.lit(float(p)))
    high = lambda p: F.least(low(p) + 1, F.col("_n") - 1)
    inside = lambda rank: (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c"))
    wanted = F.lit(False)
    for p in probabilities:
        wanted = wanted | inside(low(p)) | inside(high(p))
    chosen = materialize(ranked.where(wanted).select(*by, "_i", "_bucket", "_before", "_n"), "quantile-ranges")

    sets = chosen.groupBy(*by).agg(*[F.collect_set(F.when(F.col("_i") == i, F.col("_bucket"))).alias(f"_s{i}") for i in range(columns)])
    near = F.array(*[F.when(value(i).isNotNull() & F.array_contains(f"_s{i}", bucket(i)), F.struct(
        F.lit(i).alias("_i"), bucket(i).alias("_bucket"), value(i).alias("_v"))) for i in range(columns)])
    counted = materialize(meet(held, sets).select(*by, F.explode(F.array_compact(near)).alias("_e")).select(*by, "_e.*").groupBy(
        *by, "_i", "_bucket", "_v").agg(F.count(F.lit(1)).alias("_c")), "quantile-values")
    running = Ordered.open(counted, [*by, "_i", "_bucket"], ["_v"], F.col("_v")).running_sum({"_upto": F.col("_c")}).finish()
    placed = running.join(chosen, [*by, "_i", "_bucket"]).withColumn("_before", F.col("_before") + F.col("_upto") - F.col("_c"))
    at = placed.withColumn("q", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    rank = F.floor((F.col("_n") - 1) * F.col("q"))
    after = F.least(rank + 1, F.col("_n") - 1)
    picked = at.where(inside(rank) | inside(after)).groupBy(*by, "_i", "q").agg(
        F.max(F.when(inside(rank), F.col("_v"))).alias("_a"), F.max(F.when(inside(after), F.col("_v"))).alias("_b"),
        F.max((F.col("_n") - 1) * F.col("q") - rank).alias("_share"))
    return picked.select(*by, "_i", "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias("quantile"))


def describe(df: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, count, mean, std, min, q25, q50, q75, max) of numeric and time columns.

    Times are epoch seconds and have no std.
    """
    names = profiled_columns(df) if names is None else list(names)
    names = [n for n in names if n not in by]
    times = [f.name for f in df.schema.fields if _is_time(f) and f.name in names]
    keys = [*by, "column"]
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    numeric = df.select(*by, *[c.alias(f"v{i}") for i, c in enumerate(_numeric(df, names))])
    wide = materialize(numeric.groupBy(*by).agg(
        *[f(f"v{i}").alias(f"{s}{i}") for i in range(len(names)) for s, f in stats.items()]), "moments")
    entry = lambda i, n: F.struct(F.lit(n).alias("column"), *[
        (F.lit(None).cast("double") if s == "std" and n in times else F.col(f"{s}{i}")).alias(s) for s in stats])
    moments = wide.select(*by, F.explode(F.array(*[entry(i, n) for i, n in enumerate(names)])).alias("_e")).select(
        *by, "_e.*").where("count > 0")
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_i") + 1).alias("column")
    quantiles = refined_quantiles(numeric, len(names), by, wide).select(*by, named, "q", "quantile").groupBy(*keys).agg(*[
        F.max(F.when(F.col("q") == p, F.col("quantile"))).alias(f"q{int(p * 100)}") for p in QUARTILES])
    joined = moments.join(quantiles, keys)
    return joined.select(*keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column."""
    counts = df.agg(*[F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("long")), F.lit(0)).alias(f"n{i}")
                      for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)])
    return counts.select(F.explode(rows).alias("_e")).select("_e.column", "_e.nulls")


def any_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: is any value of the named columns null?"""
    has = F.lit(False)
    for n in names:
        has = has | F.col(n).isNull()
    return df.agg(F.coalesce(F.bool_or(has), F.lit(False)).alias("any_null"))


def any_empty(tables: dict[str, DataFrame]) -> bool:
    return any(df.isEmpty() for df in tables.values())


def shape(df: DataFrame) -> DataFrame:
    """(column, dtype, position, rows)."""
    spark = df.sparkSession
    columns = spark.createDataFrame([(c, t, i) for i, (c, t) in enumerate(df.dtypes)], "column string, dtype string, position int")
    return columns.join(F.broadcast(df.agg(F.count(F.lit(1)).alias("rows"))), F.lit(True))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("count"))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def first_of_duplicates(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row (in ``order``) of every set of rows that agree on ``subset``."""
    rest = [c for c in df.columns if c not in subset]
    kept = df.groupBy(*subset).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*[F.col(c) if c in subset else F.col(f"_row.{c}").alias(c) for c in df.columns])


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("groups"))


def correlation_matrix(df: DataFrame, names: Sequence[str], digits: int = 2) -> DataFrame:
    """(x, y, correlation) for every ordered pair, from one pass of pairwise aggregates."""
    numeric = df.select(*_numeric(df, names))
    pairs = list(combinations_with_replacement(names, 2))
    row = numeric.agg(*[F.corr(f"`{a}`", f"`{b}`").alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entry = lambda a, b, i: F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(f"c{i}", digits).alias("correlation"))
    entries = [entry(a, b, i) for i, (a, b) in enumerate(pairs)]
    entries += [entry(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.x", "_e.y", "_e.correlation")


def region_summary(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """The profile of every region, with the region's row count. Expects a ``region`` column."""
    rows = df.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))
    return describe(df, names, by=["region"]).join(rows, "region")
