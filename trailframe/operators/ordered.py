"""Ordered (lag / running total / group total) columns that survive a hot key.

A window function sends every row of its partition key to one task. When one trajectory holds a large share of all
positions that task becomes the whole job, so such keys are cut into consecutive chunks of their order column:

* ``Ordered.open`` counts rows per key (a map-side combined aggregate). When no key is larger than a fair share, every
  later window simply partitions by the key, and nothing else happens.
* Otherwise each hot key gets split points from ``percentile_approx`` of its order column. At most about ``2 * shares``
  split points exist in total, whatever the data size; they are fixed on the driver so that a recomputed task sees the
  same chunks.
* Windows then partition by key and chunk, and what crosses a chunk border (the last row, the running total so far, the
  group total) comes from a per-chunk aggregate, which has the same small bound and is broadcast. The chunked rows are
  written before the first step and after every step, so the upstream is read twice (count, chunks) and each step reads
  stored rows: once in full and once, narrowly, for its border table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailframe.session import materialize

MIN_HOT_ROWS = 5_000_000
SHARES = 4096
_CHUNK, _HOT = "_chunk", "_hot"


def _limits(df: DataFrame) -> tuple[int, int]:
    conf = df.sparkSession.conf
    return (
        int(conf.get("trailframe.hot.minRows", str(MIN_HOT_ROWS))),
        int(conf.get("trailframe.hot.shares", str(SHARES))),
    )


def hot_key_rows(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, int]:
    """Keys with more rows than a fair share (at most ``shares`` of them), or None; and the share itself."""
    return _hot_key_rows(df, keys)[:2]


def _hot_key_rows(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, int, int]:
    """``hot_key_rows`` and the rows of the largest key."""
    min_rows, shares = _limits(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(min_rows, (total or 0) // shares)
    if largest is None or largest <= limit:
        return None, limit, largest or 0
    return counts.where(F.col("_rows") > limit), limit, largest


@dataclass(frozen=True)
class Ordered:
    """A frame with a group key and a total order inside each group."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool
    #: Rows of the largest key.
    largest: int

    @staticmethod
    def open(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Column) -> "Ordered":
        """``split`` is a numeric column that never decreases along ``order``."""
        hot, limit, largest = _hot_key_rows(df, keys)
        if hot is None:
            return Ordered(df, tuple(keys), tuple(order), False, largest)
        _, shares = _limits(df)
        steps = min(shares, 2048)
        fractions = [i / steps for i in range(1, steps)]
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        located = df.select(*keys, split.alias("_split"))
        if keys:
            located = located.alias("l").join(F.broadcast(hot.alias("r")), same, "left_semi")
        points = located.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_split", fractions, 10 * steps).alias("_points"),
        ).collect()
        rows = []
        for point in points:
            pieces = max(2, -(-point["_n"] // limit))
            stride = max(1, steps // pieces)
            rows.append((*[point[k] for k in keys], sorted(set(point["_points"][stride - 1::stride]))))
        fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
        point_type = T.ArrayType(df.select(split.alias("_s")).schema["_s"].dataType)
        table = df.sparkSession.createDataFrame(rows, T.StructType([*fields, T.StructField("_points", point_type)]))
        # Branch-free binary search: how many split points lie strictly below the row.
        depth = max(1, max(len(r[-1]) for r in rows)).bit_length()
        jumps = F.array(*[F.lit(1 << b) for b in reversed(range(depth))])
        if keys:
            joined = df.alias("l").join(F.broadcast(table.alias("r")), same, "left").select("l.*", "_points")
        else:
            literal = F.array(*[F.lit(v) for v in rows[0][0]]).cast(point_type)
            joined = df.withColumn("_points", literal)
        search = F.aggregate(
            jumps, F.lit(0),
            lambda at, jump: F.when(
                (at + jump <= F.size("_points")) & (F.get(F.col("_points"), at + jump - 1) < split), at + jump,
            ).otherwise(at),
        )
        joined = joined.withColumn(_HOT, F.col("_points").isNotNull()).withColumn(
            _CHUNK, F.when(F.col(_HOT), search).otherwise(F.lit(0))).drop("_points")
        return Ordered(materialize(joined, "ordered"), tuple(keys), tuple(order), True, largest)

    # -- helpers -----------------------------------------------------------
    @property
    def _partition(self) -> list[str]:
        return [*self.keys, _CHUNK] if self.chunked else list(self.keys)

    @property
    def window(self):
        return Window.partitionBy(*self._partition).orderBy(*self.order)

    def _attach(self, df: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
        """Left join with a per-chunk table, whose size ``open`` bounds."""
        names = [c for c in small.columns if c not in on]
        if not on:
            return df.join(F.broadcast(small), F.lit(True), "left")
        match = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on]
        return df.alias("l").join(F.broadcast(small.alias("r")), match, "left").select(
            "l.*", *[F.col(f"r.{n}") for n in names])

    def _chunks(self) -> DataFrame:
        return self.df.where(F.col(_HOT))

    def with_df(self, df: DataFrame) -> "Ordered":
        return replace(self, df=df)

    def _stored(self, df: DataFrame) -> "Ordered":
        """After a chunked step the rows are written, so the next step's border table doesn't repeat this one's work."""
        return self.with_df(materialize(df, "ordered"))

    def with_columns(self, columns: Mapping[str, Column]) -> "Ordered":
        return self.with_df(self.df.withColumns(dict(columns)))

    def finish(self) -> DataFrame:
        return self.df.drop(_CHUNK, _HOT) if self.chunked else self.df

    # -- primitives --------------------------------------------------------
    def lag(self, columns: Mapping[str, str]) -> "Ordered":
        """``{new: source}``: the value of ``source`` in the previous row of the group, null in the first row."""
        out = self.df.withColumns({new: F.lag(src).over(self.window) for new, src in columns.items()})
        if not self.chunked:
            return self.with_df(out)
        last = F.max_by(F.struct(*[F.col(s).alias(n) for n, s in columns.items()]), F.struct(*self.order))
        tails = self._chunks().groupBy(*self._partition).agg(last.alias("_tail"))
        across = Window.partitionBy(*self.keys).orderBy(_CHUNK)
        carried = tails.withColumn("_carry", F.lag("_tail").over(across)).drop("_tail")
        out = out.withColumn("_first", F.row_number().over(self.window) == 1)
        out = self._attach(out, carried, self._partition)
        out = out.withColumns({
            new: F.when(F.col("_first"), F.col(f"_carry.{new}")).otherwise(F.col(new)) for new in columns
        }).drop("_first", "_carry")
        return self._stored(out)

    def running_sum(self, columns: Mapping[str, Column]) -> "Ordered":
        """Inclusive running totals in group order."""
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = self.df.withColumns({new: F.sum(expr).over(upto) for new, expr in columns.items()})
        if not self.chunked:
            return self.with_df(out)
        totals = self._chunks().groupBy(*self._partition).agg(
            *[F.sum(expr).alias(f"_t_{new}") for new, expr in columns.items()])
        before = Window.partitionBy(*self.keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(*self._partition, *[F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in columns])
        out = self._attach(out, offsets, self._partition)
        out = out.withColumns({
            n: F.coalesce(F.col(n) + F.col(f"_o_{n}"), F.col(n), F.col(f"_o_{n}")) for n in columns
        }).drop(*[f"_o_{n}" for n in columns])
        return self._stored(out)

    def row_index(self, name: str) -> "Ordered":
        """Zero-based position inside the group."""
        numbered = self.running_sum({name: F.lit(1)})
        return numbered.with_df(numbered.df.withColumn(name, F.col(name) - 1))

    def group_total(self, aggregates: Mapping[str, Column]) -> "Ordered":
        """Attach per-group aggregates (any aggregate expressions) to every row."""
        whole = Window.partitionBy(*self._partition)
        out = self.df.withColumns({n: agg.over(whole) for n, agg in aggregates.items()})
        if not self.chunked:
            return self.with_df(out)
        totals = self._chunks().groupBy(*self.keys).agg(*[agg.alias(f"_g_{n}") for n, agg in aggregates.items()])
        out = self._attach(out, totals, list(self.keys))
        out = out.withColumns({
            n: F.when(F.col(_HOT), F.col(f"_g_{n}")).otherwise(F.col(n)) for n in aggregates
        }).drop(*[f"_g_{n}" for n in aggregates])
        return self._stored(out)


def dense_index(keys: DataFrame, order: Sequence[str], name: str, split: Column) -> DataFrame:
    """Number distinct rows 1..K in ``order``: a global running count, chunked when the table is large."""
    return Ordered.open(keys, [], order, split).running_sum({name: F.lit(1)}).finish()
