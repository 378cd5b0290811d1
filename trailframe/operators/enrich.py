"""Joining positions to rentals, users and devices, and the tables built from the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.functions.columns import epoch_micros
from trailframe.operators.ordered import Ordered

BUCKET_SECONDS = 86_400
LIST_ROWS = 100_000
#: Blocks of up to 2^31 buckets, far beyond what timestamps can express in days.
DYADIC_LEVELS = 32
#: From this block size on, the middle of a long rental is one range.
RANGE_LEVEL = 8


def time_contained(server: Column, device: Column, start: Column, stop: Column) -> Column:
    """Both clocks of a position lie inside the rental, bounds included."""
    return server.between(start, stop) & device.between(start, stop)


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(1_000_000 * seconds)).cast("long")


def rental_attributes(rental: DataFrame, usr: DataFrame, device: DataFrame) -> DataFrame:
    """The 12 rental, user and device columns; inner joins drop rentals whose user or device is unknown."""
    return (
        rental.withColumnsRenamed(S.RENTAL_TO_MERGE)
        .join(usr.withColumnsRenamed(S.USR_TO_MERGE), "user_id")
        .join(device.withColumnsRenamed(S.DEVICE_TO_MERGE), "device_id")
        .select(*S.DATASET_KEYS)
    )


def _days(pos: DataFrame, bucket_seconds: int) -> DataFrame:
    """One row: the first and last time bucket that holds a position."""
    bucket = _bucket(F.col("server_time"), bucket_seconds)
    return pos.agg(F.min(bucket).alias("_low"), F.max(bucket).alias("_high"))


def dyadic_blocks(first: Column, last: Column, levels: int = DYADIC_LEVELS) -> Column:
    """The fewest aligned blocks of 2^level buckets that make up first..last: structs (level, block), two a level at most.

    With fewer ``levels``, whole blocks of 2^levels buckets are left out.
    """

    def at(level: Column) -> Column:
        scale = F.pow(F.lit(2.0), level)  # exact: bucket numbers stay far below 2^53
        low, high = F.ceil(first / scale).cast("long"), F.floor((last + 1) / scale).cast("long")
        block = lambda number: F.struct(level.alias("level"), number.alias("block"))
        odd = lambda number: F.pmod(number, F.lit(2)) == 1
        return F.filter(F.array(F.when((low < high) & odd(low), block(low)), F.when((low < high) & odd(high), block(high - 1))),
                        lambda b: b.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at))


def dyadic_join(located: DataFrame, rentals: DataFrame, first: Column, last: Column) -> DataFrame:
    """Join on the device and any block that covers a position's bucket.

    A rental takes two blocks per doubling of its length at most, and beyond 2^``RANGE_LEVEL`` buckets one range for all whole blocks of
    that size, whatever its stop time; a position looks up one block per level in use (``RANGE_LEVEL`` and the range at most, asked of
    the rental table, which is static). Blocks of one rental don't overlap: no pair comes twice. Both sides are shuffled: Spark's size
    check doesn't see that looked-up blocks multiply the positions and would broadcast them.
    """
    size = 1 << RANGE_LEVEL
    low, high = F.ceil(first / size).cast("long") * size, F.floor((last + 1) / size).cast("long") * size - 1
    middle = F.struct(F.lit(RANGE_LEVEL).alias("level"), F.lit(0).cast("long").alias("block"))
    pieces = F.concat(dyadic_blocks(first, last, RANGE_LEVEL), F.filter(F.array(middle), lambda _: low <= high))
    blocks = rentals.withColumn("_b", F.explode(pieces)).select(
        *rentals.columns, F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"), low.alias("_from"), high.alias("_to"))
    levels = sorted(row[0] for row in blocks.select("_level").distinct().collect())  # RANGE_LEVEL + 1 rows at most
    block_at = lambda level: F.expr(f"shiftright(_bucket, {level})") if level < RANGE_LEVEL else F.lit(0).cast("long")
    wanted = F.array(*[F.struct(F.lit(level).alias("_level"), block_at(level).alias("_block")) for level in levels])
    empty = F.array().cast("array<struct<_level:int,_block:bigint>>")
    looked_up = located.withColumn("_at", F.explode(wanted if levels else empty)).select("*", "_at.*").drop("_at")
    met = (F.col("_level") < RANGE_LEVEL) | F.col("_bucket").between(F.col("_from"), F.col("_to"))
    return looked_up.hint("merge").join(blocks, ["device_id", "_level", "_block"]).where(met).drop("_level", "_block", "_from", "_to")


def interval_join(pos: DataFrame, rentals: DataFrame, bucket_seconds: int = BUCKET_SECONDS,
                  span: tuple[str, str] | None = None, dyadic: bool | None = None) -> DataFrame:
    """Every (rental, position) pair with the same device and the position's clocks inside the rental.

    Rentals are repeated once per time bucket they touch, so the equality key is (device, bucket): one busy device is
    spread over all its days instead of meeting all its rentals in one task. Small rental tables are broadcast by
    Spark's own size check; larger ones sort-merge with adaptive skew splitting. Rentals only repeat within the time that
    positions cover, so a broken stop time (year 9999) doesn't multiply them. That time is ``span`` (first, last
    timestamp) or, without it and for tables that aren't streams, two numbers aggregated from the positions' clock column.
    Streams without ``span`` join on dyadic blocks instead (``dyadic_join``), where a long rental costs little.
    """
    start, stop = _bucket(F.col("start_time"), bucket_seconds), _bucket(F.col("stop_time"), bucket_seconds)
    spread = rentals.where(F.col("start_time") <= F.col("stop_time"))
    located = pos.withColumnsRenamed(S.POS_TO_MERGE).withColumn("_bucket", _bucket(F.col("server_time"), bucket_seconds))
    contained = time_contained(F.col("server_time"), F.col("device_time"), F.col("start_time"), F.col("stop_time"))
    if dyadic or (dyadic is None and span is None and pos.isStreaming):
        return dyadic_join(located, spread, start, stop).where(contained).drop("_bucket")
    if span is not None:
        low, high = (_bucket(F.to_timestamp_ntz(F.lit(s)), bucket_seconds) for s in span)
    else:
        spread = spread.join(F.broadcast(_days(pos, bucket_seconds)), F.lit(True))
        low, high = F.col("_low"), F.col("_high")
    first, last = F.greatest(start, low), F.least(stop, high)
    spread = spread.where(first <= last).withColumn("_bucket", F.explode(F.sequence(first, last))).drop("_low", "_high")
    return located.join(spread, ["device_id", "_bucket"]).where(contained).drop("_bucket")


def merge_positions(pos: DataFrame, rental: DataFrame, usr: DataFrame, device: DataFrame,
                    bucket_seconds: int = BUCKET_SECONDS, span: tuple[str, str] | None = None) -> DataFrame:
    """The enriched trajectory table: one row per (rental, position)."""
    joined = interval_join(pos, rental_attributes(rental, usr, device), bucket_seconds, span)
    return S.conform(joined, S.MERGE)


def semi_reduce(pos: DataFrame, rental: DataFrame, usr: DataFrame, device: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rentals with a known user, a known device and at least one position; then positions of those devices."""
    seen = pos.select("device_id").distinct()
    kept = (
        rental.join(device.select(F.col("id").alias("device_id")), "device_id", "left_semi")
        .join(usr.select(F.col("id").alias("user_id")), "user_id", "left_semi")
        .join(seen, "device_id", "left_semi")
        .select(*rental.columns)
    )
    return pos.join(kept.select("device_id").distinct(), "device_id", "left_semi").select(*pos.columns), kept


def valid_rentals(rental: DataFrame, merge: DataFrame) -> DataFrame:
    return rental.join(merge.select(F.col("rental_id").alias("id")).distinct(), "id", "left_semi").select(*rental.columns)


def valid_positions(pos: DataFrame, merge: DataFrame) -> DataFrame:
    return pos.join(merge.select(F.col("pos_id").alias("id")).distinct(), "id", "left_semi").select(*pos.columns)


def in_parts(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str,
             split: Column, part_rows: int = LIST_ROWS, position: str = "_at") -> DataFrame:
    """Group into ordered lists of at most ``part_rows`` entries: columns ``keys``, ``part``, ``name``.

    ``part`` (0, 1, ...) belongs to the row key of every such table, at every size: a row holds one stretch of a group, so
    neither a row nor an aggregation buffer grows with the group. When every group fits one part, its list is sorted as it
    is gathered, without numbering the rows first.
    """
    opened = Ordered.open(df, keys, order, split)
    if not opened.chunked and opened.largest <= part_rows:
        entry = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], value.alias("v"))
        whole = df.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_list"))
        return whole.select(*keys, F.lit(0).cast("long").alias("part"), F.transform("_list", lambda e: e["v"]).alias(name))
    indexed = opened.row_index(position).finish()
    listed = indexed.withColumn("part", F.floor(F.col(position) / part_rows).cast("long")).groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col(position).alias("at"), value.alias("v")))).alias("_list"))
    return listed.select(*keys, "part", F.transform("_list", lambda e: e["v"]).alias(name))


def build_dataset(merge: DataFrame, part_rows: int = LIST_ROWS) -> DataFrame:
    """One row per rental (and part) with its ordered position ids; rows with a null attribute form no group."""
    complete = merge.dropna(subset=S.DATASET_KEYS)
    narrow = complete.select(*S.DATASET_KEYS, "pos_id", "server_time", "device_time")
    indexed = Ordered.open(narrow, ["rental_id"], ["server_time", "device_time", "pos_id"],
                           epoch_micros(F.col("server_time"))).row_index("_at").finish()
    listed = (
        indexed.withColumn("part", F.floor(F.col("_at") / part_rows).cast("long"))
        .groupBy("rental_id", "part", *[c for c in S.DATASET_KEYS if c != "rental_id"])
        .agg(F.array_sort(F.collect_list(F.struct("_at", "pos_id"))).alias("_list"))
    )
    return listed.select(*S.DATASET_KEYS, F.transform("_list", lambda e: e["pos_id"]).alias("rental_positions"), "part")


def nest_positions(pos: DataFrame, rental: DataFrame, part_rows: int = LIST_ROWS) -> DataFrame:
    """Rentals with their positions as an array of structs; rentals without positions are dropped."""
    pairs = interval_join(pos, rental.withColumnRenamed("id", "rental_id").drop("user_id"))
    value = F.struct("pos_id", "latitude", "longitude", "speed", "server_time", "device_time")
    nested = in_parts(pairs, ["rental_id"], ["server_time", "device_time", "pos_id"], value, "rental_positions",
                      epoch_micros(F.col("server_time")), part_rows)
    return nested.join(rental.withColumnRenamed("id", "rental_id"), "rental_id").select(
        F.col("rental_id").alias("id"), *[c for c in rental.columns if c != "id"], "part", "rental_positions")


def nest_rentals(pos: DataFrame, rental: DataFrame, part_rows: int = LIST_ROWS) -> DataFrame:
    """Positions with the rentals that cover them as an array of structs; uncovered positions are dropped."""
    pairs = interval_join(pos, rental.withColumnRenamed("id", "rental_id"))
    value = F.struct("rental_id", "user_id", "start_time", "stop_time", "km")
    nested = in_parts(pairs, ["pos_id"], ["rental_id"], value, "rental", F.col("rental_id"), part_rows)
    return nested.join(pos.withColumnRenamed("id", "pos_id"), "pos_id").select(
        F.col("pos_id").alias("id"), *[c for c in pos.columns if c != "id"], "part", "rental")


def sorted_tables(merge: DataFrame, pos: DataFrame, rental: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Globally sorted copies for writing; nothing downstream depends on row order."""
    return merge.orderBy(*S.MERGE_SORT), pos.orderBy(*S.POS_SORT), rental.orderBy(*S.RENTAL_SORT)


def align(merge: DataFrame, pos_gen: DataFrame, columns: list[str]) -> DataFrame:
    """Bring heuristic columns of the generated positions next to the merge rows, by key."""
    side = pos_gen.select("rental_id", F.col("id").alias("pos_id"), *columns)
    return merge.join(side, ["rental_id", "pos_id"]).select(*merge.columns, *columns)
