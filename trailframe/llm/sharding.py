"""Sharding by vector bin packing: bytes, tokens and rows balanced together; law ``bytes``.

Equal texts form a group that is placed as one item with a vector (bytes, tokens, rows). Items are dealt into cells of about
``CELL_ITEMS`` by hash; every cell packs its items, largest first, into all shards, each where the dot product of its vector with
the shard's residual capacity in that cell is highest among the shards that still have room for its bytes. Items above ``LARGE`` of a
cell's shard are placed before, on levels of 1, ``FAN``, ``FAN`` squared ... cells: a level takes the items that are too large for the
next one's cells, at most 3 * FAN * SHARDS / LARGE of them in a cell, so no task grows with the table. Every cell fills its part of
what earlier levels left of each shard, beginning with another shard where several are equal. Cells are independent tasks. Only a group
larger than a quarter of a shard (a third of all rows may be copies of one text) is first split, into pieces by a hash of its rows' numbers.

Slots number the rows of a shard without gaps: rows are numbered inside each (shard, bucket), a bucket being a hash of the row's
number, and shifted by the counts of the buckets before, so no shard is sorted as a whole.

Defined cases: a null text has no bytes, no tokens and a checksum of zero; repeated rows are rows of their own; null and
repeated ids are placed like others; an empty table gives no rows. Other columns are ignored by ``assign`` and
kept by ``assign_documents``.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailframe.llm.common import whole, word_count
from trailframe.session import materialize

SHARDS = 40
#: Bytes that every row takes besides its text.
ROW_BYTES = 16
CELL_ITEMS = 8192
#: A group larger than this part of a shard is split.
PIECE = 0.25
#: An item larger than this part of a cell's shard is placed on an earlier level, of fewer cells.
LARGE = 0.5
#: Cells of a level for each cell of the level before.
FAN = 32
NAMES = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, shards: int = SHARDS, room: np.ndarray | None = None, capacity: np.ndarray | None = None,
         turn: int = 0) -> np.ndarray:
    """Shard of each item; ``items`` has one row of (bytes, tokens, rows) each.

    ``capacity`` is that of a whole shard (by default the items fill all), ``room`` the free part of each shard in these units;
    equal shards are taken from ``turn`` on.
    """
    capacity = np.maximum(items.sum(axis=0) / shards if capacity is None else capacity, 1e-9)
    need = items / capacity
    residual = np.ones((shards, items.shape[1])) if room is None else room
    residual = np.roll(residual, -turn, axis=0)
    out = np.empty(len(items), dtype=np.int64)
    for k in np.argsort(-items[:, 0], kind="stable"):
        score = residual @ need[k]
        tight = residual[:, 0] < need[k, 0]
        if tight.all():  # nowhere fits: the shard with most room in bytes
            s = int(residual[:, 0].argmax())
        else:
            score[tight] = -np.inf
            s = int(score.argmax())
        residual[s] -= need[k]
        out[k] = (s + turn) % shards
    return out


PACKED = "group string, piece int, cell int, shard long"


def _packer(room: np.ndarray | None, capacity: np.ndarray | None):
    def packed(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["bytes", "group", "piece"], ascending=[False, True, True])
        items, turn = cell[list(NAMES)].to_numpy(dtype=float), abs(int(cell["cell"].iloc[0])) % SHARDS
        return cell[["group", "piece", "cell"]].assign(shard=pack(items, SHARDS, room, capacity, turn))

    return packed


def _pack(items: DataFrame, cells: int, total: np.ndarray) -> DataFrame:
    """(group, piece, cell, shard) of every item; cells are numbered from -1 downwards on the levels before the last."""
    levels = [cells]
    while levels[0] > 1:
        levels.insert(0, math.ceil(levels[0] / FAN))
    whole_shard = np.maximum(total / SHARDS, 1e-9)
    hashed = F.xxhash64("group", "piece")
    cell, offset = F.pmod(hashed, F.lit(cells)).cast("int"), -1
    for count, following in reversed(list(zip(levels[:-1], levels[1:], strict=True))):
        large = F.lit(False)
        for name, size in zip(NAMES, total, strict=True):
            large = large | (F.col(name) > max(1.0, LARGE * size / (following * SHARDS)))
        cell = F.when(large, offset - F.pmod(hashed, F.lit(count)).cast("int")).otherwise(cell)
        offset -= count
    if len(levels) == 1:
        return items.withColumn("cell", cell).groupBy("cell").applyInPandas(_packer(None, None), PACKED)
    items, placed = materialize(items.withColumn("cell", cell), "shard-weights"), []
    used, high = np.zeros((SHARDS, len(NAMES))), offset + 1
    for count in levels[:-1]:
        room = np.maximum(1 - used / whole_shard, 0.0)
        own = items.filter(F.col("cell").between(high, high + count - 1))
        placed.append(materialize(own.groupBy("cell").applyInPandas(_packer(room, whole_shard / count), PACKED), "shard-large"))
        high += count
        for row in own.join(placed[-1].drop("cell"), ["group", "piece"]).groupBy("shard").agg(
                *[F.sum(x).alias(x) for x in NAMES]).collect():  # at most one row per shard
            used[row["shard"]] += [row[x] for x in NAMES]
    left = np.maximum(total / SHARDS - used, 0.0)
    mean = left.mean(axis=0)
    room = np.where(mean > 0, left / np.maximum(mean, 1e-9), 1.0)
    last = items.filter("cell >= 0").groupBy("cell").applyInPandas(_packer(room, None), PACKED)
    return reduce(DataFrame.unionByName, [*placed, last])


def assign(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = whole(F.col("text"))
    rows = materialize(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"), word_count(F.col("text")).alias("tokens"),
        F.sha2(text, 256).alias("group")), "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens"))
    total = groups.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("rows"), F.sum("tokens")).first()
    cells, buckets = (max(1, math.ceil((n or 0) / CELL_ITEMS)) for n in (total[0], total[2]))
    share = lambda x: max(1.0, PIECE * float(x or 0) / SHARDS)
    pieces = F.ceil(F.greatest(F.col("bytes") / share(total[1]), F.col("rows") / share(total[2])))
    split = groups.filter(F.col("rows") > 1).select("group", F.least(pieces, F.col("rows")).alias("pieces")).filter("pieces > 1")
    piece = F.coalesce(F.pmod(F.xxhash64("row"), F.col("pieces")), F.lit(0)).cast("int")
    placed = rows.join(split, "group", "left").withColumn("piece", piece).drop("pieces")
    items = placed.groupBy("group", "piece").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sums = np.array([total[1] or 0, total[3] or 0, total[2] or 0], dtype=float)
    packed = materialize(_pack(items, cells, sums), "shard-items")
    numbered = materialize(placed.join(packed, ["group", "piece"]).drop("group", "piece", "tokens", "cell")
                           .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")).drop("row"), "shard-dealt")
    counts = numbered.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", before.alias("before"))
    within = F.row_number().over(W.partitionBy("shard", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32"))
    return numbered.withColumn("within", within).join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("within") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def assign_documents(docs: DataFrame) -> DataFrame:
    """The shard table of a pipeline's last stage."""
    return assign(docs)
