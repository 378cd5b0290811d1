"""Hard-negative mining by a secondary-sort shuffle.

Every anchor meets every row, in blocks: ``BLOCK_ANCHORS`` anchors at most are sent to the tasks that scan the table, and each task scores its
batches against them as exact integers. A pair that can matter is packed into one binary key (anchor, descending score, kind, id) whose byte
order is its sort order. ``repartitionAndSortWithinPartitions`` brings the keys of an anchor together in that order, and an iterator
streams over them: a positive opens a score window, a negative inside its open window is emitted, and a window closes when it is served.
It holds the windows of one anchor and nothing else.

Two such shuffles are made, the first for the positives, the second with their windows. In front of each, a task keeps what it alone can decide:
its first rows of an anchor's label, or its first negatives of each window, ties included. That loses nothing, as the first rows
of the table are among the first of the parts, and it bounds the keys of an anchor by the number of scan tasks, which ``ROW_GROUPS`` bounds.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; so do rows of another length than the
anchor's, for that anchor. Rows with a null id are never anchors, come last among ties and are reported with a null id. Rows that share
the anchor's id aren't its positives or negatives; anchors that repeat in id, label and vector are one anchor, those that differ are mined one by one.
Anchors without a positive, and windows without a negative, give no rows. Scores beyond 64 bits are held at the ends of the range. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe.session import materialize

BLOCK_ANCHORS = 4096
#: Tasks that scan the table for one block of anchors.
ROW_GROUPS = 64
#: Scores that a task holds at once.
CELLS = 1 << 20
#: Kind of a positive; a negative of its w-th window has kind w + 1, so a positive comes before what its window may hold.
POSITIVE = 0
TOP = (1 << 63) - 1
#: Anchor, TOP - score, kind, whether the id is null, id + 2^63; big-endian, so that bytes sort like the numbers.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("null", "u1"), ("id", ">u8")])
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Rows:
    """Some rows of one vector length."""

    ids: np.ndarray
    null: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, width: int) -> Rows:
        ids = table.column("id")
        flat = table.column("x").combine_chunks() if isinstance(table, pa.Table) else table.column("x")
        flat = flat.flatten().to_numpy(zero_copy_only=False)
        return cls(ids.fill_null(0).to_numpy().astype(np.int64), np.asarray(ids.is_null()).astype(np.uint8),
                   table.column("label").to_numpy().astype(np.int64), flat.astype(np.int64).reshape(table.num_rows, width))

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at: np.ndarray | slice) -> Rows:
        return Rows(self.ids[at], self.null[at], self.labels[at], self.x[at])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, one row per row of ``a``."""
    left, right = a.astype(np.float64), b.astype(np.float64)
    if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, a.shape[1]) < 2.0**53:
        return (left @ right.T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -TOP, TOP).astype(np.int64)


class First:
    """The first ``k`` entries of each group by descending score and ascending id, over any number of additions."""

    def __init__(self, groups: int, k: int) -> None:
        self.k, self.floor = k, np.full(groups, -TOP - 1, dtype=np.int64)
        self.group, self.score, self.null, self.id = (np.empty(0, dtype=np.int64) for _ in range(4))

    def add(self, group: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        every = [np.concatenate(pair) for pair in ((self.group, group), (self.score, score), (self.null, null), (self.id, ids))]
        order = np.lexsort((every[3], every[2], -1 - every[1], every[0]))  # -1 - score has no overflow
        g, s = every[0][order], every[1][order]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        self.floor[g[rank == self.k - 1]] = s[rank == self.k - 1]
        self.group, self.score, self.null, self.id = (part[order[rank < self.k]] for part in every)

    def keys(self, anchor: np.ndarray, kind: np.ndarray | int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(packed(anchor, self.score, kind, self.null, self.id), type=pa.binary())], names=["key"])


def packed(anchor: np.ndarray, score: np.ndarray, kind: np.ndarray | int, null: np.ndarray, ids: np.ndarray) -> list[bytes]:
    out = np.empty(len(score), dtype=KEY)
    out["anchor"], out["kind"], out["null"] = anchor, kind, null
    out["score"] = np.uint64(TOP) - score.astype(np.uint64)  # wraps round below zero as it should
    out["id"] = ids.astype(np.uint64) + np.uint64(1 << 63)
    raw, size = out.tobytes(), KEY.itemsize
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def unpacked(key: bytes) -> tuple[int, int, int, int | None]:
    """Anchor, score, kind and id of a key."""
    number = lambda a, b: int.from_bytes(key[a:b], "big")
    return number(0, 8), TOP - number(8, 16), key[16], None if key[17] else number(18, 26) - (1 << 63)


def narrowed(score: np.ndarray, keep: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the kept entries that can be among the ``k`` largest of their row, ties included."""
    some = np.nonzero(keep.any(axis=1))[0]
    if not len(some):
        return some, some
    keep = keep[some]
    if score.shape[1] > k:
        masked = np.where(keep, score[some], -TOP - 1)
        keep &= masked >= np.partition(masked, -k, axis=1)[:, -k][:, None]
    row, column = np.nonzero(keep)
    return some[row], column


@dataclass
class Block:
    """A bounded number of anchors of one vector length, numbered from ``base``; per anchor its positives' scores."""

    base: int
    anchors: Rows
    windows: np.ndarray | None = None

    def slices(self, rows: Rows) -> Iterator[Rows]:
        step = max(1, CELLS // max(1, len(self.anchors)))
        for at in range(0, len(rows), step):
            yield rows.take(slice(at, at + step))

    def positives(self, batches: Iterator[pa.RecordBatch], k: int) -> First:
        best = First(len(self.anchors), k)
        for batch in batches:
            rows = Rows.of(batch, self.anchors.x.shape[1])
            for label in np.unique(rows.labels):
                own = np.nonzero(self.anchors.labels == label)[0]
                if not len(own):
                    continue
                for part in self.slices(rows.take(rows.labels == label)):
                    score = products(self.anchors.x[own], part.x)
                    keep = score >= best.floor[own][:, None]
                    keep &= (self.anchors.ids[own][:, None] != part.ids) | (part.null == 1)
                    a, b = narrowed(score, keep, k)
                    best.add(own[a], score[a, b], part.null[b], part.ids[b])
        return best

    def negatives(self, batches: Iterator[pa.RecordBatch], k: int, low: int, high: int) -> First:
        n, most = self.windows.shape
        best = First(n * most, k)
        ends = [[(1, 0) if s is None else (-(-low * s // 100), high * s // 100) for s in row] for row in self.windows.tolist()]
        lower, upper = np.moveaxis(np.array(ends, dtype=np.int64).reshape(n, most, 2), 2, 0)
        for batch in batches:
            for part in self.slices(Rows.of(batch, self.anchors.x.shape[1])):
                score = products(self.anchors.x, part.x)
                other = self.anchors.labels[:, None] != part.labels
                other &= (self.anchors.ids[:, None] != part.ids) | (part.null == 1)
                for w in range(most):
                    group = np.arange(n) * most + w
                    floor = np.maximum(lower[:, w], best.floor[group])
                    a, b = narrowed(score, other & (score <= upper[:, w][:, None]) & (score >= floor[:, None]), k)
                    best.add(group[a], score[a, b], part.null[b], part.ids[b])
        return best


def _sorted(keys: DataFrame, stream):
    """Secondary sort: the keys of an anchor come together in key order and are streamed through ``stream``."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (keys.rdd.map(lambda row: (bytes(row[0]), None))
            .repartitionAndSortWithinPartitions(parts, lambda key: int.from_bytes(key[:8], "big"))
            .mapPartitions(lambda pairs: stream(unpacked(key) for key, _ in pairs)))


def first_of_anchor(keys: Iterator[tuple], k: int) -> Iterator[tuple[int, int, int | None]]:
    """(anchor, score, id) of the first ``k`` keys of every anchor."""
    at, seen = None, 0
    for anchor, score, _, i in keys:
        at, seen = anchor, (seen + 1 if anchor == at else 1)
        if seen <= k:
            yield anchor, score, i


def open_windows(keys: Iterator[tuple], k: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) of the first ``k`` negatives of every window."""
    at, windows = None, []
    for anchor, score, kind, i in keys:
        if anchor != at:
            at, windows = anchor, []
        if kind == POSITIVE:
            windows.append([score, i, 0])
            continue
        window = windows[kind - 1]
        if window[2] < k and low * window[0] <= 100 * score <= high * window[0]:
            window[2] += 1
            yield anchor, window[1], window[2], i, window[0], score


def _blocks(anchors: DataFrame) -> Iterator[tuple[int, int, Rows]]:
    """(vector length, first number, anchors) of blocks of about ``BLOCK_ANCHORS`` anchors."""
    base = 0
    for width, n in sorted(tuple(r) for r in anchors.groupBy("width").count().collect()):
        count = math.ceil(n / BLOCK_ANCHORS)
        for k in range(count):
            rows = Rows.of(anchors.filter((F.col("width") == width) & (F.pmod(F.col("mark"), F.lit(count)) == k)).select("id", "label", "x").toArrow(), width)
            if len(rows):
                yield width, base, rows
                base += len(rows)


def mine(rows: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of the rows where ``anchor`` holds; ``rows`` has id, label and x (an array of longs).

    For each of an anchor's first ``n_positives`` other rows of its label, the first ``n_negatives`` rows of other labels whose score is
    between ``low`` and ``high`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    usable = rows.filter("label is not null and x is not null and not exists(x, v -> v is null)").select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("x").cast("array<long>").alias("x"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    anchors = materialize(usable.filter("anchor and id is not null").select("id", "label", "x").distinct().select(
        "*", F.size("x").alias("width"), F.xxhash64("id", "label", "x").alias("mark")), "anchors")
    found = []
    for width, base, own in _blocks(anchors):
        scanned = usable.filter(F.size("x") == width).select("id", "label", "x").coalesce(ROW_GROUPS)
        block = Block(base, own)

        def first_pass(batches, block=block):
            best = block.positives(batches, n_positives)
            yield best.keys(block.base + best.group, POSITIVE)

        positives = _sorted(scanned.mapInArrow(first_pass, "key binary"), lambda keys: first_of_anchor(keys, n_positives)).collect()
        windows = np.full((len(own), n_positives), None, dtype=object)  # at most n_positives rows an anchor of the block
        used = [0] * len(own)
        for a, score, _ in positives:
            windows[a - base, used[a - base]] = score
            used[a - base] += 1
        block = Block(base, own, windows)

        def second_pass(batches, block=block):
            best = block.negatives(batches, n_negatives, low, high)
            yield best.keys(block.base + best.group // n_positives, 1 + best.group % n_positives)

        opened = [packed(np.array([a]), np.array([s]), POSITIVE, np.array([i is None]), np.array([i or 0])) for a, s, i in positives]
        opened = spark.createDataFrame([(bytearray(key[0]),) for key in opened], "key binary")
        keys = scanned.mapInArrow(second_pass, "key binary").unionByName(opened)
        name = {base + i: int(x) for i, x in enumerate(own.ids)}
        found.append(_sorted(keys, lambda keys: open_windows(keys, n_negatives, low, high))
                     .map(lambda r, name=name: (name[r[0]], *r[1:])))
    return spark.createDataFrame(spark.sparkContext.union(found) if found else [], FOUND)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every fiftieth vector, with some labels shifted as if they were wrong."""
    fine = "embedding is not null and not exists(embedding, v -> v is null or isnan(v) or abs(v) = double('infinity'))"
    rows = embeddings.filter(fine).select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda v: F.floor(F.lit(256.0) * v.cast("double"))).alias("x"))
    return mine(rows, F.col("id") % 50 == 0)


ORACLE = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
