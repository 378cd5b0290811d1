"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Equal fingerprints are merged first (a combined minimum), so copies cost one row. Two 64-bit words that differ in at most
three bits agree in at least one of four 16-bit parts; fingerprints that share a part form a cell. Inside a cell they are
sorted by bit count, cut into tiles, and tile pairs are compared with numpy exclusive-or and bit counts; pairs of tiles whose
bit counts lie more than the radius apart are skipped. A cell with more than ``CELL`` fingerprints is split into salted
blocks that are compared two by two in tasks of their own, so no cell limits the whole. Nothing is approximate and no link
between different fingerprints is lost: a cell returns a spanning forest of its links, from which the components follow.

Defined cases: a null, empty or blank text has fingerprint zero and links like any other; a doc_id may repeat (each row gets
its own fingerprint) or be null (ignored as a component id unless nothing else is there); an empty table gives no rows; other
columns are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailframe.llm.components import components
from trailframe.session import materialize

RADIUS = 3
SHINGLE = 3
#: Fingerprints compared in one task, and in one numpy tile.
CELL = 8192
TILE = 512
#: Cells of at most so many fingerprints are compared together, by shifting.
SMALL = 48
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text, as a signed number."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), CHUNK):
        spans = zip(starts[k:k + CHUNK].tolist(), ends[k:k + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    packed = np.packbits(total * 2 > len(starts), bitorder="little")
    return int(packed.view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp), written once."""
    return materialize(docs.select("doc_id", fingerprint_udf("text").alias("fp")), "simhash")


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of a[i] and b[i]; parents always point to smaller places."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _tiles(x: np.ndarray, y: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of close pairs between two arrays sorted by bit count, one tile pair at a time."""
    px, py = np.bitwise_count(x), np.bitwise_count(y)
    for i in range(0, len(x), TILE):
        for j in range(i if same else 0, len(y), TILE):
            ends = int(px[min(i + TILE, len(x)) - 1]), int(py[min(j + TILE, len(y)) - 1])
            if int(py[j]) - ends[0] > RADIUS or int(px[i]) - ends[1] > RADIUS:
                continue
            a, b = np.nonzero(np.bitwise_count(x[i:i + TILE, None] ^ y[None, j:j + TILE]) <= RADIUS)
            yield a + i, b + j


def _large_cell(fp: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(np.bitwise_count(fp), kind="stable")
    fp, side = fp[order], side[order]
    parent = np.arange(len(fp))
    if side.any() and not side.all():
        left, right = np.nonzero(~side)[0], np.nonzero(side)[0]
        for a, b in _tiles(fp[left], fp[right], same=False):
            _join(parent, left[a], right[b])
    else:
        for a, b in _tiles(fp, fp, same=True):
            _join(parent, a, b)
    moved = np.nonzero(parent != np.arange(len(fp)))[0]
    return fp[moved], fp[parent[moved]]


def _links(cell: np.ndarray, fp: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal ``cell``."""
    starts = np.concatenate(([0], np.nonzero(cell[1:] != cell[:-1])[0] + 1, [len(cell)]))
    sizes = np.diff(starts)
    left, right = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    c, f = cell[small], fp[small]
    for d in range(1, min(SMALL, int(sizes[sizes <= SMALL].max(initial=0)))):
        near = (c[d:] == c[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= RADIUS)
        left.append(f[d:][near])
        right.append(f[:-d][near])
    for k in np.nonzero(sizes > SMALL)[0]:
        a, b = _large_cell(fp[starts[k]:starts[k + 1]], side[starts[k]:starts[k + 1]])
        left.append(a)
        right.append(b)
    empty = np.empty(0, dtype=np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of cells that arrive sorted; an unfinished cell waits for the next batch."""
    def out(part: pd.DataFrame) -> pd.DataFrame:
        a, b = _links(part["cell"].to_numpy(), part["fp"].to_numpy().view(np.uint64), part["side"].to_numpy(dtype=bool))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch["cell"].iloc[-1]
        if batch["cell"].iloc[0] == last:
            if rest and rest[-1]["cell"].iloc[-1] != last:
                yield out(pd.concat(rest))
                rest = []
            rest.append(batch)
            continue
        cut = int(np.searchsorted((batch["cell"] == last).to_numpy(), True))
        yield out(pd.concat([*rest, batch.iloc[:cut]]))
        rest = [batch.iloc[cut:]]
    if rest:
        yield out(pd.concat(rest))


def links(distinct: DataFrame) -> DataFrame:
    """A spanning forest (a, b) of all pairs of ``distinct`` fingerprints within the radius."""
    part = lambda k: (F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) + F.lit(k * 65536)).cast("long")
    spread = distinct.select("fp", F.explode(F.array(*[part(k) for k in range(4)])).alias("part"))
    blocks = spread.groupBy("part").count().filter(F.col("count") > CELL).select(
        "part", F.ceil(F.col("count") / CELL).cast("int").alias("blocks"))
    placed = spread.join(blocks, "part", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    cells = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = [F.col("part"), F.least("own", "other").cast("long"), F.greatest("own", "other").cast("long")]
    cells = cells.select((keys[0] * (1 << 44) + keys[1] * (1 << 22) + keys[2]).alias("cell"), "fp",
                         (F.col("own") > F.col("other")).alias("side"))
    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInPandas(_compare, "a long, b long")


def _named(marked: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``marked``."""
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    marked = fingerprints(docs)
    named = _named(marked).select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest doc_id (null last), then text hash."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    marked = materialize(docs.select("doc_id", fingerprint_udf("text").alias("fp"), digest.alias("digest")), "simhash-keyed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("digest"))
    best = marked.groupBy("fp").agg(F.min(order).alias("best")).join(_named(marked).select("fp", "root"), "fp")
    kept = best.groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.id").alias("__id"), F.col("best.digest").alias("__digest"))
    chosen = docs.withColumn("__key", digest).join(
        kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__digest")), "left_semi")
    return chosen.dropDuplicates(["doc_id", "__key"]).drop("__key")
