"""Line deduplication by winnowing over line hashes.

A text is cut into units: lines, sentences, and inside them short pieces whose borders depend on the words alone (after a word with a certain
hash, one word in ``PIECE_WORDS`` on average). So whatever two texts share is cut the same way wherever it stands, also in mid-sentence or in a text
without any punctuation. From every unit starts a gram, the shortest run of units with at least ``GRAM_WORDS`` words. In every window of gram starts
within ``WINDOW_WORDS`` words the gram with the smallest hash (the last of equal ones) is a fingerprint. A shared passage whose whole units hold
``WINDOW_WORDS + GRAM_WORDS`` words plus one unit has a common fingerprint for certain.

Every fingerprint keeps its first position (smallest row key, then place); each later one is joined to it and the match is extended
both ways, unit by unit. One window's length of context is enough: a longer match has fingerprints of its own further on.
Units of later runs are deleted; the first occurrence stays. Positions are never paired among themselves, so a passage in a third
of all texts costs one row per occurrence.

Words are hashed by prefix sums over the bytes of the text, units by prefix sums over their words, so no loop runs over words.

Defined cases: null texts stay null and blank ones as they are; texts with fewer than ``GRAM_WORDS`` words are never touched; doc_id
orders the texts, then a hash of the text, and rows with a null doc_id come last; rows equal in doc_id and text are one text and are cut equally; an
empty table gives no rows. Other columns are kept by ``cut``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailframe.session import materialize

GRAM_WORDS = 16
WINDOW_WORDS = 16
#: Context of a fingerprint on either side: a window, and a gram because units are whole.
REACH_WORDS = WINDOW_WORDS + GRAM_WORDS
PIECE_WORDS = 8
#: Texts are hashed together up to so many bytes; in the word count, one stands so many words after the other.
GROUP_BYTES, APART = 1 << 18, 1 << 20
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
STOPS = np.zeros(256, dtype=bool)
STOPS[[33, 46, 63]] = True
#: Odd multipliers of the prefix sums and of the mixing steps. Fixed values.
BYTE_FACTOR, WORD_FACTOR = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX = np.uint64(0xFF51AFD7ED558CCD)


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, made longer when a text needs it."""

    def __init__(self, factor: int) -> None:
        self.factors = np.array([factor, pow(factor, -1, 1 << 64)], dtype=np.uint64)
        self.table = np.ones((2, 1), dtype=np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        while self.table.shape[1] < n:
            size = self.table.shape[1]
            step = np.array([[pow(int(f), size, 1 << 64)] for f in self.factors], dtype=np.uint64)
            self.table = np.concatenate((self.table, self.table * step), axis=1)
        return self.table


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX
    return (x ^ (x >> np.uint64(33))) * MIX


def run_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of ``values[begin:end]`` for each pair, equal for equal runs wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * MIX)


BYTES, WORDS = Powers(BYTE_FACTOR), Powers(WORD_FACTOR)


@dataclass
class Units:
    """Units of some texts in a row: hashes, word counts, ends (UTF-8 bytes from the start of the text) and text numbers."""

    hashes: np.ndarray
    words: np.ndarray
    ends: np.ndarray
    text: np.ndarray


def units_of(texts: list[str]) -> Units:
    """Units of all texts at once; white space around a unit doesn't count."""
    parts = [t.encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
    stop = np.cumsum([len(p) + 1 for p in parts]) - 1  # where each text ends
    blank = np.concatenate(([True], BLANKS[raw], [True]))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return Units(np.empty(0, dtype=np.uint64), *[np.empty(0, dtype=np.int64)] * 3)
    words = run_hashes(raw.astype(np.uint64) + np.uint64(1), begin, end, BYTES)
    lines = np.flatnonzero(raw == 10)
    closes = STOPS[raw[end - 1]] | ((words >> np.uint64(40)) % np.uint64(PIECE_WORDS) == 0)
    closes[:-1] |= np.searchsorted(lines, begin[1:]) > np.searchsorted(lines, end[:-1])
    closes[-1] = True
    last = np.flatnonzero(closes)
    first = np.concatenate(([0], last[:-1] + 1))
    text = np.searchsorted(stop, begin[first])
    ends = np.minimum(np.append(begin[first[1:]], len(raw)), stop[text])  # the blanks after a unit belong to it
    return Units(run_hashes(words, first, last + 1, WORDS), last + 1 - first, ends - (stop[text] - np.array([len(p) for p in parts])[text]), text)


def units(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, word counts and ends of the units of one text."""
    found = units_of([text])
    return found.hashes, found.words, found.ends


def winnow(found: Units) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints: place, length, and units of context on both sides (four rows), and hashes. Places count over all texts."""
    ends = np.cumsum(found.words) + found.text * APART
    starts = ends - found.words
    last = np.searchsorted(ends, starts + GRAM_WORDS)
    real = np.flatnonzero(last < len(ends))
    real = real[found.text[last[real]] == found.text[real]]
    if not len(real):
        return np.empty((4, 0), dtype=np.int64), np.empty(0, dtype=np.int64)
    grams = run_hashes(found.hashes, real, last[real] + 1, WORDS)
    place = starts[real]
    reach = np.searchsorted(place, place + WINDOW_WORDS)
    best, row = np.arange(len(real)), np.arange(len(real))
    for step in range(1, int((reach - row).max())):
        other = row + step
        inside = np.flatnonzero(other < reach)
        smaller = inside[grams[other[inside]] <= grams[best[inside]]]
        best[smaller] = other[smaller]
    chosen = np.unique(best)
    at, to = real[chosen], last[real[chosen]] + 1
    low = np.searchsorted(found.text, found.text[at])
    left = at - np.maximum(low, np.searchsorted(starts, starts[at] - REACH_WORDS) - 1)
    right = np.searchsorted(starts, ends[to - 1] + REACH_WORDS, side="right") - to
    return np.stack([at, to - at, left, right]), grams[chosen].view(np.int64)


def short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each unit hash, enough to extend a match by."""
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


SCANNED = ["id", "mark", "units", "place", "gram"]


def packed(places: np.ndarray) -> np.ndarray:
    """Place, length and context in one number that sorts by place; none but the place reaches 64, as every unit has a word."""
    return ((places[0] << 6 | places[1]) << 6 | places[2]) << 6 | places[3]


def unpack(place: str) -> dict[str, Column]:
    field = lambda bits: F.shiftright(place, bits).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return {"at": F.shiftright(place, 18).cast("int"), "size": field(12), "left": field(6), "right": field(0)}


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``GROUP_BYTES``; a longer text is a group of its own."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > GROUP_BYTES:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, marks, texts, rows = batch["id"].tolist(), batch["mark"].tolist(), batch["text"].tolist(), []
        for lo, hi in _groups([len(t) for t in texts]):
            found = units_of(texts[lo:hi])
            places, gram = winnow(found)
            small, numbers = short(found.hashes), np.arange(hi - lo + 1)
            edge, cut_at = np.searchsorted(found.text, numbers), np.searchsorted(found.text[places[0]], numbers)
            for k in np.flatnonzero(np.diff(cut_at)).tolist():
                a, b = cut_at[k], cut_at[k + 1]
                own = places[:, a:b].copy()
                own[0] -= edge[k]
                rows.append((ids[lo + k], marks[lo + k], small[edge[k]:edge[k + 1]], packed(own), gram[a:b]))
        if rows:
            yield pd.DataFrame(rows, columns=SCANNED)


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    other = (a[:n] != b[:n]).argmax() if n else 0
    return int(n if n == 0 or a[other] == b[other] else other)


def _spans(rows: pd.DataFrame) -> pd.DataFrame:
    """Extend the matches of each text and merge them into spans (first unit, unit after the last)."""
    out = []
    for doc_id, mark, own, matches in zip(rows["id"], rows["mark"], rows["units"], rows["matches"], strict=True):
        hit = np.zeros(len(own) + 1, dtype=np.int32)
        for m in matches:
            lo, hi, left, right = m["at"], m["at"] + m["size"], m["before"], m["after"]
            lo -= agreeing(own[max(0, lo - len(left)):lo][::-1], left[::-1])
            hi += agreeing(own[hi:hi + len(right)], right)
            hit[lo] += 1
            hit[hi] -= 1
        inside = np.concatenate(([0], (np.cumsum(hit[:-1]) > 0).astype(np.int8), [0]))
        edge = np.diff(inside)
        out.append((doc_id, mark, np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()))
    return pd.DataFrame(out, columns=["id", "mark", "begin", "end"])


def _extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield _spans(batch)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` in a struct, with the row key (id, mark) that orders the texts; rows without a doc_id come last."""
    return docs.select(F.struct(*docs.columns).alias("all"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                       F.xxhash64("text").alias("mark"))


def spans(docs: DataFrame) -> DataFrame:
    """(id, mark, begin, end): unit spans to delete, by row key."""
    scanned = keyed(docs).filter("all.text is not null").select("id", "mark", "all.text").mapInPandas(
        _scan, "id long, mark long, units array<int>, place array<long>, gram array<long>")
    scanned = materialize(scanned, "winnow")
    each = scanned.select("id", "mark", F.inline(F.arrays_zip("gram", "place")))
    place = F.struct("id", "mark", "place")
    firsts = each.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first")).filter("c > 1").select("gram", "first.*")
    firsts = materialize(firsts, "winnow-first")
    anchors = firsts.groupBy("id", "mark").agg(F.collect_list(F.struct("gram", "place")).alias("list"))  # a text's fingerprints at most
    context = scanned.select("id", "mark", "units").join(anchors, ["id", "mark"]).select("id", "mark", "units", F.inline("list")).withColumns(unpack("place")).select(
        "gram", F.col("id").alias("first_id"), F.col("mark").alias("first_mark"), F.col("place").alias("first_place"),
        F.slice("units", F.col("at") - F.col("left") + 1, F.col("left")).alias("before"),
        F.slice("units", F.col("at") + F.col("size") + 1, F.col("right")).alias("after"))
    context = materialize(context.dropDuplicates(["gram"]), "winnow-context")  # written, so that a skewed gram can be split in the join below
    later = each.join(context, "gram").filter("id <> first_id or mark <> first_mark or place <> first_place").withColumns(unpack("place"))
    matches = later.groupBy("id", "mark").agg(F.collect_set(F.struct("at", "size", "before", "after")).alias("matches"))
    once = scanned.select("id", "mark", "units").dropDuplicates(["id", "mark"])
    return once.join(matches, ["id", "mark"]).mapInPandas(_extend, "id long, mark long, begin array<int>, end array<int>")


def _kept(text: str | None, begin: list | None, end: list | None) -> tuple[str | None, int]:
    """New text and the number of deleted units."""
    if text is None or begin is None or not len(begin):
        return text, 0
    raw = text.encode("utf-8", "replace")
    bounds = np.concatenate(([0], units(text)[2]))
    at = np.concatenate(([0], bounds[np.asarray(end)]))
    to = np.concatenate((bounds[np.asarray(begin)], [len(raw)]))
    return b"".join(raw[a:b] for a, b in zip(at, to, strict=True)).decode("utf-8", "replace"), int(np.sum(np.asarray(end) - np.asarray(begin)))


REWRITTEN = T.StructType([T.StructField("text", T.StringType()), T.StructField("dropped", T.LongType())])


@F.pandas_udf(REWRITTEN)
def _rewrite(texts: pd.Series, begin: pd.Series, end: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_kept(*x) for x in zip(texts, begin, end, strict=True)], columns=["text", "dropped"])


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` with later repeated runs cut from ``text``, plus ``__dropped``; extra columns may have any name."""
    joined = keyed(docs).join(spans(docs), ["id", "mark"], "left")
    hit = joined.withColumn("new", F.when(F.col("begin").isNotNull(), _rewrite("all.text", "begin", "end")))
    return hit.select(*[F.coalesce("new.text", "all.text").alias("text") if c == "text" else F.col(f"all.`{c}`").alias(c) for c in docs.columns],
                      F.coalesce("new.dropped", F.lit(0).cast("long")).alias("__dropped"))


def report(docs: DataFrame) -> DataFrame:
    return cut(docs.select("doc_id", "text")).select(
        "doc_id", "text", F.col("__dropped").alias("n_dropped"))
