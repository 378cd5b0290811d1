"""Benchmark decontamination by latent semantic retrieval.

Texts become lower-case words. The vocabulary is that of the benchmark; document frequencies are counted over all documents. A
distributed randomised SVD of TF-IDF passages gives ``RANK`` latent directions: every task multiplies its passages with the test
matrix and returns partial sums per term, Spark adds them, and the driver only orthonormalises a (vocabulary x ``SKETCH``) matrix. It is
fitted on the benchmark and on all passages of all documents. Every text becomes word numbers once; they are written, so that statistics,
both iterations and the search of ``leaks`` read them instead of the texts.

Every passage of ``PASSAGE`` words (one every ``STEP``) of every whole text is compared by cosine with all items that verification could
accept in that text, those of whose words the text holds a share of ``PARAPHRASE``. Candidates at or above
``MIN_COSINE`` are verified on the words around the passage by the longest common subsequence with the item: ``COPY`` of the item's words
is a copy; ``PARAPHRASE`` of them is a paraphrase if the answer (the item's last sentence; the rarest third of its words if it has one
sentence only) is there too, by ``ANSWER`` of its words.

An exact retrieval adds what falls below the cosine. A text can hold a share of a sequence only if it holds one of its rarest words,
one more than may be missing; every passage of texts with such a word of an item or of its answer is a candidate for that item. So
whatever verification accepts at any passage is a candidate, whatever the latent directions. Before verification the item's words around
all passages of a text are counted at once, and passages with too few are put aside.
Items under ``MIN_ITEM_WORDS`` words count only where they stand word for word.

The benchmark is handled in blocks of about ``BLOCK_ITEMS`` items, each small enough to be sent to every task, so its size is not
limited; searches keep no list of limited length.

Defined cases: null, blank and short texts match nothing unless they hold an item; blank items are ignored; equal items are
reported one by one; repeated rows report alike; null ids are kept; an empty table gives no rows. ``keep_clean`` keeps all columns.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailframe.session import materialize

BLOCK_ITEMS = 2000
PASSAGE, STEP = 32, 16
RANK, SKETCH = 128, 144
#: Passages multiplied at once, words whose passages are made at once, and bytes of texts whose words are numbered at once.
GROUP_ROWS, GROUP_WORDS, GROUP_BYTES = 256, 1_000_000, 4_000_000
MIN_COSINE = 0.5
#: Words that more than this share of the documents hold carry no weight, unless an item has no others.
COMMON = 0.1
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
#: Items with fewer words say too little to be searched for in parts: they must stand word for word.
MIN_ITEM_WORDS = 5
SEED = 6
UPPER_AND_MARKS = bytes(
    c + 32 if 65 <= c <= 90 else (32 if c < 128 and not chr(c).isalnum() else c) for c in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def separated(text: str | None) -> bytes:
    """Lower-case (A-Z) words between spaces, which stand for ASCII marks."""
    return (text or "").encode("utf-8", "replace").translate(UPPER_AND_MARKS)


def tokens(text: str) -> list[bytes]:
    """Lower-case (A-Z) words; ASCII marks separate them."""
    return separated(text).split()


@dataclass
class Block:
    """Items of one block in word numbers of its vocabulary."""

    names: list[str]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[str, str]]) -> Block:
        names, words, answers, vocabulary = [], [], [], {}
        for name, text in rows:
            found = tokens(text or "")
            if not found:
                continue
            number = lambda ws: np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws], dtype=np.int64)
            names.append(name)
            words.append(number(found))
            ends = [s for s in SENTENCE.split(text) if tokens(s)]
            answers.append(number(tokens(ends[-1])))
        return cls(names, words, answers, vocabulary)

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """``numbers`` of some ``separated`` texts, as 32-bit integers."""
        pieces = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ")
        empty = len(self.vocabulary)
        found = pc.index_in(pieces.values, pa.array([*self.vocabulary, b""], pa.large_binary())).fill_null(-1).to_numpy()
        words = found != empty
        ends = np.append(0, np.cumsum(words))[pieces.offsets.to_numpy()].tolist()
        found = found[words]
        return [found[a:b].tobytes() for a, b in pairwise(ends)]

    def numbers(self, text: str | None) -> np.ndarray:
        """Vocabulary number of each word, -1 outside."""
        found = tokens(text) if text else []
        return np.fromiter(map(self.vocabulary.get, found, repeat(-1)), dtype=np.int64, count=len(found))


def starts(n: int) -> np.ndarray:
    return np.arange(0, max(1, n - PASSAGE + STEP), STEP)


def embedded(numbers: np.ndarray, table: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Sum of the term rows of every passage; ``heavy`` marks the words that count, its last entry stands for -1."""
    known = np.nonzero(heavy[numbers])[0]
    sums = np.zeros((len(known) + 1, table.shape[1]), dtype=np.float32)
    np.cumsum(table[numbers[known]], axis=0, out=sums[1:])
    begin = starts(len(numbers))
    return sums[np.searchsorted(known, begin + PASSAGE)] - sums[np.searchsorted(known, begin)]


def lcs(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, with one machine word per item in bit-parallel form."""
    places: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for x in text.tolist():
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def run_at(item: np.ndarray, text: np.ndarray) -> bool:
    """Whether the item stands in the text word for word."""
    places = np.nonzero(text[:max(0, len(text) - len(item) + 1)] == item[0])[0]
    return any(np.array_equal(text[p:p + len(item)], item) for p in places.tolist())


def occurrences(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's words of the vocabulary, their numbers, and where each stood last (far before the text: nowhere)."""
    at = np.nonzero(numbers >= 0)[0]
    words, before = numbers[at], np.full(len(at), -(1 << 62))
    order = np.argsort(words, kind="stable")
    same = np.nonzero(words[order[1:]] == words[order[:-1]])[0]
    before[order[same + 1]] = at[order[same]]
    return at, words, before


def rarest(words: np.ndarray, share: float, seen: np.ndarray) -> set[int]:
    """Words of which any text with ``share`` of ``words`` holds one: as many of the rarest as may be missing, and one more."""
    spare = len(words) - math.ceil(share * len(words) - 1e-9)
    return set(words[np.argsort(seen[words], kind="stable")[:spare + 1]].tolist())


def key_words(words: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The rarest third of an item's words, in their order."""
    return words[np.sort(np.argsort(seen[words], kind="stable")[:math.ceil(len(words) / 3)])]


def numbered(docs: DataFrame, block: Block, *kept: str) -> DataFrame:
    """``kept`` columns and the word numbers of every text, as 32-bit integers, written once."""

    @F.pandas_udf("binary")
    def numbers(texts: pd.Series) -> pd.Series:
        out, some, size = [], [], 0
        for text in texts:
            some.append(separated(text))
            size += len(some[-1])
            if size >= GROUP_BYTES:
                out += block.packed(some)
                some, size = [], 0
        return pd.Series(out + block.packed(some), dtype=object)

    return materialize(docs.select(*kept, numbers("text").alias("numbers")), "numbers")


def unpacked(numbers: bytes) -> np.ndarray:
    return np.frombuffer(numbers, dtype=np.int32).astype(np.int64)


def document_frequencies(texts: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and the number of documents, over all rows of ``numbered``."""
    size = len(block.vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(size + 1, dtype=np.int64), 0
        own = np.zeros(size + 1, dtype=bool)
        for batch in batches:
            for packed in batch["numbers"]:
                own[:] = False
                own[unpacked(packed)] = True
                seen += own
            n += len(batch)
        seen[-1] = n
        at = np.nonzero(seen)[0]
        yield pd.DataFrame({"term": at, "n": seen[at]})

    out = np.zeros(size + 1, dtype=np.int64)
    for row in texts.select("numbers").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]  # at most one row per benchmark word
    return out[:-1], int(out[-1])


def term_weights(block: Block, seen: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency of each term; 0 for common ones."""
    idf = np.log((n + 1) / (seen + 1)) + 0.05
    common = seen > COMMON * n
    for words in block.words:
        if common[words].all():
            common[words] = False
    return np.where(common, 0.0, idf)


def passage_rows(texts: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors of all passages of some texts: first entry of each, and the term and value of every entry."""
    lengths = np.array([len(t) for t in texts])
    begin = np.cumsum(lengths) - lengths
    passages = np.maximum(1, -(-(lengths - PASSAGE + STEP) // STEP))
    base = np.cumsum(passages) - passages
    flat = np.concatenate(texts)
    heavy = np.nonzero(np.append(idf > 0, False)[flat])[0]
    text = np.searchsorted(begin, heavy, "right") - 1
    step = (heavy - begin[text]) // STEP
    inside, later = step < passages[text], step > 0  # a word stands in the passage that starts at its step and in the one before
    row = np.concatenate([(base[text] + step)[inside], (base[text] + step - 1)[later]])
    term = np.concatenate([flat[heavy[inside]], flat[heavy[later]]])
    entry, tf = np.unique(row * len(idf) + term, return_counts=True)
    row, term = np.divmod(entry, len(idf))
    first = np.nonzero(np.diff(row, prepend=-1))[0]
    value = tf * idf[term]
    if len(first):
        norms = np.sqrt(np.add.reduceat(value * value, first))
        value = value / np.repeat(np.maximum(norms, 1e-12), np.diff(first, append=len(row)))
    return first, term, value


def add_gram(out: np.ndarray, rows: tuple[np.ndarray, np.ndarray, np.ndarray], q: np.ndarray) -> None:
    """Add A'A q over the rows of A, ``GROUP_ROWS`` at a time as a dense matrix over the terms they hold."""
    first, term, value = rows
    ends, total = np.append(first, len(term)), np.zeros_like(q)
    row = np.repeat(np.arange(len(first)), np.diff(ends))
    some, column = np.zeros(len(q), dtype=bool), np.zeros(len(q), dtype=np.int64)
    for at in range(0, len(first), GROUP_ROWS):
        bounds = ends[at:at + GROUP_ROWS + 1]
        part = slice(bounds[0], bounds[-1])
        some[term[part]] = True
        held = np.nonzero(some)[0]
        some[held], column[held] = False, np.arange(len(held))
        a = np.zeros((len(bounds) - 1, len(held)), dtype=q.dtype)
        a[row[part] - at, column[term[part]]] = value[part]
        total[held] += a.T @ (a @ q[held])
    out += total


def latent_directions(texts: DataFrame, block: Block, idf: np.ndarray) -> np.ndarray:
    """(vocabulary x rank) orthonormal right singular vectors, by subspace iteration over all passages of rows of ``numbered``."""
    size = len(block.vocabulary)
    width = min(SKETCH, size)
    q = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, width)))[0]
    for _ in range(2):

        def part(batches: Iterator[pd.DataFrame], q: np.ndarray = q.astype(np.float32)) -> Iterator[pd.DataFrame]:
            y = np.zeros((size, width))
            for batch in batches:
                found, words = [], 0
                for numbers in map(unpacked, batch["numbers"]):
                    if len(numbers):
                        found.append(numbers)
                        words += len(numbers)
                    if words >= GROUP_WORDS:
                        add_gram(y, passage_rows(found, idf), q)
                        found, words = [], 0
                if found:
                    add_gram(y, passage_rows(found, idf), q)
            at = np.nonzero(y.any(axis=1))[0]
            yield pd.DataFrame({"term": at, **{f"y{j}": y[at, j] for j in range(width)}})

        schema = "term long, " + ", ".join(f"y{j} double" for j in range(width))
        summed = texts.select("numbers").mapInPandas(part, schema).groupBy("term").agg(
            *[F.sum(f"y{j}").alias(f"y{j}") for j in range(width)])
        y = np.zeros((size, width))
        for words in block.words:  # an item is one row, however long
            term, tf = np.unique(words, return_counts=True)
            value = tf * idf[term]
            value = value / max(float(np.linalg.norm(value)), 1e-12)
            y[term] += value[:, None] * (value @ q[term])
        for row in summed.collect():  # at most one row per benchmark word
            y[row["term"]] += np.array(row[1:])
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        q = np.linalg.qr(y @ turn[:, ::-1])[0]
    return q[:, :min(RANK, width)]


class Searcher:
    """Finds the items of one block in a text."""

    def __init__(self, block: Block, idf: np.ndarray, directions: np.ndarray, seen: np.ndarray) -> None:
        self.block = block
        self.table = (idf[:, None] * directions).astype(np.float32)
        self.heavy = np.append(idf > 0, False)
        vectors = np.stack([self.table[w].sum(axis=0) for w in block.words])
        self.items = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        self.answers = [a if len(a) < len(w) else key_words(w, seen) for a, w in zip(block.answers, block.words, strict=True)]
        self.posts: dict[int, list[int]] = {}
        for k, words in enumerate(block.words):
            either = rarest(words, PARAPHRASE, seen), rarest(self.answers[k], ANSWER, seen)  # a paraphrase has to hold both
            for x in rarest(words, COPY, seen) | min(either, key=lambda ws: seen[list(ws)].sum()):
                self.posts.setdefault(x, []).append(k)
        self.posted = np.zeros(len(block.vocabulary) + 1, dtype=bool)
        self.posted[list(self.posts)] = True
        self.own = np.zeros(len(block.vocabulary) + 1, dtype=bool)
        self.distinct = [np.unique(w, return_counts=True) for w in block.words]
        self.times = np.zeros(len(block.vocabulary) + 1, dtype=np.int64)
        self.flat = np.concatenate(block.words)
        sizes = np.array([len(w) for w in block.words])
        self.first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.need = np.ceil(PARAPHRASE * sizes - 1e-9).astype(np.int64)

    def possible(self, numbers: np.ndarray) -> np.ndarray:
        """Items of whose words the text as a whole holds as many as verification asks for."""
        self.own[numbers] = True
        self.own[-1] = False
        held = np.add.reduceat(self.own[self.flat], self.first, dtype=np.int64)
        self.own[numbers] = False
        return np.nonzero(held >= self.need)[0]

    def rare(self, numbers: np.ndarray) -> set[int]:
        """Items of which the text holds one of the words that it must hold."""
        return {k for x in set(numbers[self.posted[numbers]].tolist()) for k in self.posts[x]}

    def held(self, k: int, at: np.ndarray, words: np.ndarray, before: np.ndarray, passages: int) -> np.ndarray:
        """How many of an item's words stand around each passage of a text with these ``occurrences``."""
        own, counts = self.distinct[k]
        self.times[own] = counts
        times = self.times[words]
        self.times[own] = 0
        of, n = np.nonzero(times)[0], len(self.block.words[k])
        at, times = at[of], times[of]
        # a place is the first of its word around the passages that begin in (max(before, at - n - PASSAGE), at + n]
        since = np.maximum(np.maximum(before[of], at - 2 * n - PASSAGE) + n, -1) // STEP + 1
        until = (at + n) // STEP + 1
        first, past = (np.bincount(np.minimum(p, passages), times, passages + 1) for p in (since, until))
        return np.cumsum(first - past)[:-1]

    def __call__(self, text: str | None) -> list[dict]:
        return self.search(self.block.numbers(text))

    def search(self, numbers: np.ndarray) -> list[dict]:
        if not len(numbers):
            return []
        possible = self.possible(numbers)
        if not len(possible):
            return []
        z = embedded(numbers, self.table, self.heavy)
        close = (z @ self.items[possible].T) >= MIN_COSINE * np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]
        begin, best, rare = starts(len(numbers)), {}, self.rare(numbers)
        found = occurrences(numbers)
        for column, k in enumerate(possible.tolist()):
            if k in rare or close[:, column].any():
                enough = self.held(k, *found, len(begin)) >= self.need[k]
                close[:, column] = enough if k in rare else enough & close[:, column]
        for p, column in zip(*np.nonzero(close), strict=True):
            k = int(possible[column])
            item, answer, at = self.block.words[k], self.answers[k], int(begin[p])
            around = numbers[max(0, at - len(item)):at + PASSAGE + len(item)]
            if len(item) < MIN_ITEM_WORDS and not run_at(item, around):
                continue
            around = around[around >= 0]
            score = lcs(item, around) / len(item)
            if score < PARAPHRASE or (score < COPY and lcs(answer, around) < ANSWER * len(answer)):
                continue
            if k not in best or score > best[k]["score"]:
                best[k] = {"item": self.block.names[k], "score": score, "copied": score >= COPY, "word": at}
        return list(best.values())


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of bounded size."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text is not null")
    n = max(1, math.ceil(items.count() / BLOCK_ITEMS))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        block = Block.of(sorted(((r["item"], r["text"]) for r in rows), key=lambda r: (r[0] or "", r[1])))
        if block.names:
            yield block


def searchers(docs: DataFrame, benchmark: DataFrame, *kept: str) -> Iterator[tuple[Searcher, DataFrame]]:
    """A searcher for each block, with the word numbers of all texts in that block's vocabulary."""
    for block in blocks(benchmark):
        texts = numbered(docs, block, *kept)
        seen, n = document_frequencies(texts, block)
        idf = term_weights(block, seen, n)
        yield Searcher(block, idf, latent_directions(texts, block, idf), seen), texts


LEAKS = "array<struct<item string, score double, copied boolean, word int>>"


def _udf(search: Searcher):
    @F.pandas_udf(LEAKS)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([search(t) for t in texts], dtype=object)

    return found


def _numbers_udf(search: Searcher):
    @F.pandas_udf(LEAKS)
    def found(numbers: pd.Series) -> pd.Series:
        return pd.Series([search.search(unpacked(n)) for n in numbers], dtype=object)

    return found


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, copied, near_word) of every benchmark item found in a document."""
    kind = benchmark.schema["item_id"].dataType
    parts = [texts.select("doc_id", F.explode(_numbers_udf(s)("numbers")).alias("x")) for s, texts in searchers(docs, benchmark, "doc_id")]
    if not parts:
        parts = [docs.select("doc_id", F.explode(F.array().cast(LEAKS)).alias("x"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", F.col("x.item").cast(kind).alias("item_id"), F.round("x.score", 6).alias("score"),
                      "x.copied", F.col("x.word").alias("near_word"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found, all columns kept."""
    for search, _ in searchers(docs, benchmark):
        docs = docs.filter(F.size(_udf(search)("text")) == 0)
    return docs
