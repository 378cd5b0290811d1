"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample: ``TRAIN_PER_LANG`` snippets of
``SNIPPET`` bytes per language, at a hashed place of each chosen text. Every byte of every whole text then gets a
distribution over the learned languages; a document's probabilities are the mean over its bytes. Texts are run in windows of
``WINDOW`` bytes, many side by side, so memory doesn't depend on a text's length.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; without labelled rows everything is ``und``;
repeated rows get equal answers; null labels are never learned from; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HIDDEN = 8
WINDOW = 256
SNIPPET = 128
TRAIN_PER_LANG = 400
MAX_LANGS = 200
STEPS = 160
BATCH = 64
RATE = 0.02
SEED = 5
#: Windows that go through the network together.
WIDE = 2048
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
Weights = dict[str, np.ndarray]


GATES = "zrc"  # update, reset, candidate


def squash(x: np.ndarray) -> np.ndarray:
    """Softsign, in place: as good as tanh here and several times cheaper."""
    x /= np.abs(x) + 1
    return x


def slope(u: np.ndarray) -> np.ndarray:
    """Derivative of ``squash`` in terms of its value."""
    v = 1 - np.abs(u)
    return v * v


def fresh(labels: int, rng: np.random.Generator) -> Weights:
    """Per direction and gate: an input table and a recurrent matrix; then the output layer."""
    made = {}
    for d in "fb":
        for g in GATES:
            made[f"x{g}{d}"] = rng.normal(0, 0.3, (256, HIDDEN))
            made[f"h{g}{d}"] = rng.normal(0, 0.3, (HIDDEN, HIDDEN))
        made[f"o{d}"] = rng.normal(0, 0.3, (HIDDEN, labels))
    made["bias"] = np.zeros(labels)
    return {k: v.astype(np.float32) for k, v in made.items()}


def run(w: Weights, d: str, x: np.ndarray, size: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, rows, hidden) of direction ``d`` over bytes ``x`` (steps, rows), of which each row has ``size`` real ones.

    States stay zero over the padding, so the backward direction begins at a row's last byte whatever it is padded to.
    """
    steps, rows = x.shape
    shortest = int(size.min(initial=steps))
    h = np.zeros((rows, HIDDEN), dtype=np.float32)
    states = np.empty((steps, rows, HIDDEN), dtype=np.float32)
    tables, inner = [w[f"x{g}{d}"] for g in GATES], [w[f"h{g}{d}"] for g in GATES]
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        seen = x[t]
        u = squash(np.take(tables[0], seen, axis=0) + h @ inner[0])
        v = squash(np.take(tables[1], seen, axis=0) + h @ inner[1])
        z, r = u * 0.5 + 0.5, v * 0.5 + 0.5
        c = squash(np.take(tables[2], seen, axis=0) + (r * h) @ inner[2])
        if keep is not None:
            keep.append((t, h, u, v, z, r, c))
        h = np.add(h, z * (c - h), out=states[t])
        if t >= shortest:
            h[size <= t] = 0
    return states


def posteriors(w: Weights, x: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """(steps, rows, labels) probabilities of every byte of ``x`` (steps, rows); without ``size`` all bytes are real."""
    size = np.full(x.shape[1], x.shape[0]) if size is None else size
    logits = run(w, "f", x, size).reshape(-1, HIDDEN) @ w["of"]
    logits += run(w, "b", x, size).reshape(-1, HIDDEN) @ w["ob"]
    logits += w["bias"]
    np.clip(logits, -40, 40, out=logits)
    np.exp(logits, out=logits)
    logits /= logits @ np.ones((logits.shape[1], 1), dtype=np.float32)
    return logits.reshape(*x.shape, -1)


def _gradients(w: Weights, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> Weights:
    """Backpropagation through time over bytes ``x`` (steps, rows)."""
    kept: dict[str, list] = {"f": [], "b": []}
    states = {d: run(w, d, x, mask.sum(axis=0), kept[d]) for d in "fb"}
    e = np.exp(np.clip(states["f"] @ w["of"] + states["b"] @ w["ob"] + w["bias"], -40, 40))
    delta = e / e.sum(axis=2, keepdims=True)
    delta[:, np.arange(len(y)), y] -= 1
    delta *= mask[:, :, None] / max(1.0, float(mask.sum()))
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["bias"] = delta.sum(axis=(0, 1))
    for d in "fb":
        grad[f"o{d}"] = np.tensordot(states[d], delta, axes=((0, 1), (0, 1)))
        back = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
        for t, h, u, v, z, r, c in reversed(kept[d]):
            dh = (delta[t] @ w[f"o{d}"].T + back) * mask[t][:, None]
            dc = dh * z * slope(c)
            dz = dh * (c - h) * 0.5 * slope(u)
            through = dc @ w[f"hc{d}"].T
            dr = through * h * 0.5 * slope(v)
            grad[f"hz{d}"] += h.T @ dz
            grad[f"hr{d}"] += h.T @ dr
            grad[f"hc{d}"] += (r * h).T @ dc
            for g, part in zip(GATES, (dz, dr, dc), strict=True):
                np.add.at(grad[f"x{g}{d}"], x[t], part)
            back = dh * (1 - z) + through * r + dz @ w[f"hz{d}"].T + dr @ w[f"hr{d}"].T
    return grad


def train(snippets: list[bytes], y: np.ndarray, labels: int) -> Weights:
    """Adam on the mean cross-entropy of all bytes."""
    rng = np.random.default_rng(SEED)
    x = np.zeros((len(snippets), SNIPPET), dtype=np.uint8)
    mask = np.zeros(x.shape, dtype=np.float32)
    for i, s in enumerate(snippets):
        x[i, : len(s)] = np.frombuffer(s, dtype=np.uint8)
        mask[i, : len(s)] = 1
    x, mask = np.ascontiguousarray(x.T), np.ascontiguousarray(mask.T)
    w = fresh(labels, rng)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        rows = rng.choice(len(y), min(BATCH, len(y)), replace=False)
        grad = _gradients(w, x[:, rows], y[rows], mask[:, rows])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grad.values())))
        rate = RATE * (1 - 0.9 * step / STEPS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for name, g in grad.items():
            g = g / max(1.0, norm)
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.999 * second[name] + 0.001 * g * g
            w[name] = (w[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return w


def windows(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of at most ``WIDE`` windows: bytes, valid lengths, place of the text."""
    xs, sizes, places, held = [], [], [], 0
    for i, data in enumerate(raw):
        for at in range(0, len(data), WINDOW * WIDE):
            piece = data[at:at + WINDOW * WIDE]
            n = -(-len(piece) // WINDOW)
            xs.append(np.frombuffer(piece.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW))
            size = np.full(n, WINDOW)
            size[-1] = len(piece) - (n - 1) * WINDOW
            sizes.append(size)
            places.append(np.full(n, i))
            held += n
            if held >= WIDE:
                yield np.concatenate(xs), np.concatenate(sizes), np.concatenate(places)
                xs, sizes, places, held = [], [], [], 0
    if held:
        yield np.concatenate(xs), np.concatenate(sizes), np.concatenate(places)


def pooled(w: Weights, raw: list[bytes], labels: int) -> np.ndarray:
    """Mean probabilities of each text's bytes."""
    sums, counts = np.zeros((len(raw), labels)), np.zeros(len(raw))
    for x, size, place in windows(raw):
        by_length = np.argsort(size, kind="stable")
        for k in range(0, len(x), WIDE):
            some = by_length[k:k + WIDE]
            longest = int(size[some].max())
            p = posteriors(w, np.ascontiguousarray(x[some, :longest].T), size[some])
            p *= (np.arange(longest)[:, None] < size[some])[:, :, None]
            np.add.at(sums, place[some], p.sum(axis=0))
            np.add.at(counts, place[some], size[some])
    return sums / np.maximum(counts, 1)[:, None]


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame) -> DataFrame:
    """At most ``TRAIN_PER_LANG`` snippets per language, chosen and cut by hash, never from held-out rows.

    The rows of a language are first thinned to a few times that number, by its row count, so few rows meet in one task.
    """
    able = docs.filter(~held_out() & F.col("lang").isNotNull())
    counts = able.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    every = F.lit(1).cast("long")
    for r in counts:
        every = F.when(F.col("lang") == r["lang"], F.lit(max(1, r["n"] // (4 * TRAIN_PER_LANG))).cast("long")).otherwise(every)
    size = F.greatest(F.length("text") - SNIPPET, F.lit(0)) + 1
    at = (F.pmod(F.xxhash64("doc_id", "text"), size) + 1).cast("int")
    rows = able.filter(F.col("text").rlike(r"\p{L}")).withColumn("__h", F.xxhash64("text", "doc_id")).filter(
        F.pmod(F.col("__h"), every) == 0).select("lang", F.substring(F.col("text"), at, F.lit(SNIPPET)).alias("snippet"), F.col("__h").alias("h"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "snippet"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= TRAIN_PER_LANG).select("lang", "snippet", "h")


def fit(docs: DataFrame) -> tuple[list[str], Weights | None]:
    """Languages and weights learned from a bounded sample."""
    rows = sorted((r["lang"], r["h"], r["snippet"]) for r in training_rows(docs).limit(TRAIN_PER_LANG * MAX_LANGS).collect())
    langs = sorted({r[0] for r in rows})
    if not langs:
        return [], None
    snippets = [r[2].encode("utf-8", "replace")[:SNIPPET] for r in rows]
    return langs, train(snippets, np.array([langs.index(r[0]) for r in rows]), len(langs))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    langs, weights = fit(docs)
    if weights is None:
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            raw = [t.encode("utf-8", "replace") if t is not None and LETTER.search(t) else b"" for t in batch]
            p = pooled(weights, raw, len(langs))
            known = np.array([len(r) > 0 for r in raw], dtype=bool)
            best = p.argmax(axis=1) if len(raw) else np.empty(0, dtype=int)
            yield pd.DataFrame({"lang_pred": [langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
                                "score": np.clip(np.where(known, p.max(axis=1, initial=0.0), 0.0), 0.0, 1.0)})

    return docs.select("doc_id", held_out().alias("held_out"), predict("text").alias("__p")).select(
        "doc_id", "held_out", "__p.lang_pred", "__p.score")
