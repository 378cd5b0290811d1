import random

import pytest
from pyspark.sql import functions as F

from trailframe.llm import negatives


def brute(rows, k=5, m=3, low=50, high=95):
    """From plain loops over (id, label, x)."""
    usable = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for a in {(i, label, tuple(x)) for i, label, x in usable if i is not None and i % 5 == 0}:
        scored = [(sum(p * q for p, q in zip(a[2], x, strict=True)), i is None, i or 0, label) for i, label, x in usable
                  if len(x) == len(a[2]) and i != a[0]]
        scored.sort(key=lambda r: (-r[0], r[1], r[2]))
        for s, no_id, i, _ in [r for r in scored if r[3] == a[1]][:k]:
            fits = [r for r in scored if r[3] != a[1] and low * s <= 100 * r[0] <= high * s][:m]
            out += [(a[0], None if no_id else i, n + 1, None if r[1] else r[2], s, r[0]) for n, r in enumerate(fits)]
    return sorted(out, key=str)


def mined(spark, rows):
    df = spark.createDataFrame(rows, "id long, label int, x array<long>").withColumn("key", F.lit(1)).withColumn("anchor", F.lit("x"))
    return sorted((tuple(r) for r in negatives.mine(df.repartition(3), F.col("id") % 5 == 0).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_ties_and_nulls(spark, seed, monkeypatch):
    """Few different scores, zeros, repeated rows and ids, null ids, labels and entries, two vector lengths, several blocks and slices."""
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 9)
    monkeypatch.setattr(negatives, "CELLS", 40)
    rng = random.Random(seed)
    rows = []
    for _ in range(160):
        width = 3 if rng.random() < 0.9 else 2
        rows.append((rng.choice([None, *range(90)]), rng.choice([0, 0, 0, 1, 2, None]), [rng.randrange(-2, 4) for _ in range(width)]))
    rows += [(5, 0, None), (10, 0, [1, None, 2]), (15, 1, []), (20, 1, []), (25, 2, []), rows[0], rows[1], (30, 0, [0, 0, 0])]
    assert mined(spark, rows) == brute(rows)


def test_large_entries_stay_exact(spark):
    rows = [(0, 1, [1 << 30, 3]), (1, 1, [1 << 30, 5]), (2, 2, [(1 << 29) + 1, 1]), (3, 2, [(1 << 29) + 1, 2])]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_64_bits_are_held(spark):
    rows = [(0, 1, [1 << 62]), (1, 1, [1 << 62]), (2, 2, [1 << 62])]
    assert mined(spark, rows) == []
    assert mined(spark, []) == []


def test_keys_sort_like_numbers():
    import numpy as np

    rng = np.random.default_rng(1)
    score = rng.integers(-negatives.TOP - 1, negatives.TOP, 50)
    ids = rng.integers(-negatives.TOP - 1, negatives.TOP, 50)
    keys = negatives.packed(rng.integers(0, 3, 50), score, rng.integers(0, 2, 50), np.zeros(50), ids)
    assert [negatives.unpacked(k)[1] for k in keys] == score.tolist() and [negatives.unpacked(k)[3] for k in keys] == ids.tolist()
    assert sorted(keys) == sorted(keys, key=lambda k: (lambda a, s, kind, i: (a, -s, kind, i))(*negatives.unpacked(k)))


def test_query_drops_unusable_vectors(spark):
    rows = [(0, 1, [0.5, 0.5]), (7, 0, [0.5, 0.5]), (1, 1, [0.5, 0.4]), (2, 3, [0.25, 0.25]), (3, 4, [float("nan"), 1.0]), (4, 4, [float("inf"), 1.0]),
            (5, None, [0.3, 0.3]), (6, 2, None), (8, 2, [None, 0.3]), (9, 5, [0.31, 0.3])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"]) for r in negatives.hard_negatives(df).collect()}
    # 0 and 7 are divisible by 7, so their labels become 2 and 1; label 2 has no other usable row
    assert got == set()
    df = spark.createDataFrame([(50, 1, [0.5, 0.5]), *rows], "vec_id long, label int, embedding array<float>")
    got = {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"]) for r in negatives.hard_negatives(df).collect()}
    assert got == {(50, 7, 1, 9), (50, 7, 2, 2), (50, 1, 1, 9), (50, 1, 2, 2)}
