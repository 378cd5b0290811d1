import math
import random

import numpy as np
import pytest

from trailframe import schemas as S
from trailframe.operators import behavior


def naive(points, width, offset):
    """Windows by hand: (seconds, latitude, longitude, speed) rows in order."""
    out, i, n = [], 0, len(points)
    while i < n:
        w = points[i:i + width]
        if len(w) > 1:
            steps, before = [], 0.0
            for a, b in zip(w, w[1:]):
                dt, dlat, dlon, ds = (b[j] - a[j] for j in range(4))
                turn = (math.atan(dlon / dlat) if dlat else math.copysign(math.pi / 2, dlon) if dlon else 0.0)
                steps.append((dlat / (dt * 1e9), dlon / (dt * 1e9), ds, turn - before))
                before = turn
            row = []
            for values in zip(*steps):
                row += [np.mean(values), max(values), *np.quantile(values, [0.75, 0.5, 0.25]), min(values)]
            out.append(row)
        if i + width >= n:
            break
        i += offset
    return out


def _points(n, seed):
    rng = random.Random(seed)
    t, rows = 0, []
    for _ in range(n):
        t += rng.randint(1, 90)
        rows.append((t, 44 + rng.randint(-3, 3) / 1000, 12 + rng.randint(-3, 3) / 1000, rng.random() * 9))
    return rows


@pytest.mark.parametrize("width, offset", [(12, 6), (5, 5), (4, 3)])
def test_features_equal_a_plain_loop(track, width, offset):
    lengths = [1, 2, 12, 13, 18, 19]
    tracks = {k: _points(n, k) for k, n in enumerate(lengths)}
    df = track([(k, *p) for k, rows in tracks.items() for p in rows])
    got = {}
    for r in behavior.behavior_features(df, ["rental_id"], width, offset).orderBy("rental_id", S.BEHAVIOR_WINDOW_ID).collect():
        got.setdefault(r["rental_id"], []).append([r[f] for f in S.BEHAVIOR_FEATURES])
    for k, rows in tracks.items():
        want = naive(rows, width, offset)
        assert len(got.get(k, [])) == len(want), (k, len(rows))
        if want:
            np.testing.assert_allclose(got[k], want, rtol=1e-6, atol=1e-14)


def test_window_ids_start_at_zero(track):
    df = track([(1, *p) for p in _points(25, 5)])
    ids = [r[0] for r in behavior.behavior_features(df, ["rental_id"]).select(S.BEHAVIOR_WINDOW_ID).orderBy(S.BEHAVIOR_WINDOW_ID).collect()]
    assert ids == [0, 1, 2, 3]


def test_turns(track):
    df = track([(1, 0, 44, 12), (1, 10, 44, 12), (1, 20, 44, 13), (1, 30, 44, 12.5), (1, 40, 45, 13.5)])
    turns = [r["f_delta_r"] for r in behavior.movement_steps(df, ["rental_id"]).collect()]
    np.testing.assert_allclose(sorted(turns), sorted([0, math.pi / 2, -math.pi, math.pi / 4 + math.pi / 2]))


def test_same_instant_gives_zero_rate(track):
    row = behavior.behavior_features(track([(1, 0, 44, 12), (1, 0, 44.1, 12)]), ["rental_id"]).first()
    assert row["f_delta_latitude_mean"] == 0.0


def test_hot_trajectory(track, hot):
    rows = _points(60, 9)
    got = behavior.behavior_features(track([(1, *p) for p in rows]), ["rental_id"]).orderBy(S.BEHAVIOR_WINDOW_ID).collect()
    np.testing.assert_allclose([[r[f] for f in S.BEHAVIOR_FEATURES] for r in got], naive(rows, 12, 6), rtol=1e-6, atol=1e-14)


def test_bad_window(track):
    with pytest.raises(ValueError):
        behavior.behavior_features(track([(1, 0, 44, 12)]), ["rental_id"], 4, 5)
