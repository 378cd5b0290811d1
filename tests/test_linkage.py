import numpy as np
import pandas as pd
import pytest

from trailframe.operators import linkage


def brute(x, weights):
    """Heights of the tree that always merges the nearest pair."""
    centres, n, heights = x.copy(), weights.astype(float), []
    alive = np.ones(len(x), bool)
    gaps = ((x[:, None] - x[None]) ** 2).sum(-1) * (2 * n[:, None] * n[None] / (n[:, None] + n[None]))
    np.fill_diagonal(gaps, np.inf)
    group = np.arange(len(x))
    cuts = {}
    for left in range(len(x), 1, -1):
        cuts[left] = group.copy() if left <= 20 else None
        a, b = sorted(np.unravel_index(np.argmin(gaps), gaps.shape))
        heights.append(np.sqrt(gaps[a, b]))
        centres[a] = (centres[a] * n[a] + centres[b] * n[b]) / (n[a] + n[b])
        n[a] += n[b]
        alive[b] = False
        group[group == group[b]] = group[a]
        row = ((centres - centres[a]) ** 2).sum(-1) * (2 * n * n[a] / (n + n[a]))
        row[~alive] = np.inf
        row[a] = np.inf
        gaps[a], gaps[:, a], gaps[b], gaps[:, b] = row, row, np.inf, np.inf
    return np.sort(heights), cuts


@pytest.fixture(scope="module")
def spread():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (900, 2)), rng.uniform(-8, 8, (700, 2)), rng.normal((3, 3), 0.05, (400, 2))])
    return pd.DataFrame(np.round(x, 6), columns=["a", "b"])


def test_tree_equals_brute_force(spark, spread):
    heavy = pd.concat([spread, spread.iloc[:300], spread.iloc[:100]])
    points = linkage.ward_points(spark.createDataFrame(heavy), ["a", "b"])
    p = points.orderBy("id").toPandas()
    assert len(p) == len(spread.drop_duplicates()) and p["n"].sum() == len(heavy)
    want, cuts = brute(p[["x0", "x1"]].to_numpy(), p["n"].to_numpy())
    tree = linkage.ward_tree(points).toPandas()
    np.testing.assert_allclose(np.sort(tree["distance"]), want, rtol=1e-9)
    assert tree["size"].max() == len(heavy) and tree["child"].is_unique and tree["round"].max() < 60
    labels = linkage.ward_labels(spark.createDataFrame(heavy), ["a", "b"], 7).toPandas()
    got = labels.drop_duplicates(["a", "b"]).merge(p.assign(group=cuts[7]), left_on=["a", "b"], right_on=["x0", "x1"])
    assert len(labels) == len(heavy) and len(got) == len(p)
    assert got.groupby("cluster_id")["group"].nunique().eq(1).all() and got.groupby("group")["cluster_id"].nunique().eq(1).all()
    assert set(labels["cluster_id"]) == set(range(7))


def test_ties_nulls_and_small_tables(spark):
    grid = [(float(i), float(j)) for i in range(4) for j in range(4)]
    df = spark.createDataFrame([*grid, (None, 1.0)], "a double, b double")
    tree = linkage.ward_tree(linkage.ward_points(df, ["a", "b"]))
    assert tree.count() == 15 and tree.where("size = 16").count() == 1
    assert linkage.ward_labels(df, ["a", "b"], 3).where("cluster_id is null").count() == 1
    for rows in ([], [(1.0, 2.0)] * 5):
        few = spark.createDataFrame(rows, "a double, b double")
        assert linkage.ward_tree(linkage.ward_points(few, ["a", "b"])).count() == 0
        assert linkage.ward_labels(few, ["a", "b"], 2).count() == len(rows)
