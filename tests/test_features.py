import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trailframe.operators import cluster, plotdata, prep, profile, quality, regress


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0, 0], [6, 0, 1], [0, 7, 2]])
    x = np.vstack([c + rng.normal(size=(n, 3)) for c, n in zip(centres, (60, 40, 30))])
    return pd.DataFrame({"id": range(len(x)), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "flat": 5.0})


@pytest.fixture
def df(spark, blobs):
    return spark.createDataFrame(blobs)


ABC = ["a", "b", "c"]


def _matrix(df, names):
    return df.orderBy("id").select(*names).toPandas().to_numpy()


def test_scalers(df, blobs):
    x = blobs[[*ABC, "flat"]].to_numpy()
    std = np.where(x.std(axis=0) == 0, 1, x.std(axis=0))
    np.testing.assert_allclose(_matrix(prep.standardize(df, [*ABC, "flat"]), [*ABC, "flat"]), (x - x.mean(axis=0)) / std, atol=1e-12)
    span = np.where(np.ptp(x, axis=0) == 0, 1, np.ptp(x, axis=0))
    np.testing.assert_allclose(_matrix(prep.min_max(df, [*ABC, "flat"]), [*ABC, "flat"]), (x - x.min(axis=0)) / span, atol=1e-12)
    np.testing.assert_allclose(_matrix(prep.unit_norm(df, ABC), ABC), x[:, :3] / np.linalg.norm(x[:, :3], axis=1)[:, None], atol=1e-12)


def test_zero_row_keeps_zero(spark):
    assert prep.unit_norm(spark.createDataFrame([(0.0, 0.0)], "a double, b double"), ["a", "b"]).first() == (0.0, 0.0)


def test_components(df, blobs):
    x = blobs[ABC].to_numpy()
    _, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    vt = np.array([v * np.sign(v[np.argmax(np.abs(v))]) for v in vt])
    out, names = prep.project(df, ABC, 2)
    np.testing.assert_allclose(_matrix(out, names), (x - x.mean(axis=0)) @ vt[:2].T, atol=1e-9)
    share = s ** 2 / (s ** 2).sum()
    np.testing.assert_allclose(prep.fit_components(prep.Moments.of(df, ABC)).variance, share, atol=1e-9)


def test_component_count(df):
    curve = [r["cumulative"] for r in prep.variance_curve(df, ABC).orderBy("component").collect()]
    want = next(i for i, c in enumerate(curve, 1) if c > 0.8)
    moments = prep.Moments.of(df, ABC)
    assert prep.component_count(moments) == want and prep.component_count(moments, True) == max(want - 1, 1)


def test_preparation_reads_its_input_once(df, spark):
    """All scalers and components follow from one aggregate."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("prepare", "prepare")
    prep.preprocess(df, ABC, standardization=True, normalization=True, pca=True, components=[["a", "b"], ["c"]])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("prepare")) <= 3


def test_describe_equals_pandas(df, blobs):
    got = {r["column"]: r for r in profile.describe(df, ABC).collect()}
    want = blobs[ABC].describe()
    for c in ABC:
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert abs(got[c][mine] - want[c][theirs]) < 1e-12


def test_correlation(df, blobs):
    got = {(r["x"], r["y"]): r["correlation"] for r in profile.correlation_matrix(df, ABC).collect()}
    want = blobs[ABC].corr().round(2)
    assert all(abs(got[(a, b)] - want.loc[a, b]) < 1e-9 for a in ABC for b in ABC)


def test_lloyd(df, blobs):
    x = blobs[["a", "b"]].to_numpy()
    centres = x[[0, 70, 110]]
    for _ in range(4):
        label = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.array([x[label == i].mean(axis=0) for i in range(3)])
    np.testing.assert_allclose(cluster.lloyd(df, ["a", "b"], [tuple(x[i]) for i in (0, 70, 110)], 4), centres, atol=1e-9)


def test_elbow_falls(df):
    wcss = [r["wcss"] for r in cluster.elbow(df, ABC, range(1, 5)).orderBy("k").collect()]
    assert wcss[0] > wcss[1] > wcss[2] and wcss[3] <= wcss[2] * 1.01


def test_bandwidth(df, blobs):
    x = blobs[ABC].to_numpy()
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)
    want = d[:, int(len(x) * 0.2) - 1].mean()
    assert abs(cluster.bandwidth_estimate(df, ABC, ["id"], 500).first()[0] - want) < 1e-9


def test_mean_shift_equals_brute_force(df, blobs):
    x, h = blobs[["a", "b"]].to_numpy(), 2.5
    found = {}
    for c in {tuple(v) for v in np.round(x / h) * h}:
        c = np.array(c)
        for _ in range(301):
            near = x[np.linalg.norm(x - c, axis=1) <= h]
            if not len(near):
                break
            old, c = c, near.mean(axis=0)
            if np.linalg.norm(c - old) <= 1e-3 * h:
                break
        if len(near):
            found[tuple(c)] = len(near)
    kept = []
    for c, _ in sorted(found.items(), key=lambda e: (e[1], e[0]), reverse=True):
        if all(np.linalg.norm(np.subtract(c, k)) > h for k in kept):
            kept.append(c)
    np.testing.assert_allclose(sorted(cluster.mean_shift_centres(df, ["a", "b"], h)), sorted(kept), atol=1e-9)
    labelled = cluster.mean_shift(df, ["a", "b"], h)
    assert labelled.select("cluster_id").distinct().count() == len(kept)


def test_strongest_centres_in_rounds(spark):
    """5000 centres: what greedy suppression keeps, in a number of rounds that doesn't follow theirs."""
    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([rng.uniform(0, 150, (4500, 2)), rng.uniform(0, 5, (500, 2))]), 6)
    hits = rng.integers(1, 50, len(x))
    df = spark.createDataFrame([(int(h), float(a), float(b)) for h, (a, b) in zip(hits, x)], "hits long, c0 double, c1 double")
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    got = cluster.strongest(df, ["c0", "c1"], 1.5).collect()
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before < 150
    kept = []
    for h, a, b in sorted(zip(hits, x[:, 0], x[:, 1]), reverse=True):
        if all((a - p) ** 2 + (b - q) ** 2 > 1.5**2 for _, p, q in kept):
            kept.append((h, a, b))
    assert sorted(map(tuple, got)) == sorted(kept) and len(kept) > 2000


def test_mean_shift_labels_by_cells(df, monkeypatch):
    few = cluster.mean_shift(df, ["a", "b"], 0.7).select("id", "cluster_id").toPandas().set_index("id")
    monkeypatch.setattr(cluster, "FEW_CENTRES", 0)
    many = cluster.mean_shift(df, ["a", "b"], 0.7).select("id", "cluster_id").toPandas().set_index("id")
    assert len(few) == len(many) and few["cluster_id"].nunique() > 5
    assert (few["cluster_id"] == many["cluster_id"].reindex(few.index)).all()


def test_mean_shift_needs_a_bandwidth_and_settles(df):
    with pytest.raises(ValueError):
        cluster.cluster(df, ABC, "mean-shift", 3)
    with pytest.raises(RuntimeError):
        cluster.mean_shift_centres(df, ["a", "b"], 2.5, max_shifts=0)


def _naive_tree(x, k, linkage):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                a, b = x[groups[i]], x[groups[j]]
                if linkage == "ward":
                    d = 2 * len(a) * len(b) / (len(a) + len(b)) * ((a.mean(axis=0) - b.mean(axis=0)) ** 2).sum()
                else:
                    d = ((a[:, None] - b[None]) ** 2).sum(-1).max()
                if best is None or d < best[0]:
                    best = (d, i, j)
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("linkage", ["ward", "complete"])
def test_agglomerative_is_exact_on_few_points(spark, blobs, linkage):
    few = blobs.iloc[::4].reset_index(drop=True)
    few["id"] = range(len(few))
    out = cluster.agglomerative(spark.createDataFrame(few), ABC, 3, linkage)
    got = out.select("id", "cluster_id").toPandas().groupby("cluster_id").id.apply(frozenset)
    assert set(got) == _naive_tree(few[ABC].to_numpy(), 3, linkage)


def test_agglomerative_condenses_many_points(df):
    out = cluster.agglomerative(df, ABC, 3, "ward", m=20)
    assert out.count() == 130 and out.select("cluster_id").distinct().count() == 3
    steps = cluster.linkage_table(df, ABC, "ward", m=20).orderBy("step").collect()
    assert steps[-1]["size"] == 130 and all(a["distance"] <= b["distance"] + 1e-9 for a, b in zip(steps, steps[1:]))


@pytest.mark.parametrize("method", ["k-means", "gaussian-mixture"])
def test_library_methods_find_the_blobs(df, method):
    out = cluster.cluster(df, ABC, method, 3)
    assert out.select("cluster_id").distinct().count() == 3
    assert quality.silhouette(out, ABC).first()["silhouette"] > 0.4


def test_unknown_method(df):
    with pytest.raises(ValueError):
        cluster.cluster(df, ABC, "magic", 3)


def test_silhouette(df, blobs):
    x, label = blobs[ABC].to_numpy(), np.array([0] * 60 + [1] * 69 + [2])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][label == o].mean() for o in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    out = df.withColumn("cluster_id", F.when(F.col("id") < 60, 0).when(F.col("id") < 129, 1).otherwise(2))
    assert abs(quality.silhouette(out, ABC).first()["silhouette"] - np.mean(scores)) < 1e-9


def test_silhouette_of_one_cluster(df):
    assert quality.silhouette(df.withColumn("cluster_id", F.lit(1)), ABC).first() == (130, 0.0)


def _regression(spark, n=200):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 2)) * [3, 0.5] + [10, -2]
    y = x @ [1.5, -4.0] + 7 + rng.normal(size=n)
    return x, y, spark.createDataFrame(pd.DataFrame({"p": x[:, 0], "q": x[:, 1], "y": y}))


def test_regression_variants_agree(spark):
    x, y, df = _regression(spark)
    want = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    plain = regress.fit_ols(df, ["p", "q"], "y", preprocess=False)
    np.testing.assert_allclose([*plain.coefficients, plain.bias], want, rtol=1e-6)
    exact = regress.fit_exact(df, ["p", "q"], "y")
    np.testing.assert_allclose(exact.coefficients, want[:2] * x.std(axis=0, ddof=1), rtol=1e-9)
    gradient = regress.fit_gradient(df, ["p", "q"], "y")
    assert gradient.iterations > 1
    twice = regress.fit_gradient(df.unionByName(df), ["p", "q"], "y", preprocess=False, rate=1e-3)
    np.testing.assert_allclose(twice.coefficients, np.linalg.solve(x.T @ x, x.T @ y), rtol=1e-6)
    np.testing.assert_allclose(gradient.coefficients, exact.coefficients, rtol=1e-9)
    mse = np.mean((y - np.c_[x, np.ones(len(x))] @ want) ** 2)
    assert abs(exact.mse(df).first()[0] - mse) < 1e-9


def test_origin_fit_uses_mean_residual(spark):
    x, y, df = _regression(spark)
    theta = np.linalg.solve(x.T @ x, x.T @ y)
    fit = regress.fit_exact(df, ["p", "q"], "y", preprocess=False)
    np.testing.assert_allclose([*fit.coefficients, fit.bias], [*theta, y.mean() - theta @ x.mean(axis=0)], rtol=1e-7)


@pytest.mark.parametrize("rate", [10.0, 1e-9])
def test_gradient_descent_that_does_not_settle_fails(spark, rate):
    _, _, df = _regression(spark)
    with pytest.raises(RuntimeError):
        regress.fit_gradient(df, ["p", "q"], "y", rate=rate, max_iterations=5000)


def test_importance(spark):
    fit = regress.Fit(("a", "b", "c"), "y", (-5.0, 0.1, 2.0), 0.0, (0.0,) * 3, (1.0,) * 3)
    got = {r["kind"]: r["feature"] for r in regress.coefficient_importance(fit, spark).collect()}
    assert got == {"min_positive": "b", "max_positive": "c", "min_absolute": "b", "max_absolute": "a"}


def test_importance_without_a_positive_coefficient(spark):
    fit = regress.Fit(("a", "b"), "y", (-1.0, -2.0), 0.0, (0.0,) * 2, (1.0,) * 2)
    got = {r["kind"]: r["feature"] for r in regress.coefficient_importance(fit, spark).collect()}
    assert got == {"min_absolute": "a", "max_absolute": "b"}


def test_probability_points_of_a_repeated_value(spark, hot, monkeypatch):
    monkeypatch.setattr(regress, "RANK_BLOCK", 10)
    df = spark.createDataFrame([(0.0,)] * 95 + [(float(i),) for i in range(1, 5)] + [(None,)], "v double")
    rows = regress.probability_points(df, "v").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 100)) and [r["ordered"] for r in rows] == [0.0] * 95 + [1.0, 2.0, 3.0, 4.0]


def test_probability_points_with_a_large_table(spark, hot):
    df = spark.range(1, 300).select((F.col("id") * 1.0).alias("v"))
    rows = regress.probability_points(df, "v").orderBy("rank").collect()
    assert [r["ordered"] for r in rows] == [float(i) for i in range(1, 300)]
    assert abs(rows[149]["theoretical"]) < 5e-4 and rows[0]["theoretical"] < -2.5


def test_histogram(df, blobs):
    got = {r["bin"]: r["count"] for r in plotdata.histogram(df, ["a"], 10).collect()}
    want, _ = np.histogram(blobs.a, bins=10)
    assert [got.get(i, 0) for i in range(10)] == list(want)


def test_constant_column_histogram(df):
    rows = plotdata.histogram(df, ["flat"], 10).collect()
    assert len(rows) == 1 and rows[0]["count"] == 130 and rows[0]["density"] is None


def test_kernel_density_integrates_to_about_one(df, blobs):
    total = plotdata.kernel_density(df, "a", "b", 40).agg(F.sum("density")).first()[0]
    area = np.ptp(blobs.a) * np.ptp(blobs.b) / 1600
    assert 0.8 < total * area < 1.05


def test_lines_of_clusters_join_once(spark):
    """The labelled rows are stored before they are counted and listed, and lists that fit one part need no window."""
    rows = [(r, p, float(10 * p % 7), float(p), 44.0 + p / 10, 12.0 + r) for r in (1, 2) for p in range(1, 8)]
    prepared = spark.createDataFrame(rows, "rental_id long, pos_id long, server_time double, device_time double, latitude double, longitude double")
    clusters = prepared.select("rental_id", "pos_id", F.lit("all").alias("scope"), F.lit("m").alias("method"),
                               (F.col("pos_id") % 2).cast("int").alias("cluster_id"))
    lines = plotdata.cluster_lines(prepared, clusters, ["rental_id"])
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    got = {(r["rental_id"], r["cluster_id"], r["part"]): [tuple(p) for p in r["points"]] for r in lines.collect()}
    ordered = sorted(rows, key=lambda r: (r[2], r[3], r[1]))
    assert got == {(r, c, 0): [(x[5], x[4]) for x in ordered if x[0] == r and x[1] % 2 == c] for r in (1, 2) for c in (0, 1)}
    short = polylines_of(prepared, 3)
    whole = polylines_of(prepared, 100)
    assert {k: sum((short[k, p] for p in range(3)), []) for k in (1, 2)} == {k: whole[k, 0] for k in (1, 2)}


def polylines_of(df, part_rows):
    lines = plotdata.polylines(df, ["rental_id"], "longitude", "latitude", order=["server_time", "device_time", "pos_id"],
                               split=F.col("server_time"), part_rows=part_rows)
    return {(r["rental_id"], r["part"]): [tuple(p) for p in r["points"]] for r in lines.collect()}
