"""Clustering methods. Every method returns the input rows with an integer ``cluster_id``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.functions.columns import hash_order, sq_distance
from trailframe.operators.ordered import dense_index
from trailframe.operators.prep import preprocess
from trailframe.operators.regions import with_region
from trailframe.session import materialize, scratch_path

LABEL = "cluster_id"
SEED = 42
BANDWIDTH_QUANTILE = 0.2
MAX_SHIFTS = 300
#: Centres that are compared one by one inside the plan.
FEW_CENTRES = 256
#: Points that hierarchical clustering condenses a table to, whatever its size.
MICRO_CLUSTERS = 200
_VECTOR = "_features"


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR).transform(df)


def nearest_centre(features: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre, the lowest index on ties."""
    columns = [F.col(f) for f in features]
    options = [F.struct(sq_distance(columns, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*options))["i"]


# -- k-means ---------------------------------------------------------------
def _kmeans_model(vectors: DataFrame, k: int, seed: int = SEED):
    return KMeans(k=k, seed=seed, initMode="k-means||", featuresCol=_VECTOR, predictionCol=LABEL).fit(vectors)


def kmeans(df: DataFrame, features: Sequence[str], k: int, seed: int = SEED) -> DataFrame:
    if k == 1:
        return df.withColumn(LABEL, F.lit(0))
    vectors = _vectors(df, features)
    return _kmeans_model(vectors.select(_VECTOR), k, seed).transform(vectors).drop(_VECTOR)


def first_centres(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int, seed: int = SEED) -> list[tuple]:
    """A reproducible start: the feature values of the first ``k`` rows in hashed key order."""
    picked = df.select(*features, hash_order(*[F.col(c) for c in keys], seed=seed).alias("_h")).orderBy("_h").limit(k)
    return [tuple(float(r[f]) for f in features) for r in picked.collect()]


def lloyd(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]], iterations: int) -> list[tuple]:
    """Plain k-means updates from given centres. Each step is one map-side combined aggregate over k groups."""
    centres = [tuple(c) for c in centres]
    rows = df.select(*features).persist()
    for _ in range(iterations):
        means = rows.groupBy(nearest_centre(features, centres).alias(LABEL)).agg(*[F.avg(f).alias(f) for f in features])
        moved = {r[LABEL]: tuple(float(r[f]) for f in features) for r in means.collect()}
        updated = [moved.get(i, c) for i, c in enumerate(centres)]
        if updated == centres:
            break
        centres = updated
    rows.unpersist()
    return centres


def elbow(df: DataFrame, features: Sequence[str], ks: Iterable[int], seed: int = SEED) -> DataFrame:
    """(k, wcss): within-cluster sum of squares for every k."""
    vectors = _vectors(df.select(*features), features).persist()
    columns = [F.col(f) for f in features]
    rows = []
    for k in ks:
        if k == 1:
            means = vectors.agg(*[F.avg(f).alias(f) for f in features]).first()
            total = vectors.agg(F.sum(sq_distance(columns, [means[f] for f in features])).alias("w")).first()["w"]
            rows.append((1, float(total)))
        else:
            rows.append((int(k), float(_kmeans_model(vectors.select(_VECTOR), k, seed).summary.trainingCost)))
    vectors.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, wcss double")


# -- Gaussian mixture --------------------------------------------------------
def gaussian_mixture(df: DataFrame, features: Sequence[str], k: int, seed: int = SEED, iterations: int = 100,
                     tolerance: float = 1e-3, ridge: float = 1e-6) -> DataFrame:
    """Most likely component of each row, by expectation maximisation from a k-means start.

    A step is one aggregate of weighted moments over all rows; the driver holds the ``k`` means and covariances. It ends
    when the mean log-likelihood gains less than ``tolerance``.
    """
    if k == 1:
        return df.withColumn(LABEL, F.lit(0))
    d, names = len(features), [f"x{i}" for i in range(len(features))]
    vectors = _vectors(df, features)
    model = _kmeans_model(vectors.select(_VECTOR), k, seed)
    rows = model.transform(vectors).select(LABEL, *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)]).persist()
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    start = rows.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(n).alias(n) for n in names],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).orderBy(LABEL).collect()
    weights = np.array([r["n"] for r in start], dtype=float)
    means = np.array([[r[n] for n in names] for r in start])
    covs = np.array([[[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)] for r in start])
    weights, before = weights / weights.sum(), -np.inf
    for _ in range(iterations):
        logs = _log_densities([F.col(n) for n in names], weights, means, covs + ridge * np.eye(d))
        top = F.greatest(*logs)
        packed = rows.select(*names, F.array(*logs).alias("_l"), top.alias("_t"))
        total = F.aggregate("_l", F.lit(0.0), lambda t, v: t + F.exp(v - F.col("_t")))
        shared = packed.select(*names, (F.log(total) + F.col("_t")).alias("_all"), "_l").select(
            *names, "_all", *[F.exp(F.get("_l", F.lit(j)) - F.col("_all")).alias(f"r{j}") for j in range(len(means))])
        away = lambda j, i: F.col(names[i]) - F.lit(float(means[j][i]))
        sums = shared.agg(F.avg("_all").alias("fit"), F.count(F.lit(1)).alias("n"), *[a for j in range(len(means)) for a in (
            F.sum(f"r{j}").alias(f"w{j}"), *[F.sum(F.col(f"r{j}") * away(j, i)).alias(f"m{j}_{i}") for i in range(d)],
            *[F.sum(F.col(f"r{j}") * away(j, i) * away(j, h)).alias(f"s{j}_{i}_{h}") for i, h in pairs])]).first()
        mass = np.maximum([sums[f"w{j}"] for j in range(len(means))], 1e-12)
        shift = np.array([[sums[f"m{j}_{i}"] for i in range(d)] for j in range(len(means))]) / mass[:, None]
        second = np.array([[[sums[f"s{j}_{min(i, h)}_{max(i, h)}"] for h in range(d)] for i in range(d)]
                           for j in range(len(means))]) / mass[:, None, None]
        weights, means, covs = mass / sums["n"], means + shift, second - shift[:, :, None] * shift[:, None, :]
        if sums["fit"] - before < tolerance:
            break
        before = sums["fit"]
    rows.unpersist()
    logs = _log_densities([F.col(f).cast("double") for f in features], weights, means, covs + ridge * np.eye(d))
    best = F.array_max(F.array(*[F.struct(log.alias("l"), F.lit(-j).alias("j")) for j, log in enumerate(logs)]))
    return df.withColumn(LABEL, -best["j"])


def _log_densities(x: list[Column], weights: np.ndarray, means: np.ndarray, covs: np.ndarray) -> list[Column]:
    """Log of weight times normal density of each component, without the shared constant."""
    out = []
    for w, m, c in zip(weights, means, covs):
        white = np.linalg.inv(np.linalg.cholesky(c))
        squares = F.lit(0.0)
        for i in range(len(m)):
            part = reduce(lambda t, j: t + (x[j] - F.lit(float(m[j]))) * F.lit(float(white[i, j])), range(i + 1), F.lit(0.0))
            squares = squares + part * part
        out.append(F.lit(float(np.log(w) + np.log(np.diag(white)).sum())) - squares / 2)
    return out


# -- mean shift --------------------------------------------------------------
def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """A reproducible sample: the first ``n`` rows in hashed key order."""
    return df.withColumn("_h", hash_order(*[F.col(k) for k in keys], seed=seed)).orderBy("_h").limit(n).drop("_h")


def bandwidth_estimate(df: DataFrame, features: Sequence[str], keys: Sequence[str], n_samples: int,
                       quantile: float = BANDWIDTH_QUANTILE, seed: int = SEED) -> DataFrame:
    """One row ``bandwidth``: mean distance of the sampled points to their neighbour at the quantile, self included.

    The sample (at most ``n_samples`` points) travels as one array, so no pairs of rows are produced.
    """
    point = F.array(*[F.col(f).cast("double") for f in features])
    sample = sample_rows(df.select(*keys, *features), keys, n_samples, seed).select(point.alias("p"))
    packed = sample.agg(F.collect_list("p").alias("all"))
    distance = lambda a, b: F.sqrt(F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v))
    rank = F.greatest(F.lit(1), F.floor(F.size("all") * F.lit(float(quantile))).cast("int"))
    reach = F.element_at(F.array_sort(F.transform("all", lambda q: distance(F.col("p"), q))), rank)
    return sample.join(F.broadcast(packed), F.lit(True)).agg(F.avg(reach).alias("bandwidth"))


def _cells(names: Sequence[str], side: float) -> list[Column]:
    return [F.floor(F.col(n) / F.lit(side)).cast("long").alias(f"_cell{i}") for i, n in enumerate(names[:3])]


def _beside(names: Sequence[str], side: float) -> Column:
    """Exploded cells around a point, its own included, with fields as ``_cells`` of the same side has them."""
    own = _cells(names, side)
    return F.explode(F.array(*[
        F.struct(*[(F.floor(F.col(n) / F.lit(side)).cast("long") + o).alias(f"_cell{i}")
                   for i, (n, o) in enumerate(zip(names, offsets))]) for offsets in product((-1, 0, 1), repeat=len(own))]))


def _gap(a: Sequence[str], b: Sequence[str]) -> Column:
    """Squared distance of two points given by column names."""
    return reduce(lambda t, p: t + (F.col(p[0]) - F.col(p[1])) * (F.col(p[0]) - F.col(p[1])), zip(a, b), F.lit(0.0))


def settled_centres(df: DataFrame, features: Sequence[str], bandwidth: float, max_shifts: int = MAX_SHIFTS) -> DataFrame:
    """(hits, c0..): centres of a flat-kernel mean shift from one start per occupied grid cell.

    Starts move in parallel: points meet the starts of their own and neighbouring grid cells by an equality join on the
    cell (the start table is far smaller and is broadcast while Spark's size check allows), and each start becomes the
    mean of the points within the bandwidth. Settled starts leave the loop.
    """
    d = len(features)
    names = [f"x{i}" for i in range(d)]
    points = df.select(*[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    points = points.groupBy(*names).agg(F.count(F.lit(1)).alias("w")).select(*names, "w", *_cells(names, bandwidth)).persist()
    binned = [(F.bround(F.col(n) / F.lit(bandwidth)) * F.lit(bandwidth)).alias(f"c{i}") for i, n in enumerate(names)]
    centre = [f"c{i}" for i in range(d)]
    cells = [f"_cell{i}" for i in range(min(d, 3))]
    moving = materialize(points.select(*binned).distinct(), "starts")
    base = scratch_path(df.sparkSession, "shifts")
    for shift in range(max_shifts + 1):
        around = moving.withColumn("_n", _beside(centre, bandwidth)).select(*centre, "_n.*")
        near = points.join(around, cells).where(_gap(names, centre) <= F.lit(bandwidth * bandwidth))
        means = near.groupBy(*centre).agg(
            F.sum("w").alias("hits"), *[(F.sum(F.col(f"x{i}") * F.col("w")) / F.sum("w")).alias(f"m{i}") for i in range(d)])
        step = reduce(lambda t, i: t + (F.col(f"m{i}") - F.col(f"c{i}")) * (F.col(f"m{i}") - F.col(f"c{i}")), range(d), F.lit(0.0))
        path = f"{base}/shift={shift}"
        means.select(*[F.col(f"m{i}").alias(f"c{i}") for i in range(d)], "hits",
                     (F.sqrt(step) <= F.lit(1e-3 * bandwidth)).alias("still")).write.parquet(path)
        moving = df.sparkSession.read.parquet(path).where(~F.col("still")).select(*centre).distinct()
        if moving.isEmpty():
            break
    else:
        raise RuntimeError(f"mean shift has not settled after {max_shifts} moves")
    points.unpersist()
    settled = df.sparkSession.read.parquet(base).where("still").select("hits", *centre)
    return strongest(materialize(settled.distinct(), "settled"), centre, bandwidth)


def strongest(settled: DataFrame, centre: Sequence[str], bandwidth: float) -> DataFrame:
    """What is left when the strongest centre is kept, all within a bandwidth of it go, and so on.

    Centres without a stronger one within the bandwidth are kept in the same round, and those near a kept one go; that is the
    same as one after the other. Rounds follow the longest chain of ever stronger neighbours, not the number of centres.
    """
    base = scratch_path(settled.sparkSession, "centres")
    cells = [f"_cell{i}" for i in range(min(len(centre), 3))]
    other = [f"_{c}" for c in centre]
    left, number = settled, 0
    while not left.isEmpty():
        around = left.select("hits", *centre, _beside(centre, bandwidth).alias("_at")).select("hits", *centre, "_at.*")
        held = left.select(F.col("hits").alias("_hits"), *[F.col(c).alias(o) for c, o in zip(centre, other)], *_cells(centre, bandwidth))
        near = around.join(held, cells).where(_gap(centre, other) <= F.lit(bandwidth * bandwidth))
        top = near.groupBy("hits", *centre).agg(F.max(F.struct("_hits", *other)).alias("_top"))
        path = f"{base}/round={number}"
        top.where(F.col("_top") == F.struct(F.col("hits").alias("_hits"), *[F.col(c).alias(o) for c, o in zip(centre, other)])).select(
            "hits", *centre).write.parquet(path)
        kept = settled.sparkSession.read.schema(settled.schema).parquet(path)
        taken = kept.select(*[F.col(c).alias(o) for c, o in zip(centre, other)], _beside(centre, bandwidth).alias("_at")).select(*other, "_at.*")
        gone = left.select("hits", *centre, *_cells(centre, bandwidth)).join(taken, cells).where(
            _gap(centre, other) <= F.lit(bandwidth * bandwidth)).select("hits", *centre)
        left = materialize(left.join(gone, ["hits", *centre], "left_anti"), "centres-left")
        number += 1
    if not number:
        return settled
    return settled.sparkSession.read.schema(settled.schema).parquet(base).select("hits", *centre)


def mean_shift_centres(df: DataFrame, features: Sequence[str], bandwidth: float, max_shifts: int = MAX_SHIFTS) -> list[tuple]:
    """The centres of ``settled_centres`` as a list, the strongest first."""
    return _listed(settled_centres(df, features, bandwidth, max_shifts))


def _listed(centres: DataFrame) -> list[tuple]:
    rows = sorted((tuple(r) for r in centres.collect()), reverse=True)
    return [tuple(float(v) for v in r[1:]) for r in rows]


def _nearest_by_cells(df: DataFrame, features: Sequence[str], centres: DataFrame, bandwidth: float) -> DataFrame:
    """Label of the nearest centre by joins on neighbouring cells, whose side doubles for points that have none near enough."""
    names, centre = [f"x{i}" for i in range(len(features))], [c for c in centres.columns if c != "hits"]
    cells = [f"_cell{i}" for i in range(min(len(names), 3))]
    numbered = materialize(dense_index(
        centres.select((-F.col("hits")).alias("hits"), *[(-F.col(c)).alias(c) for c in centre]), ["hits", *centre], "_label",
        F.col("hits").cast("double")).select((F.col("_label") - 1).cast("int").alias(LABEL), *[(-F.col(c)).alias(c) for c in centre]), "labels")
    left = materialize(df.select(*[F.col(f).cast("double").alias(n) for f, n in zip(features, names)]).dropna().distinct(), "points")
    reach = numbered.agg(*[F.max(F.abs(c)).alias(c) for c in centre]).first()
    farthest = left.agg(*[F.max(F.abs(n)).alias(n) for n in names]).first()
    widest = 2 * max([float(v or 0) for v in (*reach, *farthest)]) + bandwidth
    side, found = bandwidth, []
    while True:
        around = left.select(*names, _beside(names, side).alias("_at")).select(*names, "_at.*")
        held = numbered.select(LABEL, *centre, *_cells(centre, side))
        best = around.join(held, cells).groupBy(*names).agg(F.min(F.struct(_gap(names, centre).alias("d"), LABEL)).alias("_b"))
        sure = F.lit(True) if side > widest else F.col("_b.d") < F.lit(side * side * (1 - 1e-9))
        found.append(materialize(best.where(sure).select(*names, F.col(f"_b.{LABEL}").alias(LABEL)), "labelled"))
        left = materialize(left.join(found[-1], names, "left_anti"), "points")
        if side > widest or left.isEmpty():
            break
        side *= 2
    labels = reduce(DataFrame.unionByName, found)
    same = reduce(lambda t, p: t & p, [F.col(f).cast("double") == F.col(n) for f, n in zip(features, names)])
    return df.drop(LABEL).join(labels, same, "left").drop(*names)


def mean_shift(df: DataFrame, features: Sequence[str], bandwidth: float) -> DataFrame:
    """Label of the nearest mean-shift centre; ``bandwidth_estimate`` proposes a bandwidth from a sample.

    A few centres stand in the plan; more are a table that points meet by grid cells, with equal labels.
    """
    if not bandwidth > 0:
        raise ValueError("mean shift needs a positive bandwidth")
    centres = materialize(settled_centres(df, features, float(bandwidth)), "mean-shift")
    if 0 < centres.count() <= FEW_CENTRES:
        return df.withColumn(LABEL, nearest_centre(features, _listed(centres)))
    return _nearest_by_cells(df, features, centres, float(bandwidth))


# -- agglomerative -------------------------------------------------------------
def _micro_clusters(df: DataFrame, features: Sequence[str], m: int, seed: int):
    """Rows tagged with one of at most ``m`` k-means micro-clusters ``_m``, and their centres and row counts."""
    vectors = _vectors(df, features)
    model = _kmeans_model(vectors.select(_VECTOR), m, seed)
    tagged = model.transform(vectors).withColumnRenamed(LABEL, "_m").drop(_VECTOR)
    centres = [tuple(float(v) for v in c) for c in model.clusterCenters()]
    sizes = {r["_m"]: r["n"] for r in tagged.groupBy("_m").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = sorted(sizes)
    return tagged, kept, ([centres[i] for i in kept], np.array([sizes[i] for i in kept], dtype=float))


def merge_steps(centres: Sequence[tuple], sizes: np.ndarray, linkage: str) -> list[tuple]:
    """(a, b, distance, size) per merge of a bounded set of weighted points; merged node ``i`` is numbered ``m + i``."""
    points, n = np.array(centres, dtype=float), np.array(sizes, dtype=float)
    m = len(points)
    plain = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    if linkage == "ward":
        dist = plain * np.sqrt(2 * n[:, None] * n[None, :] / (n[:, None] + n[None, :]))
    else:
        dist = plain
    np.fill_diagonal(dist, np.inf)
    node, steps = list(range(m)), []
    for step in range(m - 1):
        a, b = divmod(int(np.argmin(dist)), m)
        a, b = min(a, b), max(a, b)
        height = float(dist[a, b])
        if linkage == "ward":
            points[a] = (points[a] * n[a] + points[b] * n[b]) / (n[a] + n[b])
        n[a] += n[b]
        alive = np.isfinite(dist[a])
        alive[[a, b]] = False
        if linkage == "ward":
            row = np.sqrt(2 * n[a] * n / (n[a] + n)) * np.sqrt(((points - points[a]) ** 2).sum(-1))
        else:
            row = np.maximum(dist[a], dist[b])
        dist[b, :] = dist[:, b] = np.inf
        dist[a, alive] = dist[alive, a] = row[alive]
        steps.append((node[a], node[b], height, int(n[a])))
        node[a] = m + step
    return steps


def _cut(m: int, steps: Sequence[tuple], k: int) -> list[int]:
    """Cluster number of every summary when ``k`` clusters are left, numbered by first appearance."""
    parent = list(range(m + len(steps)))
    for i, (a, b, _, _) in enumerate(steps[:max(0, m - k)]):
        parent[a] = parent[b] = m + i

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    numbers: dict[int, int] = {}
    return [numbers.setdefault(root(i), len(numbers)) for i in range(m)]


def linkage_table(df: DataFrame, features: Sequence[str], linkage: str, m: int = MICRO_CLUSTERS, seed: int = SEED) -> DataFrame:
    """(step, a, b, distance, size) of the merge tree over the micro-clusters."""
    _, _, summary = _micro_clusters(df, features, m, seed)
    steps = merge_steps(*summary, linkage)
    return df.sparkSession.createDataFrame(
        [(i, int(a), int(b), d, s) for i, (a, b, d, s) in enumerate(steps)], "step int, a int, b int, distance double, size long")


def agglomerative(df: DataFrame, features: Sequence[str], k: int, linkage: str, m: int = MICRO_CLUSTERS,
                  seed: int = SEED) -> DataFrame:
    """Hierarchical clusters of all rows through at most ``m`` micro-clusters.

    Hierarchical merging needs all pairwise distances, which no large table allows, so every table is condensed to
    micro-clusters by k-means and their centres are merged: Ward weights them by their rows, complete linkage takes the
    largest distance between centres. Tables with fewer distinct points keep each of them as a centre.
    """
    tagged, kept, summary = _micro_clusters(df, features, m, seed)
    labels = _cut(len(kept), merge_steps(*summary, linkage), k)
    table = df.sparkSession.createDataFrame(list(zip(kept, labels)), f"_m int, {LABEL} int")
    return tagged.join(F.broadcast(table), "_m").drop("_m")


# -- all methods -----------------------------------------------------------------
def cluster(df: DataFrame, features: Sequence[str], method: str, k: int, seed: int = SEED,
            bandwidth: float | None = None) -> DataFrame:
    if method == "k-means":
        return kmeans(df, features, k, seed)
    if method == "mean-shift":
        if bandwidth is None:
            raise ValueError("mean shift needs a bandwidth")
        return mean_shift(df, features, bandwidth)
    if method == "gaussian-mixture":
        return gaussian_mixture(df, features, k, seed)
    if method == "full-agglomerative":
        return agglomerative(df, features, k, "complete", seed=seed)
    if method == "ward-agglomerative":
        return agglomerative(df, features, k, "ward", seed=seed)
    raise ValueError(f"unknown clustering method {method!r}")


def cluster_scopes(prepared: DataFrame, k: int, *, keys: Sequence[str] = ("rental_id", "pos_id"),
                   columns: Sequence[str] = S.CLUSTERING_COLS, methods: Sequence[str] = S.CLUSTER_METHODS,
                   only_north: bool = False, include_all: bool = True, seed: int = SEED,
                   bandwidth: float | None = None, scopes: Sequence[str] | None = None, **scaling) -> DataFrame:
    """(scope, method, keys, cluster_id) for every region and, with ``include_all``, for all rows together.

    ``scopes`` names the wanted ones among the regions and ``all``.
    """
    narrow = materialize(prepared.select(*dict.fromkeys([*keys, *columns, "latitude", "longitude"])), "prepared")
    located = with_region(narrow, only_north)
    names = [r["region"] for r in located.select("region").distinct().orderBy("region").collect()]
    frames = {s: located.where(F.col("region") == s) for s in names}
    if include_all:
        frames["all"] = narrow
    frames = {s: f for s, f in frames.items() if scopes is None or s in scopes}
    parts = []
    for scope, frame in frames.items():
        scaled, features = preprocess(frame, columns, **scaling)
        scaled = materialize(scaled.select(*keys, *features), "scaled")
        for method in methods:
            labelled = cluster(scaled, features, method, k, seed, bandwidth)
            parts.append(labelled.select(F.lit(scope).alias("scope"), F.lit(method).alias("method"), *keys,
                                         F.col(LABEL).cast("int").alias(LABEL)))
    return reduce(DataFrame.unionByName, parts)
