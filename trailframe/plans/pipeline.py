"""The full flow from raw tables to clusters, as options plus one function."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.operators import behavior, cluster, enrich, plotdata, prep, profile, regions, segments, similar
from trailframe.session import materialize


@dataclass(frozen=True)
class Options:
    """Settings of a run. The heuristics are on, every other step is off unless asked for.

    Clustering with mean shift needs ``bandwidth``.
    """

    group_on_timedelta: bool = True
    heuristic: bool = True
    timedelta: float | str | None = None
    timedelta_mode: str = "runs"
    spreaddelta: float | None = None
    edgedelta: float | None = None
    seed: int = 42
    clustering: bool = False
    n_clusters: int | None = None
    bandwidth: float | None = None
    elbow_all: tuple[int, int] = (1, 20)
    elbow_region: tuple[int, int] = (1, 30)
    with_pca: bool = False
    components: tuple[tuple[str, ...], ...] | int | None = tuple(tuple(c) for c in S.CLUSTERING_SUBSETS)
    with_standardization: bool = False
    with_normalization: bool = False
    with_unit_norm: bool = False
    only_north: bool = False
    exam: bool = False
    behavior: bool = False
    window_width: int = S.WINDOW_WIDTH
    window_offset: int | None = None
    profiles: bool = False
    rentals_to_analyze: int | None = None

    @property
    def keys(self) -> list[str]:
        return ["rental_id", "timedelta_id"] if self.group_on_timedelta else ["rental_id"]

    @property
    def scaling(self) -> dict:
        parts = [list(c) for c in self.components] if isinstance(self.components, tuple) else self.components
        return {"standardization": self.with_standardization, "normalization": self.with_normalization,
                "norm": self.with_unit_norm, "pca": self.with_pca, "components": parts}


def heuristics(pos_gen: DataFrame, options: Options) -> DataFrame:
    """Segmentation, then the three groupings, each on the stored result of the one before."""
    out = materialize(segments.timedelta(pos_gen, options.timedelta, options.timedelta_mode), "timedelta")
    out = materialize(similar.spreaddelta(out, options.keys, options.spreaddelta), "spreaddelta")
    out = materialize(similar.edgedelta(out, options.keys, options.edgedelta, options.seed), "edgedelta")
    return materialize(similar.coorddelta(out, options.keys, options.spreaddelta, options.edgedelta, options.seed),
                       "coorddelta")


def generate(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw tables to the generated ones (merge, dataset, pos, rental)."""
    merge = materialize(enrich.merge_positions(tables["pos"], tables["rental"], tables["usr"], tables["device"]), "merge")
    return {
        "merge": merge,
        "dataset": enrich.build_dataset(merge),
        "pos": S.merge_to_pos_gen(merge),
        "rental": enrich.valid_rentals(tables["rental"], merge),
    }


def elbows(prepared: DataFrame, options: Options, columns: list[str] = S.CLUSTERING_COLS) -> DataFrame:
    """(scope, k, wcss) for all rows and for every region."""
    located = regions.with_region(prepared, options.only_north)
    names = [r["region"] for r in located.select("region").distinct().orderBy("region").collect()]
    scopes = [("all", prepared, range(*options.elbow_all))]
    scopes += [(n, located.where(F.col("region") == n), range(*options.elbow_region)) for n in names]
    out = None
    for scope, frame, ks in scopes:
        scaled, features = prep.preprocess(frame, columns, **options.scaling)
        rows = cluster.elbow(scaled, features, ks, options.seed).select(F.lit(scope).alias("scope"), "k", "wcss")
        out = rows if out is None else out.unionByName(rows)
    return out


def run(spark: SparkSession, tables: dict[str, DataFrame], options: Options = Options()) -> dict[str, DataFrame]:
    """Run the chosen steps and return their tables.

    ``tables`` holds either the raw tables (pos, rental, usr, device) or generated ones (merge, pos).
    """
    out = dict(tables) if "merge" in tables else generate(tables)
    keys = options.keys
    if options.heuristic:
        out["pos"] = heuristics(out["pos"], options)
    if options.clustering:
        prepared = materialize(prep.prepare(out["merge"], out["pos"]), "prepared")
        if profile.any_null(prepared, S.CLUSTERING_COLS).first()[0]:
            raise ValueError("clustering needs the heuristic columns of every row: run with heuristic=True or pass generated tables")
        if options.n_clusters is None:
            out["elbow"] = elbows(prepared, options)
        else:
            methods = S.EXAM_METHODS if options.exam else S.CLUSTER_METHODS
            out["clusters"] = cluster.cluster_scopes(
                prepared, options.n_clusters, methods=methods, only_north=options.exam or options.only_north,
                include_all=not options.exam, seed=options.seed, bandwidth=options.bandwidth, **options.scaling)
            out["clusters"] = materialize(out["clusters"], "clusters")
            out["cluster_summary"] = plotdata.cluster_summary(prepared, out["clusters"], S.CLUSTERING_COLS)
            out["cluster_lines"] = plotdata.cluster_lines(prepared, out["clusters"], keys, options.rentals_to_analyze)
            if any(m.endswith("agglomerative") for m in methods):
                scaled, features = prep.preprocess(prepared, S.CLUSTERING_COLS, **options.scaling)
                out["linkage"] = cluster.linkage_table(scaled, features, "ward", seed=options.seed)
    if options.behavior:
        out["moving_behavior_feature"] = behavior.behavior_features(
            out["pos"], keys, options.window_width, options.window_offset)
    if options.profiles:
        out["profile"] = profile.describe(out["pos"])
        out["region_profile"] = profile.region_summary(regions.with_region(out["pos"], options.only_north))
        out["lines"] = plotdata.region_lines(regions.filter_positions(out["pos"]), keys, only_north=options.only_north,
                                             rentals=options.rentals_to_analyze)
    return out
