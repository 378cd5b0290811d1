"""Registered queries: every operator on the trajectory views over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.functions import columns as X
from trailframe.operators import (
    behavior, cluster, enrich, linkage, plotdata, prep, profile, quality, regions, regress, segments, sensors, sequences, similar,
)
from trailframe.plans import fixtures, pipeline
from trailframe.session import materialize, scratch_path
from trailframe.sources import sensors as sensor_source
from trailframe.sources import tables as table_source
from trailframe.streaming import ingest

RENTAL = ["rental_id"]
SEGMENT = ["rental_id", "timedelta_id"]
ROW = ["rental_id", "pos_id"]
PLACE = ["latitude", "longitude"]
REGRESSORS, TARGET = ["q", "d", "t"], "y"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def r(c: Column | str, digits: int = 6) -> Column:
    """Round like the SQL side does: a tiny offset keeps exact halves from falling on different sides."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(float(f"3.3e-{digits + 3}")), digits) + F.lit(0.0)


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: r(n, digits) for n in names})


def merge(spark: SparkSession, d: str) -> DataFrame:
    """The enriched positions, written once, so that steps that read them twice don't join them twice."""
    return materialize(enrich.merge_positions(**fixtures.tables(spark, d)), "merge")


def pos_gen(spark: SparkSession, d: str) -> DataFrame:
    return S.merge_to_pos_gen(merge(spark, d))


def segmented(spark: SparkSession, d: str) -> DataFrame:
    return segments.timedelta(pos_gen(spark, d))


def features(spark: SparkSession, d: str) -> DataFrame:
    """Positions inside the box with the spreads and edges of their rental, written once."""
    pos = pos_gen(spark, d)
    ext = similar.extents(pos, RENTAL)
    inside = regions.filter_positions(pos).select("rental_id", F.col("id").alias("pos_id"), "latitude", "longitude")
    return materialize(inside.join(ext, RENTAL).select(*ROW, *S.CLUSTERING_COLS), "features")


def located(spark: SparkSession, d: str) -> DataFrame:
    return regions.with_region(merge(spark, d))


def lineitem(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.table(spark, d, "lineitem").select(
        F.col("l_quantity").cast("double").alias("q"), F.col("l_discount").cast("double").alias("d"),
        F.col("l_tax").cast("double").alias("t"), F.col("l_extendedprice").cast("double").alias("y"))


# -- joins -------------------------------------------------------------------
@query
def merge_positions(spark, d):
    return enrich.merge_positions(**fixtures.tables(spark, d))


@query
def semi_reduce_positions(spark, d):
    return enrich.semi_reduce(**fixtures.tables(spark, d))[0]


@query
def semi_reduce_rentals(spark, d):
    return enrich.semi_reduce(**fixtures.tables(spark, d))[1]


@query
def valid_rentals_semi(spark, d):
    return enrich.valid_rentals(fixtures.rental(spark, d), merge(spark, d))


@query
def valid_positions_semi(spark, d):
    return enrich.valid_positions(fixtures.pos(spark, d), merge(spark, d))


@query
def nest_positions(spark, d):
    nested = enrich.nest_positions(fixtures.pos(spark, d), fixtures.rental(spark, d))
    return nested.select("id", "device_id", "user_id", "km", "part", F.size("rental_positions").cast("long").alias("n"),
                         F.array_join(F.transform("rental_positions", lambda p: p["pos_id"].cast("string")), ",").alias("ids"))


@query
def nest_rentals(spark, d):
    nested = enrich.nest_rentals(fixtures.pos(spark, d), fixtures.rental(spark, d))
    return nested.select("id", "device_id", "speed", "part",
                         F.array_join(F.transform("rental", lambda p: p["rental_id"].cast("string")), ",").alias("ids"))


@query
def dataset_positions(spark, d):
    return enrich.build_dataset(merge(spark, d)).withColumn(
        "rental_positions", F.array_join(F.col("rental_positions").cast("array<string>"), ","))


@query
def align_heuristics(spark, d):
    m = merge(spark, d)
    return enrich.align(m, segments.timedelta(S.merge_to_pos_gen(m)), ["timedelta_id", "time_gap"])


@query
def sorted_merge(spark, d):
    m = merge(spark, d)
    return enrich.sorted_tables(m, S.merge_to_pos_gen(m), fixtures.rental(spark, d))[0]


@query
def unassigned_rentals(spark, d):
    """Set difference: rentals without any merged position."""
    rental = fixtures.rental(spark, d)
    return rental.join(merge(spark, d).select(F.col("rental_id").alias("id")).distinct(), "id", "left_anti").select("id")


@query
def union_sources(spark, d):
    """Several position inputs read as one table, as chunks or files would be, without repeats."""
    moved = fixtures.pos_outliers(spark, d)
    return fixtures.pos(spark, d).unionByName(moved).distinct()


# -- projection, filters --------------------------------------------------------
@query
def pos_gen_schema(spark, d):
    return pos_gen(spark, d)


@query
def epoch_seconds(spark, d):
    return fixtures.pos(spark, d).select("id", X.epoch_seconds(F.col("server_time")).alias("server_time"),
                                         X.epoch_seconds(F.col("device_time")).alias("device_time"))


@query
def parse_timestamps(spark, d):
    text = fixtures.pos(spark, d).select("id", F.col("server_time").cast("string").alias("t"))
    return text.select("id", X.parse_timestamp(F.col("t")).alias("server_time"))


@query
def bbox_positions(spark, d):
    return regions.filter_positions(fixtures.pos_outliers(spark, d))


@query
def bbox_rentals(spark, d):
    return regions.filter_rentals(fixtures.rental(spark, d))


@query
def region_partition(spark, d):
    return regions.with_region(fixtures.pos_outliers(spark, d)).select("id", "latitude", "longitude", "region")


@query
def region_only_north(spark, d):
    return regions.with_region(fixtures.pos_outliers(spark, d), only_north=True).groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def first_n_rentals(spark, d):
    return regions.first_rentals(merge(spark, d), force=True)


@query
def first_rows(spark, d):
    return regions.first_rows(merge(spark, d), 1000, ["rental_id", "server_time", "device_time", "pos_id"]).select(*ROW)


@query
def map_shift(spark, d):
    return rounded(regions.shift_for_map(fixtures.pos(spark, d)).select("id", "latitude", "longitude"), ["latitude", "longitude"], 9)


# -- segmentation ------------------------------------------------------------------
@query
def time_gaps(spark, d):
    return segments.time_gaps(pos_gen(spark, d)).select("rental_id", "id", "server_gap", "device_gap", "time_gap")


def _segments(df: DataFrame) -> DataFrame:
    return df.select("rental_id", "id", "timedelta_id", "time_gap")


@query
def timedelta_auto(spark, d):
    return _segments(segmented(spark, d))


@query
def timedelta_fixed(spark, d):
    return _segments(segments.timedelta(pos_gen(spark, d), "12 hours"))


@query
def timedelta_split(spark, d):
    return _segments(segments.timedelta(pos_gen(spark, d), mode="split"))


@query
def segment_renumber(spark, d):
    return segments.renumber_segments(segmented(spark, d)).select("rental_id", "id", "timedelta_id")


# -- similarity ----------------------------------------------------------------------
@query
def group_spread(spark, d):
    return rounded(similar.group_spread(segmented(spark, d), SEGMENT), S.SPREADS, 9)


@query
def group_edges(spark, d):
    return similar.group_edges(segmented(spark, d), SEGMENT)


@query
def group_moments(spark, d):
    return rounded(similar.group_moments(pos_gen(spark, d), RENTAL),
                   ["mean_latitude", "mean_longitude", "std_latitude", "std_longitude"], 9)


@query
def spreaddelta(spark, d):
    return rounded(similar.spread_ids(pos_gen(spark, d), RENTAL), S.SPREADS, 9)


@query
def edgedelta(spark, d):
    return similar.edge_ids(pos_gen(spark, d), RENTAL)


@query
def coorddelta_fixed(spark, d):
    """With both half-widths given, the rounds use them instead of deviations."""
    return similar.coord_ids(pos_gen(spark, d), RENTAL, spread_delta=0.002, edge_delta=0.01)


@query
def coorddelta(spark, d):
    return similar.coord_ids(pos_gen(spark, d), RENTAL)


# -- behaviour -------------------------------------------------------------------------
@query
def behavior_windows(spark, d):
    return behavior.sliding_windows(pos_gen(spark, d), RENTAL).select(
        "rental_id", "id", F.col("row").cast("long").alias("row"), S.BEHAVIOR_WINDOW_ID)


def _behavior(df: DataFrame) -> DataFrame:
    scaled = {f: r(F.col(f) * F.lit(1e12)) for f in df.columns if f.startswith(("f_delta_latitude", "f_delta_longitude"))}
    return df.withColumns({**scaled, **{f: r(f) for f in df.columns if f.startswith("f_delta") and f not in scaled}})


@query
def movement_steps(spark, d):
    return _behavior(behavior.movement_steps(pos_gen(spark, d), RENTAL))


@query
def behavior_features(spark, d):
    return _behavior(behavior.behavior_features(pos_gen(spark, d), RENTAL))


@query
def behavior_features_segments(spark, d):
    return _behavior(behavior.behavior_features(segmented(spark, d), SEGMENT, width=4, offset=3))


# -- profiles -----------------------------------------------------------------------------
def _profile(df: DataFrame) -> DataFrame:
    stats = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return df.withColumns({s: F.when(F.col("column").endswith("time"), r(s, 3)).otherwise(r(s)) for s in stats})


PROFILED = ["latitude", "longitude", "speed", "rental_km", "usr_km", "server_time", "device_time"]


@query
def profile_positions(spark, d):
    return _profile(profile.describe(merge(spark, d), PROFILED))


@query
def region_profile(spark, d):
    return _profile(profile.region_summary(located(spark, d), PROFILED))


@query
def null_counts(spark, d):
    return profile.null_counts(segmented(spark, d))


@query
def heuristic_null_check(spark, d):
    return profile.any_null(segmented(spark, d), S.HEURISTIC_COLS)


@query
def value_counts(spark, d):
    return profile.value_counts(segmented(spark, d), "timedelta_id")


@query
def distinct_values(spark, d):
    return profile.distinct_values(segmented(spark, d), "timedelta_id")


@query
def group_count(spark, d):
    return profile.group_count(segmented(spark, d), SEGMENT)


@query
def table_shape(spark, d):
    return profile.shape(pos_gen(spark, d))


@query
def first_duplicates(spark, d):
    return profile.first_of_duplicates(merge(spark, d).select("latitude", "longitude", "rental_id", "pos_id"),
                                       ["latitude", "longitude"], ["rental_id", "pos_id"])


@query
def exact_quantiles(spark, d):
    values = fixtures.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").cast("double").alias("value"))
    return rounded(profile.exact_quantiles(values, ["flag"]), ["quantile"])


@query
def correlation_matrix(spark, d):
    return rounded(profile.correlation_matrix(features(spark, d), S.CLUSTERING_COLS, 4), ["correlation"], 3)


# -- preparation ---------------------------------------------------------------------------
@query
def prepare_features(spark, d):
    m = merge(spark, d)
    ready = prep.prepare(m, segments.timedelta(S.merge_to_pos_gen(m)), ["timedelta_id", "time_gap"])
    return ready.select(*ROW, "timedelta_id", "time_gap", "latitude", "longitude", "start_time", "stop_time", "server_time", "device_time")


@query
def scale_standard(spark, d):
    return rounded(prep.standardize(features(spark, d), S.CLUSTERING_COLS), S.CLUSTERING_COLS)


@query
def scale_minmax(spark, d):
    return rounded(prep.min_max(features(spark, d), S.CLUSTERING_COLS), S.CLUSTERING_COLS)


@query
def scale_unit(spark, d):
    return rounded(prep.unit_norm(features(spark, d), S.CLUSTERING_COLS), S.CLUSTERING_COLS)


@query
def scale_chain(spark, d):
    out, names = prep.preprocess(features(spark, d), S.CLUSTERING_COLS, standardization=True, normalization=True, norm=True)
    return rounded(out.select(*ROW, *names), names)


@query
def pca_subsets(spark, d):
    out, names = prep.project(features(spark, d), S.CLUSTERING_COLS, S.CLUSTERING_SUBSETS)
    return rounded(out.select(*ROW, *names), names)


@query
def pca_variance(spark, d):
    return rounded(prep.variance_curve(features(spark, d), PLACE), ["cumulative"])


@query
def pca_auto(spark, d):
    out, names = prep.project(features(spark, d), PLACE, None)
    return rounded(out.select(*ROW, *names), names)


@query
def pca_fixed(spark, d):
    out, names = prep.project(features(spark, d), PLACE, 1)
    return rounded(out.select(*ROW, *names), names)


# -- clustering ----------------------------------------------------------------------------------
def numbered(df: DataFrame, by: list[str] = []) -> DataFrame:
    """Labels in a form that doesn't depend on the method's numbering: the smallest pos_id of the cluster."""
    first = df.groupBy(*by, "cluster_id").agg(F.min("pos_id").alias("first"))
    return df.join(first, [*by, "cluster_id"]).select(*by, *ROW, F.col("first").alias("cluster_id"))


@query
def kmeans_lloyd(spark, d):
    df = features(spark, d)
    names = ["latitude", "longitude"]
    centres = cluster.lloyd(df, names, cluster.first_centres(df, names, ROW, 5), 5)
    return df.select(*ROW, cluster.nearest_centre(names, centres).cast("long").alias("cluster_id"))


@query
def kmeans_ml(spark, d):
    return numbered(cluster.kmeans(features(spark, d), PLACE, 4))


@query
def elbow_wcss(spark, d):
    return rounded(cluster.elbow(features(spark, d), PLACE, [1, 4]), ["wcss"], 3)


@query
def elbow_regions(spark, d):
    """The elbow table of every region and of all rows, as the flow without a cluster count makes it."""
    out = pipeline.elbows(features(spark, d), pipeline.Options(elbow_all=(1, 2), elbow_region=(1, 2)), PLACE)
    return rounded(out, ["wcss"], 3)


@query
def gmm(spark, d):
    return numbered(cluster.gaussian_mixture(features(spark, d), PLACE, 4))


@query
def bandwidth_estimate(spark, d):
    return rounded(cluster.bandwidth_estimate(features(spark, d), S.CLUSTERING_COLS, ROW, 500), ["bandwidth"])


@query
def meanshift(spark, d):
    return numbered(cluster.mean_shift(features(spark, d), PLACE, 1.0))


@query
def agglomerative_ward(spark, d):
    return numbered(cluster.agglomerative(features(spark, d), PLACE, 4, "ward"))


@query
def agglomerative_complete(spark, d):
    return numbered(cluster.agglomerative(features(spark, d), PLACE, 4, "complete"))


@query
def linkage_table(spark, d):
    """The last three merges: the four cities, whose order follows from their centres and sizes."""
    steps = cluster.linkage_table(features(spark, d), PLACE, "ward")
    last = steps.withColumn("_back", F.max("step").over(Window.partitionBy(F.lit(0))) - F.col("step")).where("_back < 3")
    return rounded(last.select(F.col("_back").cast("long").alias("back"), "distance", "size"), ["distance"], 1)


@query
def ward_cut(spark, d):
    """Four clusters of the exact Ward tree over all positions."""
    return numbered(linkage.ward_labels(features(spark, d), PLACE, 4))


@query
def ward_tree(spark, d):
    """The exact Ward tree: its last three merges, then all merges together.

    Half of all squared heights is the sum of squares about the mean, whatever the order of the merges.
    """
    tree = materialize(linkage.ward_tree(linkage.ward_points(features(spark, d), PLACE)), "ward")
    total = tree.agg(F.lit(-1).cast("long").alias("back"), (F.sum(F.col("distance") * F.col("distance")) / 2).alias("distance"),
                     F.count(F.lit(1)).alias("size"))
    last = tree.orderBy(F.desc("distance")).limit(3)
    last = last.select((F.row_number().over(Window.orderBy(F.desc("distance"))) - 1).cast("long").alias("back"), "distance", "size")
    return rounded(last.unionByName(total), ["distance"], 3)


@query
def cluster_scopes(spark, d):
    """Every method on every region and on all rows; a region is one city, so each finds one cluster there."""
    df = features(spark, d)
    whole = cluster.cluster_scopes(df, 4, columns=PLACE, bandwidth=1.0, scopes=["all"])
    each = cluster.cluster_scopes(df, 1, columns=PLACE, bandwidth=1.0, include_all=False)
    return numbered(whole.unionByName(each), ["scope", "method"])


def _labelled(spark, d) -> DataFrame:
    """Regions as clusters: labels both engines can derive."""
    number = F.when(F.col("region") == "N-E", 0).when(F.col("region") == "N-W", 1).when(F.col("region") == "S-E", 2).otherwise(3)
    return located(spark, d).withColumn("cluster_id", number.cast("long"))


@query
def silhouette(spark, d):
    return rounded(quality.silhouette(_labelled(spark, d), PLACE), ["silhouette"])


@query
def cluster_stats(spark, d):
    out = quality.cluster_stats(_labelled(spark, d), ["latitude", "longitude", "speed"])
    return rounded(out, [c for c in out.columns if c.endswith(("_mean", "_std"))])


@query
def cluster_report(spark, d):
    out = quality.cluster_report(_labelled(spark, d), PLACE)
    return rounded(out, [c for c in out.columns if c.endswith(("_mean", "_std", "silhouette"))])


def _scoped(spark, d) -> tuple[DataFrame, DataFrame]:
    """Prepared rows and the labels of a clustering run over all rows, written once, as they are numbered and joined."""
    prepared = prep.prepare(merge(spark, d))
    labels = cluster.cluster_scopes(prepared, 4, columns=PLACE, methods=S.EXAM_METHODS, bandwidth=1.0, scopes=["all"])
    return prepared, numbered(materialize(labels, "labels"), ["scope", "method"])


@query
def cluster_lines(spark, d):
    return _line_text(plotdata.cluster_lines(*_scoped(spark, d), RENTAL))


@query
def cluster_summary(spark, d):
    names = ["latitude", "longitude", "speed"]
    out = plotdata.cluster_summary(*_scoped(spark, d), names)
    return rounded(out, [c for c in out.columns if c.endswith(("_mean", "_std"))])


# -- regression --------------------------------------------------------------------------------------
def _coefficients(fit: regress.Fit, spark) -> DataFrame:
    return rounded(fit.table(spark), ["coefficient"], 3)


@query
def linreg_ols(spark, d):
    return _coefficients(regress.fit_ols(lineitem(spark, d), REGRESSORS, TARGET), spark)


@query
def linreg_exact(spark, d):
    return _coefficients(regress.fit_exact(lineitem(spark, d), REGRESSORS, TARGET), spark)


@query
def linreg_origin(spark, d):
    return _coefficients(regress.fit_exact(lineitem(spark, d), REGRESSORS, TARGET, preprocess=False), spark)


@query
def linreg_gd(spark, d):
    return _coefficients(regress.fit_gradient(lineitem(spark, d), REGRESSORS, TARGET), spark)


@query
def linreg_mse(spark, d):
    df = lineitem(spark, d)
    return rounded(regress.fit_exact(df, REGRESSORS, TARGET).mse(df), ["mse"], 1)


@query
def linreg_residuals(spark, d):
    df = fixtures.table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"),
        F.col("l_tax").alias("t"), F.col("l_extendedprice").alias("y"))
    out = regress.fit_exact(df, REGRESSORS, TARGET).residuals(df)
    return rounded(out.select("l_orderkey", "l_linenumber", "y", "prediction", "residual"), ["prediction", "residual"], 3)


@query
def coef_importance(spark, d):
    fit = regress.fit_exact(lineitem(spark, d), REGRESSORS, TARGET)
    out = regress.coefficient_importance(fit, spark)
    return rounded(out.withColumn("number", F.col("number").cast("long")), ["coefficient"], 3)


@query
def regression_overlay(spark, d):
    df = lineitem(spark, d)
    out = plotdata.regression_overlay(df, regress.fit_exact(df, REGRESSORS, TARGET))
    return rounded(out, ["x", "prediction", "line"], 3)


@query
def probability_plot(spark, d):
    return rounded(regress.probability_points(lineitem(spark, d), "y"), ["theoretical"])


# -- sequences ------------------------------------------------------------------------------------------
@query
def sequence_windows(spark, d):
    out = sequences.sequence_windows(pos_gen(spark, d), RENTAL, PLACE, 12)
    total = lambda i: F.aggregate("values", F.lit(0.0), lambda t, p: t + p[i])
    return rounded(out.select("rental_id", F.col("window").cast("long").alias("window"),
                              F.size("values").cast("long").alias("length"), total(0).alias("latitude"),
                              total(1).alias("longitude")), PLACE)


@query
def label_positions(spark, d):
    """Labels of trajectories brought back to their positions, with the segments renumbered."""
    labels = pos_gen(spark, d).select("rental_id", (F.col("rental_id") % 7).alias("cluster_id")).distinct().where("cluster_id <> 3")
    return sequences.label_positions(segmented(spark, d), labels, RENTAL).select("rental_id", "id", "timedelta_id", "cluster_id")


# -- sensors ----------------------------------------------------------------------------------------------
def _sensor_rows(spark, d) -> DataFrame:
    slots = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(S.SENSOR_COLS)]
    kind = F.concat(F.char((F.lit(97) + F.col("label") % 6)), F.lit("ws"))
    return fixtures.table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("_index"), *slots,
        F.concat(kind, F.lit("_"), (F.col("vec_id") % 16 + 1).cast("string")).alias("trial"),
        F.concat(F.lit("sub_"), (F.col("vec_id") % 24 + 1).cast("string"), F.lit(".csv")).alias("file"))


def _trials(spark, d) -> DataFrame:
    folder = scratch_path(spark, "trials")
    _sensor_rows(spark, d).write.partitionBy("trial", "file").option("header", True).csv(folder)
    return sensor_source.read_trials(spark, folder)


def _plain(df: DataFrame) -> DataFrame:
    names = {c: f"s{i}" for i, c in enumerate(S.SENSOR_COLS)}
    return df.select(*[F.col(f"`{c}`").cast("long" if c in (S.TRIAL_SUBJECT, "trial number") else df.schema[c].dataType)
                       .alias(names.get(c, c.replace(" ", "_"))) for c in df.columns])


@query
def sensor_trials(spark, d):
    return _plain(_trials(spark, d))


@query
def trial_flags(spark, d):
    return _plain(_trials(spark, d).groupBy(S.TRIAL_TYPE, "trial number", S.TRIAL_LONG).agg(F.count(F.lit(1)).alias("rows")))


@query
def subject_mask(spark, d):
    trials = _trials(spark, d)
    place = F.row_number().over(Window.orderBy(S.TRIAL_TYPE, "trial number"))
    mask = trials.select(S.TRIAL_TYPE, "trial number").distinct().withColumn(
        S.TRIAL_SUBJECT, ((place - 1) * 5 % 24 + 1).cast("int"))
    return _plain(sensors.select_subjects(trials, mask))


@query
def sensor_subject_join(spark, d):
    info = fixtures.table(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("code"), (60 + F.abs("c_acctbal") / 200).alias("weight"),
        (150 + F.col("c_nationkey")).cast("double").alias("height"), (20 + F.col("c_nationkey")).cast("double").alias("age"),
        (F.col("c_custkey") % 2).cast("int").alias("gender"))
    folder = scratch_path(spark, "info")
    info.write.option("header", True).csv(folder)
    out = _plain(sensors.with_subject_info(_trials(spark, d), sensor_source.read_subject_info(spark, folder)))
    return rounded(out.select("s0", "is_long", "subject", "trial_type", "trial_number", "weight", "height", "age",
                              F.col("gender").cast("long").alias("gender")), ["weight"])


@query
def sensor_correlation(spark, d):
    out = profile.correlation_matrix(_plain(_trials(spark, d)), [f"s{i}" for i in range(12)], 4)
    return rounded(out, ["correlation"], 3)


# -- plot tables ---------------------------------------------------------------------------------------------
@query
def histogram(spark, d):
    return rounded(plotdata.histogram(merge(spark, d), ["latitude", "longitude", "speed"]).withColumn(
        "bin", F.col("bin").cast("long")), ["low", "high", "density"])


@query
def joint_marginals(spark, d):
    return rounded(plotdata.joint_marginals(located(spark, d), "longitude", "latitude", "region", 30).withColumn(
        "bin", F.col("bin").cast("long")), ["low", "high", "density"])


@query
def density_grid(spark, d):
    return plotdata.density_grid(merge(spark, d), "longitude", "latitude").select(
        F.col("xi").cast("long").alias("xi"), F.col("yi").cast("long").alias("yi"), "count")


@query
def kernel_density(spark, d):
    return rounded(plotdata.kernel_density(merge(spark, d), "longitude", "latitude").select(
        F.col("xi").cast("long").alias("xi"), F.col("yi").cast("long").alias("yi"), "density"), ["density"])


def _line_text(df: DataFrame) -> DataFrame:
    """Lines as one comparable value: the point count and a position-weighted sum."""
    weighted = F.aggregate(F.sequence(F.lit(1), F.size("points")), F.lit(0.0),
                           lambda t, i: t + i * (F.element_at("points", i)["longitude"] + 2 * F.element_at("points", i)["latitude"]))
    rest = [c for c in df.columns if c != "points"]
    return df.select(*rest, F.size("points").cast("long").alias("n"), r(weighted).alias("line"))


@query
def polylines(spark, d):
    return _line_text(plotdata.polylines(segmented(spark, d), SEGMENT, "longitude", "latitude"))


@query
def label_lines_3d(spark, d):
    return _line_text(plotdata.label_lines_3d(segmented(spark, d), RENTAL, "longitude", "latitude", "timedelta_id"))


@query
def facet_lines(spark, d):
    return _line_text(plotdata.facet_lines(segmented(spark, d)))


@query
def region_lines(spark, d):
    return _line_text(plotdata.region_lines(segmented(spark, d), SEGMENT))


@query
def map_layer(spark, d):
    return rounded(plotdata.map_layer(segmented(spark, d), "timedelta_id"), ["latitude", "longitude"], 9)


@query
def map_centre(spark, d):
    return rounded(plotdata.map_centre(merge(spark, d)), ["latitude", "longitude"])


@query
def feature_target_points(spark, d):
    return plotdata.feature_target_points(lineitem(spark, d), REGRESSORS, TARGET)


# -- sources, streaming, pipeline -----------------------------------------------------------------------------
@query
def raw_csv_merge(spark, d):
    """Raw CSV files written and read back (positions in two files), then merged."""
    folder = scratch_path(spark, "raw")
    made = fixtures.tables(spark, d)
    even = F.col("id") % 2 == 0
    for name, frames in (("pos", [made["pos"].where(even), made["pos"].where(~even)]), ("rental", [made["rental"]]),
                         ("usr", [made["usr"]]), ("device", [made["device"]])):
        for file, df in zip(S.RAW_FILES[name], frames):
            table_source.write_csv(df, f"{folder}/{file}")
    return enrich.merge_positions(**table_source.read_all_raw(spark, folder))


def _stored(spark, d, fmt: str) -> DataFrame:
    folder = scratch_path(spark, "generated")
    made = pipeline.generate(fixtures.tables(spark, d))
    table_source.store_generated(made, folder, fmt)
    back = table_source.load_generated(spark, folder, RENTAL, fmt)
    listed = back["dataset"].select("rental_id", F.posexplode("rental_positions").alias("at", "pos_id"))
    return back["merge"].join(listed, ROW).select(*back["merge"].columns, F.col("at").cast("long").alias("at"))


@query
def csv_roundtrip(spark, d):
    return _stored(spark, d, "csv")


@query
def parquet_roundtrip(spark, d):
    return _stored(spark, d, "parquet")


@query
def stream_ingest(spark, d):
    """The event file as a stream of positions, joined to static tables, appended to a table and read back."""
    made = fixtures.tables(spark, d)
    events = ingest.position_stream(spark, d, "parquet", schema=fixtures.table(spark, d, "events").schema,
                                    pattern="events.parquet")
    target = scratch_path(spark, "stream")
    ingest.start_ingest(fixtures.pos_from_events(events), made["rental"], made["usr"], made["device"], target,
                        scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(S.MERGE).parquet(target)


@query
def generated_roundtrip(spark, d):
    """Positions with filled heuristic columns, stored as CSV with rentals and features, and read back."""
    folder = scratch_path(spark, "generated")
    made = pipeline.generate(fixtures.tables(spark, d))
    made["pos"] = materialize(segments.timedelta(made["pos"]), "segments")
    made["moving_behavior_feature"] = behavior.behavior_features(made["pos"], RENTAL)
    table_source.store_generated(made, folder, "csv")
    back = table_source.load_generated(spark, folder, RENTAL, "csv")
    counts = back["moving_behavior_feature"].groupBy("rental_id").agg(F.count(F.lit(1)).alias("windows"))
    rentals = back["rental"].select(F.col("id").alias("rental_id"), "start_time", "stop_time", F.col("km").alias("rental_km"))
    return _segments(back["pos"]).join(rentals, "rental_id").join(counts, "rental_id")


@query
def stream_chunks(spark, d):
    """As stream_ingest, from several files taken one per trigger."""
    made, folder = fixtures.tables(spark, d), scratch_path(spark, "chunks")
    for part in range(3):
        fixtures.table(spark, d, "events").where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    events = ingest.position_stream(spark, folder, "parquet", schema=fixtures.table(spark, d, "events").schema, files_per_trigger=1)
    target = scratch_path(spark, "stream")
    ingest.start_ingest(fixtures.pos_from_events(events), made["rental"], made["usr"], made["device"], target,
                        scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(S.MERGE).parquet(target)


@query
def broken_input(spark, d):
    """Null coordinates and a stop time in the year 9999: no row is lost and no rental multiplies."""
    made = fixtures.tables(spark, d)
    hole = F.col("id") % 7 == 0
    made["pos"] = made["pos"].withColumns({c: F.when(~hole, F.col(c)) for c in PLACE})
    far = F.when(F.col("id") % 4 == 1, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("stop_time"))
    made["rental"] = made["rental"].withColumn("stop_time", far)
    pos = S.merge_to_pos_gen(materialize(enrich.merge_positions(**made), "broken"))
    ids = similar.edge_ids(pos, RENTAL, delta=0.5).select("rental_id", (F.col("edgedelta_id") > 0).alias("grouped"))
    return pos.join(ids, "rental_id").select("rental_id", "id", "latitude", "grouped")


def _far(rental: DataFrame) -> DataFrame:
    """A quarter of the rentals stop in the year 9999."""
    far = F.when(F.col("id") % 4 == 1, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("stop_time"))
    return rental.withColumn("stop_time", far)


@query
def stream_open_end(spark, d):
    """A stream of positions joined to rentals of which many stop in the year 9999."""
    made, target = fixtures.tables(spark, d), scratch_path(spark, "stream")
    events = ingest.position_stream(spark, d, "parquet", schema=fixtures.table(spark, d, "events").schema, pattern="events.parquet")
    ingest.start_ingest(fixtures.pos_from_events(events), _far(made["rental"]), made["usr"], made["device"], target,
                        scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(S.MERGE).parquet(target).select(
        "rental_id", "pos_id", F.year("stop_time").cast("long").alias("stop_year"), "latitude")


@query
def stream_segments(spark, d):
    """Segments at a fixed gap from three micro-batches in the order of time, state kept between them."""
    made, folder = fixtures.tables(spark, d), scratch_path(spark, "chunks")
    third = F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10))
    for part in range(3):
        # small row groups, so that many tasks read the one file of a micro-batch
        fixtures.table(spark, d, "events").where(third == part).coalesce(1).write.mode("append").option(
            "parquet.block.size", 4 << 20).parquet(folder)
    events = ingest.position_stream(spark, folder, "parquet", schema=fixtures.table(spark, d, "events").schema, files_per_trigger=1)
    target = scratch_path(spark, "stream")
    ingest.start_segments(fixtures.pos_from_events(events), made["rental"], made["usr"], made["device"], "12 hours", target,
                          scratch_path(spark, "stream-state")).awaitTermination()
    return _segments(spark.read.parquet(target))


@query
def remembered_tables(spark, d):
    """A table made, taken from the store, and made again for another parameter."""
    store, inputs = scratch_path(spark, "store"), [fixtures.table(spark, d, name) for name in ("events", "customer")]
    out, made = None, []
    for call, km in enumerate((1.0, 1.0, 3.0)):

        def make(km: float = km, call: int = call) -> DataFrame:
            made.append(call)
            return enrich.merge_positions(**fixtures.tables(spark, d)).where(F.col("rental_km") < km)

        kept = table_source.remembered(spark, store, "short", {"km": km}, inputs, make)
        row = kept.agg(F.count(F.lit(1)).alias("rows"), F.sum("pos_id").alias("ids")).select(
            F.lit(call).cast("long").alias("call"), F.lit(call in made).alias("made"), "rows", "ids")
        out = row if out is None else out.unionByName(row)
    return out


@query
def state_checks(spark, d):
    """Row counts, emptiness and nulls of four tables, observed while they are written."""
    pos = pos_gen(spark, d)
    found = table_source.state_of({
        "generated": pos,
        "segmented": segments.timedelta(pos).select("rental_id", "id", "timedelta_id", "latitude", "time_gap"),
        "holes": pos.select("id", "latitude", F.when(F.col("id") % 7 != 0, F.col("speed")).alias("speed")),
        "outside": pos.where(F.col("latitude") > 90).select("id", "latitude"),
    }, scratch_path(spark, "checked"))
    rows = [(name, rows, empty, holes, ",".join(columns)) for name, rows, empty, holes, columns in found]
    return spark.createDataFrame(rows, "`table` string, `rows` long, empty boolean, any_null boolean, columns string")


@query
def pipeline_run(spark, d):
    """Raw tables to segments, all three groupings to their last round, and behaviour features."""
    out = pipeline.run(spark, fixtures.tables(spark, d), pipeline.Options(group_on_timedelta=False, behavior=True))
    windows = out["moving_behavior_feature"].groupBy("rental_id").agg(F.count(F.lit(1)).alias("windows"))
    return out["pos"].join(windows, "rental_id").select(
        "id", "rental_id", "timedelta_id", "spreaddelta_id", "edgedelta_id", "coorddelta_id", "time_gap", "windows")
