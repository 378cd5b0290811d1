"""The same queries in DuckDB SQL."""

from __future__ import annotations

from checks.sqlviews import (
    EDGES, FEATURES, KEYS12, MERGE18, POS_BOX, SPREADS, box_rounds, over, r, spread_rounds, union_columns,
)

W = "PARTITION BY rental_id ORDER BY server_time, device_time, pos_id"
ORACLES: dict[str, str] = {}


def _rounded(names: list[str], digits: int = 6, lead: str = "") -> str:
    return ", ".join(f"{r(lead + n, digits)} AS {n}" for n in names)


# -- joins -------------------------------------------------------------------
MERGED = over("merge_all", f"SELECT {MERGE18} FROM merge_all")
ORACLES["merge_positions"] = ORACLES["raw_csv_merge"] = ORACLES["stream_ingest"] = ORACLES["sorted_merge"] = MERGED
KEPT = ("kept", """SELECT * FROM rental WHERE device_id IN (SELECT id FROM device) AND user_id IN (SELECT id FROM usr)
    AND device_id IN (SELECT device_id FROM pos)""")
ORACLES["semi_reduce_positions"] = over(
    "pos rental usr device", "SELECT * FROM pos WHERE device_id IN (SELECT device_id FROM kept)", KEPT)
ORACLES["semi_reduce_rentals"] = over("pos rental usr device", "SELECT * FROM kept", KEPT)
ORACLES["valid_rentals_semi"] = over("merge_all", "SELECT * FROM rental WHERE id IN (SELECT rental_id FROM merge_all)")
ORACLES["valid_positions_semi"] = over("merge_all", "SELECT * FROM pos WHERE id IN (SELECT pos_id FROM merge_all)")
ORACLES["unassigned_rentals"] = over("merge_all", "SELECT id FROM rental WHERE id NOT IN (SELECT rental_id FROM merge_all)")
ORACLES["union_sources"] = over("pos_outliers", "SELECT * FROM pos UNION SELECT * FROM pos_outliers")
PAIRS = ("pairs", """SELECT r.id AS rental_id, p.id AS pos_id, p.server_time, p.device_time FROM rental r
    JOIN pos p ON p.device_id = r.device_id AND p.server_time BETWEEN r.start_time AND r.stop_time
     AND p.device_time BETWEEN r.start_time AND r.stop_time""")
ORACLES["nest_positions"] = over("pos rental", """SELECT r.id, r.device_id, r.user_id, r.km, 0::bigint AS part, l.n, l.ids
    FROM rental r JOIN (SELECT rental_id, count(*)::bigint AS n,
      string_agg(pos_id::varchar, ',' ORDER BY server_time, device_time, pos_id) AS ids FROM pairs GROUP BY 1) l
    ON l.rental_id = r.id""", PAIRS)
ORACLES["nest_rentals"] = over("pos rental", """SELECT p.id, p.device_id, p.speed, 0::bigint AS part, l.ids
    FROM pos p JOIN (SELECT pos_id, string_agg(rental_id::varchar, ',' ORDER BY rental_id) AS ids FROM pairs GROUP BY 1) l
    ON l.pos_id = p.id""", PAIRS)
ORACLES["dataset_positions"] = over("merge_all", f"""SELECT {KEYS12},
    string_agg(pos_id::varchar, ',' ORDER BY server_time, device_time, pos_id) AS rental_positions, 0::bigint AS part
    FROM merge_all GROUP BY {KEYS12}""")
ORACLES["align_heuristics"] = over("segs", f"SELECT {MERGE18}, timedelta_id, time_gap FROM segs")
ORACLES["csv_roundtrip"] = ORACLES["parquet_roundtrip"] = over(
    "merge_all", f"SELECT {MERGE18}, (row_number() OVER ({W}) - 1)::bigint AS at FROM merge_all")

# -- projection, filters --------------------------------------------------------
NULLS = ", ".join(f"NULL::bigint AS {c}" for c in ("timedelta_id", "spreaddelta_id", "edgedelta_id", "coorddelta_id"))
NULLD = ", ".join(f"NULL::double AS {c}" for c in [*SPREADS, *EDGES, "time_gap"])
ORACLES["pos_gen_schema"] = over("merge_all", f"""SELECT pos_id AS id, rental_id, latitude, longitude, speed, server_time,
    device_time, {NULLS}, {NULLD} FROM merge_all""")
ORACLES["epoch_seconds"] = over("pos", """SELECT id, epoch_us(server_time) / 1e6::double AS server_time,
    epoch_us(device_time) / 1e6::double AS device_time FROM pos""")
ORACLES["parse_timestamps"] = over("pos", "SELECT id, server_time FROM pos")
ORACLES["bbox_positions"] = over("pos_outliers", f"SELECT * FROM pos_outliers WHERE {POS_BOX}")
ORACLES["bbox_rentals"] = over("rental", """SELECT * FROM rental WHERE longitude_start > 7 AND longitude_start < 15
    AND longitude_stop > 7 AND longitude_stop < 15 AND latitude_start > 42 AND latitude_start < 46
    AND latitude_stop > 42 AND latitude_stop < 46""")
REGION = """CASE WHEN latitude >= 43 AND latitude < 44.3 AND longitude >= 12 THEN 'N-E'
    WHEN latitude >= 43 AND latitude < 44.3 AND longitude > 8 AND longitude < 10 THEN 'N-W'
    WHEN latitude < 43 AND longitude >= 13 AND longitude < 14.2 THEN 'S-E'
    WHEN latitude < 43 AND longitude > 11.7 AND longitude < 13 THEN 'S-W' END"""
ORACLES["region_partition"] = over(
    "pos_outliers", f"SELECT * FROM (SELECT id, latitude, longitude, {REGION} AS region FROM pos_outliers) WHERE region IS NOT NULL")
ORACLES["region_only_north"] = over("pos_outliers", f"""SELECT region, count(*)::bigint AS rows
    FROM (SELECT {REGION} AS region FROM pos_outliers) WHERE region IN ('N-E', 'N-W') GROUP BY 1""")
FIRST100 = "(SELECT DISTINCT rental_id FROM merge_all ORDER BY rental_id LIMIT 100)"
ORACLES["first_n_rentals"] = over("merge_all", f"SELECT {MERGE18} FROM merge_all WHERE rental_id IN {FIRST100}")
ORACLES["first_rows"] = over("merge_all", """SELECT rental_id, pos_id FROM merge_all
    ORDER BY rental_id, server_time, device_time, pos_id LIMIT 1000""")
ORACLES["map_shift"] = over("pos", f"SELECT id, {r('latitude + 1.2::double', 9)} AS latitude, {r('longitude - 1.2::double', 9)} AS longitude FROM pos")

# -- segmentation ------------------------------------------------------------------
GAP = "(floor(sg / 1000.0::double) + floor(dg / 1000.0::double)) / 2.0::double"
ORACLES["time_gaps"] = over("gaps", f"SELECT rental_id, pos_id AS id, sg AS server_gap, dg AS device_gap, {GAP} AS time_gap FROM gaps")
ORACLES["timedelta_auto"] = over("segs", "SELECT rental_id, pos_id AS id, timedelta_id, time_gap FROM segs")
FIXED = ("fixed", f"SELECT *, {GAP} AS time_gap, sg >= 43200000000 AND dg >= 43200000000 AS flag FROM gaps")
FIXED2 = ("fixed2", f"SELECT *, lag(flag) OVER ({W}) AS pflag FROM fixed")
RUNS = f"(sum(CASE WHEN pflag IS NULL OR pflag <> flag THEN 1 ELSE 0 END) OVER ({W} ROWS UNBOUNDED PRECEDING))::bigint AS timedelta_id"
ORACLES["timedelta_fixed"] = over("gaps", f"SELECT rental_id, pos_id AS id, {RUNS}, time_gap FROM fixed2", FIXED, FIXED2)
ORACLES["timedelta_split"] = over("flags", f"""SELECT rental_id, pos_id AS id, time_gap,
    (1 + sum(flag::int) OVER ({W} ROWS UNBOUNDED PRECEDING))::bigint AS timedelta_id FROM flags""")
ORACLES["segment_renumber"] = over("segs", """SELECT rental_id, pos_id AS id,
    (dense_rank() OVER (ORDER BY rental_id, timedelta_id))::bigint AS timedelta_id FROM segs""")

# -- similarity ----------------------------------------------------------------------
ORACLES["group_spread"] = over("segs", f"""SELECT rental_id, timedelta_id, {r('max(latitude) - min(latitude)', 9)} AS spread_latitude,
    {r('max(longitude) - min(longitude)', 9)} AS spread_longitude FROM segs GROUP BY 1, 2""")
EDGE_WINDOW = "WINDOW w AS (PARTITION BY rental_id, timedelta_id ORDER BY server_time, device_time, pos_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
ORACLES["group_edges"] = over("segs", f"""SELECT DISTINCT rental_id, timedelta_id, first_value(latitude) OVER w AS edge_latitude_start,
    first_value(longitude) OVER w AS edge_longitude_start, last_value(latitude) OVER w AS edge_latitude_stop,
    last_value(longitude) OVER w AS edge_longitude_stop FROM segs {EDGE_WINDOW}""")
ORACLES["group_moments"] = over("groups", f"""SELECT rental_id, n, {r('ml', 9)} AS mean_latitude, {r('mo', 9)} AS mean_longitude,
    {r('dl', 9)} AS std_latitude, {r('dlo', 9)} AS std_longitude FROM groups""")
ORACLES["spreaddelta"] = f"SELECT rental_id, {_rounded(SPREADS, 9)}, spreaddelta_id FROM ({spread_rounds()})"
ORACLES["edgedelta"] = box_rounds("edgedelta_id", False)
ORACLES["coorddelta_fixed"] = box_rounds("coorddelta_id", True, None, 0.01, 0.002)
ORACLES["coorddelta"] = box_rounds("coorddelta_id", True)
# -- behaviour -------------------------------------------------------------------------


def _numbered(keys: str, source: str) -> tuple[str, str]:
    return ("numbered", f"""SELECT *, (row_number() OVER w - 1)::bigint AS rw, (count(*) OVER (PARTITION BY {keys}))::bigint AS n,
        epoch_us(server_time) - epoch_us(lag(server_time) OVER w) + epoch_us(device_time) - epoch_us(lag(device_time) OVER w) AS dt2,
        latitude - lag(latitude) OVER w AS dlat, longitude - lag(longitude) OVER w AS dlon, speed - lag(speed) OVER w AS dspeed
        FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY server_time, device_time, pos_id)""")


def _windowed(width: int, offset: int, first: int) -> str:
    low = f"greatest(0, floor((rw - {width}) / {offset}.0::double)::bigint + 1)"
    last = f"(CASE WHEN n <= {width} THEN 0 ELSE ceil((n - {width}) / {offset}.0::double)::bigint END)"
    return f"unnest(generate_series({low}, least({last}, floor((rw - {first}) / {offset}.0::double)::bigint)))::bigint AS moving_window_id"


def _steps(keys: str, source: str, width: int, offset: int) -> list[tuple[str, str]]:
    return [
        _numbered(keys, source),
        ("turned", """SELECT *, dt2 * 500.0::double AS dt, CASE WHEN dlat <> 0 THEN atan(dlon / dlat) WHEN dlon > 0 THEN pi() / 2
            WHEN dlon < 0 THEN -pi() / 2 ELSE 0.0::double END AS turn FROM numbered"""),
        ("changes", f"SELECT *, turn - lag(turn) OVER (PARTITION BY {keys} ORDER BY rw) AS dturn FROM turned"),
        ("windowed", f"SELECT *, {_windowed(width, offset, 1)} FROM changes WHERE rw > 0"),
        ("steps", f"""SELECT {keys}, moving_window_id, CASE WHEN dt <> 0 THEN dlat / dt END AS f_delta_latitude,
            CASE WHEN dt <> 0 THEN dlon / dt END AS f_delta_longitude, dspeed AS f_delta_s,
            CASE WHEN rw = moving_window_id * {offset} + 1 THEN turn ELSE dturn END AS f_delta_r FROM windowed"""),
    ]


RATES = [("f_delta_latitude", "quantile", " * 1e12::double"), ("f_delta_longitude", "quantile", " * 1e12::double"),
         ("f_delta_s", "quantise", ""), ("f_delta_r", "quantile", "")]


def _features(keys: str) -> str:
    out = []
    for rate, word, scale in RATES:
        stats = [("mean", f"avg({rate})"), ("max", f"max({rate})"), ("min", f"min({rate})")]
        stats += [(f"{word}{int(q * 100)}", f"quantile_cont({rate}, {q})") for q in (0.75, 0.5, 0.25)]
        out += [f"{r(f'coalesce({e}, 0){scale}')} AS {rate}_{n}" for n, e in stats]
    return f"SELECT {keys}, moving_window_id, {', '.join(out)} FROM steps GROUP BY {keys}, moving_window_id"


ORACLES["behavior_windows"] = over("merge_all", f"SELECT rental_id, pos_id AS id, rw AS row, {_windowed(12, 6, 0)} FROM numbered",
                                   _numbered("rental_id", "merge_all"))
ORACLES["movement_steps"] = over("merge_all", "SELECT rental_id, moving_window_id, " + ", ".join(
    f"{r(rate + scale)} AS {rate}" for rate, _, scale in RATES) + " FROM steps", *_steps("rental_id", "merge_all", 12, 6))
ORACLES["behavior_features"] = over("merge_all", _features("rental_id"), *_steps("rental_id", "merge_all", 12, 6))
ORACLES["behavior_features_segments"] = over(
    "segs", _features("rental_id, timedelta_id"), *_steps("rental_id, timedelta_id", "segs", 4, 3))

# -- profiles -----------------------------------------------------------------------------
PROFILED = [(c, c) for c in ("latitude", "longitude", "speed", "rental_km", "usr_km")]
PROFILED += [(c, f"epoch_us({c}) / 1e6::double") for c in ("server_time", "device_time")]


def _describe(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    stats = {"mean": "avg(value)", "std": "CASE WHEN \"column\" NOT LIKE '%time' THEN stddev_samp(value) END", "min": "min(value)",
             "q25": "quantile_cont(value, 0.25)", "q50": "quantile_cont(value, 0.5)", "q75": "quantile_cont(value, 0.75)",
             "max": "max(value)"}
    shown = ", ".join(f"CASE WHEN \"column\" LIKE '%time' THEN {r(e, 3)} ELSE {r(e)} END AS {n}" for n, e in stats.items())
    return f"SELECT {lead}\"column\", count(*)::bigint AS count, {shown} FROM vals GROUP BY {lead}\"column\""


ORACLES["profile_positions"] = over("merge_all", _describe(), ("vals", union_columns("merge_all", PROFILED)))
ORACLES["region_profile"] = over(
    "located", f"SELECT p.*, n.rows FROM ({_describe('region')}) p JOIN (SELECT region, count(*)::bigint AS rows FROM located GROUP BY 1) n USING (region)",
    ("vals", union_columns("located", PROFILED, "region")))
FULL = {"id": "pos_id", "rental_id": "rental_id", "timedelta_id": "timedelta_id", "latitude": "latitude", "longitude": "longitude",
        "speed": "speed", "server_time": "server_time", "device_time": "device_time", "time_gap": "time_gap"}
EMPTY = ["spreaddelta_id", "edgedelta_id", "coorddelta_id", *SPREADS, *EDGES]
ORACLES["null_counts"] = over("segs", " UNION ALL ".join(
    [f"SELECT '{n}' AS \"column\", count(*) FILTER ({e} IS NULL)::bigint AS nulls FROM segs" for n, e in FULL.items()]
    + [f"SELECT '{n}' AS \"column\", count(*)::bigint AS nulls FROM segs" for n in EMPTY]))
ORACLES["heuristic_null_check"] = over("segs", "SELECT count(*) > 0 AS any_null FROM segs")
ORACLES["value_counts"] = over("segs", "SELECT timedelta_id, count(*)::bigint AS count FROM segs GROUP BY 1")
ORACLES["distinct_values"] = over("segs", "SELECT DISTINCT timedelta_id FROM segs")
ORACLES["group_count"] = over("segs", "SELECT count(DISTINCT (rental_id, timedelta_id))::bigint AS groups FROM segs")
ORACLES["first_duplicates"] = over("merge_all", """SELECT latitude, longitude, rental_id, pos_id FROM merge_all
    QUALIFY row_number() OVER (PARTITION BY latitude, longitude ORDER BY rental_id, pos_id) = 1""")
ORACLES["exact_quantiles"] = " UNION ALL ".join(
    f"SELECT l_returnflag AS flag, {q}::double AS q, {r(f'quantile_cont(l_extendedprice, {q})')} AS quantile FROM lineitem GROUP BY 1"
    for q in (0.25, 0.5, 0.75))


def _correlations(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {r(f'round(corr({a}, {b}), 4)', 3)} AS correlation FROM {{src}}" for a in names for b in names)


ORACLES["correlation_matrix"] = over("feat", _correlations(FEATURES).format(src="feat"))

# -- preparation ---------------------------------------------------------------------------
ORACLES["prepare_features"] = over("segs", f"""SELECT rental_id, pos_id,
    (dense_rank() OVER (ORDER BY rental_id, timedelta_id))::bigint AS timedelta_id, time_gap, latitude, longitude,
    {', '.join(f'epoch_us({t}) / 1e6::double AS {t}' for t in ('start_time', 'stop_time', 'server_time', 'device_time'))}
    FROM segs WHERE {POS_BOX}""")


def _standard(f: str) -> str:
    return f"({f} - avg({f}) OVER ()) / (CASE WHEN stddev_pop({f}) OVER () = 0 THEN 1 ELSE stddev_pop({f}) OVER () END)"


def _minmax(f: str) -> str:
    span = f"(max({f}) OVER () - min({f}) OVER ())"
    return f"({f} - min({f}) OVER ()) / (CASE WHEN {span} = 0 THEN 1 ELSE {span} END)"


def _apply(fn, names: list[str]) -> str:
    return ", ".join(f"{r(fn(f))} AS {f}" for f in names)


LENGTH = "sqrt(" + " + ".join(f"{f} * {f}" for f in FEATURES) + ")"
ORACLES["scale_standard"] = over("feat", f"SELECT rental_id, pos_id, {_apply(_standard, FEATURES)} FROM feat")
ORACLES["scale_minmax"] = over("feat", f"SELECT rental_id, pos_id, {_apply(_minmax, FEATURES)} FROM feat")
ORACLES["scale_unit"] = over("feat", f"SELECT rental_id, pos_id, {_apply(lambda f: f'{f} / {LENGTH}', FEATURES)} FROM feat")
ORACLES["scale_chain"] = over(
    "feat", "SELECT rental_id, pos_id, " + ", ".join(f"{r(f'CASE WHEN len = 0 THEN 0 ELSE {f} / len END')} AS x_{f}" for f in FEATURES) + " FROM s3",
    ("s1", f"SELECT rental_id, pos_id, {', '.join(f'{_standard(f)} AS {f}' for f in FEATURES)} FROM feat"),
    ("s2", f"SELECT rental_id, pos_id, {', '.join(f'{_minmax(f)} AS {f}' for f in FEATURES)} FROM s1"),
    ("s3", f"SELECT *, {LENGTH} AS len FROM s2"))
PAIRS2 = [("spread_latitude", "spread_longitude"), ("edge_latitude_start", "edge_longitude_start"),
          ("edge_latitude_stop", "edge_longitude_stop")]


def _component(i: int, a: str, b: str) -> tuple[str, str]:
    """First principal direction of two columns in closed form, its larger weight positive."""
    return (f"p{i}", f"""SELECT ma, mb, wa * s / l AS wa, wb * s / l AS wb FROM (SELECT *, sqrt(wa * wa + wb * wb) AS l,
        CASE WHEN abs(wa) >= abs(wb) THEN sign(wa) ELSE sign(wb) END AS s FROM (SELECT ma, mb, cab AS wa,
        (va + vb) / 2 + sqrt(((va - vb) / 2) ** 2 + cab ** 2) - va AS wb FROM (SELECT avg({a}) AS ma, avg({b}) AS mb,
        var_samp({a}) AS va, var_samp({b}) AS vb, covar_samp({a}, {b}) AS cab FROM feat)))""")


ORACLES["pca_subsets"] = over("feat", f"SELECT rental_id, pos_id, {r('latitude')} AS pc0, {r('longitude')} AS pc1, " + ", ".join(
    f"{r(f'({a} - p{i}.ma) * p{i}.wa + ({b} - p{i}.mb) * p{i}.wb')} AS pc{i}" for i, (a, b) in enumerate(PAIRS2, start=2))
    + " FROM feat, p2, p3, p4", *[_component(i, a, b) for i, (a, b) in enumerate(PAIRS2, start=2)])

P0 = _component(0, "latitude", "longitude")
ORACLES["pca_fixed"] = over("feat", f"SELECT rental_id, pos_id, {r('(latitude - p0.ma) * p0.wa + (longitude - p0.mb) * p0.wb')} AS pc0 FROM feat, p0", P0)
ORACLES["pca_auto"] = over("feat", f"""SELECT rental_id, pos_id, {r('(latitude - p0.ma) * p0.wa + (longitude - p0.mb) * p0.wb')} AS pc0,
    {r('((latitude - p0.ma) * -p0.wb + (longitude - p0.mb) * p0.wa) * CASE WHEN abs(p0.wb) >= abs(p0.wa) THEN -sign(p0.wb) ELSE sign(p0.wa) END')} AS pc1
    FROM feat, p0""", P0)
ORACLES["pca_variance"] = over("feat", f"""SELECT 1 AS component, {r('(1 + abs(corr(latitude, longitude))) / 2')} AS cumulative FROM feat
    UNION ALL SELECT 2, {r('1.0::double')}""")

# -- clustering ----------------------------------------------------------------------------------


def _lloyd(iterations: int) -> str:
    dist = "(f.latitude - c.la) ** 2 + (f.longitude - c.lo) ** 2"
    nearest = lambda src: f"""SELECT f.rental_id, f.pos_id, any_value(f.latitude) AS latitude, any_value(f.longitude) AS longitude,
        arg_min(c.cid, row({dist}, c.cid)) AS cid FROM feat f, {src} c GROUP BY 1, 2"""
    steps = [("c0", """SELECT row_number() OVER (ORDER BY h) - 1 AS cid, la, lo FROM (SELECT latitude AS la, longitude AS lo,
        md5('42:' || rental_id || ':' || pos_id) AS h FROM feat ORDER BY h LIMIT 5)""")]
    for i in range(iterations):
        steps.append((f"n{i}", nearest(f"c{i}")))
        steps.append((f"c{i + 1}", f"""SELECT c.cid, coalesce(m.la, c.la) AS la, coalesce(m.lo, c.lo) AS lo FROM c{i} c LEFT JOIN
            (SELECT cid, avg(latitude) AS la, avg(longitude) AS lo FROM n{i} GROUP BY 1) m USING (cid)"""))
    steps.append(("final", nearest(f"c{iterations}")))
    return over("feat", "SELECT rental_id, pos_id, cid::bigint AS cluster_id FROM final", *steps)


ORACLES["kmeans_lloyd"] = _lloyd(5)
GAPS8 = " + ".join(f"(a.{f} - b.{f}) ** 2" for f in FEATURES)
ORACLES["bandwidth_estimate"] = over("feat", f"SELECT {r('avg(d)')} AS bandwidth FROM ranked WHERE rk = nn", (
    "sample", "SELECT * FROM feat ORDER BY md5('42:' || rental_id || ':' || pos_id) LIMIT 500"), (
    "ranked", f"""SELECT sqrt({GAPS8}) AS d, row_number() OVER (PARTITION BY a.rental_id, a.pos_id ORDER BY {GAPS8}) AS rk,
        greatest(1, floor((SELECT count(*) FROM sample) * 0.2::double)::bigint) AS nn FROM sample a, sample b"""))
NUMBER = "CASE region WHEN 'N-E' THEN 0 WHEN 'N-W' THEN 1 WHEN 'S-E' THEN 2 ELSE 3 END"
LABELLED = ("labelled", f"SELECT *, ({NUMBER})::bigint AS cluster_id FROM located WHERE region IS NOT NULL")
SCORES = [
    ("sums", """SELECT cluster_id AS c, count(*) AS n, avg(latitude) AS la, avg(longitude) AS lo,
        var_pop(latitude) + var_pop(longitude) AS v FROM labelled GROUP BY 1"""),
    ("gaps2", """SELECT l.pos_id, l.rental_id, l.cluster_id, s.c, s.n, (l.latitude - s.la) ** 2 + (l.longitude - s.lo) ** 2 + s.v AS d
        FROM labelled l, sums s"""),
    ("inner_outer", """SELECT rental_id, pos_id, max(n) FILTER (c = cluster_id) AS n, min(d) FILTER (c <> cluster_id) AS b,
        max(d * n / greatest(n - 1, 1)) FILTER (c = cluster_id) AS a FROM gaps2 GROUP BY 1, 2"""),
    ("scores", "SELECT CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM inner_outer"),
]
ORACLES["silhouette"] = over("located", f"SELECT count(*)::bigint AS points, {r('avg(s)')} AS silhouette FROM scores", LABELLED, *SCORES)

# The fixture's cities lie far apart, so every method with four clusters must return them: user_id mod 4.
CITY = "(rental_id // 10) % 4"
BY_CITY = over("feat", f"SELECT rental_id, pos_id, min(pos_id) OVER (PARTITION BY {CITY}) AS cluster_id FROM feat")
for name in ("kmeans_ml", "gmm", "meanshift", "agglomerative_ward", "agglomerative_complete", "ward_cut"):
    ORACLES[name] = BY_CITY
REGION_OF = f"CASE {CITY} WHEN 0 THEN 'N-E' WHEN 1 THEN 'N-W' WHEN 2 THEN 'S-E' ELSE 'S-W' END"
METHODS = "(SELECT unnest(['k-means', 'mean-shift', 'gaussian-mixture', 'full-agglomerative', 'ward-agglomerative']) AS method)"
ORACLES["cluster_scopes"] = over("feat", f"""SELECT scope, method, rental_id, pos_id, cluster_id FROM (
    SELECT 'all' AS scope, rental_id, pos_id, min(pos_id) OVER (PARTITION BY {CITY}) AS cluster_id FROM feat UNION ALL
    SELECT {REGION_OF}, rental_id, pos_id, min(pos_id) OVER (PARTITION BY {CITY}) FROM feat), {METHODS}""")
WSS = "sum((latitude - la) ** 2 + (longitude - lo) ** 2)"
ORACLES["elbow_wcss"] = over("feat", f"""SELECT 1 AS k, {r(WSS, 3)} AS wcss FROM (SELECT *, avg(latitude) OVER () AS la, avg(longitude) OVER () AS lo FROM feat)
    UNION ALL SELECT 4, {r(WSS, 3)} FROM (SELECT *, avg(latitude) OVER c AS la, avg(longitude) OVER c AS lo FROM feat WINDOW c AS (PARTITION BY {CITY}))""")
ORACLES["elbow_regions"] = over("feat", f"""SELECT 'all' AS scope, 1 AS k, {r(WSS, 3)} AS wcss FROM (
    SELECT *, avg(latitude) OVER () AS la, avg(longitude) OVER () AS lo FROM feat) UNION ALL
    SELECT {REGION_OF} AS scope, 1, {r(WSS, 3)} FROM (
    SELECT *, avg(latitude) OVER c AS la, avg(longitude) OVER c AS lo FROM feat WINDOW c AS (PARTITION BY {CITY})) GROUP BY 1""")


def _ward(a: str, b: str) -> str:
    """Ward distance of two unions of cities, given as lists of their numbers."""
    part = lambda x, i: f"(SELECT count(*) AS n{i}, avg(latitude) AS la{i}, avg(longitude) AS lo{i} FROM feat WHERE {CITY} IN ({x}))"
    return (f"SELECT sqrt(2.0::double * n1 * n2 / (n1 + n2) * ((la1 - la2) ** 2 + (lo1 - lo2) ** 2)) AS distance, n1 + n2 AS size "
            f"FROM {part(a, 1)}, {part(b, 2)}")


ORACLES["linkage_table"] = over("feat", " UNION ALL ".join(
    f"SELECT {back}::bigint AS back, {r('distance', 1)} AS distance, size::bigint AS size FROM ({_ward(a, b)})"
    for back, a, b in ((2, "0", "3"), (1, "0, 3", "2"), (0, "0, 2, 3", "1"))))

ORACLES["ward_tree"] = over("feat", " UNION ALL ".join([*[
    f"SELECT {back}::bigint AS back, {r('distance', 3)} AS distance, size::bigint AS size FROM ({_ward(a, b)})"
    for back, a, b in ((2, "0", "3"), (1, "0, 3", "2"), (0, "0, 2, 3", "1"))],
    f"""SELECT -1::bigint, {r(WSS, 3)}, (SELECT count(*) - 1 FROM (SELECT DISTINCT latitude, longitude FROM feat))::bigint
    FROM (SELECT *, avg(latitude) OVER () AS la, avg(longitude) OVER () AS lo FROM feat)"""]))


def _stats(names: list[str]) -> str:
    return "SELECT cluster_id, count(*)::bigint AS rows, " + ", ".join(
        f"{r(f'avg({f})')} AS {f}_mean, {r(f'stddev_samp({f})')} AS {f}_std" for f in names) + " FROM labelled GROUP BY 1"


ORACLES["cluster_stats"] = over("located", _stats(["latitude", "longitude", "speed"]), LABELLED)
ORACLES["cluster_report"] = over(
    "located", f"SELECT c.*, s.silhouette FROM ({_stats(['latitude', 'longitude'])}) c, (SELECT {r('avg(s)')} AS silhouette FROM scores) s",
    LABELLED, *SCORES)

# -- regression --------------------------------------------------------------------------------------


def _solved(deviation: str) -> list[tuple[str, str]]:
    """Coefficients of three standardised features from their correlations (closed 3 x 3 inverse)."""
    return [
        ("m", f"""SELECT corr(q, d) AS a, corr(q, t) AS b, corr(d, t) AS c, corr(q, y) AS rq, corr(d, y) AS rd, corr(t, y) AS rt,
            {deviation}(y) AS sy, avg(y) AS my, avg(q) AS mq, avg(d) AS md, avg(t) AS mt, {deviation}(q) AS sq,
            {deviation}(d) AS sd, {deviation}(t) AS st FROM regress"""),
        ("fit", """SELECT *, ((1 - c * c) * rq + (b * c - a) * rd + (a * c - b) * rt) * sy / det AS wq,
            ((b * c - a) * rq + (1 - b * b) * rd + (a * b - c) * rt) * sy / det AS wd,
            ((a * c - b) * rq + (a * b - c) * rd + (1 - a * a) * rt) * sy / det AS wt
            FROM (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM m)"""),
    ]


def _table(bias: str = "my") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS feature, {r(e, 3)} AS coefficient FROM fit"
                              for n, e in (("q", "wq"), ("d", "wd"), ("t", "wt"), ("bias", bias)))


SAMPLE_FIT = _solved("stddev_samp")
ORACLES["linreg_ols"] = over("regress", _table(), *_solved("stddev_pop"))
ORACLES["linreg_exact"] = ORACLES["linreg_gd"] = over("regress", _table(), *SAMPLE_FIT)
ORACLES["linreg_origin"] = over("regress", _table("my - wq * mq - wd * md - wt * mt"), (
    "m", """SELECT sum(q * q) AS a, sum(q * d) AS b, sum(q * t) AS c, sum(d * d) AS e, sum(d * t) AS f, sum(t * t) AS g,
        sum(q * y) AS u, sum(d * y) AS v, sum(t * y) AS w, avg(y) AS my, avg(q) AS mq, avg(d) AS md, avg(t) AS mt FROM regress"""), (
    "fit", """SELECT *, ((e * g - f * f) * u + (c * f - b * g) * v + (b * f - c * e) * w) / det AS wq,
        ((c * f - b * g) * u + (a * g - c * c) * v + (b * c - a * f) * w) / det AS wd,
        ((b * f - c * e) * u + (b * c - a * f) * v + (a * e - b * b) * w) / det AS wt
        FROM (SELECT *, a * (e * g - f * f) - b * (b * g - c * f) + c * (b * f - c * e) AS det FROM m)"""))
PREDICTED = "(q - mq) / sq * wq + (d - md) / sd * wd + (t - mt) / st * wt + my"
ORACLES["linreg_mse"] = over("regress", f"SELECT {r(f'avg((y - ({PREDICTED})) ** 2)', 1)} AS mse FROM regress, fit", *SAMPLE_FIT)
ORACLES["linreg_residuals"] = over("regress", f"""SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, y, {r('p', 3)} AS prediction, {r('y - p', 3)} AS residual
    FROM (SELECT *, {PREDICTED} AS p FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, l_tax AS t, l_extendedprice AS y
    FROM lineitem), fit)""", *SAMPLE_FIT)
ORACLES["coef_importance"] = over("regress", f"""SELECT kind, number::bigint AS number, feature, {r('w', 3)} AS coefficient FROM (
    SELECT 'min_positive' AS kind, * FROM (SELECT * FROM ws WHERE w > 0 ORDER BY w, number LIMIT 1) UNION ALL
    SELECT 'max_positive', * FROM (SELECT * FROM ws WHERE w > 0 ORDER BY w DESC, number LIMIT 1) UNION ALL
    SELECT 'min_absolute', * FROM (SELECT * FROM ws ORDER BY abs(w), number LIMIT 1) UNION ALL
    SELECT 'max_absolute', * FROM (SELECT * FROM ws ORDER BY abs(w) DESC, number LIMIT 1))""", *SAMPLE_FIT, (
    "ws", "SELECT 1 AS number, 'q' AS feature, wq AS w FROM fit UNION ALL SELECT 2, 'd', wd FROM fit UNION ALL SELECT 3, 't', wt FROM fit"))
ORACLES["regression_overlay"] = over("regress", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, y AS target, {r(PREDICTED, 3)} AS prediction, {r(f'({f} - m{f}) / s{f}', 3)} AS x, {r(f'({f} - m{f}) / s{f} * w{f} + my', 3)} AS line FROM regress, fit"
    for f in "qdt"), *SAMPLE_FIT)
TAIL = "sqrt(-2.0::double * ln(least(p, 1 - p)))"
ORACLES["probability_plot"] = over("regress", f"""SELECT rank, ordered, {r("CASE WHEN p < 0.5 THEN -x ELSE x END")} AS theoretical FROM (
    SELECT *, k - (2.515517::double + 0.802853::double * k + 0.010328::double * k * k)
      / (1 + 1.432788::double * k + 0.189269::double * k * k + 0.001308::double * k * k * k) AS x FROM (SELECT *, {TAIL} AS k FROM (
    SELECT rank, y AS ordered, CASE WHEN rank = n THEN 0.5::double ** (1.0::double / n) WHEN rank = 1 THEN 1 - 0.5::double ** (1.0::double / n)
      ELSE (rank - 0.3175::double) / (n + 0.365::double) END AS p FROM (SELECT y, row_number() OVER (ORDER BY y)::bigint AS rank,
      count(*) OVER () AS n FROM regress))))""")

# -- sequences, sensors -------------------------------------------------------------------------------------------
ORACLES["sequence_windows"] = over("merge_all", f"""SELECT rental_id, w::bigint AS "window", count(*)::bigint AS length,
    {r('sum(latitude)')} AS latitude, {r('sum(longitude)')} AS longitude FROM (
    SELECT *, unnest(generate_series(greatest(0, rw - 11), least(rw, greatest(n - 12, 0)))) AS w FROM numbered)
    GROUP BY rental_id, w""", _numbered("rental_id", "merge_all"))
ORACLES["label_positions"] = over("segs", """SELECT rental_id, pos_id AS id, (dense_rank() OVER (ORDER BY rental_id, timedelta_id))::bigint AS timedelta_id,
    rental_id % 7 AS cluster_id FROM segs WHERE rental_id % 7 <> 3""")
LONG = "CASE WHEN num BETWEEN 1 AND 9 THEN true WHEN num BETWEEN 11 AND 16 THEN false END"
SLOTS = ", ".join(f"s{i}" for i in range(12))
TRIALS = f"{SLOTS}, {LONG} AS is_long, subject, kind AS trial_type, num AS trial_number"
ORACLES["sensor_trials"] = over("sensor", f"SELECT {TRIALS} FROM sensor")
ORACLES["trial_flags"] = over("sensor", f"""SELECT kind AS trial_type, num AS trial_number, {LONG} AS is_long, count(*)::bigint AS rows
    FROM sensor GROUP BY 1, 2, 3""")
ORACLES["subject_mask"] = over("sensor", f"""SELECT {TRIALS} FROM sensor JOIN (SELECT kind, num,
    ((row_number() OVER (ORDER BY kind, num) - 1) * 5) % 24 + 1 AS chosen FROM (SELECT DISTINCT kind, num FROM sensor))
    USING (kind, num) WHERE subject = chosen""")
ORACLES["sensor_subject_join"] = over("sensor", f"""SELECT s0, {LONG} AS is_long, subject, kind AS trial_type, num AS trial_number,
    {r('60 + abs(c_acctbal) / 200')} AS weight, (150 + c_nationkey)::double AS height, (20 + c_nationkey)::double AS age,
    (c_custkey % 2)::bigint AS gender FROM sensor JOIN customer ON c_custkey = subject""")
ORACLES["sensor_correlation"] = over("sensor", _correlations([f"s{i}" for i in range(12)]).format(src="sensor"))

# -- plot tables ---------------------------------------------------------------------------------------------


def _histogram(bins: int, by: str = "") -> tuple[str, list[tuple[str, str]]]:
    lead = f"{by}, " if by else ""
    body = f"""SELECT {lead}"column", bin, {r('any_value(lo) + bin * any_value(w)')} AS low, {r('any_value(lo) + (bin + 1) * any_value(w)')} AS high,
        count(*)::bigint AS count, {r('count(*) / (any_value(n) * any_value(w))')} AS density FROM binned GROUP BY {lead}"column", bin"""
    return body, [("ranged", f"""SELECT *, min(value) OVER k AS lo, count(*) OVER k AS n, (max(value) OVER k - min(value) OVER k) / {bins} AS w
        FROM vals WINDOW k AS (PARTITION BY "column")"""),
        ("binned", f"SELECT *, least(floor((value - lo) / w), {bins - 1})::bigint AS bin FROM ranged")]


BODY, STEPS = _histogram(50)
ORACLES["histogram"] = over("merge_all", BODY, (
    "vals", union_columns("merge_all", [(c, c) for c in ("latitude", "longitude", "speed")])), *STEPS)
BODY, STEPS = _histogram(30, "region")
ORACLES["joint_marginals"] = over("located", BODY, ("placed", "SELECT * FROM located WHERE region IS NOT NULL"), (
    "vals", union_columns("placed", [(c, c) for c in ("longitude", "latitude")], "region")), *STEPS)
CELL = lambda c: f"least(floor(({c} - min({c}) OVER ()) / ((max({c}) OVER () - min({c}) OVER ()) / 50)), 49)::bigint"
GRID = ("cells", f"""SELECT xi, yi, count(*)::bigint AS count FROM (SELECT {CELL('longitude')} AS xi, {CELL('latitude')} AS yi
    FROM merge_all) GROUP BY 1, 2""")
ORACLES["density_grid"] = over("merge_all", "SELECT * FROM cells", GRID)
KERNEL = lambda t, c, s, h: f"exp(-0.5 * (({t} - {c}) * {s} / {h}) ** 2) / ({h} * sqrt(2 * pi()))"
ORACLES["kernel_density"] = over("merge_all", f"""SELECT gx.g AS xi, gy.g AS yi,
    {r(f"sum(count * {KERNEL('gx.g', 'xi', 'sx', 'hx')} * {KERNEL('gy.g', 'yi', 'sy', 'hy')}) / any_value(n)")} AS density
    FROM cells, (SELECT unnest(generate_series(0, 49))::bigint AS g) gx, (SELECT unnest(generate_series(0, 49))::bigint AS g) gy,
    (SELECT count(*) AS n, (max(longitude) - min(longitude)) / 50 AS sx, (max(latitude) - min(latitude)) / 50 AS sy,
      stddev_samp(longitude) * count(*) ** (-1.0::double / 6) AS hx, stddev_samp(latitude) * count(*) ** (-1.0::double / 6) AS hy
      FROM merge_all) s GROUP BY 1, 2""", GRID)


def _lines(keys: str, source: str = "segs") -> str:
    return f"""SELECT {keys}, 0::bigint AS part, count(*)::bigint AS n, {r('sum(k * (longitude + 2 * latitude))')} AS line
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY server_time, device_time, pos_id) AS k FROM {source}) GROUP BY {keys}"""


ORACLES["polylines"] = over("segs", _lines("rental_id, timedelta_id"))
ORACLES["label_lines_3d"] = over("segs", f"SELECT *, timedelta_id::double AS z FROM ({_lines('rental_id, timedelta_id')})")
ORACLES["facet_lines"] = over("segs", _lines("rental_id, timedelta_id"))
ORACLES["region_lines"] = over("segs", _lines("region, rental_id, timedelta_id",
                                              f"(SELECT * FROM (SELECT *, {REGION} AS region FROM segs) WHERE region IS NOT NULL)"))
ORACLES["map_layer"] = over("segs", f"""SELECT {r('latitude + 1.2::double', 9)} AS latitude, {r('longitude - 1.2::double', 9)} AS longitude,
    timedelta_id, server_time, speed FROM segs""")
ORACLES["map_centre"] = over("merge_all", f"SELECT {r('avg(latitude)')} AS latitude, {r('avg(longitude)')} AS longitude FROM merge_all")
ORACLES["feature_target_points"] = over("regress", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f}::double AS x, y AS target FROM regress" for f in "qdt"))
CITIES = ("cities", f"SELECT *, min(pos_id) OVER (PARTITION BY {CITY}) AS cluster_id FROM merge_all WHERE {POS_BOX}")
EXAM = "(SELECT unnest(['k-means', 'mean-shift', 'ward-agglomerative']) AS method)"
ORACLES["cluster_lines"] = over("merge_all", f"SELECT 'all' AS scope, * FROM {EXAM}, ({_lines('rental_id, cluster_id', 'cities')})", CITIES)
ORACLES["cluster_summary"] = over(
    "merge_all", f"SELECT 'all' AS scope, * FROM {EXAM}, ({_stats(['latitude', 'longitude', 'speed']).replace('labelled', 'cities')})", CITIES)
WINDOWS = """(SELECT rental_id, CASE WHEN n < 2 THEN 0 WHEN n <= 12 THEN 1 ELSE ceil((n - 12) / 6.0::double)::bigint + 1 END AS windows
    FROM (SELECT rental_id, count(*) AS n FROM merge_all GROUP BY 1))"""
ORACLES["generated_roundtrip"] = over("segs", f"""SELECT s.rental_id, pos_id AS id, timedelta_id, time_gap, start_time, stop_time, rental_km, windows
    FROM segs s JOIN {WINDOWS} w ON w.rental_id = s.rental_id WHERE windows > 0""")
ORACLES["stream_chunks"] = MERGED
ORACLES["pipeline_run"] = over("segs", f"""SELECT pos_id AS id, rental_id, timedelta_id, time_gap, spreaddelta_id, edgedelta_id, coorddelta_id, windows
    FROM segs JOIN ({spread_rounds()}) USING (rental_id) JOIN ({box_rounds('edgedelta_id', False)}) USING (rental_id)
    JOIN ({box_rounds('coorddelta_id', True)}) USING (rental_id) JOIN {WINDOWS} USING (rental_id) WHERE windows > 0""")
ORACLES["broken_input"] = over("pos rental usr device", """SELECT rental_id, id, latitude, NOT (first IS NULL OR last IS NULL) AS grouped FROM (
    SELECT *, first_value(latitude) OVER w AS first, last_value(latitude) OVER w AS last FROM (
      SELECT r.id AS rental_id, p.id, CASE WHEN p.id % 7 <> 0 THEN latitude END AS latitude, server_time, device_time FROM rental r
      JOIN pos p ON p.device_id = r.device_id AND greatest(p.server_time, p.device_time) <= CASE WHEN r.id % 4 = 1 THEN TIMESTAMP '9999-12-31' ELSE stop_time END
        AND least(p.server_time, p.device_time) >= start_time
      JOIN usr u ON u.id = r.user_id JOIN device d ON d.id = r.device_id)
    WINDOW w AS (PARTITION BY rental_id ORDER BY server_time, device_time, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""")
ORACLES["stream_segments"] = ORACLES["timedelta_fixed"]
ORACLES["stream_open_end"] = over("pos rental usr device", """SELECT r.id AS rental_id, p.id AS pos_id, year(stop)::bigint AS stop_year, latitude
    FROM (SELECT *, CASE WHEN id % 4 = 1 THEN TIMESTAMP '9999-12-31' ELSE stop_time END AS stop FROM rental) r
    JOIN pos p ON p.device_id = r.device_id AND p.server_time BETWEEN r.start_time AND r.stop AND p.device_time BETWEEN r.start_time AND r.stop
    JOIN usr u ON u.id = r.user_id JOIN device d ON d.id = r.device_id""")
ORACLES["remembered_tables"] = over("merge_all", " UNION ALL ".join(
    f"SELECT {call}::bigint AS call, {made} AS made, count(*) AS rows, sum(pos_id)::bigint AS ids FROM merge_all WHERE rental_km < {km}"
    for call, made, km in ((0, "true", 1.0), (1, "false", 1.0), (2, "true", 3.0))))
HOLLOW = ",".join(sorted(["timedelta_id", "spreaddelta_id", "edgedelta_id", "coorddelta_id", "time_gap", *SPREADS, *EDGES]))
ORACLES["state_checks"] = over("segs", " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS rows, count(*) = 0 AS empty, coalesce(bool_or({holes}), false) AS any_null, "
    f"CASE WHEN coalesce(bool_or({holes}), false) THEN '{columns}' ELSE '' END AS columns FROM segs WHERE {where}"
    for name, holes, columns, where in (
        ("generated", "true", HOLLOW, "true"),
        ("segmented", "timedelta_id IS NULL OR latitude IS NULL OR time_gap IS NULL", "", "true"),
        ("holes", "pos_id % 7 = 0", "speed", "true"), ("outside", "true", "", "latitude > 90"))))
SHAPE = [("id", "bigint"), ("rental_id", "bigint"), ("timedelta_id", "bigint"), ("spreaddelta_id", "bigint"), ("edgedelta_id", "bigint"),
         ("coorddelta_id", "bigint"), ("latitude", "double"), ("longitude", "double"), ("spread_latitude", "double"),
         ("spread_longitude", "double"), ("edge_latitude_start", "double"), ("edge_latitude_stop", "double"),
         ("edge_longitude_start", "double"), ("edge_longitude_stop", "double"), ("speed", "double"),
         ("server_time", "timestamp_ntz"), ("device_time", "timestamp_ntz"), ("time_gap", "double")]
ORACLES["table_shape"] = over("merge_all", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, {i} AS position, count(*) AS rows FROM merge_all" for i, (c, t) in enumerate(SHAPE)))
