"""DuckDB text of the trajectory views and helpers to put a query on top of them."""

from __future__ import annotations

LAT = "CASE user_id % 4 WHEN 0 THEN 44.24::double WHEN 1 THEN 43.86::double WHEN 2 THEN 42.76::double ELSE 42.48::double END"
LON = "CASE user_id % 4 WHEN 0 THEN 12.19::double WHEN 1 THEN 8.87::double WHEN 2 THEN 13.94::double ELSE 11.79::double END"
KEYS12 = ("rental_id, device_id, device_km, user_id, usr_km, latitude_start, longitude_start, latitude_stop, "
          "longitude_stop, start_time, stop_time, rental_km")
MERGE18 = KEYS12 + ", pos_id, latitude, longitude, speed, server_time, device_time"
EDGES = ["edge_latitude_start", "edge_longitude_start", "edge_latitude_stop", "edge_longitude_stop"]
SPREADS = ["spread_latitude", "spread_longitude"]
FEATURES = ["latitude", "longitude", "spread_latitude", "spread_longitude",
            "edge_latitude_start", "edge_latitude_stop", "edge_longitude_start", "edge_longitude_stop"]
POS_BOX = "longitude > 8 AND longitude < 15 AND latitude > 42 AND latitude < 45"

BASE = {
    "pos": f"""SELECT event_id AS id, {LAT} + ((event_id * 37) % 1000 - 500) / 100000.0::double AS latitude,
        {LON} + ((event_id * 53) % 1000 - 500) / 100000.0::double AS longitude, value / 10.0::double AS speed,
        ts AS server_time, ts - (event_id % 5) * INTERVAL 1 SECOND AS device_time, user_id AS device_id FROM events""",
    "pos_outliers": "SELECT * REPLACE (CASE WHEN id % 97 = 0 THEN latitude + 5.0::double ELSE latitude END AS latitude) FROM pos",
    "rental": f"""SELECT user_id * 10 + half AS id, user_id AS device_id, user_id,
        {LAT} - 0.001::double AS latitude_start, {LON} - 0.001::double AS longitude_start,
        {LAT} + 0.001::double AS latitude_stop, {LON} + 0.001::double AS longitude_stop,
        TIMESTAMP '2024-01-01 06:00:00' + (15 * half) * INTERVAL 1 DAY AS start_time,
        TIMESTAMP '2024-01-15 18:00:00' + (15 * half) * INTERVAL 1 DAY AS stop_time,
        ((user_id * 10 + half) % 50) / 10.0::double AS km
        FROM (SELECT DISTINCT user_id, least(1, (day(ts) - 1) // 15)::bigint AS half FROM events)""",
    "device": "SELECT c_custkey AS id, c_acctbal AS km FROM customer WHERE c_custkey % 13 <> 12",
    "usr": "SELECT c_custkey AS id, c_acctbal AS km FROM customer WHERE c_custkey % 17 <> 16",
    "merge_all": """SELECT r.id AS rental_id, r.device_id, d.km AS device_km, r.user_id, u.km AS usr_km, r.latitude_start,
        r.longitude_start, r.latitude_stop, r.longitude_stop, r.start_time, r.stop_time, r.km AS rental_km,
        p.id AS pos_id, p.latitude, p.longitude, p.speed, p.server_time, p.device_time
        FROM rental r JOIN pos p ON p.device_id = r.device_id
         AND p.server_time BETWEEN r.start_time AND r.stop_time AND p.device_time BETWEEN r.start_time AND r.stop_time
        JOIN usr u ON u.id = r.user_id JOIN device d ON d.id = r.device_id""",
    "gaps": """SELECT *, coalesce(date_diff('microsecond', lag(server_time) OVER w, server_time), 0)::bigint AS sg,
        coalesce(date_diff('microsecond', lag(device_time) OVER w, device_time), 0)::bigint AS dg
        FROM merge_all WINDOW w AS (PARTITION BY rental_id ORDER BY server_time, device_time, pos_id)""",
    "flags": """SELECT *, sg >= avg(sg) OVER k + coalesce(stddev_samp(sg) OVER k, 0)
          AND dg >= avg(dg) OVER k + coalesce(stddev_samp(dg) OVER k, 0) AS flag,
        (floor(sg / 1000.0::double) + floor(dg / 1000.0::double)) / 2.0::double AS time_gap
        FROM gaps WINDOW k AS (PARTITION BY rental_id)""",
    "turns": """SELECT *, lag(flag) OVER w AS pflag FROM flags
        WINDOW w AS (PARTITION BY rental_id ORDER BY server_time, device_time, pos_id)""",
    "segs": """SELECT *, (sum(CASE WHEN pflag IS NULL OR pflag <> flag THEN 1 ELSE 0 END) OVER (
        PARTITION BY rental_id ORDER BY server_time, device_time, pos_id ROWS UNBOUNDED PRECEDING))::bigint AS timedelta_id
        FROM turns""",
    "ends": """SELECT rental_id, latitude AS la, longitude AS lo,
        row_number() OVER (PARTITION BY rental_id ORDER BY server_time, device_time, pos_id) AS f,
        row_number() OVER (PARTITION BY rental_id ORDER BY server_time DESC, device_time DESC, pos_id DESC) AS b
        FROM merge_all""",
    "edges": """SELECT rental_id, max(la) FILTER (f = 1) AS edge_latitude_start, max(lo) FILTER (f = 1) AS edge_longitude_start,
        max(la) FILTER (b = 1) AS edge_latitude_stop, max(lo) FILTER (b = 1) AS edge_longitude_stop FROM ends GROUP BY 1""",
    "groups": """SELECT e.*, m.* EXCLUDE (rental_id) FROM edges e JOIN (SELECT rental_id, count(*)::bigint AS n,
        max(latitude) - min(latitude) AS spread_latitude, max(longitude) - min(longitude) AS spread_longitude,
        avg(latitude) AS ml, avg(longitude) AS mo, coalesce(stddev_samp(latitude), 0) AS dl,
        coalesce(stddev_samp(longitude), 0) AS dlo FROM merge_all GROUP BY 1) m USING (rental_id)""",
    "feat": f"""SELECT m.rental_id, m.pos_id, m.latitude, m.longitude, g.spread_latitude, g.spread_longitude,
        {', '.join('g.' + e for e in EDGES)} FROM merge_all m JOIN groups g USING (rental_id) WHERE {POS_BOX}""",
    "located": """SELECT *, CASE WHEN latitude >= 43 AND latitude < 44.3 AND longitude >= 12 THEN 'N-E'
        WHEN latitude >= 43 AND latitude < 44.3 AND longitude > 8 AND longitude < 10 THEN 'N-W'
        WHEN latitude < 43 AND longitude >= 13 AND longitude < 14.2 THEN 'S-E'
        WHEN latitude < 43 AND longitude > 11.7 AND longitude < 13 THEN 'S-W' END AS region FROM merge_all""",
    "regress": "SELECT l_quantity AS q, l_discount AS d, l_tax AS t, l_extendedprice AS y FROM lineitem",
    "sensor": "SELECT vec_id, " + ", ".join(f"embedding[{i + 1}]::double AS s{i}" for i in range(12)) + """,
        (vec_id % 24 + 1)::bigint AS subject, chr((97 + label % 6)::int) || 'ws' AS kind, (vec_id % 16 + 1)::bigint AS num FROM embeddings""",
}
# A view pulls in the ones it reads.
NEEDS = {
    "pos_outliers": ["pos"], "merge_all": ["pos", "rental", "device", "usr"], "gaps": ["merge_all"], "flags": ["gaps"],
    "turns": ["flags"], "segs": ["turns"], "ends": ["merge_all"], "edges": ["ends"], "groups": ["edges", "merge_all"],
    "feat": ["merge_all", "groups"], "located": ["merge_all"],
}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in seen:
            seen.append(name)

    for name in names:
        visit(name)
    return seen


def over(names: str, body: str, *extra: tuple[str, str], recursive: str = "") -> str:
    """``WITH <views>, <extra views> <body>``."""
    ctes = [f"{n} AS ({BASE[n]})" for n in _order(names.split())] + [f"{n} AS ({s})" for n, s in extra]
    if recursive:
        ctes.append(recursive)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + body


def r(x: str, digits: int = 6) -> str:
    """Round alike in both engines: a tiny offset keeps exact halves from falling on different sides."""
    return f"(round(({x}) + 3.3e-{digits + 3}::double, {digits}) + 0.0::double)"


def union_columns(source: str, columns: list[tuple[str, str]], by: str = "") -> str:
    """Long form: one (by, column, value) row per value."""
    lead = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{n}' AS \"column\", ({e})::double AS value FROM {source} WHERE ({e}) IS NOT NULL" for n, e in columns)


def spread_rounds(limit: int | None = None) -> str:
    stop = f" AND i < {limit}" if limit else ""
    return over("groups", """SELECT g.rental_id, g.spread_latitude, g.spread_longitude, coalesce(s.i, 0)::bigint AS spreaddelta_id
        FROM groups g LEFT JOIN (SELECT rental_id, i FROM st WHERE hit) s USING (rental_id)""", recursive=f"""
    st(i, rental_id, a, b, hit) AS (
      SELECT 0::bigint, rental_id, spread_latitude, spread_longitude, false FROM groups
      UNION ALL
      SELECT i + 1, rental_id, a, b, a BETWEEN ca - sa * 0.25 AND ca + sa * 0.25 AND b BETWEEN cb - sb * 0.25 AND cb + sb * 0.25
      FROM (SELECT *, first_value(a) OVER w AS ca, first_value(b) OVER w AS cb
        FROM (SELECT *, abs(a - avg(a) OVER ()) + abs(b - avg(b) OVER ()) AS d, coalesce(stddev_samp(a) OVER (), 0) AS sa,
                coalesce(stddev_samp(b) OVER (), 0) AS sb FROM st WHERE NOT hit{stop})
        WINDOW w AS (ORDER BY d, rental_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)))""")


def box_rounds(name: str, with_spread: bool, limit: int | None = None, edge_delta: float | None = None,
               spread_delta: float | None = None) -> str:
    measures = EDGES + (SPREADS if with_spread else [])
    cols = ", ".join(measures)
    stop = f" AND i < {limit}" if limit else ""
    votes = "merge_all" if with_spread else "copies"
    copies = ("copies", f"""SELECT min(rental_id) AS rental_id, pos_id, latitude, longitude
        FROM merge_all JOIN edges USING (rental_id)
        GROUP BY pos_id, latitude, longitude, speed, server_time, device_time, {', '.join(EDGES)}""")

    def half(m: str) -> str:
        if m in SPREADS:
            return f"{spread_delta!r}::double" if spread_delta is not None else f"coalesce(sd_{m}, 0) * 0.25"
        return f"{edge_delta!r}::double" if edge_delta is not None else f"coalesce(sd_{m}, 0) * 2.0"

    dist = " + ".join(f"abs({e} - av_{e})" for e in EDGES)
    inside = " AND ".join(f"{m} BETWEEN c_{m} - {half(m)} AND c_{m} + {half(m)}" for m in measures)
    shown = "" if with_spread else ", " + ", ".join("g." + e for e in EDGES)
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return over("groups", f"""SELECT g.rental_id{shown}, coalesce(s.i, 0)::bigint AS {name}
        FROM groups g LEFT JOIN (SELECT rental_id, i FROM st WHERE hit) s USING (rental_id)""", copies, recursive=f"""
    st(i, rental_id, n, ml, mo, dl, dlo, {cols}, prio, lastp, hit) AS (
      SELECT 0::bigint, rental_id, n, ml, mo, dl, dlo, {cols}, md5('42:' || rental_id), '', false FROM groups
      UNION ALL
      SELECT DISTINCT i + 1, rental_id, n, ml, mo, dl, dlo, {cols}, prio, sp, {inside}
      FROM (SELECT *, {', '.join(f'first_value({m}) OVER w AS c_{m}' for m in measures)}
        FROM (SELECT *, {dist} AS d FROM (
          SELECT o.*, p.pos_id, {', '.join(f'avg({e}) FILTER (p.pos_id IS NOT NULL) OVER () AS av_{e}' for e in EDGES)},
            {', '.join(f'stddev_samp({m}) FILTER (p.pos_id IS NOT NULL) OVER () AS sd_{m}' for m in measures)}
          FROM (SELECT *, first_value(ml) OVER s AS sl, first_value(mo) OVER s AS so, first_value(dl) OVER s AS tl,
                  first_value(dlo) OVER s AS tlo FROM (
              SELECT *, coalesce(CASE WHEN i = 0 THEN min(prio) FILTER (n > 1) OVER () ELSE min(prio) FILTER (prio > lastp) OVER () END,
                min(prio) OVER ()) AS sp FROM st WHERE NOT hit{stop})
                WINDOW s AS (ORDER BY CASE WHEN prio = sp THEN 0 ELSE 1 END {frame})) o
          LEFT JOIN {votes} p ON p.rental_id = o.rental_id AND p.latitude BETWEEN sl - 2 * tl AND sl + 2 * tl
            AND p.longitude BETWEEN so - 2 * tlo AND so + 2 * tlo))
        WINDOW w AS (ORDER BY CASE WHEN pos_id IS NULL THEN 1 ELSE 0 END, d, rental_id {frame})))""")
