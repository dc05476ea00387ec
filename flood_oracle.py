"""DuckDB statements giving the expected result of each registered query, built from named WITH terms."""

from __future__ import annotations

from inundation import fixtures as fx
from inundation.functions.grid import EARTH_RADIUS_M, METERS_PER_DEGREE, STEP_DEG
from inundation.operators.terrain import DEM_STEP_DEG

S = repr(STEP_DEG)
D = repr(DEM_STEP_DEG)
LON = f"((x + 0.5) * {S} - 180.0)"
LAT = f"(90.0 - (y + 0.5) * {S})"
AREA = f"(2.0 * {EARTH_RADIUS_M!r} * {EARTH_RADIUS_M!r} * radians({S}) * sin(radians({S}) / 2) * cos(radians({LAT})))"


def _edges(rings, source: str, key: str) -> str:
    parts = []
    for r, ring in enumerate(rings):
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
            parts.append(
                f"SELECT {key} AS event_id, {r} AS ring, {fx.lon_sql(ax)} AS lon1, {fx.lat_sql(ay)} AS lat1, "
                f"{fx.lon_sql(bx)} AS lon2, {fx.lat_sql(by)} AS lat2 FROM {source}"
            )
    return " UNION ALL ".join(parts)


def _inside(edges: str) -> str:
    return (
        f"SELECT e.event_id, c.x, c.y FROM cells c JOIN {edges} e ON (e.lat1 > c.lat) <> (e.lat2 > c.lat) "
        "AND c.lon < (e.lon2 - e.lon1) * (c.lat - e.lat1) / (e.lat2 - e.lat1) + e.lon1 "
        "GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1"
    )


def _matched(scope: str, scenes: str, days: int) -> str:
    return (
        f"SELECT e.event_id, CASE WHEN r.acquired_at < e.event_ts THEN 'pre' ELSE 'post' END AS side, r.scene_id, "
        f"CASE WHEN r.acquired_at < e.event_ts THEN e.event_ts - r.acquired_at ELSE r.acquired_at - e.event_ts END AS gap "
        f"FROM events_{scope} e JOIN {scenes} r ON r.acquired_at >= e.event_ts - INTERVAL {days} DAY "
        f"AND r.acquired_at < e.event_ts + INTERVAL {days} DAY AND e.has_area"
    )


STATUS = (
    "CASE WHEN NOT has_area THEN 'no_area' WHEN n_scenes < 2 THEN 'too_few_scenes' WHEN n_pre = 0 THEN 'no_pre_scene' "
    "WHEN n_post = 0 THEN 'no_post_scene' ELSE 'ok' END AS status"
)


def _coverage(matched: str, events: str) -> str:
    return (
        f"SELECT event_id, n_scenes, n_pre, n_post, {STATUS} FROM (SELECT e.event_id, any_value(e.has_area) AS has_area, count(m.scene_id) AS n_scenes, "
        "count(*) FILTER (WHERE m.side = 'pre') AS n_pre, count(*) FILTER (WHERE m.side = 'post') AS n_post "
        f"FROM {events} e LEFT JOIN {matched} m ON m.event_id = e.event_id GROUP BY 1) c"
    )


def _histogram(values: str, by: str) -> str:
    """Buckets of column ``v`` per ``by``."""
    return f"""
SELECT {by}, width, CAST(floor(v / width) AS BIGINT) AS bucket, count(*) AS n, sum(v) AS total, sum(v) / count(*) AS mean
FROM (SELECT * FROM {values} WHERE v IS NOT NULL) a JOIN (
  SELECT {by}, CASE WHEN floor(hi / w) - floor(lo / w) + 1 > 256 THEN 2 * w ELSE w END AS width
  FROM (SELECT {by}, lo, hi,
          CASE WHEN hi > lo THEN pow(2.0, ceil(log2(greatest(hi - lo, 1e-300) / 256) - 1e-9)) ELSE 1.0 END AS w
        FROM (SELECT {by}, min(v) AS lo, max(v) AS hi FROM {values} WHERE v IS NOT NULL GROUP BY {by}) r) q
) wd USING ({by})
GROUP BY {by}, width, bucket"""


def _curve(hist: str, by: str) -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY sigma_b2 DESC, bucket) = 1 AS is_threshold
FROM (SELECT {by}, bucket, width, n, mean,
        pow(mu_all * omega - mu, 2) / (omega * (1 - omega) + 1e-10) AS sigma_b2
      FROM (SELECT *, sum(n) OVER f / sum(n) OVER a AS omega, sum(total) OVER f / sum(n) OVER a AS mu,
              sum(total) OVER a / sum(n) OVER a AS mu_all
            FROM {hist}
            WINDOW a AS (PARTITION BY {by}), f AS (PARTITION BY {by} ORDER BY bucket ROWS UNBOUNDED PRECEDING)) u) v"""


NDWI = "CASE WHEN {0}B3 + {0}B8 = 0 THEN CAST(0 AS DOUBLE) ELSE ({0}B3 - {0}B8) / ({0}B3 + {0}B8) END"


def _scope_terms(s: str) -> dict[str, tuple[str, list[str]]]:
    if s == "main":
        base = {
            "events_main": (f"SELECT CAST(0 AS BIGINT) AS event_id, TIMESTAMP '{fx.EVENT_DATE}' AS event_ts, true AS has_area", []),
            "edges_main": (_edges(fx.main_rings(), "dims", "0"), ["dims"]),
            "oedges_main": (_edges(fx.main_rings(fx.MAIN_OTSU_RINGS), "dims", "0"), ["dims"]),
        }
    else:
        base = {
            "events_sites": (
                f"SELECT event_id, TIMESTAMP '{fx.EVENT_DATE}' + to_days(day_offset) AS event_ts, {fx.SITE_HAS_AREA} AS has_area FROM sites",
                ["sites"],
            ),
            "edges_sites": (_edges(fx.SITE_RINGS, f"(SELECT * FROM sites WHERE {fx.SITE_HAS_AREA}) s", "event_id"), ["sites"]),
            "oedges_sites": ("SELECT * FROM edges_sites", ["edges_sites"]),
        }
    both = lambda f: ", ".join(f(side) for side in ("pre", "post"))
    masked = both(
        lambda q: ", ".join(
            f"CASE WHEN same_count OR (pre_{b} IS NOT NULL AND post_{b} IS NOT NULL) THEN {q}_{b} END AS {q}_{b}"
            for b in ("VV", "VH")
        )
    )
    stacked = "SELECT event_id, 'pre' AS side, pre_VH AS v FROM {0} UNION ALL SELECT event_id, 'post', post_VH FROM {0}"
    flood = "CASE WHEN water_post - water_pre > 0 THEN 1 END AS flood"

    def refined(n):
        return (
            f"SELECT f.event_id, f.x, f.y FROM (SELECT *, floor(({LON} + 180.0) / {D}) AS gx, floor((90.0 - {LAT}) / {D}) AS gy "
            f"FROM big{n}_{s}) f JOIN slope USING (gx, gy) WHERE slope_deg < 5",
            [f"big{n}_{s}", "slope"],
        )

    def big(n):
        return (
            f"SELECT c.event_id, c.x, c.y FROM cc{n}_{s} c JOIN (SELECT event_id, label, count(*) AS size FROM cc{n}_{s} "
            "GROUP BY 1, 2) z USING (event_id, label) WHERE z.size >= 8",
            [f"cc{n}_{s}"],
        )

    return base | {
        f"inside_{s}": (_inside(f"edges_{s}"), [f"edges_{s}", "cells"]),
        f"oinside_{s}": (_inside(f"oedges_{s}"), [f"oedges_{s}", "cells"]),
        f"m1_{s}": (_matched(s, "rs", 12), [f"events_{s}", "rs"]),
        f"cov1_{s}": (_coverage(f"m1_{s}", f"events_{s}"), [f"m1_{s}", f"events_{s}"]),
        f"picks1_{s}": (
            f"SELECT event_id, side, scene_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id, side ORDER BY gap, "
            f"scene_id) AS rn FROM m1_{s}) t JOIN cov1_{s} USING (event_id) WHERE rn = 1 AND status = 'ok'",
            [f"m1_{s}", f"cov1_{s}"],
        ),
        f"sm_{s}": (
            "SELECT k.event_id, k.side, c.x, c.y, sum(p.VV) / count(p.VV) AS VV, sum(p.VH) / count(p.VH) AS VH "
            f"FROM inside_{s} c JOIN picks1_{s} k ON k.event_id = c.event_id CROSS JOIN offs o "
            "JOIN s1_px p ON p.scene_id = k.scene_id AND p.x = c.x + o.ox AND p.y = c.y + o.oy GROUP BY 1, 2, 3, 4",
            [f"inside_{s}", f"picks1_{s}", "offs", "s1_px"],
        ),
        f"pair1_{s}": (
            "SELECT event_id, x, y, "
            + both(lambda q: ", ".join(f"max({b}) FILTER (WHERE side = '{q}') AS {q}_{b}" for b in ("VV", "VH")))
            + f" FROM sm_{s} GROUP BY 1, 2, 3 HAVING count(VV) + count(VH) > 0",
            [f"sm_{s}"],
        ),
        f"cnt1_{s}": (
            "SELECT event_id, count(pre_VV) AS pre_px, count(post_VV) AS post_px, count(pre_VV) = count(post_VV) AS same_count "
            f"FROM pair1_{s} GROUP BY 1",
            [f"pair1_{s}"],
        ),
        f"cm1_{s}": (
            f"SELECT event_id, x, y, {masked} FROM pair1_{s} JOIN cnt1_{s} USING (event_id)",
            [f"pair1_{s}", f"cnt1_{s}"],
        ),
        f"ov_{s}": (
            "SELECT event_id || ':' || side AS k, v FROM (" + stacked.format(f"(cm1_{s} SEMI JOIN oinside_{s} USING (event_id, x, y))") + ")",
            [f"cm1_{s}", f"oinside_{s}"],
        ),
        f"oh_{s}": (_histogram(f"ov_{s}", "k"), [f"ov_{s}"]),
        f"oc_{s}": (_curve(f"oh_{s}", "k"), [f"oh_{s}"]),
        f"thr_{s}": (
            "SELECT event_id, "
            + both(
                lambda q: f"coalesce((SELECT max(mean) FROM oc_{s} c WHERE c.is_threshold AND c.k = e.event_id || ':{q}'), -20.0) "
                f"AS threshold_{q}"
            )
            + f", (SELECT count(*) FROM oc_{s} c WHERE c.is_threshold AND c.k IN (e.event_id || ':pre', e.event_id || ':post')) < 2 "
            f"AS threshold_defaulted FROM cov1_{s} e WHERE status = 'ok'",
            [f"oc_{s}", f"cov1_{s}"],
        ),
        f"det1_{s}": (
            f"SELECT *, {flood} FROM (SELECT event_id, x, y, CAST(pre_VH < threshold_pre AS INT) AS water_pre, "
            f"CAST(post_VH < threshold_post AS INT) AS water_post FROM cm1_{s} JOIN thr_{s} USING (event_id)) t",
            [f"cm1_{s}", f"thr_{s}"],
        ),
        f"m2_{s}": (_matched(s, "(SELECT * FROM rs WHERE cloudy_pixel_percentage < 30)", 20), [f"events_{s}", "rs"]),
        f"cov2_{s}": (_coverage(f"m2_{s}", f"events_{s}"), [f"m2_{s}", f"events_{s}"]),
        f"med_{s}": (
            "SELECT c.event_id, c.x, c.y, "
            + both(lambda q: ", ".join(f"median({b}) FILTER (WHERE m.side = '{q}') AS {q}_{b}" for b in ("B3", "B8")))
            + f" FROM inside_{s} c JOIN m2_{s} m ON m.event_id = c.event_id JOIN cov2_{s} v ON v.event_id = c.event_id AND v.status = 'ok' "
            "JOIN s2_px p ON p.scene_id = m.scene_id AND p.x = c.x AND p.y = c.y GROUP BY 1, 2, 3",
            [f"inside_{s}", f"m2_{s}", f"cov2_{s}", "s2_px"],
        ),
        f"w2_{s}": (
            "SELECT event_id, x, y, "
            + both(lambda q: f"CAST({NDWI.format(q + '_')} > 0 AS INT) AS water_{q}")
            + f" FROM med_{s}",
            [f"med_{s}"],
        ),
        f"cnt2_{s}": (
            "SELECT event_id, count(water_pre) AS pre_px, count(water_post) AS post_px, "
            f"count(water_pre) = count(water_post) AS same_count FROM w2_{s} GROUP BY 1",
            [f"w2_{s}"],
        ),
        f"det2_{s}": (
            f"SELECT event_id, x, y, water_pre, water_post, {flood} FROM (SELECT event_id, x, y, "
            + both(
                lambda q: "CASE WHEN same_count OR (water_pre IS NOT NULL AND water_post IS NOT NULL) "
                f"THEN water_{q} END AS water_{q}"
            )
            + f" FROM w2_{s} JOIN cnt2_{s} USING (event_id)) t",
            [f"w2_{s}", f"cnt2_{s}"],
        ),
        **{f"cc{n}_{s}": (_components(f"(SELECT * FROM det{n}_{s} WHERE flood = 1)", f"cc{n}_{s}"), [f"det{n}_{s}"]) for n in (1, 2)},
        **{f"big{n}_{s}": big(n) for n in (1, 2)},
        **{f"ref{n}_{s}": refined(n) for n in (1, 2)},
        **{
            f"rep{n}_{s}": (
                f"SELECT v.event_id, '{m}' AS method, v.status, "
                f"CASE WHEN v.status = 'ok' THEN round(coalesce(a.km2, 0), 6) END AS area_km2, "
                + (
                    "round(t.threshold_pre, 6) AS threshold_pre, round(t.threshold_post, 6) AS threshold_post, "
                    "CAST(t.threshold_defaulted AS INT) AS threshold_defaulted, "
                    if n == 1
                    else "CAST(NULL AS DOUBLE) AS threshold_pre, CAST(NULL AS DOUBLE) AS threshold_post, CAST(NULL AS INT) AS threshold_defaulted, "
                )
                + "CASE WHEN v.status = 'ok' THEN coalesce(c.pre_px, 0) END AS pre_px, "
                "CASE WHEN v.status = 'ok' THEN coalesce(c.post_px, 0) END AS post_px "
                f"FROM cov{n}_{s} v LEFT JOIN (SELECT event_id, sum({AREA}) / 1e6 AS km2 FROM ref{n}_{s} GROUP BY 1) a USING (event_id) "
                f"LEFT JOIN cnt{n}_{s} c USING (event_id)" + (f" LEFT JOIN thr_{s} t USING (event_id)" if n == 1 else ""),
                [f"cov{n}_{s}", f"ref{n}_{s}", f"cnt{n}_{s}", *([f"thr_{s}"] if n == 1 else [])],
            )
            for n, m in ((1, "sar"), (2, "s2"))
        },
    }


def _components(nodes: str, name: str) -> str:
    """Smallest cell number reachable through 8-neighbours; the body of a recursive term keyed by cell."""
    return f"""
SELECT event_id, x, y, x * 10000000 + y AS label FROM {nodes} n
UNION
SELECT r.event_id, r.x, r.y, min(c.label)
FROM {name} c CROSS JOIN (SELECT a.i AS ox, b.i AS oy FROM (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(i)) o
JOIN recurring.{name} r ON r.event_id = c.event_id AND r.x = c.x + o.ox AND r.y = c.y + o.oy
WHERE c.label < r.label GROUP BY 1, 2, 3"""


TERMS: dict[str, tuple[str, list[str]]] = {
    name: (sql.strip().format(**{t: t for t in fx._TABLES}), fx._NEEDS.get(name, [])) for name, sql in fx.VIEWS.items()
}
TERMS |= {
    "rs": (f"SELECT *, TIMESTAMP '{fx.EVENT_DATE}' + to_days(day_offset) AS acquired_at FROM raster_scenes", ["raster_scenes"]),
    "ce": (
        f"SELECT *, TIMESTAMP '{fx.CATALOG_EVENT_START}' + to_days(day_offset) AS event_ts, true AS has_area FROM catalog_events",
        ["catalog_events"],
    ),
    "cells": (
        f"SELECT *, {LON} AS lon, {LAT} AS lat FROM (SELECT {fx.X0} + i AS x, {fx.Y0} + j AS y FROM "
        f"(SELECT unnest(range(-3, {fx.WIDTH + 3})) AS i) a CROSS JOIN (SELECT unnest(range(-3, h + 3)) AS j FROM dims) b) g",
        ["dims"],
    ),
    "offs": ("SELECT a.i AS ox, b.i AS oy FROM range(-3, 4) a(i) CROSS JOIN range(-3, 4) b(i)", []),
    "slope": (
        f"""SELECT z.gx, z.gy, z.elevation, degrees(atan(sqrt(
  pow((e.elevation - w.elevation) / (2 * {DEM_STEP_DEG * METERS_PER_DEGREE!r} * cos(radians(90.0 - (z.gy + 0.5) * {D}))), 2)
  + pow((n.elevation - s.elevation) / (2 * {DEM_STEP_DEG * METERS_PER_DEGREE!r}), 2)))) AS slope_deg
FROM dem z LEFT JOIN dem e ON e.gx = z.gx + 1 AND e.gy = z.gy LEFT JOIN dem w ON w.gx = z.gx - 1 AND w.gy = z.gy
LEFT JOIN dem n ON n.gx = z.gx AND n.gy = z.gy - 1 LEFT JOIN dem s ON s.gx = z.gx AND s.gy = z.gy + 1""",
        ["dem"],
    ),
    "cmatch": (
        "SELECT e.event_id, CASE WHEN c.acquired_at < e.event_ts THEN 'pre' ELSE 'post' END AS side, c.scene_id, c.acquired_at, "
        "CASE WHEN c.acquired_at < e.event_ts THEN e.event_ts - c.acquired_at ELSE c.acquired_at - e.event_ts END AS gap "
        "FROM ce e JOIN catalog c ON c.instrument_mode = 'IW' AND c.resolution_meters = 10 "
        f"AND c.acquired_at >= e.event_ts - INTERVAL {fx.CATALOG_EVENT_DAYS} DAY "
        f"AND c.acquired_at < e.event_ts + INTERVAL {fx.CATALOG_EVENT_DAYS} DAY "
        "AND c.min_lon <= e.max_lon AND c.max_lon >= e.min_lon AND c.min_lat <= e.max_lat AND c.max_lat >= e.min_lat",
        ["ce", "catalog"],
    ),
    "xmatch": (
        "SELECT * FROM (SELECT m.*, greatest(e.min_lon - (c.min_lon + 1), c.min_lon + 1 - e.max_lon, 0) + "
        "greatest(e.min_lat - (c.min_lat + 1), c.min_lat + 1 - e.max_lat, 0) AS away FROM cmatch m JOIN ce e USING (event_id) "
        "JOIN catalog c USING (scene_id)) t WHERE away <= 1",
        ["cmatch", "ce", "catalog"],
    ),
    "edges_shifted": (
        _edges([[(f"({x} + {fx.SITE_SHIFT[0]})", f"({y} + {fx.SITE_SHIFT[1]})") for x, y in fx.SITE_RINGS[0]]],
               f"(SELECT * FROM sites WHERE {fx.SITE_HAS_AREA}) s", "event_id"),
        ["sites"],
    ),
    "inside_shifted": (_inside("edges_shifted"), ["edges_shifted", "cells"]),
    **_scope_terms("main"),
    **_scope_terms("sites"),
}


#: Slabs of two convex shapes per event: between two neighbouring corners or crossings, each has one edge above and one below.
_SLABS = """
twos AS (SELECT event_id, 0 AS k, lon1, lat1, lon2, lat2 FROM edges_sites UNION ALL SELECT event_id, 1, lon1, lat1, lon2, lat2 FROM edges_shifted),
org AS (SELECT event_id, min(lon1) AS ox, min(lat1) AS oy FROM twos GROUP BY 1),
e AS (SELECT event_id, k, lon1 - ox AS x1, lat1 - oy AS y1, lon2 - ox AS x2, lat2 - oy AS y2 FROM twos JOIN org USING (event_id)),
meet AS (SELECT event_id, a.x1 + (a.x2 - a.x1) * t / (t - u) AS x FROM (SELECT a.event_id, a, (b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1) AS t,
    (b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1) AS u, (a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1) AS v,
    (a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1) AS w FROM e a JOIN e b ON a.event_id = b.event_id AND a.k = 0 AND b.k = 1) m
  WHERE t * u < 0 AND v * w < 0),
cut AS (SELECT DISTINCT event_id, x1 AS x FROM e UNION SELECT event_id, x FROM meet),
slab AS (SELECT * FROM (SELECT event_id, x AS xa, lead(x) OVER (PARTITION BY event_id ORDER BY x) AS xb FROM cut) c WHERE xb > xa),
line AS (SELECT s.event_id, xa, xb, k, y1 + (y2 - y1) * (xa - x1) / (x2 - x1) AS ya, y1 + (y2 - y1) * (xb - x1) / (x2 - x1) AS yb
  FROM slab s JOIN e ON e.event_id = s.event_id AND least(x1, x2) < (xa + xb) / 2 AND greatest(x1, x2) > (xa + xb) / 2),
shape AS (SELECT event_id, xa, xb, k, max_by(ya, ya + yb) AS ta, max_by(yb, ya + yb) AS tb, min_by(ya, ya + yb) AS ba, min_by(yb, ya + yb) AS bb FROM line GROUP BY 1, 2, 3, 4),
common AS (SELECT a.event_id, a.xa, a.xb, least(a.ta, b.ta) AS ta, least(a.tb, b.tb) AS tb, greatest(a.ba, b.ba) AS ba, greatest(a.bb, b.bb) AS bb
  FROM shape a JOIN shape b ON a.event_id = b.event_id AND a.xa = b.xa AND a.k = 0 AND b.k = 1),
every AS (SELECT event_id, 1 AS sgn, xa, xb, ta, tb, ba, bb FROM shape UNION ALL
  SELECT event_id, -1, xa, xb, ta, tb, ba, bb FROM common WHERE ta + tb > ba + bb)
"""
#: Area and centroid of two overlapping convex shapes: both, less what they have in common.
UNITED = (
    ", " + _SLABS.strip() + f"""
SELECT event_id, round(ox + sum(sgn * (xb - xa) * (ha * (2 * xa + xb) + hb * (xa + 2 * xb)) / 6) / sum(sgn * a), 8) AS centroid_lon,
  round(oy + sum(sgn * (xb - xa) * (ta * ta + ta * tb + tb * tb - ba * ba - ba * bb - bb * bb) / 6) / sum(sgn * a), 8) AS centroid_lat,
  round(sum(sgn * radians(xb - xa) * ((sin(radians(oy + ta)) - sin(radians(oy + ba))) + (sin(radians(oy + tb)) - sin(radians(oy + bb)))) / 2)
    * {EARTH_RADIUS_M!r} * {EARTH_RADIUS_M!r}, 1) AS area_m2
FROM (SELECT *, ta - ba AS ha, tb - bb AS hb, (ta - ba + tb - bb) / 2 * (xb - xa) AS a FROM every) t JOIN org USING (event_id) GROUP BY event_id, ox, oy
"""
)
#: Corners of their union: those of each that the other doesn't hold, and the crossings.
CORNERS = (
    ", " + _SLABS.strip() + """
, held AS (SELECT c.event_id, c.k, c.x1, c.y1 FROM e c JOIN e o ON o.event_id = c.event_id AND o.k <> c.k AND (o.y1 > c.y1) <> (o.y2 > c.y1)
  AND c.x1 < (o.x2 - o.x1) * (c.y1 - o.y1) / (o.y2 - o.y1) + o.x1 GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1)
SELECT event_id, 1 AS parts, 1 AS rings, count(*) - (SELECT count(*) FROM held h WHERE h.event_id = e.event_id)
  + (SELECT count(*) FROM meet m WHERE m.event_id = e.event_id) AS corners FROM e GROUP BY 1
"""
)
#: Share of a site that a scene's box covers: each edge is followed as far as the box reaches, its latitude held between the box's.
COVERED = f"""
, box AS (SELECT scene_id, min(x) * {S} - 180 AS w, 90 - (max(y) + 1) * {S} AS s, (max(x) + 1) * {S} - 180 AS e, 90 - min(y) * {S} AS n FROM s1_px GROUP BY 1),
run AS (SELECT event_id, scene_id, sign(lon2 - lon1) AS d, lon1, lat1, (lat2 - lat1) / (lon2 - lon1) AS g, s, n, xa, xb
  FROM (SELECT *, greatest(least(lon1, lon2), w) AS xa, least(greatest(lon1, lon2), e) AS xb
    FROM edges_sites JOIN (SELECT DISTINCT event_id, scene_id FROM m1_sites) p USING (event_id) JOIN box USING (scene_id)) c WHERE xb > xa),
stop AS (SELECT *, least(greatest(CASE WHEN g = 0 THEN xa ELSE lon1 + (s - lat1) / g END, xa), xb) AS p, least(greatest(CASE WHEN g = 0 THEN xa ELSE lon1 + (n - lat1) / g END, xa), xb) AS q FROM run),
bit AS (SELECT event_id, scene_id, d, lon1, lat1, g, s, n, unnest([xa, least(p, q), greatest(p, q)]) AS xa, unnest([least(p, q), greatest(p, q), xb]) AS xb FROM stop),
high AS (SELECT *, sin(radians(least(greatest(lat1 + g * (xa - lon1), s), n))) - sin(radians(s)) AS ha, sin(radians(least(greatest(lat1 + g * (xb - lon1), s), n))) - sin(radians(s)) AS hb FROM bit),
got AS (SELECT event_id, scene_id, abs(sum(d * (xb - xa) * (ha + hb) / 2)) AS a FROM high GROUP BY 1, 2),
whole AS (SELECT event_id, abs(sum((lon2 - lon1) * ((sin(radians(lat1)) + sin(radians(lat2))) / 2 - sin(radians(oy))))) AS a
  FROM edges_sites JOIN (SELECT event_id, min(lat1) AS oy FROM edges_sites GROUP BY 1) b USING (event_id) GROUP BY 1)
SELECT p.event_id, p.scene_id, round(coalesce(got.a, 0) / whole.a, 6) AS share FROM (SELECT DISTINCT event_id, scene_id FROM m1_sites) p
JOIN whole USING (event_id) LEFT JOIN got USING (event_id, scene_id)
"""


def statement(select: str, *terms: str) -> str:
    order: list[str] = []

    def need(name):
        if name in order:
            return
        for n in TERMS[name][1]:
            need(n)
        order.append(name)

    for t in terms:
        need(t)
    parts = [
        f"{n}(event_id, x, y, label) USING KEY (event_id, x, y) AS ({TERMS[n][0]})"
        if n.startswith("cc")
        else f"{n} AS MATERIALIZED ({TERMS[n][0]})"
        for n in order
    ]
    return (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + select
