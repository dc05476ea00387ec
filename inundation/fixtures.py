"""Rasters, catalogs and areas derived from the driver's tables.

The tables hold no imagery, so pixels are derived: four consecutive orders make one cell of a raster 64 cells wide, a line number
is a scene, and prices and quantities give the band values.  Raster height, areas and catalogs grow with the tables.  The
SQL runs unchanged on Spark and on DuckDB, where the oracle uses the same text.  Values are integers or multiples of 1/64, so
sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.grid import STEP_DEG

#: North-west corner of the raster: 12 cells before a tile border both ways, so patches and kernels straddle tiles.
X0, Y0 = 2019316, 932084
EVENT_DATE = "2025-06-02"

WIDTH = 64
HEIGHT = "SELECT CAST(ceil(CAST(max(o_orderkey) + 1 AS DOUBLE) / (4 * 64)) AS BIGINT) AS h FROM {orders}"

PLACED = """
SELECT scene_id, p, q, cell % 64 AS dx, CAST(floor(CAST(cell AS DOUBLE) / 64) AS BIGINT) AS dy
FROM (SELECT CAST(l_linenumber AS BIGINT) AS scene_id, CAST(floor(CAST(l_orderkey AS DOUBLE) / 4) AS BIGINT) AS cell,
        MIN(CAST(floor(l_extendedprice) AS BIGINT)) AS p, MAX(CAST(floor(l_quantity) AS BIGINT)) AS q
      FROM {lineitem} GROUP BY 1, 2) r
"""

# Water: some 12x12 blocks before the event (odd scenes), more blocks and diagonal streams after it (even scenes).
WET = """
SELECT scene_id, p, q, dx, dy,
  CASE WHEN scene_id % 2 = 1 THEN (blk % 5 = 0)
       ELSE (blk % 5 < (CASE WHEN scene_id = 2 THEN 2 ELSE 3 END) OR (dx + 2 * dy) % 61 < 5) END AS wet
FROM (SELECT scene_id, p, q, dx, dy,
        CAST(floor(CAST(dx AS DOUBLE) / 12) AS BIGINT) * 7 + CAST(floor(CAST(dy AS DOUBLE) / 12) AS BIGINT) * 11 AS blk
      FROM placed) b
"""

S1_PIXELS = f"""
SELECT scene_id, dx + {X0} AS x, dy + {Y0} AS y,
  CASE WHEN p % 19 = 0 THEN NULL WHEN p % 23 = 0 THEN CAST(-30 AS DOUBLE)
       WHEN wet THEN -19 + CAST(p % 192 AS DOUBLE) / 64 ELSE -11 + CAST(p % 320 AS DOUBLE) / 64 END AS VV,
  CASE WHEN p % 13 = 0 THEN NULL WHEN p % 17 = 0 THEN -29 - CAST(p % 128 AS DOUBLE) / 64
       WHEN wet THEN -26 + CAST(p % 256 AS DOUBLE) / 64 ELSE -17 + CAST(p % 448 AS DOUBLE) / 64 END AS VH
FROM wet
"""

S2_PIXELS = f"""
SELECT scene_id, dx + {X0} AS x, dy + {Y0} AS y,
  CASE WHEN q = 11 THEN NULL WHEN q = 7 AND p % 3 = 0 THEN CAST(0 AS DOUBLE)
       WHEN wet THEN CAST(800 + p % 200 AS DOUBLE) ELSE CAST(500 + p % 200 AS DOUBLE) END AS B3,
  CASE WHEN q = 7 AND p % 3 = 0 THEN CAST(0 AS DOUBLE)
       WHEN wet THEN CAST(300 + p % 200 AS DOUBLE) ELSE CAST(2000 + p % 900 AS DOUBLE) END AS B8,
  CASE WHEN q % 16 = 0 THEN 1024 WHEN q % 16 = 1 THEN 2048 WHEN q % 16 = 2 THEN 3072 WHEN q % 16 = 3 THEN 3
       WHEN q % 16 = 4 THEN NULL ELSE 0 END AS QA60
FROM wet
"""

# Days of the raster scenes relative to the event date: 1,3,5,7 before it, 2,4,6 after.
RASTER_SCENES = """
SELECT scene_id, CASE WHEN scene_id % 2 = 1 THEN -CAST(floor(CAST(3 * scene_id + 1 AS DOUBLE) / 2) AS INT)
    ELSE CAST(floor(CAST(3 * scene_id AS DOUBLE) / 2) AS INT) - 2 END AS day_offset,
  'IW' AS instrument_mode, 10 AS resolution_meters, CAST(scene_id * 5 AS INT) AS cloudy_pixel_percentage,
  CAST(1.0 AS DOUBLE) AS min_lon, CAST(6.0 AS DOUBLE) AS min_lat,
  CAST(9.0 AS DOUBLE) AS max_lon, CAST(6.5 AS DOUBLE) AS max_lat
FROM (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS scene_id FROM {lineitem}) s
"""

CATALOG = """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS scene_id, o_orderdate AS acquired_at,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'EW' ELSE 'IW' END AS instrument_mode,
  CASE WHEN o_orderstatus = 'P' THEN 40 ELSE 10 END AS resolution_meters,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS INT) AS cloudy_pixel_percentage,
  CAST(o_custkey % 358 AS DOUBLE) - 180 AS min_lon, CAST(o_orderkey % 160 AS DOUBLE) - 80 AS min_lat,
  CAST(o_custkey % 358 AS DOUBLE) - 178 AS max_lon, CAST(o_orderkey % 160 AS DOUBLE) - 78 AS max_lat
FROM {orders}
"""

# One elevation cell per part, on a 3 arc-second grid that starts just north-west of the raster.
DEM_GX0, DEM_GY0 = 217677, 100475
DEM = f"""
SELECT p_partkey % n + {DEM_GX0} AS gx, CAST(floor(CAST(p_partkey AS DOUBLE) / n) AS BIGINT) + {DEM_GY0} AS gy,
  CAST(floor(CAST(p_size AS DOUBLE) / 2) AS DOUBLE) AS elevation
FROM (SELECT p_partkey, p_size,
        (SELECT CAST(ceil(sqrt(CAST(max(p_partkey) + 1 AS DOUBLE))) AS BIGINT) FROM {{part}}) AS n FROM {{part}}) t
"""

# Catalog events, one per supplier: a 20 x 16 degree box and a date within the orders.
CATALOG_EVENTS = """
SELECT s_suppkey AS event_id, CAST((s_suppkey * 173) % 1900 AS INT) AS day_offset,
  CAST((s_suppkey * 37) % 330 AS DOUBLE) - 175 AS min_lon, CAST((s_suppkey * 29) % 130 AS DOUBLE) - 75 AS min_lat,
  CAST((s_suppkey * 37) % 330 AS DOUBLE) - 155 AS max_lon, CAST((s_suppkey * 29) % 130 AS DOUBLE) - 59 AS max_lat
FROM {supplier}
"""
CATALOG_EVENT_START = "1996-01-01"
CATALOG_EVENT_DAYS = 30

# Flood events, one per supplier: a tilted four-sided area somewhere on the raster, dated 0 to 2 days after the event date.
SITES = """
SELECT s_suppkey AS event_id, CAST(s_suppkey % 3 AS INT) AS day_offset,
  CAST((s_suppkey * 31) % 64 AS DOUBLE) AS ax, CAST((s_suppkey * 17) % (SELECT h FROM dims) AS DOUBLE) AS ay,
  CAST(20 + s_suppkey % 9 AS DOUBLE) AS sx, CAST(18 + s_suppkey % 7 AS DOUBLE) AS sy
FROM {supplier}
"""
SITE_RINGS = [[("ax", "ay + 3.3"), ("ax + sx + 0.2", "ay"), ("ax + sx - 2.7", "ay + sy"), ("ax + 4.1", "ay + sy + 1.6")]]

# Some sites have no area; documents of sites have a second ring, this many cells further on.
SITE_HAS_AREA = "event_id % 10 <> 3"
SITE_SHIFT = (5, 4)

# The main event's area (a shell and a hole) and threshold region, in fractions of the raster's width and height.
MAIN_RINGS = [
    [(0.04, 0.10), (0.55, 0.03), (0.97, 0.35), (0.90, 0.95), (0.30, 0.98)],
    [(0.45, 0.45), (0.55, 0.47), (0.50, 0.56)],
]
MAIN_OTSU_RINGS = [[(0.15, 0.20), (0.80, 0.25), (0.75, 0.80), (0.20, 0.70)]]


def main_rings(rings=MAIN_RINGS):
    return [[(f"{a} * {WIDTH}", f"{b} * h") for a, b in ring] for ring in rings]


def lon_sql(px: str) -> str:
    return f"({X0} + CAST({px} AS DOUBLE)) * {STEP_DEG!r} - 180"


def lat_sql(py: str) -> str:
    return f"90 - ({Y0} + CAST({py} AS DOUBLE)) * {STEP_DEG!r}"


VIEWS = {
    "dims": HEIGHT,
    "placed": PLACED,
    "wet": WET,
    "s1_px": S1_PIXELS,
    "s2_px": S2_PIXELS,
    "raster_scenes": RASTER_SCENES,
    "catalog": CATALOG,
    "dem": DEM,
    "catalog_events": CATALOG_EVENTS,
    "sites": SITES,
}
_NEEDS = {
    "wet": ["placed"],
    "s1_px": ["placed", "wet"],
    "s2_px": ["placed", "wet"],
    "sites": ["dims"],
}
_TABLES = ("orders", "lineitem", "part", "supplier")


def view_terms(*names: str) -> list[str]:
    """``name AS (...)`` terms of the views and all they need, in order."""
    order: list[str] = []
    for name in names:
        for n in [*_NEEDS.get(name, []), name]:
            if n not in order:
                order.append(n)
    return [f"{n} AS ({VIEWS[n].strip()})" for n in order]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view on Spark."""
    sql = f"WITH {', '.join(view_terms(name))} SELECT * FROM {name}"
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def _dated(df: DataFrame, start: str, name: str) -> DataFrame:
    day = f"CAST('{start}' AS TIMESTAMP_NTZ) + make_dt_interval(day_offset) AS {name}"
    return df.selectExpr("*", day).drop("day_offset")


def raster_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(view(spark, sf_dir, "raster_scenes"), EVENT_DATE, "acquired_at")


def catalog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(view(spark, sf_dir, "catalog_events"), CATALOG_EVENT_START, "event_ts")


def _area(df: DataFrame, rings, key: str) -> DataFrame:
    point = lambda p: f"named_struct('lon', {lon_sql(p[0])}, 'lat', {lat_sql(p[1])})"
    arrays = ", ".join(f"array({', '.join(point(p) for p in ring)})" for ring in rings)
    return df.selectExpr(f"CAST({key} AS BIGINT) AS aoi_id", "0 AS part", f"posexplode(array({arrays})) AS (ring, pts)")


def main_event(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event, area and threshold region of the main event."""
    dims = view(spark, sf_dir, "dims")
    event = dims.selectExpr("0L AS event_id", f"CAST('{EVENT_DATE}' AS TIMESTAMP_NTZ) AS event_ts")
    return event, _area(dims, main_rings(), "0"), _area(dims, main_rings(MAIN_OTSU_RINGS), "0")


def site_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of all sites and their areas."""
    sites = view(spark, sf_dir, "sites")
    events = _dated(sites.select("event_id", "day_offset"), EVENT_DATE, "event_ts")
    return events, _area(sites.where(SITE_HAS_AREA), SITE_RINGS, "event_id")


def with_footprints(catalog: DataFrame) -> DataFrame:
    """Scenes with the diamond inside their box as footprint, so that box and footprint differ at every corner."""
    points = (("min_lon + 1", "min_lat"), ("max_lon", "min_lat + 1"), ("min_lon + 1", "max_lat"), ("min_lon", "min_lat + 1"))
    ring = ", ".join(f"named_struct('lon', {x}, 'lat', {y})" for x, y in points)
    return catalog.withColumn("footprint", F.expr(f"array(array({ring}))"))


def site_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A GeoJSON document per site, with its id: a collection of two features, the site's ring and the same ring a little further on."""
    sites = view(spark, sf_dir, "sites").where(SITE_HAS_AREA)

    def feature(dx, dy):
        ring = SITE_RINGS[0]
        points = ", ".join(f"array({lon_sql(f'({x} + {dx})')}, {lat_sql(f'({y} + {dy})')})" for x, y in [*ring, ring[0]])
        return f"named_struct('type', 'Feature', 'geometry', named_struct('type', 'Polygon', 'coordinates', array(array({points}))))"

    features = ", ".join(feature(dx, dy) for dx, dy in ((0, 0), SITE_SHIFT))
    return sites.selectExpr("event_id", f"to_json(named_struct('type', 'FeatureCollection', 'id', CAST(event_id AS BIGINT), 'features', array({features}))) AS value")
