"""Registered queries and the SQL each must agree with.

Every query runs over the whole of the rasters, catalogs or areas derived from the given tables; see
``inundation/fixtures.py`` for the derivation, which both engines share.
"""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import flood_oracle as o  # noqa: E402
from inundation import fixtures as fx  # noqa: E402
from inundation.functions import bands as B  # noqa: E402
from inundation.functions import geometry as G  # noqa: E402
from inundation.functions.grid import METERS_PER_DEGREE, STEP_DEG  # noqa: E402
from inundation.operators import change, layers, overlay, pyramid, regions  # noqa: E402
from inundation.operators.area import area_km2  # noqa: E402
from inundation.operators.components import connected_pixel_count  # noqa: E402
from inundation.operators.composite import median_composite  # noqa: E402
from inundation.operators.focal import speckle_smooth  # noqa: E402
from inundation.operators.histogram import band_histogram, otsu_curve, otsu_threshold  # noqa: E402
from inundation.operators.terrain import dem_cell, regrid_nearest, slope_degrees  # noqa: E402
from inundation.plans import optical, report, sar  # noqa: E402
from inundation.plans.scope import make_scope  # noqa: E402
from inundation.sources import catalog  # noqa: E402
from inundation.sources.aoi import read_geojson  # noqa: E402
from inundation.sources.control import settle, shared_folder  # noqa: E402
from inundation.sources.export import export_extents  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
BOX = (0.0, 0.0, 60.0, 40.0)
PERIOD = ("1998-03-23", "1998-10-09")
SCALE_30 = 30.0 / METERS_PER_DEGREE


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="inundation-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _with_folder(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Gives a session in one process that names no shared folder one of its own; a cluster has to name it."""

    @wraps(fn)
    def run(spark, d):
        sc = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not named and (sc.master == "local" or sc.master.startswith("local[")):
            sc.setCheckpointDir(_own_folder())
        return fn(spark, d)

    return run


def _finished(result: DataFrame, *branches) -> DataFrame:
    """Computes a result whose pixels are kept for its time only, and gives these back."""
    try:
        return settle(result)
    finally:
        for b in branches:
            b.release()


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias("acquired")


# --- catalogs -------------------------------------------------------------------------------------------------------


def s1_catalog_scan(spark, d):
    return catalog.radar_scenes(fx.view(spark, d, "catalog"), BOX, *PERIOD).select("scene_id", _day("acquired_at"))


#: A diamond over the middle of the box; scenes have diamonds for footprints.
DIAMOND = [[(30.0, 0.0), (50.0, 20.0), (30.0, 40.0), (10.0, 20.0)]]


def s1_catalog_area(spark, d):
    """Scenes whose footprint itself meets an area."""
    scenes = fx.with_footprints(fx.view(spark, d, "catalog"))
    return catalog.radar_scenes(scenes, None, *PERIOD, polygon=DIAMOND).select("scene_id", _day("acquired_at"))


def event_scene_exact(spark, d):
    """Scene counts of events by footprint and area, not by their boxes."""
    events = fx.catalog_events(spark, d)
    corners = (("min_lon", "min_lat"), ("max_lon", "min_lat"), ("max_lon", "max_lat"), ("min_lon", "max_lat"))
    ring = ", ".join(f"named_struct('lon', {x}, 'lat', {y})" for x, y in corners)
    events = events.withColumn("pts", F.expr(f"array({ring})")).withColumn("parts", F.expr(f"array({G.ring_edges('pts')})")).drop("pts")
    scenes = fx.with_footprints(fx.view(spark, d, "catalog").where(catalog.RADAR_QUALITY))
    return catalog.scene_coverage(catalog.match_scenes(scenes, events, fx.CATALOG_EVENT_DAYS), events)


def s2_catalog_scan(spark, d):
    return catalog.optical_scenes(fx.view(spark, d, "catalog"), BOX, *PERIOD).select(
        "scene_id", _day("acquired_at"), "cloudy_pixel_percentage"
    )


def _matched(spark, d):
    scenes = fx.view(spark, d, "catalog").where(catalog.RADAR_QUALITY)
    events = fx.catalog_events(spark, d)
    return catalog.match_scenes(scenes, events, fx.CATALOG_EVENT_DAYS), events


def event_scene_counts(spark, d):
    return catalog.scene_coverage(*_matched(spark, d))


def _nearest(spark, d, side):
    picks = catalog.nearest_scenes(catalog.scene_choice(*_matched(spark, d)))
    return picks.where(F.col("side") == side).select("event_id", "scene_id", _day("acquired_at"))


def latest_pre_scene(spark, d):
    return _nearest(spark, d, "pre")


def first_post_scene(spark, d):
    return _nearest(spark, d, "post")


# --- masks and bands ------------------------------------------------------------------------------------------------


def edge_mask(spark, d):
    px = fx.view(spark, d, "s1_px")
    return px.selectExpr("scene_id", "x", "y", *[f"{B.edge_masked(b)} AS {b.lower()}" for b in ("VV", "VH")])


def cloud_mask(spark, d):
    px = fx.view(spark, d, "s2_px")
    clear = [f"{B.cloud_masked_reflectance(b)} AS {b.lower()}" for b in ("B3", "B8")]
    return px.selectExpr("scene_id", "x", "y", *clear)


def band_validity(spark, d):
    """Validity within the main area, after the cloud mask."""
    _, area, _ = fx.main_event(spark, d)
    px = fx.view(spark, d, "s2_px")
    clear = px.withColumns({b: F.expr(B.cloud_masked_reflectance(b)) for b in ("B3", "B8")})
    inside = regions.clip(clear, regions.polygon_spans(area))
    flagged = change.band_validity(inside, fx.raster_scenes(spark, d))
    return flagged.select("scene_id", F.col("has_required_bands_pixels").cast("int").alias("valid"))


def ndwi_water(spark, d):
    px = fx.view(spark, d, "s2_px")
    return px.selectExpr("scene_id", "x", "y", f"{B.ndwi()} AS ndwi", f"CAST({B.ndwi_water()} AS INT) AS water")


def vv_minus_vh(spark, d):
    px = fx.view(spark, d, "s1_px")
    return px.selectExpr("scene_id", "x", "y", f"{B.band_difference('VV', 'VH')} AS vv_minus_vh")


def _scene_pairs(spark, d, view, bands):
    """Each odd raster scene as before, the following even one as after, aligned by cell; the last has no partner."""
    tagged = fx.view(spark, d, view).selectExpr(
        "CAST(floor((scene_id + 1) / 2) AS BIGINT) AS event_id", "IF(scene_id % 2 = 1, 'pre', 'post') AS side", "x", "y", *bands
    )
    return change.align(tagged, bands)


def mask_algebra(spark, d):
    water = optical.ndwi_pairs(_scene_pairs(spark, d, "s2_px", ["B3", "B8"]))
    pre, post = "pre_water = 1", "post_water = 1"
    masks = {
        "both": B.binary(f"{pre} AND {post}"),
        "either": B.binary(f"{pre} OR {post}"),
        "dry_before": B.binary(f"NOT {pre}"),
        "wet_after": B.self_mask("post_water"),
        "pre_where_post": B.update_mask("pre_water", post),
    }
    return water.selectExpr("event_id", "x", "y", *[f"CAST({e} AS INT) AS `{name}`" for name, e in masks.items()])


# --- areas ----------------------------------------------------------------------------------------------------------


def clip_polygon(spark, d):
    _, area, _ = fx.main_event(spark, d)
    return regions.clip(fx.view(spark, d, "s2_px").select("scene_id", "x", "y"), regions.polygon_spans(area))


def clip_many(spark, d):
    """All sites at once: which pixels of scene coverage fall in which area."""
    events, areas = fx.site_events(spark, d)
    scope = make_scope(events, areas, areas)
    tiles = scope.aoi.cover().withColumnRenamed("aoi_id", "event_id")
    px = regions.in_areas(fx.view(spark, d, "s1_px").select("scene_id", "x", "y"), tiles, rows=scope.aoi.tile_rows)
    inside = regions.clip_tiles(px.select("event_id", "scene_id", "x", "y"), scope.aoi.shapes, "event_id", scope.aoi.shape_rows)
    return inside.groupBy("event_id").agg(F.count("*").alias("pixels"), F.countDistinct("scene_id").alias("scenes"))


def _center(spark, d):
    lon, lat = fx.lon_sql("32"), fx.lat_sql("0.5D * h")
    return fx.view(spark, d, "dims").selectExpr("0L AS aoi_id", f"{lon} AS lon", f"{lat} AS lat", "h * 3.3D AS meters")


def geojson_area(spark, d):
    """Cells of the raster's surroundings in each site's document: two parts that overlap, written and read as GeoJSON."""
    spans = regions.polygon_spans(_site_rings(spark, d))
    west, east = fx.X0 - 3, fx.X0 + fx.WIDTH + 2
    inside = spans.join(F.broadcast(fx.view(spark, d, "dims"))).where(f"y BETWEEN {fx.Y0 - 3} AND {fx.Y0 + 2} + h")
    cells = F.expr(f"sum(greatest(least(x_hi, {east}) - greatest(x_lo, {west}) + 1, 0))").alias("cells")
    return inside.groupBy(F.col("aoi_id").alias("event_id")).agg(cells).where("cells > 0")


def within_buffer(spark, d):
    px = fx.view(spark, d, "s1_px").select("scene_id", "x", "y")
    return regions.clip(px, regions.buffer_spans(_center(spark, d)))


def aoi_geometry(spark, d):
    _, main, _ = fx.main_event(spark, d)
    _, sites = fx.site_events(spark, d)
    m = overlay.measures(sites.unionByName(main.withColumn("aoi_id", F.lit(-1).cast("bigint"))))
    return m.select(
        "aoi_id",
        *[F.round(c, 9).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")],
        *[F.round(c, 8).alias(c) for c in ("centroid_lon", "centroid_lat")],
        F.round("area_m2", 1).alias("area_m2"),
    )


def _site_rings(spark, d):
    """The rings of every site's document, two parts that overlap, written and read as GeoJSON."""
    path = f"{shared_folder(spark)}/geojson-{uuid.uuid4().hex}"
    fx.site_documents(spark, d).select("value").write.text(path)
    # Documents are parsed once; the areas are read by several steps.
    return settle(read_geojson(spark, path, lines=True).select("aoi_id", "part", "ring", "pts"))


def dissolved_area(spark, d):
    """Measures of the documents' areas: what both parts hold counts once."""
    m = overlay.measures(_site_rings(spark, d))
    centroid = [F.round(c, 8).alias(c) for c in ("centroid_lon", "centroid_lat")]
    return m.select(F.col("aoi_id").alias("event_id"), *centroid, F.round("area_m2", 1).alias("area_m2"))


def dissolved_geometry(spark, d):
    """The documents' areas as polygons without overlaps: how many parts, rings and corners each has."""
    rings = overlay.dissolve(_site_rings(spark, d))
    return rings.groupBy(F.col("aoi_id").alias("event_id")).agg(
        F.countDistinct("part").alias("parts"), F.count("*").alias("rings"), F.sum(F.size("pts")).alias("corners")
    )


def scene_cover(spark, d):
    """The share of each site's area that the pixels of its radar scenes cover."""
    events, areas = fx.site_events(spark, d)
    scope = make_scope(events, areas, areas)
    pairs = catalog.match_scenes(fx.raster_scenes(spark, d).where(catalog.RADAR_QUALITY), scope.events, catalog.SAR_DAYS)
    found = overlay.covered_share(areas, regions.footprints(fx.view(spark, d, "s1_px"), ["scene_id"]), pairs)
    return found.select("event_id", "scene_id", F.round("share", 6).alias("share"))


def scene_footprint(spark, d):
    f = regions.footprints(fx.view(spark, d, "s1_px"), ["scene_id"])
    return f.select("scene_id", *[F.round(c, 9).alias(c) for c in f.columns if c != "scene_id"])


# --- neighbourhoods, composites, grids -----------------------------------------------------------------------------


def _lower(df, *names):
    return df.select(*[F.col(c).alias(c.lower()) for c in df.columns])


def speckle_mean(spark, d):
    return _lower(speckle_smooth(fx.view(spark, d, "s1_px"), ["VV", "VH"], fill_masked=False))


def speckle_mean_dilated(spark, d):
    return _lower(speckle_smooth(fx.view(spark, d, "s1_px"), ["VV", "VH"]))


def median_composite_query(spark, d):
    return _lower(median_composite(fx.view(spark, d, "s2_px"), ["B3", "B8"]))


def terrain_slope(spark, d):
    s = slope_degrees(fx.view(spark, d, "dem"))
    return s.select("gx", "gy", "elevation", F.round("slope_deg", 6).alias("slope_deg"))


def regrid_30m(spark, d):
    """Sum of water pixels per scene after nearest-neighbour resampling to 30 m, with the resampled cells."""
    water = fx.view(spark, d, "s2_px").selectExpr("scene_id", "x", "y", f"CAST({B.ndwi_water()} AS INT) AS water")
    return regrid_nearest(water, STEP_DEG, SCALE_30).groupBy("scene_id").agg(
        F.sum("water").alias("water_px"), F.count("*").alias("cells"), F.min("x").alias("x_min"), F.max("y").alias("y_max")
    )


def regrid_dem(spark, d):
    """Elevation at every pixel of scene coverage."""
    px = fx.view(spark, d, "s1_px").select("scene_id", "x", "y")
    sampled = dem_cell(px).join(fx.view(spark, d, "dem"), ["gx", "gy"])
    return sampled.groupBy("scene_id").agg(F.count("*").alias("pixels"), F.sum("elevation").alias("elevation_sum"))


# --- counts, histograms, thresholds --------------------------------------------------------------------------------


def _n_scenes(spark, d):
    return fx.raster_scenes(spark, d).count()


def valid_pixel_count(spark, d):
    return _lower(change.valid_pixel_count(fx.view(spark, d, "s1_px"), ["VV", "VH"], ["scene_id"]))


def common_mask(spark, d):
    pairs = _scene_pairs(spark, d, "s1_px", ["VV", "VH"])
    counts = change.pair_counts(pairs, "VV")
    return _lower(change.common_mask(pairs, ["VV", "VH"], counts, n_events=_n_scenes(spark, d)))


def pixel_count_check(spark, d):
    c = change.pair_counts(_scene_pairs(spark, d, "s1_px", ["VV", "VH"]), "VV")
    return c.select("event_id", "pre_px", "post_px", F.col("same_count").cast("int").alias("same_count"))


def otsu_histogram(spark, d):
    h = band_histogram(fx.view(spark, d, "s1_px"), "VH", ["scene_id"])
    c = otsu_curve(h, ["scene_id"])
    return c.select(
        "scene_id", "bucket", "width", "n", "mean", F.round("sigma_b2", 6).alias("sigma_b2"),
        F.col("is_threshold").cast("int").alias("is_threshold"),
    )


def otsu_threshold_query(spark, d):
    """Thresholds of every catalog scene on VV - VH, edges masked; orders without pixels get the default."""
    diff = B.band_difference(f"({B.edge_masked('VV')})", f"({B.edge_masked('VH')})")
    px = fx.view(spark, d, "s1_px").selectExpr("scene_id", "x", "y", f"{diff} AS diff")
    # Scene -1 has no pixels.
    listed = fx.raster_scenes(spark, d).select("scene_id")
    wanted = listed.unionByName(spark.range(1).selectExpr("-1L AS scene_id"))
    t = otsu_threshold(px, "diff", ["scene_id"], wanted, n_images=wanted.count())
    return t.select(
        "scene_id", "threshold", F.col("threshold_defaulted").cast("int").alias("defaulted")
    )


# --- flood pipelines ------------------------------------------------------------------------------------------------


def _main_scope(spark, d):
    return make_scope(*fx.main_event(spark, d))


def _main_sar(spark, d, scope):
    return sar.sar_branch(fx.raster_scenes(spark, d), fx.view(spark, d, "s1_px"), scope)


def _main_optical(spark, d, scope):
    return optical.optical_branch(fx.raster_scenes(spark, d), fx.view(spark, d, "s2_px"), scope)


def sar_pre_post(spark, d):
    scope = _main_scope(spark, d)
    picks, _ = sar.sar_scenes(fx.raster_scenes(spark, d), scope)
    return _lower(sar.smoothed_pairs(fx.view(spark, d, "s1_px"), picks, scope.aoi, ["VV", "VH"]))


def s2_pre_post(spark, d):
    scope = _main_scope(spark, d)
    picks, _ = optical.optical_scenes(fx.raster_scenes(spark, d), scope)
    return _lower(optical.median_pairs(fx.view(spark, d, "s2_px"), picks, scope))


def _water(branch):
    return branch.detected.select(
        "event_id", "x", "y", *[F.col(c).cast("int").alias(c) for c in ("water_pre", "water_post", "flood")]
    )


def sar_flood_extent(spark, d):
    branch = _main_sar(spark, d, _main_scope(spark, d))
    return _finished(_water(branch), branch)


def ndwi_flood_extent(spark, d):
    branch = _main_optical(spark, d, _main_scope(spark, d))
    return _finished(_water(branch), branch)


def connected_pixels(spark, d):
    branch = _main_optical(spark, d, _main_scope(spark, d))
    return _finished(connected_pixel_count(report.flooded(branch)), branch)


def connected_water(spark, d):
    """Same-valued patches of the water masks of all scenes, by size."""
    px = fx.view(spark, d, "s2_px").selectExpr("scene_id", "x", "y", f"CAST({B.ndwi_water()} AS INT) AS water")
    return connected_pixel_count(px, ["scene_id"], "water").groupBy("scene_id", "water", "component_size").agg(F.count("*").alias("pixels"))


def _refined(spark, d, branch, scope):
    return report.refine_extent(report.flooded(branch), fx.view(spark, d, "dem"), scope)


def refined_extent(spark, d):
    scope = _main_scope(spark, d)
    branch = _main_optical(spark, d, scope)
    return _finished(_refined(spark, d, branch, scope), branch)


def refined_extent_sar(spark, d):
    scope = _main_scope(spark, d)
    branch = _main_sar(spark, d, scope)
    return _finished(_refined(spark, d, branch, scope), branch)


def _km2(df):
    return df.withColumn("area_km2", F.round("area_km2", 6))


def flood_area(spark, d):
    return _km2(area_km2(refined_extent(spark, d)))


def water_area(spark, d):
    """Water area of every scene, masked and dry pixels left out."""
    px = fx.view(spark, d, "s2_px").selectExpr("scene_id", "y", f"{B.ndwi_water()} AS water")
    return _km2(area_km2(px, ["scene_id"], "water"))


def area_pyramid(spark, d):
    """Water area of every scene in cells of each level, and in as many cells as a budget allows; the area is the same."""
    px = fx.view(spark, d, "s2_px").selectExpr("scene_id", "x", "y", f"{B.ndwi_water()} AS water")
    sums = pyramid.cell_sums(px, ["scene_id"], "water", range(3, 13)).groupBy("scene_id", "level").agg(
        F.count("*").alias("cells"), F.sum("pixels").alias("pixels"), (F.sum("area_m2") / 1e6).alias("area_km2")
    )
    within = pyramid.area_within(px, ["scene_id"], "water", max_pixels=200, n_images=_n_scenes(spark, d))
    return _km2(sums.withColumn("budget", F.lit(0)).unionByName(within.withColumn("budget", F.lit(200))))


def site_flood_area(spark, d):
    """Flooded area of every site's event, 0 where there is no flood."""
    events, areas = fx.site_events(spark, d)
    scope = make_scope(events, areas, areas)
    branch = _main_optical(spark, d, scope)
    return _finished(_km2(area_km2(_refined(spark, d, branch, scope), wanted=scope.events)), branch)


def _report(r):
    rounded = {c: F.round(c, 6) for c in ("area_km2", "threshold_pre", "threshold_post")}
    return r.withColumns(rounded | {"threshold_defaulted": F.col("threshold_defaulted").cast("int")})


def flood_report(spark, d):
    event, area, otsu = fx.main_event(spark, d)
    scenes = fx.raster_scenes(spark, d)
    return _report(
        report.flood_report(
            event, area, fx.view(spark, d, "dem"), scenes, fx.view(spark, d, "s1_px"), scenes, fx.view(spark, d, "s2_px"), otsu
        )
    )


def multi_event_report(spark, d):
    events, areas = fx.site_events(spark, d)
    scenes = fx.raster_scenes(spark, d)
    return _report(
        report.flood_report(
            events, areas, fx.view(spark, d, "dem"), scenes, fx.view(spark, d, "s1_px"), scenes, fx.view(spark, d, "s2_px"), areas
        )
    )


# --- layers and export ----------------------------------------------------------------------------------------------


def layer_stretch(spark, d):
    return layers.layer(fx.view(spark, d, "s1_px"), layers.SAR_BAND, layers.SAR_RANGE, by=["scene_id"])


def layer_water(spark, d):
    px = fx.view(spark, d, "s2_px").selectExpr("scene_id", "x", "y", f"{B.ndwi_water()} AS water")
    return layers.layer(px, "water", layers.WATER_RANGE, layers.WATER_PALETTE, water_only=True, by=["scene_id"])


def layer_zoom(spark, d):
    return layers.zoom_out(layer_stretch(spark, d), 16, ["scene_id"])


def export_roundtrip(spark, d):
    """Export the refined extents of both methods under the cluster's shared folder and read them back."""
    scope = _main_scope(spark, d)
    branches = {"sar": _main_sar(spark, d, scope), "s2": _main_optical(spark, d, scope)}
    try:
        refined = {name: _refined(spark, d, b, scope) for name, b in branches.items()}
        paths = export_extents(refined, f"{shared_folder(spark)}/", fx.EVENT_DATE, uuid.uuid4().hex, scope.aoi.spans, scope.aoi.span_rows)
    finally:
        for b in branches.values():
            b.release()
    back = [spark.read.parquet(p).withColumn("name", F.lit(os.path.basename(p).rsplit("_", 1)[0])) for p in paths.values()]
    return back[0].unionByName(back[1]).groupBy("name", "tile_x", "tile_y").agg(F.count("*").alias("pixels"), F.sum("flood").alias("flood_px"))


# --- registration ---------------------------------------------------------------------------------------------------

_CENTER = (fx.lon_sql("32"), fx.lat_sql("0.5 * (SELECT h FROM dims)"))
_HAV = (
    "2.0 * {R} * asin(sqrt(least(pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) "
    "* pow(sin(radians(lon - lon0) / 2), 2), 1.0)))"
).format(R=repr(o.EARTH_RADIUS_M))
_CATALOG_WHERE = (
    f"min_lon <= {BOX[2]} AND max_lon >= {BOX[0]} AND min_lat <= {BOX[3]} AND max_lat >= {BOX[1]} "
    f"AND acquired_at >= TIMESTAMP '{PERIOD[0]}' AND acquired_at < TIMESTAMP '{PERIOD[1]}'"
)
_ACQ = "strftime(acquired_at, '%Y-%m-%d') AS acquired"
def _pair_sql(view, bands):
    cols = ", ".join(
        f"max({b}) FILTER (WHERE scene_id % 2 = {n}) AS {s}_{b}" for s, n in (("pre", 1), ("post", 0)) for b in bands
    )
    return f"(SELECT (scene_id + 1) // 2 AS event_id, x, y, {cols} FROM {view} GROUP BY 1, 2, 3) pr"


_SMOOTHED = (
    "(SELECT p.scene_id, p.x - o.ox AS x, p.y - o.oy AS y, sum(p.VV) / count(p.VV) AS vv, sum(p.VH) / count(p.VH) AS vh "
    "FROM s1_px p CROSS JOIN offs o GROUP BY 1, 2, 3 HAVING count(p.VV) + count(p.VH) > 0) s"
)
_MEASURES = """
SELECT aoi_id, round(min(lon1), 9) AS min_lon, round(min(lat1), 9) AS min_lat, round(max(lon1), 9) AS max_lon,
  round(max(lat1), 9) AS max_lat, round(sum(sgn * (mx + a * ox)) / sum(sgn * a), 8) AS centroid_lon,
  round(sum(sgn * (my + a * oy)) / sum(sgn * a), 8) AS centroid_lat,
  round(sum(sg0 * solid) * {R} * {R}, 1) AS area_m2
FROM (SELECT *, CASE WHEN ring = 0 THEN 1 ELSE -1 END AS sg0, CASE WHEN ring = 0 THEN 1 ELSE -1 END * sign(a) AS sgn
  FROM (SELECT aoi_id, ring, min(lon1) AS lon1, min(lat1) AS lat1, any_value(ox) AS ox, any_value(oy) AS oy,
      sum(cr) / 2 AS a, sum((lon1 + lon2 - 2 * ox) * cr) / 6 AS mx, sum((lat1 + lat2 - 2 * oy) * cr) / 6 AS my,
      abs(sum(radians(lon2 - lon1) * ((sin(radians(lat1)) + sin(radians(lat2))) / 2 - sin(radians(oy))))) AS solid
    FROM (SELECT *, (lon1 - ox) * (lat2 - oy) - (lon2 - ox) * (lat1 - oy) AS cr
      FROM (SELECT *, min(lon1) OVER (PARTITION BY aoi_id, ring) AS ox, min(lat1) OVER (PARTITION BY aoi_id, ring) AS oy
        FROM (SELECT -1 AS aoi_id, ring, lon1, lat1, lon2, lat2 FROM edges_main
              UNION ALL SELECT event_id, ring, lon1, lat1, lon2, lat2 FROM edges_sites) e0) e1) e2
    GROUP BY 1, 2) r) t
GROUP BY 1
""".replace("{R}", repr(o.EARTH_RADIUS_M))
_BOUNDS = """
SELECT m.aoi_id, b.min_lon, b.min_lat, b.max_lon, b.max_lat, m.centroid_lon, m.centroid_lat, m.area_m2
FROM (%s) m JOIN (SELECT aoi_id, round(min(lon1), 9) AS min_lon, round(min(lat1), 9) AS min_lat,
  round(max(lon1), 9) AS max_lon, round(max(lat1), 9) AS max_lat
  FROM (SELECT -1 AS aoi_id, lon1, lat1 FROM edges_main UNION ALL SELECT event_id, lon1, lat1 FROM edges_sites) e
  GROUP BY 1) b USING (aoi_id)
""" % _MEASURES
_NDWI = o.NDWI.format("")
_WATER = f"CAST({_NDWI} > 0 AS INT)"
_WATER_PAIR = [f"CAST({o.NDWI.format(q)} > 0 AS INT)" for q in ("pre_", "post_")]
_SIZES = (
    "SELECT c.event_id, c.x, c.y, z.size AS component_size FROM cc2_main c JOIN "
    "(SELECT event_id, label, count(*) AS size FROM cc2_main GROUP BY 1, 2) z USING (event_id, label)"
)
_VALUED = f"(SELECT scene_id * 2 + {_WATER} AS event_id, x, y FROM s2_px WHERE {_WATER} IS NOT NULL)"
o.TERMS["water"] = (f"SELECT scene_id, x, y FROM s2_px WHERE {_WATER} = 1", ["s2_px"])
o.TERMS["ccw"] = (o._components(_VALUED, "ccw"), ["s2_px"])
_LEVEL = "CAST(greatest(0, least(255, floor((VH + 25.0) / 25.0 * 255))) AS INT)"

_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "s1_catalog_scan": (
        s1_catalog_scan,
        o.statement(
            f"SELECT scene_id, {_ACQ} FROM catalog WHERE instrument_mode = 'IW' AND resolution_meters = 10 AND {_CATALOG_WHERE}",
            "catalog",
        ),
    ),
    "s2_catalog_scan": (
        s2_catalog_scan,
        o.statement(
            f"SELECT scene_id, {_ACQ}, cloudy_pixel_percentage FROM catalog WHERE cloudy_pixel_percentage < 30 AND {_CATALOG_WHERE}",
            "catalog",
        ),
    ),
    "s1_catalog_area": (
        s1_catalog_area,
        o.statement(
            f"SELECT scene_id, {_ACQ} FROM catalog WHERE instrument_mode = 'IW' AND resolution_meters = 10 AND {_CATALOG_WHERE} "
            "AND abs(min_lon + 1 - 30) + abs(min_lat + 1 - 20) <= 21",
            "catalog",
        ),
    ),
    "event_scene_exact": (event_scene_exact, o.statement(o._coverage("xmatch", "ce"), "xmatch", "ce")),
    "event_scene_counts": (event_scene_counts, o.statement(o._coverage("cmatch", "ce"), "cmatch", "ce")),
    **{
        name: (
            fn,
            o.statement(
                f"SELECT event_id, scene_id, {_ACQ} FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap, "
                f"scene_id) AS rn FROM cmatch WHERE side = '{side}') t WHERE rn = 1",
                "cmatch",
            ),
        )
        for name, fn, side in (
            ("latest_pre_scene", latest_pre_scene, "pre"),
            ("first_post_scene", first_post_scene, "post"),
        )
    },
    "edge_mask": (
        edge_mask,
        o.statement(
            "SELECT scene_id, x, y, CASE WHEN VV >= -30 THEN VV END AS vv, CASE WHEN VH >= -30 THEN VH END AS vh FROM s1_px",
            "s1_px",
        ),
    ),
    "cloud_mask": (
        cloud_mask,
        o.statement(
            "SELECT scene_id, x, y, CASE WHEN QA60 & 1024 = 0 AND QA60 & 2048 = 0 THEN B3 / 10000 END AS b3, "
            "CASE WHEN QA60 & 1024 = 0 AND QA60 & 2048 = 0 THEN B8 / 10000 END AS b8 FROM s2_px",
            "s2_px",
        ),
    ),
    "band_validity": (
        band_validity,
        o.statement(
            "SELECT r.scene_id, CAST(count(c.b3) > 0 AND count(c.b8) > 0 AS INT) AS valid FROM raster_scenes r LEFT JOIN "
            "(SELECT p.scene_id, CASE WHEN QA60 & 3072 = 0 THEN B3 END AS b3, CASE WHEN QA60 & 3072 = 0 THEN B8 END AS b8 "
            "FROM s2_px p SEMI JOIN inside_main i USING (x, y)) c ON c.scene_id = r.scene_id GROUP BY 1",
            "raster_scenes", "s2_px", "inside_main",
        ),
    ),
    "ndwi_water": (ndwi_water, o.statement(f"SELECT scene_id, x, y, {_NDWI} AS ndwi, {_WATER} AS water FROM s2_px", "s2_px")),
    "vv_minus_vh": (vv_minus_vh, o.statement("SELECT scene_id, x, y, VV - VH AS vv_minus_vh FROM s1_px", "s1_px")),
    "mask_algebra": (
        mask_algebra,
        o.statement(
            "SELECT event_id, x, y, CAST(a = 1 AND b = 1 AS INT) AS \"both\", CAST(a = 1 OR b = 1 AS INT) AS either, "
            "CAST(a <> 1 AS INT) AS dry_before, CASE WHEN b > 0 THEN b END AS wet_after, CASE WHEN b = 1 THEN a END AS "
            f"pre_where_post FROM (SELECT event_id, x, y, {_WATER_PAIR[0]} AS a, {_WATER_PAIR[1]} AS b FROM {_pair_sql('s2_px', ['B3', 'B8'])}) t",
            "s2_px",
        ),
    ),
    "clip_polygon": (
        clip_polygon,
        o.statement("SELECT p.scene_id, p.x, p.y FROM s2_px p JOIN inside_main i USING (x, y)", "s2_px", "inside_main"),
    ),
    "clip_many": (
        clip_many,
        o.statement(
            "SELECT event_id, count(*) AS pixels, count(DISTINCT scene_id) AS scenes FROM inside_sites JOIN s1_px USING (x, y) "
            "GROUP BY 1",
            "inside_sites", "s1_px",
        ),
    ),
    "geojson_area": (
        geojson_area,
        o.statement(
            "SELECT event_id, count(*) AS cells FROM (SELECT event_id, x, y FROM inside_sites UNION SELECT event_id, x, y FROM inside_shifted) t GROUP BY 1",
            "inside_sites", "inside_shifted",
        ),
    ),
    "within_buffer": (
        within_buffer,
        o.statement(
            f"SELECT scene_id, x, y FROM (SELECT scene_id, x, y, {o.LON} AS lon, {o.LAT} AS lat, {_CENTER[0]} AS lon0, "
            f"{_CENTER[1]} AS lat0 FROM s1_px) t WHERE {_HAV} <= CAST((SELECT h FROM dims) AS DOUBLE) * CAST(3.3 AS DOUBLE)",
            "s1_px", "dims",
        ),
    ),
    "aoi_geometry": (aoi_geometry, o.statement(_BOUNDS, "edges_main", "edges_sites")),
    "dissolved_area": (dissolved_area, o.statement(o.UNITED, "edges_sites", "edges_shifted")),
    "dissolved_geometry": (dissolved_geometry, o.statement(o.CORNERS, "edges_sites", "edges_shifted")),
    "scene_cover": (scene_cover, o.statement(o.COVERED, "m1_sites", "edges_sites", "s1_px")),
    "scene_footprint": (
        scene_footprint,
        o.statement(
            f"SELECT scene_id, round(min(x) * {o.S} - 180, 9) AS min_lon, round(90 - (max(y) + 1) * {o.S}, 9) AS min_lat, "
            f"round((max(x) + 1) * {o.S} - 180, 9) AS max_lon, round(90 - min(y) * {o.S}, 9) AS max_lat FROM s1_px GROUP BY 1",
            "s1_px",
        ),
    ),
    "speckle_mean": (
        speckle_mean,
        o.statement(
            "SELECT scene_id, x, y, CASE WHEN q.VV IS NOT NULL THEN s.vv END AS vv, CASE WHEN q.VH IS NOT NULL THEN s.vh END AS vh "
            f"FROM {_SMOOTHED} JOIN s1_px q USING (scene_id, x, y) WHERE q.VV IS NOT NULL OR q.VH IS NOT NULL",
            "s1_px", "offs",
        ),
    ),
    "speckle_mean_dilated": (speckle_mean_dilated, o.statement(f"SELECT * FROM {_SMOOTHED}", "s1_px", "offs")),
    "median_composite": (
        median_composite_query,
        o.statement("SELECT x, y, median(B3) AS b3, median(B8) AS b8 FROM s2_px GROUP BY 1, 2", "s2_px"),
    ),
    "terrain_slope": (
        terrain_slope,
        o.statement("SELECT gx, gy, elevation, round(slope_deg, 6) AS slope_deg FROM slope", "slope"),
    ),
    "regrid_30m": (
        regrid_30m,
        o.statement(
            f"SELECT scene_id, sum({_WATER}) AS water_px, count(*) AS cells, min(x // 3) AS x_min, max(y // 3) AS y_max "
            "FROM s2_px WHERE x % 3 = 1 AND y % 3 = 1 GROUP BY 1",
            "s2_px",
        ),
    ),
    "regrid_dem": (
        regrid_dem,
        o.statement(
            "SELECT scene_id, count(*) AS pixels, sum(elevation) AS elevation_sum FROM (SELECT scene_id, "
            f"floor(({o.LON} + 180.0) / {o.D}) AS gx, floor((90.0 - {o.LAT}) / {o.D}) AS gy FROM s1_px) p "
            "JOIN dem USING (gx, gy) GROUP BY 1",
            "s1_px", "dem",
        ),
    ),
    "valid_pixel_count": (
        valid_pixel_count,
        o.statement("SELECT scene_id, count(VV) AS vv_px, count(VH) AS vh_px FROM s1_px GROUP BY 1", "s1_px"),
    ),
    "pixel_count_check": (
        pixel_count_check,
        o.statement(
            "SELECT event_id, count(pre_VV) AS pre_px, count(post_VV) AS post_px, CAST(count(pre_VV) = count(post_VV) AS INT) AS same_count "
            f"FROM {_pair_sql('s1_px', ['VV', 'VH'])} GROUP BY 1",
            "s1_px",
        ),
    ),
    "common_mask": (
        common_mask,
        o.statement(
            "SELECT event_id, x, y, "
            + ", ".join(
                f"CASE WHEN s OR (pre_{b} IS NOT NULL AND post_{b} IS NOT NULL) THEN {q}_{b} END AS {q}_{b.lower()}"
                for q in ("pre", "post")
                for b in ("VV", "VH")
            )
            + f" FROM (SELECT *, count(pre_VV) OVER e = count(post_VV) OVER e AS s FROM {_pair_sql('s1_px', ['VV', 'VH'])} WINDOW e AS (PARTITION BY event_id)) t",
            "s1_px",
        ),
    ),
    "otsu_histogram": (
        otsu_histogram,
        o.statement(
            "SELECT scene_id, bucket, width, n, mean, round(sigma_b2, 6) AS sigma_b2, "
            f"CAST(is_threshold AS INT) AS is_threshold FROM ({o._curve('h', 'scene_id')}) c".replace(
                "FROM h", f"FROM ({o._histogram('(SELECT scene_id, VH AS v FROM s1_px)', 'scene_id')}) h"
            ),
            "s1_px",
        ),
    ),
    "otsu_threshold": (
        otsu_threshold_query,
        o.statement(
            "SELECT w.scene_id, coalesce(c.mean, -20.0) AS threshold, CAST(c.mean IS NULL AS INT) AS defaulted "
            "FROM (SELECT scene_id FROM raster_scenes UNION ALL SELECT -1) w LEFT JOIN (SELECT * FROM ("
            + o._curve("h", "scene_id").replace(
                "FROM h",
                "FROM ("
                + o._histogram(
                    "(SELECT scene_id, CASE WHEN VV >= -30 THEN VV END - CASE WHEN VH >= -30 THEN VH END AS v FROM s1_px)",
                    "scene_id",
                )
                + ") h",
            )
            + ") t WHERE is_threshold) c USING (scene_id)",
            "s1_px", "raster_scenes",
        ),
    ),
    "sar_pre_post": (
        sar_pre_post,
        o.statement(
            "SELECT event_id, x, y, pre_VV AS pre_vv, pre_VH AS pre_vh, post_VV AS post_vv, post_VH AS post_vh FROM pair1_main",
            "pair1_main",
        ),
    ),
    "s2_pre_post": (
        s2_pre_post,
        o.statement(
            "SELECT event_id, x, y, pre_B3 AS pre_b3, pre_B8 AS pre_b8, post_B3 AS post_b3, post_B8 AS post_b8 FROM med_main",
            "med_main",
        ),
    ),
    "sar_flood_extent": (sar_flood_extent, o.statement("SELECT * FROM det1_main", "det1_main")),
    "ndwi_flood_extent": (ndwi_flood_extent, o.statement("SELECT * FROM det2_main", "det2_main")),
    "connected_pixel_count": (connected_pixels, o.statement(_SIZES, "cc2_main")),
    "connected_water": (
        connected_water,
        o.statement(
            "SELECT event_id // 2 AS scene_id, event_id % 2 AS water, z.size AS component_size, sum(z.size) AS pixels "
            "FROM (SELECT event_id, label, count(*) AS size FROM ccw GROUP BY 1, 2) z GROUP BY 1, 2, 3",
            "ccw",
        ),
    ),
    "refined_extent": (refined_extent, o.statement("SELECT event_id, x, y FROM ref2_main", "ref2_main")),
    "refined_extent_sar": (refined_extent_sar, o.statement("SELECT event_id, x, y FROM ref1_main", "ref1_main")),
    "flood_area": (
        flood_area,
        o.statement(f"SELECT event_id, round(sum({o.AREA}) / 1e6, 6) AS area_km2 FROM ref2_main GROUP BY 1", "ref2_main"),
    ),
    "water_area": (
        water_area,
        o.statement(
            f"SELECT scene_id, round(coalesce(sum({o.AREA}) FILTER (WHERE {_WATER} <> 0), 0) / 1e6, 6) AS area_km2 FROM s2_px GROUP BY 1",
            "s2_px",
        ),
    ),
    "area_pyramid": (
        area_pyramid,
        o.statement(
            "SELECT scene_id, level, 0 AS budget, count(*) AS cells, sum(n) AS pixels, round(sum(a) / 1e6, 6) AS area_km2 FROM (SELECT scene_id, level, "
            f"x >> level AS cx, y >> level AS cy, count(*) AS n, sum({o.AREA}) AS a FROM water, (SELECT unnest(range(3, 13)) AS level) l GROUP BY ALL) t GROUP BY 1, 2 "
            "UNION ALL SELECT scene_id, level, 200, count(*), sum(n), round(sum(a) / 1e6, 6) FROM (SELECT scene_id, level, x >> level AS cx, y >> level AS cy, count(*) AS n, "
            f"sum({o.AREA}) AS a FROM water JOIN (SELECT scene_id, min(level) AS level FROM (SELECT scene_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM water "
            "GROUP BY 1) b, (SELECT unnest(range(0, 23)) AS level) l WHERE ((x1 >> level) - (x0 >> level) + 1) * ((y1 >> level) - (y0 >> level) + 1) <= 200 GROUP BY 1) f "
            "USING (scene_id) GROUP BY ALL) t GROUP BY 1, 2",
            "water",
        ),
    ),
    "site_flood_area": (
        site_flood_area,
        o.statement(
            f"SELECT e.event_id, round(coalesce(sum({o.AREA}), 0) / 1e6, 6) AS area_km2 FROM events_sites e LEFT JOIN ref2_sites r USING (event_id) GROUP BY 1",
            "events_sites", "ref2_sites",
        ),
    ),
    "flood_report": (
        flood_report,
        o.statement("SELECT * FROM rep1_main UNION ALL SELECT * FROM rep2_main", "rep1_main", "rep2_main"),
    ),
    "multi_event_report": (
        multi_event_report,
        o.statement("SELECT * FROM rep1_sites UNION ALL SELECT * FROM rep2_sites", "rep1_sites", "rep2_sites"),
    ),
    "layer_stretch": (
        layer_stretch,
        o.statement(f"SELECT scene_id, x, y, {_LEVEL} AS level FROM s1_px WHERE VH IS NOT NULL", "s1_px"),
    ),
    "layer_water": (
        layer_water,
        o.statement(
            f"SELECT scene_id, x, y, 255 AS level, '#0000ff' AS colour FROM s2_px WHERE {_WATER} = 1", "s2_px"
        ),
    ),
    "layer_zoom": (
        layer_zoom,
        o.statement(
            f"SELECT scene_id, x // 16 AS zx, y // 16 AS zy, avg({_LEVEL}) AS level, count(*) AS pixels "
            "FROM s1_px WHERE VH IS NOT NULL GROUP BY 1, 2, 3",
            "s1_px",
        ),
    ),
    "export_roundtrip": (
        export_roundtrip,
        o.statement(
            "SELECT name || '_20250602' AS name, x // 4096 AS tile_x, y // 4096 AS tile_y, count(*) AS pixels, count(*) AS flood_px FROM ("
            "SELECT 'Effective_Flood_Extent_SAR' AS name, x, y FROM ref1_main UNION ALL SELECT 'Flood_Extent_S2_NDWI', x, y FROM ref2_main) t GROUP BY 1, 2, 3",
            "ref1_main", "ref2_main",
        ),
    ),
}


try:
    from inundation.llm import queries as llm
except ImportError as error:
    # The training-data operators are a part that can be taken out; a fault inside it is not hidden.
    if not (error.name or "").startswith(("inundation.llm", "corpus_pipeline")):
        raise
    llm = None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the flood report of the main event by both methods."""
    return _with_folder(flood_report)(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _with_folder(fn) for name, (fn, _) in _REGISTRY.items()} | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql is not None} | (llm.oracle_sql() if llm else {})
