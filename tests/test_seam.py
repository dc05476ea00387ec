"""Longitude 180: areas, smoothing, patches, slopes and reads there equal the same elsewhere."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from inundation.functions import geometry as G
from inundation.functions.grid import COLUMNS, STEP_DEG, TILE
from inundation.operators import regions
from inundation.operators.components import connected_pixel_count, drop_small_patches
from inundation.operators.focal import speckle_smooth
from inundation.operators.terrain import dem_near, slope_degrees
from inundation.plans import report
from inundation.plans.scope import make_scope

#: The same image with its middle at the seam and 111,319 columns (10 degrees) to the west of it.
SHIFT = 111_319
Y0 = 900_000


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def at_seam(df):
    """The image with columns counted from the seam."""
    return df.withColumn("x", F.expr(f"pmod(x, {COLUMNS})"))


def elsewhere(df):
    return df.withColumn("x", F.expr(f"x + {COLUMNS} - {SHIFT}"))


def back(df, moved):
    """Columns counted from the middle again."""
    return df.withColumn("x", F.expr(f"x - {COLUMNS} + {SHIFT}" if moved else f"IF(x > {COLUMNS // 2}, x - {COLUMNS}, x)"))


@pytest.fixture(scope="module")
def image(spark):
    """600 by 40 cells with values that differ, holes, and patches over the middle; x is counted from the middle."""
    cells = spark.range(600 * 40).selectExpr("id % 600 - 300 AS x", f"floor(id / 600) + {Y0} AS y", "1 AS event_id")
    value = "CAST((x * x * 7 + y * 13) % 97 AS DOUBLE) / 64"
    return cells.selectExpr("*", f"IF((x + 3 * y) % 11 = 0, NULL, {value}) AS v", "CAST((abs(x) + y) % 9 < 4 OR y % 17 = 0 AS INT) AS water")


def test_the_last_column_is_the_last_with_its_centre_before_180():
    assert (COLUMNS - 0.5) * STEP_DEG - 180 < 180 <= (COLUMNS + 0.5) * STEP_DEG - 180


@pytest.mark.parametrize("fill", [True, False])
def test_smoothing_over_the_seam(spark, image, fill):
    got = [
        rows(back(speckle_smooth(move(image), ["v"], ["event_id"], fill_masked=fill, columns=COLUMNS), moved), "x", "y", "v")
        for move, moved in ((at_seam, False), (elsewhere, True))
    ]
    assert got[0] == got[1] and len(got[0]) >= image.where("v IS NOT NULL").count()


def test_patches_over_the_seam(spark, image):
    wet = image.where("water = 1")
    for count in (
        lambda df: connected_pixel_count(df, columns=COLUMNS),
        lambda df: drop_small_patches(df, min_connected=30, columns=COLUMNS).withColumn("component_size", F.lit(1)),
        lambda df: drop_small_patches(df, min_connected=100, columns=COLUMNS).withColumn("component_size", F.lit(1)),
    ):
        a, b = (rows(back(count(move(wet)), moved), "x", "y", "component_size") for move, moved in ((at_seam, False), (elsewhere, True)))
        assert a == b and a
    # Two cells, one on each side, are one patch.
    two = spark.createDataFrame([(1, 0, 5), (1, COLUMNS - 1, 6), (1, 100, 5)], "event_id int, x long, y long")
    assert rows(connected_pixel_count(two, columns=COLUMNS), "x", "component_size") == [(0, 2), (100, 1), (COLUMNS - 1, 2)]


def polygon(west, cells, moved):
    """A polygon of so many columns from ``west`` on, counted from the middle, with a corner cut off."""
    edge = lambda i: i * STEP_DEG + (180.0 - SHIFT * STEP_DEG if moved else 180.0)
    # East of the seam columns begin at 180 itself, west of it they end a part of a cell before the next would.
    lost = 0.0 if moved else 360.0 - COLUMNS * STEP_DEG
    left = edge(west) - lost
    top, bottom = 90 - Y0 * STEP_DEG, 90 - (Y0 + 40) * STEP_DEG
    return [[(left, top), (edge(west + cells), top), (edge(west + cells), bottom), (left, bottom)]]


@pytest.mark.parametrize("turn", [0, -360])
def test_area_over_the_seam(spark, turn):
    """Spans of an area over 180, written beyond 180 or beyond -180, and clips by them."""
    ring = [[(lon + turn, lat) for lon, lat in polygon(-70, 150, False)[0]]]
    spans = regions.polygon_spans(G.areas(spark, {1: ring}))
    cells = spans.selectExpr("y", "explode(sequence(x_lo, x_hi)) AS x")
    want = {(x % COLUMNS, y) for x in range(-70, 80) for y in range(Y0, Y0 + 40)}
    assert {(r.x, r.y) for r in cells.collect()} == want and cells.count() == len(want)
    image = spark.range(400 * 50).selectExpr(f"pmod(id % 400 - 200, {COLUMNS}) AS x", f"floor(id / 400) + {Y0 - 5} AS y")
    assert {(r.x, r.y) for r in regions.clip(image, spans).collect()} == want
    # The cover and what lies around it.
    near = regions.in_areas(image, regions.cover(spans, 3))
    assert {(r.x, r.y) for r in near.select("x", "y").collect()} == {(x % COLUMNS, y) for x in range(-73, 83) for y in range(Y0 - 3, Y0 + 43)}


def test_cover_of_an_area_beside_the_seam_goes_on_at_the_other_end(spark):
    spans = regions.polygon_spans(G.areas(spark, {1: polygon(0, 20, False)}))
    tiles = regions.cover(spans, 3).collect()
    assert {r.tx for r in tiles} == {0, (COLUMNS - 1) // 64}
    assert {(r.x0, r.x1) for r in tiles} == {(0, 22), (COLUMNS - 3, COLUMNS - 1)}
    scope = make_scope(spark.createDataFrame([(1, datetime(2025, 6, 2))], "event_id long, event_ts timestamp_ntz"), G.areas(spark, {1: polygon(0, 20, False)}))
    assert scope.aoi.envelope[:2] == (0, (COLUMNS - 1) // TILE)


def test_circle_over_the_seam(spark):
    circle = lambda lon: spark.createDataFrame([(1, lon, 9.0, 500.0)], "aoi_id long, lon double, lat double, meters double")
    n = lambda s: s.selectExpr("sum(x_hi - x_lo + 1) AS n").first().n
    over = regions.buffer_spans(circle(180.0))
    assert {r.x_lo == 0 or r.x_hi == COLUMNS - 1 for r in over.collect()} == {True}
    assert n(over) == pytest.approx(n(regions.buffer_spans(circle(120.0))), rel=0.02)
    assert rows(over, "y", "x_lo", "x_hi") == rows(regions.buffer_spans(circle(-180.0)), "y", "x_lo", "x_hi")


def test_slope_over_the_seam(spark):
    cells = spark.range(41 * 12).selectExpr("id % 41 - 20 AS x", "floor(id / 41) + 98000 AS gy").selectExpr("*", "CAST((x * x * 3 + gy * 5) % 31 AS DOUBLE) AS elevation")
    n = 432_000
    a = slope_degrees(cells.selectExpr(f"pmod(x, {n}) AS gx", "gy", "elevation")).selectExpr(f"IF(gx > {n // 2}, gx - {n}, gx) AS x", "gy", "slope_deg")
    b = slope_degrees(cells.selectExpr("x + 200000 AS gx", "gy", "elevation")).selectExpr("gx - 200000 AS x", "gy", "slope_deg")
    assert rows(a.where("slope_deg IS NOT NULL"), "x", "gy", "slope_deg") == rows(b.where("slope_deg IS NOT NULL"), "x", "gy", "slope_deg")
    near = dem_near(cells.selectExpr(f"pmod(x, {n}) AS gx", "gy", "elevation"), spark.createDataFrame([(0, int((98004 / 1200) / STEP_DEG) // 64)], "tx long, ty long"))
    assert {r.gx for r in near.collect()} >= {0, 1, n - 1}


def _report(spark, moved):
    """A wet square over the middle, seen by scenes before and after; the scenes' boxes go over 180 where the square does."""
    cells = spark.range(160 * 60).selectExpr("id % 160 - 80 AS x", f"floor(id / 160) + {Y0} AS y")
    wet = f"(x BETWEEN -20 AND 25 AND y BETWEEN {Y0 + 10} AND {Y0 + 40})"
    px = cells.selectExpr("explode(sequence(1L, 4L)) AS scene_id", "x", "y").selectExpr(
        "*", f"IF(scene_id > 2 AND {wet}, 900D, 500D) AS B3", f"IF(scene_id > 2 AND {wet}, 300D, 2000D) AS B8",
        f"IF(scene_id > 2 AND {wet}, -22D, -12D) AS VV", f"IF(scene_id > 2 AND {wet}, -25D, -15D) AS VH",
    )
    px = (elsewhere if moved else at_seam)(px)
    middle = 180.0 - (SHIFT * STEP_DEG if moved else 0.0)
    lat = 90 - Y0 * STEP_DEG
    scenes = spark.createDataFrame([(i, datetime(2025, 6, d), middle - 1, lat - 1, middle + 1, lat + 1, "IW", 10, 5) for i, d in ((1, 1), (2, 1), (3, 3), (4, 3))],
        "scene_id long, acquired_at timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double, instrument_mode string, resolution_meters int, cloudy_pixel_percentage int")
    events = spark.createDataFrame([(1, datetime(2025, 6, 2))], "event_id long, event_ts timestamp_ntz")
    area = G.areas(spark, {1: polygon(-60, 120, moved)})
    dem = spark.range(60 * 60).selectExpr(f"pmod(floor(({middle}D + 180) * 1200) - 30 + id % 60, 432000) AS gx", f"floor((90 - {lat}D) * 1200) - 5 + floor(id / 60) AS gy", "10D AS elevation")
    out = report.flood_report(events, area, dem, scenes, px, scenes, px, area)
    return {r.method: (r.status, r.pre_px, r.post_px, r.threshold_pre, r.threshold_post, pytest.approx(r.area_km2, rel=1e-9)) for r in out.collect()}


def test_report_over_the_seam(spark):
    got, want = _report(spark, False), _report(spark, True)
    assert want["s2"][0] == want["sar"][0] == "ok" and want["s2"][1] == 120 * 40
    assert {m: v[:5] for m, v in got.items()} == {m: v[:5] for m, v in want.items()}
    assert got["s2"][5].expected == want["s2"][5] and got["sar"][5].expected == want["sar"][5]
