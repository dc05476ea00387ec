"""Polygon overlay against closed forms and a raster of points; the area pyramid against plain sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from inundation.functions import geometry as G
from inundation.functions.grid import quad_key
from inundation.operators import overlay, pyramid
from inundation.operators.area import area_km2
from inundation.operators.regions import polygon_spans

M2 = 12364e6  # about a square degree at the equator, in m2


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]


def frame(spark, shapes):
    """``{aoi_id: [[shell, hole, ...], ...]}`` as an area frame."""
    rows = [(a, p, i, [(float(x), float(y)) for x, y in ring]) for a, parts in shapes.items() for p, rings in enumerate(parts) for i, ring in enumerate(rings)]
    return spark.createDataFrame(rows, G.AREA_SCHEMA)


PARTS = {
    1: [[square(0, 0, 2)], [square(0, 0, 2)]],  # copies
    2: [[square(0, 0, 2)], [square(1, 1, 2)]],  # overlap
    3: [[square(0, 0, 4)], [square(1, 1, 1)]],  # nested
    4: [[square(0, 0, 1)], [square(1, 0, 1)]],  # an edge in common
    5: [[square(0, 0, 4), square(1, 1, 2)], [square(1.5, 1.5, 1)]],  # an island in a hole
    6: [[square(0, 0, 1)], [square(1, 1, 1)]],  # a corner in common
    7: [[square(0, 0, 4), square(1, 1, 2)], [square(0.5, 1.5, 3)]],  # a hole that is covered in part
    8: [[square(0, 0, 3)], [[(1, -1), (2, -1), (2, 4), (1, 4)]]],  # a cross
    9: [[square(0, 0, 1)], [[(1, 0.25), (2, 0.25), (2, 0.75), (1, 0.75)]]],  # corners on an edge
    10: [[square(5, 5, 1)[::-1]]],  # one part, the other way round
    11: [[square(0, 0, 3), square(1, 1, 1)], [square(1, 1, 1)]],  # a hole filled exactly
}
WANTED = {1: 4, 2: 7, 3: 16, 4: 2, 5: 13, 6: 2, 7: 16.5, 8: 11, 9: 1.5, 10: 1, 11: 9}


@pytest.fixture(scope="module")
def dissolved(spark):
    return overlay.dissolve(frame(spark, PARTS)).cache()


def test_union_counts_each_place_once(spark):
    got = {r.aoi_id: r for r in overlay.measures(frame(spark, PARTS)).collect()}
    assert {i: pytest.approx(r.area_m2 / M2, rel=0.01) for i, r in got.items()} == WANTED
    alone = {r.aoi_id: r.area_m2 for r in G.ring_measures(frame(spark, {1: PARTS[1][:1], 3: PARTS[3][:1]})).collect()}
    assert all(got[i].area_m2 == pytest.approx(a, rel=1e-12) for i, a in alone.items())
    assert (got[2].centroid_lon, got[2].centroid_lat) == (pytest.approx(1.5), pytest.approx(1.5))
    assert (got[8].min_lon, got[8].min_lat, got[8].max_lon, got[8].max_lat) == (0, -1, 3, 4)


def test_dissolved_areas_have_the_same_measures_and_no_overlaps(spark, dissolved):
    want = {r.aoi_id: r for r in overlay.measures(frame(spark, PARTS)).collect()}
    for r in G.ring_measures(dissolved).collect():
        assert r.area_m2 == pytest.approx(want[r.aoi_id].area_m2, rel=1e-9) and r.centroid_lon == pytest.approx(want[r.aoi_id].centroid_lon)
    shapes = {(r.aoi_id, r.part, r.ring): len(r.pts) for r in dissolved.collect()}
    assert shapes == {
        (1, 0, 0): 4, (2, 0, 0): 8, (3, 0, 0): 4, (4, 0, 0): 4, (5, 0, 0): 4, (5, 1, 0): 4, (5, 1, 1): 4, (6, 0, 0): 4, (6, 1, 0): 4, (7, 0, 0): 8,
        (7, 0, 1): 4, (8, 0, 0): 12, (9, 0, 0): 8, (10, 0, 0): 4, (11, 0, 0): 4,
    }
    again = overlay.border_measures(overlay.border(dissolved)).collect()
    assert all(r.area_m2 == pytest.approx(want[r.aoi_id].area_m2, rel=1e-9) for r in again)


def _inside(parts, x, y):
    held = np.zeros(x.shape, bool)
    for rings in parts:
        odd = np.zeros(x.shape, bool)
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
                if ay != by:
                    odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        held |= odd
    return held


@pytest.mark.parametrize("operation", ["union", "intersection", "difference"])
def test_random_polygons_against_points(spark, operation):
    rng = np.random.default_rng(7)

    def star(k):
        at = np.sort(rng.random(k)) * 2 * math.pi
        r, c = 0.05 + 0.25 * rng.random(k), 0.3 + 0.4 * rng.random(2)
        return [(float(c[0] + a * math.cos(t)), float(c[1] + a * math.sin(t))) for a, t in zip(r, at, strict=True)]

    first = {i: [[star(9)] for _ in range(3)] for i in range(1, 7)}
    other = {i: [[star(7)] for _ in range(2)] for i in range(1, 7)}
    second = None if operation == "union" else frame(spark, other)
    edges = overlay.border(frame(spark, first), second, operation)
    got = {r.aoi_id: r.area_m2 for r in overlay.border_measures(edges).collect()}
    step = 1 / 1500
    x, y = np.meshgrid(np.arange(step / 2, 1, step), np.arange(step / 2, 1, step))
    for i in first:
        a, b = _inside(first[i], x, y), _inside(other[i], x, y)
        held = {"union": a, "intersection": a & b, "difference": a & ~b}[operation]
        assert got.get(i, 0.0) / M2 == pytest.approx(held.mean(), abs=2e-4)
    # The geometry covers the same points.
    shapes = {}
    for r in overlay.rings(edges).collect():
        shapes.setdefault(r.aoi_id, {}).setdefault(r.part, []).append([(p.lon, p.lat) for p in r.pts])
    px, py = rng.random(4000), rng.random(4000)
    for i in first:
        a, b = _inside(first[i], px, py), _inside(other[i], px, py)
        held = {"union": a, "intersection": a & b, "difference": a & ~b}[operation]
        assert (_inside(shapes.get(i, {}).values(), px, py) == held).all()


def test_union_of_many_parts_equals_their_spans(spark):
    """A patchwork that overlaps: polygons and cells must agree."""
    rng = np.random.default_rng(3)
    parts = [[square(1.4 + 0.002 * rng.random(), 6.2 + 0.002 * rng.random(), 0.0005 + 0.0008 * rng.random())] for _ in range(120)]
    area = frame(spark, {1: parts})
    got = overlay.measures(area).first()
    spans = polygon_spans(area).selectExpr("sum(x_hi - x_lo + 1) AS n").first().n
    assert got.area_m2 == pytest.approx(spans * 100 * math.cos(math.radians(6.2)), rel=0.02)
    same = polygon_spans(overlay.dissolve(area)).exceptAll(polygon_spans(area))
    assert same.count() == 0


def test_covered_share(spark):
    areas = frame(spark, {1: [[square(0, 0, 2)]], 2: [[square(10, 0, 1)], [square(10.5, 0, 1)]]})
    footprints = spark.createDataFrame([("a", 1.0, -1.0, 5.0, 5.0), ("b", 9.0, -1.0, 12.0, 2.0)], "scene_id string, min_lon double, min_lat double, max_lon double, max_lat double")
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (2, "b")], "event_id long, scene_id string")
    got = {(r.event_id, r.scene_id): r for r in overlay.covered_share(areas, footprints, pairs).collect()}
    assert {k: pytest.approx(r.share, abs=1e-9) for k, r in got.items()} == {(1, "a"): 0.5, (1, "b"): 0, (2, "a"): 0, (2, "b"): 1, (2, "c"): 0}
    assert got[2, "b"].covered_m2 == pytest.approx(1.5 * M2, rel=0.01)


def test_empty_areas_and_results(spark):
    nothing = frame(spark, {1: [[square(0, 0, 1)]]}).limit(0)
    assert overlay.border(nothing).count() == 0 and overlay.dissolve(nothing).count() == 0 and overlay.measures(nothing).count() == 0
    far = overlay.intersect(frame(spark, {1: [[square(0, 0, 1)]]}), frame(spark, {1: [[square(3, 3, 1)]], 2: [[square(0, 0, 1)]]}))
    assert far.count() == 0


# --- pyramid --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pixels(spark):
    rng = np.random.default_rng(11)
    cells = {(int(x), int(y)) for x, y in zip(rng.integers(2_000_000, 2_000_300, 4000), rng.integers(900_000, 900_200, 4000), strict=True)}
    rows = [(1, x, y, int(rng.integers(0, 2))) for x, y in cells] + [(2, 5, 5, 1), (3, 7, 7, 0), (3, 8, 7, None)]
    return spark.createDataFrame(rows, "event_id int, x long, y long, water int")


def test_quad_keys_go_up_a_level_by_two_bits(spark):
    def plain(x, y):
        return sum((x >> i & 1) << (2 * i + 1) | (y >> i & 1) << (2 * i) for i in range(30))

    rows = [(0, 0), (1, 0), (0, 1), (2**30 - 1, 0), (0, 2**30 - 1), (4_007_501, 2_003_750), (123, 456)]
    up = quad_key("shiftright(x, 1)", "shiftright(y, 1)")
    for r in spark.createDataFrame(rows, "x long, y long").selectExpr("*", f"{quad_key('x', 'y')} AS q", f"{up} AS up").collect():
        assert r.q == plain(r.x, r.y) and r.up == r.q >> 2


def test_area_is_the_same_at_every_level(spark, pixels):
    whole = {r.event_id: r.area_km2 for r in area_km2(pixels, value="water").collect() if r.area_km2}
    sums = pyramid.cell_sums(pixels, value="water").collect()
    cells = {(r.x, r.y) for r in pixels.where("event_id = 1 AND water = 1").collect()}
    for level in range(pyramid.BASE_LEVEL, pyramid.TOP_LEVEL + 1):
        mine = [r for r in sums if r.level == level]
        for event, area in whole.items():
            assert math.isclose(sum(r.area_m2 for r in mine if r.event_id == event), area * 1e6, rel_tol=1e-12)
        assert sum(r.pixels for r in mine if r.event_id == 1) == len(cells)
        assert len([r for r in mine if r.event_id == 1]) == len({(x >> level, y >> level) for x, y in cells})


@pytest.mark.parametrize("budget, n_images", [(1, 3), (50, 3), (5000, None), (10**9, 3)])
def test_level_keeps_to_the_budget_and_the_area(spark, pixels, budget, n_images):
    whole = {r.event_id: r.area_km2 for r in area_km2(pixels, value="water").collect()}
    got = {r.event_id: r for r in pyramid.area_within(pixels, value="water", max_pixels=budget, n_images=n_images).collect()}
    assert set(got) == {1, 2} and got[2].level == 0
    for event, r in got.items():
        assert math.isclose(r.area_km2, whole[event], rel_tol=1e-12) and r.cells <= budget
    cells = [(r.x, r.y) for r in pixels.where("event_id = 1 AND water = 1").collect()]
    box = lambda n: math.prod((max(c[i] for c in cells) >> n) - (min(c[i] for c in cells) >> n) + 1 for i in (0, 1))
    assert box(got[1].level) <= budget and (got[1].level == 0 or box(got[1].level - 1) > budget)


def test_budget_must_be_positive(pixels):
    with pytest.raises(ValueError):
        pyramid.area_within(pixels, max_pixels=0)


def test_small_borders_are_traced_together(spark, monkeypatch):
    area = frame(spark, PARTS)
    whole = {tuple(r) for r in overlay.dissolve(area).selectExpr("aoi_id", "part", "ring", "to_json(pts)").collect()}
    edges = overlay.border(area).selectExpr("*", "0L AS root").toPandas()
    assert set(overlay._rings_of(edges)["aoi_id"]) == set(PARTS)
    monkeypatch.setattr(overlay, "TRACE_EDGES", 1)
    assert {tuple(r) for r in overlay.dissolve(area).selectExpr("aoi_id", "part", "ring", "to_json(pts)").collect()} == whole
