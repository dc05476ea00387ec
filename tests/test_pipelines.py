import json
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_queries import compare, duck
from inundation.functions import geometry as G
from inundation.operators import regions
from inundation.operators.regions import polygon_spans, tile_shapes
from inundation.operators.change import align, pair_counts
from inundation.operators.terrain import regrid_nearest
from inundation.functions.grid import METERS_PER_DEGREE, STEP_DEG, TILE
from inundation.operators.area import area_km2
from inundation.plans import report, sar, scope
from inundation.plans.optical import detect_ndwi
from inundation.plans.scope import make_scope
from inundation.sources.aoi import area_or_default, read_geojson
from inundation.sources.export import export_name, export_raster, write_pixels
from inundation.sources.rasters import constant_raster, read_pixels

SMALL = "/root/testdata/sf0.001"

# The box of the tests, the limits of the closed-form water masks in test_closed_form_ndwi_change, the square of the area
# documents, and the export name in test_export.
BOX = (1.0, 6.0, 1.5, 6.5)
SQUARE = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0)]
EVENT = "event_id long, event_ts timestamp_ntz"
SCENES = (
    "scene_id long, acquired_at timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double, "
    "instrument_mode string, resolution_meters int, cloudy_pixel_percentage int"
)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, SMALL)
    assert ok, note


def test_entry_has_rows(spark):
    assert {r.method for r in entry.entry(spark).collect()} == {"sar", "s2"}


def test_closed_form_ndwi_change(spark):
    """Water by longitude and latitude; the flood is exactly the new quarter."""
    # One cell in 30 both ways keeps the half-degree box small; areas scale by 900.
    step = 30 * STEP_DEG
    px = constant_raster(spark, *BOX, step=step)
    water = px.selectExpr(
        "1L AS event_id", "x", "y", "lon", "lat",
        "CAST(lon < 1.2 AND lat < 6.25 AS TINYINT) AS pre_water",
        "CAST((lon > 1.3 AND lat > 6.25) OR (lon < 1.2 AND lat < 6.25) AS TINYINT) AS post_water",
    )
    found = detect_ndwi(water, None)
    flood = report.flooded(found).join(px.select("x", "y", "lon", "lat"), ["x", "y"])
    assert flood.where("NOT (lon > 1.3 AND lat > 6.25)").count() == 0
    assert flood.count() == px.where("lon > 1.3 AND lat > 6.25").count() > 0
    fine = flood.selectExpr("event_id", "x * 30 + 15 AS x", "y * 30 + 15 AS y")
    assert area_km2(fine).first().area_km2 * 900 == pytest.approx(614.4, rel=0.01)
    assert found.counts.first().same_count
    with pytest.raises(ValueError):
        detect_ndwi(water.drop("pre_water"), None)


def world(spark):
    """A rectangle where land turns to water after the event, seen by radar and optical scenes."""
    west, south, east, north = 1.10, 6.10, 1.105, 6.104
    cells = constant_raster(spark, west, south, east, north)
    wet = "lon > 1.102 AND lat > 6.101"
    # A spread of values on both sides, so that the two modes have some width.
    noise = "pmod(x * 7 + y * 13, 16) / 8.0D"
    s1 = cells.selectExpr("x", "y", f"-20 + {noise} AS dry", f"IF({wet}, -34, -20) + {noise} AS after", "lon")
    s1 = s1.selectExpr("1L AS scene_id", "x", "y", "IF(lon < 1.101, -34 + 0.5D, dry) AS VV", "IF(lon < 1.101, -34 + 0.5D, dry) AS VH").union(
        s1.selectExpr("2L AS scene_id", "x", "y", "IF(lon < 1.101, -34 + 0.5D, after)", "IF(lon < 1.101, -34 + 0.5D, after)")
    )
    s2 = cells.selectExpr("1L AS scene_id", "x", "y", "500D AS B3", "2000D AS B8", "0 AS QA60").union(
        cells.selectExpr("2L", "x", "y", f"IF({wet}, 900D, 500D)", f"IF({wet}, 300D, 2000D)", "0")
    )
    scenes = spark.createDataFrame(
        [(1, datetime(2025, 6, 1), *BOX, "IW", 10, 5), (2, datetime(2025, 6, 3), *BOX, "IW", 10, 5)], SCENES
    )
    events = spark.createDataFrame([(1, datetime(2025, 6, 2)), (2, datetime(2020, 1, 1))], EVENT)
    area = G.areas(spark, {i: G.rectangle(1.09, 6.09, 1.12, 6.12) for i in (1, 2)})
    dem = constant_raster(spark, 1.05, 6.05, 1.15, 6.15, step=1 / 1200).selectExpr("x AS gx", "y AS gy", "10D AS elevation")
    want = cells.where(wet).selectExpr("1L AS event_id", "x", "y")
    return scenes, s1, s2, events, area, dem, want


def test_report_on_a_known_flood(spark, tmp_path):
    scenes, s1, s2, events, area, dem, want = world(spark)
    out = {(r.event_id, r.method): r for r in report.flood_report(events, area, dem, scenes, s1, scenes, s2, area).collect()}
    km2 = area_km2(want).first().area_km2
    assert out[1, "s2"].area_km2 == pytest.approx(km2, rel=1e-9)
    # Smoothing blurs the border of the 33-cell square, and carries it past the edge of the image, by up to three cells.
    assert km2 <= out[1, "sar"].area_km2 <= km2 * (39 / 33) ** 2
    assert out[2, "sar"].status == out[2, "s2"].status == "too_few_scenes" and out[2, "s2"].area_km2 is None
    only = report.flood_report(events, area, dem, scenes_s2=scenes, pixels_s2=s2, method="s2").collect()
    assert {r.method for r in only} == {"s2"}
    with pytest.raises(ValueError):
        report.flood_report(events, area, dem, method="radar")

    # The stored forms of the pixel table, by tile and by day and tile, give the same report.
    for name, listed in (("tiles", None), ("days", scenes)):
        write_pixels(s2, f"{tmp_path}/{name}", listed)
        stored = spark.read.parquet(f"{tmp_path}/{name}")
        again = report.flood_report(events, area, dem, scenes_s2=scenes, pixels_s2=stored, method="s2").collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, only))


def test_read_opens_the_days_and_tiles_it_wants(spark, tmp_path):
    """Scenes on many days over a wide strip: the read opens those of the picked scene's day beside the area."""
    cells = constant_raster(spark, 1.0, 6.0, 1.25, 6.002)
    px = cells.selectExpr("explode(sequence(0L, 9L)) AS scene_id", "x", "y", "1D AS B3", "2D AS B8")
    scenes = spark.range(10).selectExpr("id AS scene_id", "TIMESTAMP_NTZ '2025-06-01 10:00:00' + make_dt_interval(CAST(id AS INT)) AS acquired_at")
    write_pixels(px, f"{tmp_path}/px", scenes)
    stored = spark.read.parquet(f"{tmp_path}/px")
    scope = make_scope(spark.createDataFrame([(1, datetime(2025, 6, 4))], EVENT), G.areas(spark, {1: G.rectangle(1.1, 6.0, 1.101, 6.002)}))
    picks = scenes.where("scene_id IN (3, 4)").selectExpr("1L AS event_id", "IF(scene_id = 3, 'pre', 'post') AS side", "*")
    read = read_pixels(stored, picks, scope.aoi.cover(), ["B3", "B8"], rows=2 * scope.aoi.tile_rows, envelope=scope.aoi.envelope)
    got = read.groupBy("side").count().collect()
    inside = px.where("scene_id = 3").count()
    assert {r.side for r in got} == {"pre", "post"} and sum(r["count"] for r in got) < inside
    days = {r[0].day for r in stored.where(scan_filter(read)).select("acquired_on").distinct().collect()}
    assert days == {4, 5}
    # Beside the literal limits, the list prunes at run time.
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()


def test_read_by_day_has_pixels_that_came_before_their_scene(spark, tmp_path):
    """Pixels of a scene that was listed only after they were stored have no day."""
    px = constant_raster(spark, 1.1, 6.0, 1.101, 6.002).selectExpr("explode(sequence(3L, 5L)) AS scene_id", "x", "y", "1D AS B3", "2D AS B8")
    scenes = spark.range(10).selectExpr("id AS scene_id", "TIMESTAMP_NTZ '2025-06-01 10:00:00' + make_dt_interval(CAST(id AS INT)) AS acquired_at")
    write_pixels(px, f"{tmp_path}/px", scenes.where("scene_id <> 4"))
    scope = make_scope(spark.createDataFrame([(1, datetime(2025, 6, 4))], EVENT), G.areas(spark, {1: G.rectangle(1.1, 6.0, 1.101, 6.002)}))
    picks = scenes.where("scene_id IN (3, 4)").selectExpr("1L AS event_id", "IF(scene_id = 3, 'pre', 'post') AS side", "*")
    read = lambda p: sorted(map(tuple, read_pixels(p, picks, scope.aoi.cover(), ["B3", "B8"], envelope=scope.aoi.envelope).collect()))
    want = read(px)
    assert {x[1] for x in want} == {"pre", "post"} and read(spark.read.parquet(f"{tmp_path}/px")) == want


def scan_filter(df):
    """The partition filters of a read that are literals."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    low, high = re.search(r"acquired_on#\d+ >= (\S+?)\)", plan)[1], re.search(r"acquired_on#\d+ <= (\S+?)\)", plan)[1]
    return f"acquired_on BETWEEN DATE '{low}' AND DATE '{high}'"


def test_small_threshold_region_is_read_by_itself(spark, monkeypatch):
    """A region that is read and smoothed from its own tiles gives the thresholds of one that is clipped from all pixels."""
    scenes, s1, _, events, area, dem, _ = world(spark)
    region = G.areas(spark, {i: G.rectangle(1.1012, 6.1005, 1.1035, 6.1025) for i in (1, 2)})
    scope = make_scope(events, area, region)
    assert 0 < scope.otsu.cells < sar.SMALL_REGION * scope.aoi.cells
    reports = []
    for small in (sar.SMALL_REGION, 0.0):
        monkeypatch.setattr(sar, "SMALL_REGION", small)
        reports.append(report.flood_report(events, area, dem, scenes, s1, otsu_aois=region, method="sar").orderBy("event_id").collect())
    assert reports[0][0].threshold_pre is not None and not reports[0][0].threshold_defaulted
    assert [[v if not isinstance(v, float) else pytest.approx(v, rel=1e-9) for v in a] for a in reports[0]] == [list(b) for b in reports[1]]


def test_groups_of_events_give_the_same_report(spark):
    scenes, s1, s2, _, _, dem, _ = world(spark)
    events = spark.createDataFrame([(i, datetime(2025, 6, 2)) for i in range(1, 7)], EVENT)
    area = G.areas(spark, {i: G.rectangle(1.1 + i / 2000, 6.09, 1.1021 + i / 2000, 6.12) for i in range(1, 6)})
    whole = report.flood_report(events, area, dem, scenes, s1, scenes, s2, area).collect()
    assert {r.event_id: r.status for r in whole} == {**{i: "ok" for i in range(1, 6)}, 6: "no_area"} and len(whole) == 12
    parts = report.flood_report(events, area, dem, scenes, s1, scenes, s2, area, batch_rows=20).collect()
    key = lambda r: (r.event_id, r.method)
    for a, b in zip(sorted(whole, key=key), sorted(parts, key=key), strict=True):
        assert [v if not isinstance(v, float) else pytest.approx(v, rel=1e-9) for v in a] == list(b)


def many_small_events(spark, n):
    """Events on one small scene, side by side and over each other, most of them at one place."""
    scenes, s1, s2, _, _, dem, _ = world(spark)
    events = spark.range(n).selectExpr("id AS event_id", "TIMESTAMP_NTZ '2025-06-02 00:00:00' AS event_ts")
    ring = ", ".join(f"named_struct('lon', {x}, 'lat', {y})" for x, y in (("w", "6.101D"), ("w + 0.001D", "6.101D"), ("w + 0.001D", "6.102D"), ("w", "6.102D")))
    area = events.selectExpr("event_id AS aoi_id", "1.1D + IF(event_id % 3 = 0, event_id % 40, 7) / 10000D AS w").selectExpr("aoi_id", "0 AS part", "0 AS ring", f"array({ring}) AS pts")
    return scenes, s2, events, area, dem


def test_batches_hold_every_event_once_and_keep_their_bound(spark):
    *_, events, area, _ = many_small_events(spark, 500)
    lone = events.unionByName(spark.createDataFrame([(900, datetime(2025, 6, 2))], EVENT))
    batches = scope.place_batches(lone, area, 120)
    ids = [sorted(r.event_id for r in b.collect()) for _, b in batches]
    assert sorted(i for b in ids for i in b) == [*range(500), 900] and len(batches) > 10
    rows_of = {r.aoi_id: r.n for r in tile_shapes(polygon_spans(area)).groupBy("aoi_id").agg(F.count("*").alias("n")).collect()}
    assert max(sum(rows_of.get(i, 0) for i in b) for b in ids) < 2 * 120
    again = scope.place_batches(lone.repartition(7), area.repartition(3), 120)
    assert [n for n, _ in again] == [n for n, _ in batches] and len({n for n, _ in batches}) == len(batches)
    moved = lone.withColumn("event_ts", F.expr("IF(event_id = 3, event_ts + INTERVAL 1 DAY, event_ts)"))
    assert len({n for n, _ in scope.place_batches(moved, area, 120)} & {n for n, _ in batches}) == len(batches) - 1
    assert len(scope.place_batches(lone, area, 10**6)) == 1


def test_two_thousand_events_and_a_second_call_that_does_what_is_missing(spark, tmp_path, monkeypatch):
    scenes, s2, events, area, dem = many_small_events(spark, 2000)
    how = {"scenes_s2": scenes, "pixels_s2": s2, "method": "s2", "batch_rows": 3_000}
    ran, plain = [], report.branch_runs

    def counted(*args, **options):
        runs = plain(*args, **options)

        def run(name):
            ran.append(name)
            if len(ran) == 2 and broken:
                raise RuntimeError("lost")
            return runs[name]()

        return {name: lambda name=name: run(name) for name in runs}

    monkeypatch.setattr(report, "branch_runs", counted)
    broken = True
    folder = f"{tmp_path}/results"
    n = len(scope.place_batches(events, area, 3_000))
    assert n >= 3
    with pytest.raises(RuntimeError, match="lost"):
        report.flood_report(events, area, dem, results=folder, at_a_time=2, **how)
    assert len(ran) == n  # the others had their turn
    broken, before = False, len(ran)
    out = report.flood_report(events, area, dem, results=folder, **how)
    assert len(ran) == before + 1
    got = out.collect()
    assert len(got) == 2000 and {r.event_id for r in got} == set(range(2000)) and {r.status for r in got} == {"ok"}
    # The plan reads one table, however many groups there were; a third call runs nothing.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert report.flood_report(events, area, dem, results=folder, **how).count() == 2000 and len(ran) == before + 1
    # Events of the same place have the same figures.
    same = {r.area_km2 for r in got if r.event_id % 3}
    assert len(same) == 1
    # Other options or methods are other rows.
    few, own = events.where("event_id < 3"), area.where("aoi_id < 3")
    one = report.flood_report(few, own, dem, scenes_s2=scenes, pixels_s2=s2, method="s2", results=folder, min_connected=10**6)
    assert {r.area_km2 for r in one.collect()} == {0.0}


def test_exports_of_all_events_in_one_call(spark, tmp_path, monkeypatch):
    scenes, s1, s2, _, area, dem, want = world(spark)
    events = spark.createDataFrame([(1, datetime(2025, 6, 2)), (2, datetime(2025, 6, 2, 12))], EVENT)
    middle = want.agg(F.expr("CAST((min(x) + max(x)) / 2 AS INT)")).first()[0] * STEP_DEG - 180
    area = G.areas(spark, {1: G.rectangle(1.09, 6.09, 1.12, 6.12), 2: G.rectangle(1.09, 6.09, middle, 6.12)})
    where = (events, area, dem, f"{tmp_path}/out/", "t1", scenes, s1, scenes, s2, area)
    got = report.flood_exports(*where, batch_rows=20).collect()
    assert {r.name for r in got} == {"Effective_Flood_Extent_SAR_20250602_t1", "Flood_Extent_S2_NDWI_20250602_t1"}
    optical = {(r.event_id, r.x, r.y) for r in got if r.name.startswith("Flood_Extent_S2")}
    whole = {(r.x, r.y) for r in want.collect()}
    inside = {(r.x, r.y) for r in regions.clip(want.select("x", "y"), polygon_spans(area.where("aoi_id = 2"))).collect()}
    assert optical == {(1, *c) for c in whole} | {(2, *c) for c in inside} and 0 < len(inside) < len(whole)
    assert all((r.tile_x, r.tile_y, r.flood) == (r.x // 4096, r.y // 4096, 1) for r in got)
    # The same call writes nothing more; another timestamp is another export.
    monkeypatch.setattr(report, "branch_runs", None)
    assert len(report.flood_exports(*where, batch_rows=20).collect()) == len(got)
    with pytest.raises(TypeError):
        report.flood_exports(*where[:4], "t2", *where[5:], batch_rows=20)


def test_slope_limit_in_percent(spark):
    flood = constant_raster(spark, 1.1, 6.1, 1.11, 6.103).selectExpr("1L AS event_id", "x", "y")
    dem = constant_raster(spark, 1.09, 6.09, 1.12, 6.12, step=1 / 1200).selectExpr("x AS gx", "y AS gy", "CAST(x * 9 AS DOUBLE) AS elevation")
    count = lambda **how: report.refine_extent(flood, dem, **how).count()
    # 9 m over a cell of 92 m is 9.8 percent, or 5.6 degrees.
    assert (count(max_slope_deg=9.0), count(max_slope_percent=9.0), count(max_slope_percent=10.0)) == (flood.count(), 0, flood.count())


def test_geojson_with_latitude_first(spark, tmp_path):
    ring = [[-1.0, 10.0], [1.0, 10.0], [1.0, 12.0], [-1.0, 12.0], [-1.0, 10.0]]
    for name, points in (("lon", ring), ("lat", [p[::-1] for p in ring])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"type": "Polygon", "coordinates": [points]}))
    a, b = (read_geojson(spark, str(tmp_path / f"{n}.json"), lat_first=n == "lat").first().pts for n in ("lon", "lat"))
    assert a == b and area_or_default(spark, str(tmp_path / "lat.json"), lat_first=True).first().pts == a


def test_a_branch_that_fails_leaves_the_other(spark):
    scenes, s1, s2, events, area, dem, _ = world(spark)
    out = {(r.event_id, r.method): r for r in report.flood_report(events, area, dem, scenes, s1.drop("VH"), scenes, s2, area).collect()}
    assert out[1, "s2"].status == "ok" and out[1, "s2"].area_km2 > 0
    assert out[1, "sar"].status == "failed: ValueError: The radar pixels have no band VH" and out[1, "sar"].area_km2 is None
    with pytest.raises(ValueError, match="no band VH"):
        report.flood_report(events, area, dem, scenes, s1.drop("VH"), method="sar")
    # A fault that shows only when pixels are read.
    bad = s1.withColumn("VV", F.expr("CAST(raise_error('unreadable') AS DOUBLE)"))
    out = {(r.event_id, r.method): r for r in report.flood_report(events, area, dem, scenes, bad, scenes, s2, area).collect()}
    assert out[1, "s2"].status == "ok" and out[1, "sar"].status.startswith("failed: ")
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("name", ["sar_flood_extent", "connected_pixel_count", "refined_extent", "flood_area", "export_roundtrip", "flood_report"])
def test_queries_give_back_what_they_keep(spark, name):
    entry.queries()[name](spark, SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_result_does_not_depend_on_partitioning(spark):
    scenes, s1, s2, events, area, dem, _ = world(spark)
    first = report.flood_report(events, area, dem, scenes, s1, scenes, s2).collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        mixed = report.flood_report(
            events, area, dem, scenes, s1.orderBy(F.rand(1)), scenes, s2.orderBy(F.rand(2)).repartition(5)
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda r: (r.event_id, r.method)
    for a, b in zip(sorted(first, key=key), sorted(mixed, key=key)):
        assert [v if isinstance(v, str) or v is None else pytest.approx(v, rel=1e-9) for v in a] == list(b)


def test_invariants(spark):
    d = "/root/testdata/sf0.001"
    scope = entry._main_scope(spark, d)
    branch = entry._main_optical(spark, d, scope)
    wet = report.flooded(branch)
    on = ["event_id", "x", "y"]
    assert wet.join(branch.detected.where("water_post = 1"), on, "left_anti").count() == 0
    assert wet.join(branch.detected.where("water_pre = 1"), on, "left_semi").count() == 0
    assert entry._refined(spark, d, branch, scope).join(wet, on, "left_anti").count() == 0
    branch.release()


# --- sources and sinks


def write(path, doc):
    path.write_text(doc if isinstance(doc, str) else json.dumps(doc))
    return str(path)


def poly(*rings):
    return {"type": "Polygon", "coordinates": [[list(p) for p in r] for r in rings]}


def test_geojson_kinds(spark, tmp_path):
    hole = [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.0)]
    feature = lambda g: {"type": "Feature", "properties": {"a": 1}, "geometry": g}
    docs = {
        "a": {"type": "FeatureCollection", "features": [feature(poly(SQUARE))]},
        "b": feature(poly(SQUARE, hole)),
        "c": poly(SQUARE),
        "d": {"type": "FeatureCollection", "features": [feature(poly(SQUARE)), feature({"type": "MultiPolygon", "coordinates": [[SQUARE], [hole]]})]},
        "e": {"type": "GeometryCollection", "geometries": [poly(SQUARE), {"type": "Point", "coordinates": [0, 0]}]},
    }
    for name, doc in docs.items():
        write(tmp_path / f"{name}.geojson", doc)
    got = read_geojson(spark, str(tmp_path)).selectExpr("substring(path, -9, 1) AS n", "part", "ring", "size(pts) AS k").collect()
    assert sorted(map(tuple, got)) == [
        ("a", 0, 0, 5), ("b", 0, 0, 5), ("b", 0, 1, 4), ("c", 0, 0, 5), ("d", 0, 0, 5), ("d", 1, 0, 5), ("d", 2, 0, 4), ("e", 0, 0, 5),
    ]
    one = read_geojson(spark, str(tmp_path / "a.geojson")).first()
    assert [tuple(p) for p in one.pts] == SQUARE


def test_geojson_lines_have_ids_of_their_own(spark, tmp_path):
    doc = lambda i, x: json.dumps(poly([(x, 6.1), (x + 0.5, 6.1), (x, 6.2)]) | ({} if i is None else {"id": i}))
    lines = lambda name, *docs: write(tmp_path / name, "\n".join([*docs, ""]))
    got = read_geojson(spark, lines("two.geojsonl", doc(7, 1.0), doc(-8, 2.0)), lines=True).selectExpr("aoi_id", "part", "ring", "pts[0].lon").collect()
    assert sorted(map(tuple, got)) == [(-8, 0, 0, 2.0), (7, 0, 0, 1.0)]
    for name, docs, why in (("twice", (doc(7, 1.0), doc(7, 2.0)), "7 repeats"), ("none", (doc(None, 1.0),), "is missing"), ("bad", (doc(1, 1.0), "{not"), "Invalid GeoJSON")):
        with pytest.raises(ValueError, match=why):
            read_geojson(spark, lines(f"{name}.geojsonl", *docs), lines=True)


@pytest.mark.parametrize("name", ["geojson_area", "dissolved_area", "dissolved_geometry"])
def test_documents_of_sites_share_files(spark, name):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("geojson-*"))
    found = entry.queries()[name](spark, SMALL).count()
    (written,) = set(folder.glob("geojson-*")) - before
    files = len(list(written.rglob("part-*")))
    documents = sum(len(f.read_text().splitlines()) for f in written.rglob("part-*"))
    assert found == documents and files < documents


def test_geojson_errors_and_fallback(spark, tmp_path):
    with pytest.raises(ValueError, match="GeoJSON file not found"):
        read_geojson(spark, str(tmp_path / "missing.geojson"))
    with pytest.raises(ValueError, match="Invalid GeoJSON"):
        read_geojson(spark, write(tmp_path / "bad.geojson", "{not json"))
    with pytest.raises(ValueError, match="Error loading"):
        read_geojson(spark, write(tmp_path / "other.geojson", {"hello": 1}))
    # Documents of one directory are united.
    folder = tmp_path / "two"
    folder.mkdir()
    for n, x in (("a", 1.1), ("b", 1.104)):
        write(folder / f"{n}.geojson", poly([(x, 6.1), (x + 0.01, 6.1), (x + 0.01, 6.11), (x, 6.11), (x, 6.1)]))
    united = regions.polygon_spans(area_or_default(spark, str(folder), 7)).selectExpr("sum(x_hi - x_lo + 1)").first()[0]
    assert united == regions.polygon_spans(G.areas(spark, {7: G.rectangle(1.1, 6.1, 1.114, 6.11)})).selectExpr("sum(x_hi - x_lo + 1)").first()[0]
    default = area_or_default(spark, str(tmp_path / "missing.geojson"), 7).first()
    assert default.aoi_id == 7 and len(default.pts) == 5
    assert area_or_default(spark, write(tmp_path / "ok.geojson", poly(SQUARE)), 7).first().pts[0].lon == -1.0


def test_parts_of_a_directory_differ_without_one_task_for_all(spark, tmp_path):
    for n in "abc":
        write(tmp_path / f"{n}.geojson", {"type": "MultiPolygon", "coordinates": [[SQUARE, SQUARE], [SQUARE]]})
    area = area_or_default(spark, str(tmp_path), 7)
    assert sorted(r["count"] for r in area.groupBy("part").count().collect()) == [1, 1, 1, 2, 2, 2]
    plan = area._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_default_areas(spark):
    scope = make_scope(spark.createDataFrame([(1, datetime(2025, 6, 2))], EVENT), area_or_default(spark, None, 1))
    assert scope.n_events == 1 and scope.aoi.cells == pytest.approx(27.7e6, rel=0.02)
    assert scope.otsu.cells == pytest.approx(9.4e3, rel=0.05) and scope.otsu.span_rows == scope.otsu.spans.count()
    assert scope.aoi.cover(3).count() <= scope.aoi.tile_rows
    x0, x1, y0, y1 = scope.aoi.envelope
    out = scope.aoi.spans.where(f"x_lo < {x0 * TILE} OR x_hi >= {(x1 + 1) * TILE} OR y < {y0 * TILE} OR y >= {(y1 + 1) * TILE}")
    assert out.count() == 0


def test_export(spark, tmp_path):
    name = export_name("Flood_Extent_S2_NDWI", "2025-06-02", "20250603_101500")
    assert name == "Flood_Extent_S2_NDWI_20250602_20250603_101500"
    raster = constant_raster(spark, 1.1, 6.1, 1.11, 6.11)
    spans = regions.polygon_spans(G.areas(spark, {1: G.rectangle(1.1, 6.1, 1.105, 6.11)}))
    path = export_raster(raster.select("x", "y", "value"), f"{tmp_path}/", name, spans)
    assert path.endswith(name)
    back = spark.read.parquet(path)
    assert back.count() == raster.where("lon >= 1.1 AND lon < 1.105").count()
    coarse = export_raster(raster.select("x", "y", "value"), f"{tmp_path}/", "coarse", spans, scale_m=30)
    inside = regions.clip(raster.select("x", "y", "value"), spans)
    assert spark.read.parquet(coarse).count() == regrid_nearest(inside, STEP_DEG, 30 / METERS_PER_DEGREE).count()


def test_align_is_the_inner_and_outer_view(spark):
    df = spark.createDataFrame(
        [(1, "pre", 0, 0, 1.0), (1, "post", 0, 0, 2.0), (1, "pre", 1, 0, 3.0)], "event_id int, side string, x int, y int, v double"
    )
    got = sorted((r.x, r.pre_v, r.post_v) for r in align(df, ["v"]).collect())
    assert got == [(0, 1.0, 2.0), (1, 3.0, None)]
    assert not pair_counts(align(df, ["v"]), "v").first().same_count
