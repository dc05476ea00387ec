"""Stored catalog and elevation: the same answers, from a part of the files and without shuffles."""

import random
from datetime import datetime, timedelta

import pytest

from inundation.operators.terrain import slope_degrees
from inundation.sources import catalog
from inundation.sources.rasters import constant_raster
from inundation.sources.stored import append_scenes, read_elevation, slope_of_blocks, write_elevation

SCHEMA = "scene_id string, acquired_at timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double, instrument_mode string, resolution_meters int, cloudy_pixel_percentage int"


def scenes_of(n, seed=1, first=datetime(2025, 1, 1), days=90):
    rng = random.Random(seed)
    for i in range(n):
        lon, lat, w, h = rng.uniform(-180, 180), rng.uniform(-85, 83), rng.uniform(0.5, 4), rng.uniform(0.5, 2)
        if i % 50 == 0:
            w, h = 40.0, 30.0
        yield (f"s{seed}-{i}", first + timedelta(minutes=rng.randrange(days * 1440)), lon, lat, lon + w, lat + h, "IW", 10, rng.randrange(60))


BOXES = [(1.0, 6.0, 1.5, 6.5), (-180.0, -90.0, 180.0, 90.0), (178.0, -20.0, -178.0, -15.0), (179.0, 10.0, 183.0, 12.0), (-181.0, 10.0, -179.0, 12.0), (22.5, 0.0, 22.5, 0.0)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('catalog')}/scenes"
    df = spark.createDataFrame(list(scenes_of(900, days=70)), SCHEMA)
    assert append_scenes(df, path) == 900
    return df, path


@pytest.mark.parametrize("box", BOXES)
def test_scans_of_a_stored_catalog_give_the_same(spark, stored, box):
    df, path = stored
    kept = spark.read.parquet(path)
    for period in (("2025-02-01", "2025-03-01"), (datetime(2025, 1, 10, 6), datetime(2025, 1, 20, 18))):
        a, b = (catalog.optical_scenes(x, box, *period) for x in (df, kept))
        assert a.columns == b.columns and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        assert catalog.radar_scenes(kept, box, *period).count() == catalog.radar_scenes(df, box, *period).count()


def test_a_month_opens_its_days_and_few_of_their_files(spark, stored):
    _, path = stored
    kept = spark.read.parquet(path)
    opened = catalog.radar_scenes(kept, (1.0, 6.0, 1.5, 6.5), "2025-02-01", "2025-03-01")
    plan = opened._jdf.queryExecution().optimizedPlan().toString()
    assert "acquired_on#" in plan.split("Filter")[1] and "zone#" in plan.split("Filter")[1]
    month = kept.where("acquired_on BETWEEN DATE '2025-02-01' AND DATE '2025-03-01'")
    wanted = month.where(catalog.in_zones(1.0, 6.0, 1.5, 6.5))
    count = lambda df: df.selectExpr("_metadata.file_path AS f").distinct().count()
    assert 0 < count(wanted) < count(month) / 10 and count(month) < count(kept) * 0.6


def test_appending_adds_only_what_is_new(spark, tmp_path):
    path = f"{tmp_path}/scenes"
    first, more = (spark.createDataFrame(list(scenes_of(60, seed)), SCHEMA) for seed in (2, 3))
    assert append_scenes(first, path) == 60 and append_scenes(first, path) == 0
    before = {r.f for r in spark.read.parquet(path).selectExpr("_metadata.file_path AS f").distinct().collect()}
    assert append_scenes(first.unionByName(more).unionByName(more), path) == 60
    again = spark.read.parquet(path)
    assert again.count() == again.select("scene_id").distinct().count() == 120
    assert before < {r.f for r in again.selectExpr("_metadata.file_path AS f").distinct().collect()}
    assert append_scenes(first.limit(0), path) == 0


def test_slopes_of_stored_blocks_need_no_shuffle_and_are_the_same(spark, tmp_path):
    cells = constant_raster(spark, 1.0, 6.0, 1.3, 6.2, step=1 / 1200).selectExpr("x AS gx", "y AS gy", "CAST((x * 7 + y * y) % 53 AS DOUBLE) AS elevation")
    cells = cells.where("NOT (gx % 97 = 5 AND gy % 31 = 3)")
    edge = spark.range(30).selectExpr("IF(id % 3 = 2, 431999, id % 3) AS gx", "floor(id / 3) + 100 AS gy", "CAST(id % 7 AS DOUBLE) AS elevation")
    dem = cells.unionByName(edge)
    write_elevation(dem, f"{tmp_path}/dem")
    got = slope_of_blocks(read_elevation(spark, f"{tmp_path}/dem"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = slope_degrees(dem)
    key = lambda df: sorted(map(tuple, df.select("gx", "gy", "elevation", "slope_deg").collect()), key=str)
    assert key(got) == key(want) and got.where("slope_deg IS NULL").count() > 0 and got.where("gx = 0 AND slope_deg IS NOT NULL").count() > 0
    # Around a place only its blocks are opened.
    tile = lambda deg: int(deg / (10 / 111319.49)) // 256
    near = read_elevation(spark, f"{tmp_path}/dem", (tile(181.1), tile(181.11), tile(83.9), tile(83.91)))
    assert 0 < near.count() < spark.read.parquet(f"{tmp_path}/dem").count()
    inside = "gx BETWEEN 217330 AND 217331 AND gy BETWEEN 100681 AND 100690"
    assert key(slope_of_blocks(near).where(inside)) == key(want.where(inside)) and want.where(inside).count() > 0
