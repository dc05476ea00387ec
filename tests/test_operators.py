import itertools
import math
import random
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inundation.functions import bands as B
from inundation.functions import geometry as G
from inundation.functions.grid import METERS_PER_DEGREE, STEP_DEG, center_lat, center_lon
from inundation.operators import change, histogram, layers, overlay, regions
from inundation.operators.area import area_km2
from inundation.operators.components import connected_pixel_count, drop_small_patches
from inundation.operators.composite import median_composite
from inundation.operators.focal import speckle_smooth
from inundation.operators.histogram import band_histogram, otsu_threshold
from inundation.operators.lookup import lookup_join
from inundation.operators.terrain import dem_near, drop_steep, regrid_nearest, slope_degrees
from inundation.sources import catalog
from inundation.sources.rasters import constant_raster


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# --- bands and masks


def test_masks_and_index(spark):
    df = spark.createDataFrame(
        [(-30.0, 0, 0.0, 0.0), (-30.5, 1024, 3.0, 1.0), (None, 2048, 1.0, 3.0), (-5.0, 3, None, 1.0), (-1.0, 3072, 2.0, 2.0), (0.0, None, 4.0, 1.0)],
        "v double, QA60 int, B3 double, B8 double",
    )
    out = df.selectExpr(
        f"{B.edge_masked('v')} AS v", f"{B.cloud_free()} AS clear", f"{B.ndwi()} AS n", f"{B.ndwi_water()} AS w"
    ).collect()
    assert [r.v for r in out] == [-30.0, None, None, -5.0, -1.0, 0.0]
    assert [r.clear for r in out] == [True, False, False, True, False, None]
    assert [r.n for r in out] == [0.0, 0.5, -0.5, None, 0.0, 0.6]
    assert [r.w for r in out] == [0, 1, 0, None, 0, 1]
    assert B.percent_to_degrees(5) == pytest.approx(2.8624, abs=1e-4)


def test_layers(spark):
    df = spark.createDataFrame([(-25.0,), (0.0,), (-30.0,), (-12.5,), (None,)], "v double")
    got = df.selectExpr(f"{layers.stretch('v', -25, 0)} AS l").selectExpr(
        "l", f"{layers.colour('l', layers.WATER_PALETTE)} AS c", f"{layers.colour('l', layers.SAR_FLOOD_PALETTE)} AS r"
    )
    assert [tuple(r) for r in got.collect()] == [
        (0, "#ffffff", "#ff0000"), (255, "#0000ff", "#ff0000"), (0, "#ffffff", "#ff0000"), (127, "#8080ff", "#ff0000"), (None, None, None),
    ]


# --- neighbourhoods


def grid_frame(spark, cells, schema="scene_id int, x long, y long, v double"):
    return spark.createDataFrame(cells, schema)


@pytest.mark.parametrize("fill", [True, False])
def test_speckle_against_brute_force(spark, fill):
    rng = random.Random(1)
    x0, y0 = 128 * 5 - 9, 128 * 3 - 6
    px = {(x0 + i, y0 + j): (None if rng.random() < 0.2 else rng.randint(-900, 900) / 8) for i in range(20) for j in range(17) if rng.random() < 0.8}
    df = grid_frame(spark, [(1, x, y, v) for (x, y), v in px.items()])
    want = {}
    for x, y in itertools.product(range(x0 - 4, x0 + 25), range(y0 - 4, y0 + 22)):
        near = [px.get((x + a, y + b)) for a in range(-3, 4) for b in range(-3, 4)]
        near = [v for v in near if v is not None]
        if near and (fill or px.get((x, y)) is not None):
            want[x, y] = sum(near) / len(near)
    got = {(r.x, r.y): r.v for r in speckle_smooth(df, ["v"], fill_masked=fill).collect()}
    assert got == want
    small = {(r.x, r.y): r.v for r in speckle_smooth(df, ["v"], fill_masked=fill, block=8).collect()}
    assert small == want


def flood_fill(cells):
    left, sizes = dict(cells), {}
    while left:
        start = next(iter(left))
        value, stack, patch = left[start], [start], [start]
        del left[start]
        while stack:
            x, y = stack.pop()
            for a, b in itertools.product((-1, 0, 1), repeat=2):
                n = (x + a, y + b)
                if left.get(n) == value:
                    del left[n]
                    stack.append(n)
                    patch.append(n)
        sizes.update({c: len(patch) for c in patch})
    return sizes


@pytest.mark.parametrize("seed,density,block", [(1, 0.35, 256), (2, 0.45, 32), (3, 0.5, 16), (4, 0.6, 8)])
def test_components_against_flood_fill(spark, seed, density, block):
    rng = random.Random(seed)
    cells = {(250 + i, 251 + j): 1 for i in range(45) for j in range(40) if rng.random() < density}
    df = spark.createDataFrame([(1, x, y) for x, y in cells], "event_id int, x long, y long")
    got = {(r.x, r.y): r.component_size for r in connected_pixel_count(df, block=block).collect()}
    assert got == flood_fill(cells)


def test_components_long_snake_and_values(spark):
    # A winding line much longer than any halo, crossing many blocks, and equal-valued neighbours only.
    snake = []
    for row in range(12):
        xs = range(60) if row % 2 == 0 else range(59, -1, -1)
        snake += [(x, 3 * row) for x in xs]
        end = snake[-1][0]
        snake += [(end, 3 * row + 1), (end, 3 * row + 2)]
    df = spark.createDataFrame([(1, x, y) for x, y in snake], "event_id int, x long, y long")
    got = connected_pixel_count(df, block=16)
    assert {r.component_size for r in got.collect()} == {len(snake)} and got.count() == len(snake)
    rng = random.Random(9)
    cells = {(x, y): rng.choice([0, 1, 1]) for x in range(20) for y in range(20)}
    df = spark.createDataFrame([(1, x, y, v) for (x, y), v in cells.items()] + [(1, 50, 50, None)], "event_id int, x long, y long, v int")
    got = {(r.x, r.y): r.component_size for r in connected_pixel_count(df, value="v", block=8).collect()}
    assert got == flood_fill(cells)


def test_components_large_patch_over_many_blocks(spark):
    # A ring of 12,000 cells around the grid's origin, with a patch inside that it doesn't touch.
    ring = spark.range(-1500, 1500).selectExpr("1 AS event_id", "explode(array(-1500L, 1500L)) AS x", "id AS y").union(
        spark.range(-1499, 1500).selectExpr("1 AS event_id", "id AS x", "explode(array(-1500L, 1499L)) AS y")
    )
    inner = spark.range(-60, 60).selectExpr("1 AS event_id", "id AS x", "explode(sequence(-60L, 59L)) AS y")
    got = connected_pixel_count(ring.union(inner)).groupBy("component_size").count().collect()
    n = ring.distinct().count()
    assert n > 10_000 and sorted(map(tuple, got)) == sorted([(n, n), (120 * 120, 120 * 120)])


def test_minimum_patch(spark):
    def patch(n, x, y):
        return [(1, x + i, y + (i % 2)) for i in range(n)]

    cells = patch(7, 0, 0) + patch(8, 250, 300) + patch(9, 0, 500) + [(2, 251, 300)]
    df = spark.createDataFrame(cells, "event_id int, x long, y long")
    assert drop_small_patches(df).count() == 17
    block = spark.range(100).selectExpr("1 AS event_id", "250 + id % 10 AS x", "floor(id / 10) AS y")
    for least, left in ((64, 100), (65, 100), (100, 100), (101, 0), (2000, 0)):
        assert drop_small_patches(df.union(block), min_connected=least).count() == left


def test_slope_plane_and_gaps(spark):
    step = 1 / 1200
    cell = step * METERS_PER_DEGREE
    cells = [(x, y, 3.0 * x) for x in range(125, 132) for y in range(126, 131) if (x, y) != (128, 128)]
    got = {(r.gx, r.gy): r.slope_deg for r in slope_degrees(spark.createDataFrame(cells, "gx long, gy long, elevation double"), step).collect()}
    for (x, y), s in got.items():
        full = all((x + a, y + b) in got for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1)))
        if not full:
            assert s is None
        else:
            lat = 90 - (y + 0.5) * step
            assert s == pytest.approx(math.degrees(math.atan(3.0 / (cell * math.cos(math.radians(lat))))), rel=1e-12)
    assert sum(s is not None for s in got.values()) == 10


def test_steep_and_unknown_slopes_are_dropped(spark):
    flood = constant_raster(spark, 1.1, 6.1, 1.102, 6.102).withColumn("event_id", F.lit(1)).select("event_id", "x", "y")
    slope = spark.createDataFrame([(217320 + i, 100677 + j, float(5 * i)) for i in range(1, 3) for j in range(-3, 4)], "gx long, gy long, slope_deg double")
    assert drop_steep(flood, slope).count() < flood.count()
    assert drop_steep(flood, slope.where("false")).count() == 0


def test_median(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 5.0), (2, 0, 0, 1.0), (3, 0, 0, None), (4, 0, 0, 2.0), (1, 1, 0, 4.0), (2, 1, 0, 7.0), (1, 2, 0, None)],
        "scene_id int, x int, y int, v double",
    )
    assert rows(median_composite(df, ["v"]), "x", "v")[:2] == [(0, 2.0), (1, 5.5)]
    assert median_composite(df, ["v"]).where("x = 2").first().v is None


@pytest.mark.parametrize("factor", [1.0, 3.0, 2.0, 2.5, 0.5, 9.27])
def test_regrid_takes_the_cell_holding_the_centre(spark, factor):
    n = 24
    df = spark.createDataFrame([(x, y, 100 * x + y) for x in range(n) for y in range(n)], "x long, y long, v long")
    got = {(r.x, r.y): r.v for r in regrid_nearest(df, STEP_DEG, STEP_DEG * factor).collect()}
    src = lambda t: math.floor((t + 0.5) * factor + 1e-9)
    want = {(a, b): 100 * src(a) + src(b) for a in range(60) for b in range(60) if src(a) < n and src(b) < n}
    assert got == want


# --- thresholds


def numpy_otsu(v, bins=256):
    v = np.asarray(v)
    lo, hi = v.min(), v.max()
    w = 2.0 ** math.ceil(math.log2((hi - lo) / bins)) if hi > lo else 1.0
    if math.floor(hi / w) - math.floor(lo / w) + 1 > bins:
        w *= 2
    buckets = {}
    for x in v:
        buckets.setdefault(math.floor(x / w), []).append(x)
    means = np.array([np.mean(buckets[k]) for k in sorted(buckets)])
    weight = np.array([len(buckets[k]) for k in sorted(buckets)]) / len(v)
    below = np.array([weight[: i + 1].sum() for i in range(len(weight))])
    moment = np.array([(weight * means)[: i + 1].sum() for i in range(len(weight))])
    between = (moment[-1] * below - moment) ** 2 / (below * (1 - below) + 1e-10)
    return means[int(between.argmax())]


def test_otsu(spark):
    rng = random.Random(4)
    two = [rng.gauss(-22, 1) for _ in range(300)] + [rng.gauss(-12, 2) for _ in range(500)]
    data = [(1, i, 0, v) for i, v in enumerate(two)] + [(2, i, 0, 0.1) for i in range(10)] + [(3, 0, 0, None), (3, 1, 0, float("nan"))]
    df = spark.createDataFrame(data, "scene_id int, x int, y int, v double")
    wanted = spark.createDataFrame([(1,), (2,), (3,), (4,)], "scene_id int")
    got = {r.scene_id: r for r in otsu_threshold(df, "v", ["scene_id"], wanted, n_images=4).collect()}
    assert got[1].threshold == pytest.approx(numpy_otsu(two), rel=1e-12)
    # A constant image: the threshold is the constant itself, to the bit, so nothing lies below it.
    assert got[2].threshold == 0.1 and not got[2].threshold_defaulted
    assert got[3].threshold == -20.0 and got[3].threshold_defaulted and got[4].threshold_defaulted
    h = band_histogram(df, "v", ["scene_id"])
    assert h.groupBy("scene_id").count().agg(F.max("count")).first()[0] <= 256
    # Beyond the broadcast bound the join salts; the result is the same.
    salted = otsu_threshold(df, "v", ["scene_id"], wanted, n_images=None)
    assert {(r.scene_id, r.threshold) for r in salted.collect()} == {(k, r.threshold) for k, r in got.items()}


def plain_histogram(v, bins=256):
    lo, hi = min(v), max(v)
    w = 2.0 ** math.ceil(math.log2((hi - lo) / bins)) if hi > lo else 1.0
    if math.floor(hi / w) - math.floor(lo / w) + 1 > bins:
        w *= 2
    buckets = {}
    for x in v:
        buckets.setdefault(math.floor(x / w), []).append(x)
    return {(k, w): (len(x), sum(x)) for k, x in buckets.items()}


def test_histogram_of_parts_with_other_ranges(spark):
    """Each partition sees another part of an image's range: nothing, one value, a sliver far from zero, nearly all of it."""
    rng = random.Random(8)
    parts = [
        [], [5.0] * 9, [1000 + rng.randint(0, 64) / 4096 for _ in range(200)], [rng.randint(-8000, 8000) / 8 for _ in range(400)],
        [0.0, -0.0], [-3.25], [rng.randint(0, 3) / 65536 for _ in range(50)],
    ]
    cells = [(i, who, v) for i, p in enumerate(parts) for v in p for who in ("a", None, f"only {i}")]
    df = spark.createDataFrame(cells, "part int, who string, v double").repartitionByRange(len(parts), "part").withColumn("side", F.lit(1))
    got = {}
    for r in band_histogram(df, "v", ["who", "side"]).collect():
        got.setdefault(r.who, {})[r.bucket, r.width] = (r.n, r.total)
    want = {}
    for _, who, v in cells:
        want.setdefault(who, []).append(v)
    assert got == {who: plain_histogram(v) for who, v in want.items()}
    assert band_histogram(df.limit(0), "v", ["who"]).collect() == []


@pytest.mark.parametrize("held", [4, 50, 1 << 16])
def test_histogram_parts_that_are_added_up_again(monkeypatch, held):
    monkeypatch.setattr(histogram, "HELD_BUCKETS", held)
    rng = random.Random(9)
    rows_ = [(rng.randint(0, 5), rng.randint(-4000, 4000) / 16) for _ in range(3000)]
    batches = [pa.record_batch([pa.array(c) for c in zip(*rows_[i : i + 100])], ["k0", "v"]) for i in range(0, 3000, 100)]
    out = [r for b in histogram._partial_buckets(1, 256)(iter(batches)) for r in b.to_pylist()]
    for k in range(6):
        v = [x for i, x in rows_ if i == k]
        mine, w = [r for r in out if r["k0"] == k], next(iter(plain_histogram(v)))[1]
        added = {}
        for r in mine:
            assert r["w"] <= w and math.floor(r["lo"] / w) == math.floor(r["hi"] / w)
            n, t = added.get((math.floor(r["lo"] / w), w), (0, 0.0))
            added[math.floor(r["lo"] / w), w] = (n + r["n"], t + r["total"])
        assert added == plain_histogram(v)


def test_histogram_reads_pixels_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 AS scene_id", "id * 0.5D AS v").write.parquet(str(tmp_path / "px"))
    plan = otsu_threshold(spark.read.parquet(str(tmp_path / "px")), "v", ["scene_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_broadcast(spark, how):
    big = spark.range(5000).selectExpr("IF(id % 3 = 0, 7, id % 50) AS k", "id AS x")
    small = spark.range(40).selectExpr("id AS k", *(["id * 2 AS v"] if how != "left_semi" else []))
    a = lookup_join(big, small, ["k"], 40, how)
    b = lookup_join(big, small, ["k"], None, how, salt=["x"])
    assert rows(a, *a.columns) == rows(b, *a.columns) if how != "left" else a.exceptAll(b.select(*a.columns)).count() == 0


# --- change


def test_change_and_common_mask(spark):
    pairs = spark.createDataFrame(
        [(1, 0, 0, -25.0, -25.0), (1, 1, 0, -10.0, -25.0), (1, 2, 0, None, -25.0), (1, 3, 0, -25.0, -10.0), (2, 0, 0, -9.0, None), (2, 1, 0, None, -25.0)],
        "event_id int, x int, y int, pre_VH double, post_VH double",
    )
    counts = change.pair_counts(pairs, "VH")
    assert rows(counts, "event_id", "pre_px", "post_px", "same_count") == [(1, 3, 4, False), (2, 1, 1, True)]
    masked = change.common_mask(pairs, ["VH"], counts)
    assert masked.where("event_id = 1 AND x = 2").first().post_VH is None
    assert masked.where("event_id = 2 AND x = 1").first().post_VH == -25.0
    t = spark.createDataFrame([(1, -20.0, -20.0), (2, -20.0, -20.0)], "event_id int, threshold_pre double, threshold_post double")
    out = change.water_below(masked, "VH", t)
    assert rows(out.where("flood = 1"), "event_id", "x") == [(1, 1)]
    assert out.where("flood IS NOT NULL AND flood != 1").count() == 0
    narrow = spark.createDataFrame([(1, 0, 1, 0, 0)], "event_id int, x_lo int, x_hi int, y_lo int, y_hi int")
    assert rows(change.pair_counts(pairs.where("event_id = 1"), "VH", footprint=narrow), "pre_px", "post_px") == [(2, 2)]
    with pytest.raises(ValueError):
        change.with_threshold_band(pairs, "VV_minus_VH")
    with pytest.raises(ValueError):
        change.with_threshold_band(pairs, "VV")


def test_band_validity(spark):
    px = spark.createDataFrame([(1, 1.0, None), (1, None, 2.0), (2, 1.0, None)], "scene_id int, B3 double, B8 double")
    scenes = spark.createDataFrame([(1,), (2,), (3,)], "scene_id int")
    assert rows(change.band_validity(px, scenes), "scene_id", "has_required_bands_pixels") == [(1, True), (2, False), (3, False)]


# --- areas


def even_odd(rings, lon, lat):
    inside = False
    for ring in rings:
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            if (b > lat) != (d > lat) and lon < (c - a) * (lat - b) / (d - b) + a:
                inside = not inside
    return inside


def test_clip_against_even_odd(spark):
    o_lon, o_lat = 1.40, 6.27
    shell = [(o_lon, o_lat), (o_lon + 0.004, o_lat - 0.001), (o_lon + 0.005, o_lat - 0.005), (o_lon + 0.001, o_lat - 0.006), (o_lon + 0.002, o_lat - 0.003)]
    hole = [(o_lon + 0.003, o_lat - 0.002), (o_lon + 0.004, o_lat - 0.002), (o_lon + 0.0035, o_lat - 0.003)]
    area = G.areas(spark, {1: [shell, hole]})
    raster = constant_raster(spark, o_lon - 0.001, o_lat - 0.007, o_lon + 0.006, o_lat + 0.001)
    got = rows(regions.clip(raster, regions.polygon_spans(area)), "x", "y")
    want = sorted((r.x, r.y) for r in raster.collect() if even_odd([shell, hole], r.lon, r.lat))
    assert got == want and len(got) > 1000
    # Two overlapping parts are a union, not an even-odd of both.
    two = G.areas(spark, {1: [shell]}).unionByName(G.areas(spark, {1: G.rectangle(o_lon, o_lat - 0.004, o_lon + 0.004, o_lat - 0.001)}).withColumn("part", F.lit(1)))
    got = rows(regions.clip(raster.withColumn("event_id", F.lit(1)), regions.polygon_spans(two), "event_id"), "x", "y")
    box = lambda r: o_lon <= r.lon < o_lon + 0.004 and o_lat - 0.004 < r.lat < o_lat - 0.001
    assert got == sorted((r.x, r.y) for r in raster.collect() if even_odd([shell], r.lon, r.lat) or box(r))


def test_tiles_inside_an_area_carry_no_spans(spark):
    """A default-size area sends a tenth of its spans or less, lines of cells only along its border, and a pixel inside meets none."""
    spans = regions.polygon_spans(G.areas(spark, {1: G.DEFAULT_AOI})).cache()
    shapes = regions.tile_shapes(spans).cache()
    n, inner = shapes.count(), shapes.where("inner").count()
    assert n * 10 < spans.count() and inner > 0.9 * n and shapes.where("inner").where("lo IS NOT NULL OR hi IS NOT NULL").count() == 0
    cells = shapes.selectExpr(f"IF(inner, {64 * 64}, aggregate(zip_with(lo, hi, (a, b) -> greatest(b - a + 1, 0)), 0, (s, v) -> s + v)) AS n").agg(F.sum("n")).first()[0]
    assert cells == spans.selectExpr("sum(x_hi - x_lo + 1) AS n").first().n
    plan = regions.clip_tiles(spark.range(10).selectExpr("id AS x", "id AS y"), shapes, rows=n)._jdf.queryExecution().optimizedPlan().toString()
    assert "x_lo" not in plan.split("InMemoryRelation")[0]


def test_clip_where_rows_have_several_spans(spark):
    """A comb: rows of a tile with one, three and no spans; tiles inside, on the border and beside it."""
    o_lon, o_lat, step = 1.4, 6.27, STEP_DEG
    teeth = []
    for i in range(3):
        teeth += [(o_lon + (40 * i + a) * step, o_lat + b * step) for a, b in ((0, 0), (0, 30), (17, 30), (17, 0))]
    comb = [[*teeth, (o_lon + 197 * step, o_lat - 250 * step), (o_lon, o_lat - 250 * step)]]
    raster = constant_raster(spark, o_lon - 20 * step, o_lat - 300 * step, o_lon + 210 * step, o_lat + 60 * step)
    want = sorted((r.x, r.y) for r in raster.collect() if even_odd(comb, r.lon, r.lat))
    area = G.areas(spark, {1: comb, 2: G.rectangle(o_lon, o_lat, o_lon + 5 * step, o_lat + 5 * step)})
    spans = regions.polygon_spans(area)
    shapes = regions.tile_shapes(spans.where("aoi_id = 1"))
    assert shapes.groupBy("tx", "ty").count().agg(F.max("count")).first()[0] > 1 and shapes.where("inner").count() > 0
    one = spans.where("aoi_id = 1")
    for got in (regions.clip(raster, one), regions.clip(raster, one, rows=10**4), regions.clip(raster, one, rows=10**9)):
        assert rows(got, "x", "y") == want
    both = raster.withColumn("event_id", F.explode(F.array(F.lit(1), F.lit(2))))
    for n in (10**4, 10**9):
        got = regions.clip(both, spans, "event_id", n)
        assert rows(got.where("event_id = 1"), "x", "y") == want and got.where("event_id = 2").count() == 25


def test_buffer_spans_equal_distance(spark):
    raster = constant_raster(spark, 1.38, 6.25, 1.42, 6.29)
    center = spark.createDataFrame([(1, 1.4, 6.27, 1000.0)], "aoi_id long, lon double, lat double, meters double")
    got = rows(regions.clip(raster, regions.buffer_spans(center)), "x", "y")
    want = rows(raster.where(regions.within_buffer("lon", "lat", "1.4D", "6.27D", 1000.0)), "x", "y")
    assert got == want and len(got) == pytest.approx(math.pi * 100**2 / (METERS_PER_DEGREE / 111195.08) ** -2 / math.cos(math.radians(6.27)), rel=0.02)


def test_cover_and_boxes(spark):
    spans = regions.polygon_spans(G.areas(spark, {1: G.rectangle(1.40, 6.26, 1.41, 6.27)}))
    got = spans.agg(F.min("x_lo"), F.max("x_hi"), F.min("y"), F.max("y")).first()
    tiles = {(r.tx, r.ty) for r in regions.cover(spans, 3).collect()}
    assert tiles == {(a, b) for a in range((got[0] - 3) // 64, (got[1] + 3) // 64 + 1) for b in range((got[2] - 3) // 64, (got[3] + 3) // 64 + 1)}
    px = constant_raster(spark, 1.39, 6.25, 1.42, 6.28).select("x", "y")
    near = regions.in_areas(px, regions.cover(spans, 3))
    assert near.count() == (got[1] - got[0] + 7) * (got[3] - got[2] + 7) and near.select("x", "y").distinct().count() == near.count()


def test_area_of_square_and_closed_form(spark):
    square = constant_raster(spark, 1.1, 6.1, 1.101, 6.101).withColumn("event_id", F.lit(1))
    # 11 or 12 cells a side, by where the grid falls; a larger square is not so coarse.
    assert area_km2(square).first().area_km2 == pytest.approx(0.012294, abs=0.001)
    large = constant_raster(spark, 1.1, 6.1, 1.15, 6.15).withColumn("event_id", F.lit(1))
    assert area_km2(large).first().area_km2 == pytest.approx(0.012294 * 2500, rel=0.002)
    exact = overlay.measures(G.areas(spark, {1: G.rectangle(1.1, 6.1, 1.101, 6.101)})).first()
    assert exact.area_m2 / 1e6 == pytest.approx(0.012294, rel=1e-3)
    assert (exact.centroid_lon, exact.centroid_lat) == (pytest.approx(1.1005), pytest.approx(6.1005))
    holed = overlay.measures(G.areas(spark, {1: G.rectangle(0, 0, 2, 2) + G.rectangle(0, 0, 1, 2)})).first()
    assert holed.centroid_lon == pytest.approx(1.5) and holed.area_m2 == pytest.approx(overlay.measures(G.areas(spark, {1: G.rectangle(1, 0, 2, 2)})).first().area_m2)
    wanted = spark.createDataFrame([(1,), (2,)], "event_id int")
    assert {r.event_id: r.area_km2 > 0 for r in area_km2(square, wanted=wanted).collect()} == {1: True, 2: False}
    zero = square.withColumn("value", F.lit(0))
    assert area_km2(zero, value="value").first().area_km2 == 0.0


# --- catalogs


def scene(spark, *items):
    data = [(i, datetime.fromisoformat(t), *box) for i, t, box in items]
    return spark.createDataFrame(data, "scene_id string, acquired_at timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double")


def event(spark, box=(1.0, 6.0, 1.5, 6.5)):
    return spark.createDataFrame(
        [(1, datetime(2025, 6, 2), *box)], "event_id long, event_ts timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double"
    )


def test_windows_bounds_and_choice(spark):
    here, away, wide = (0.0, 5.0, 2.0, 7.0), (1.6, 6.0, 2.0, 7.0), (-60.0, -60.0, 60.0, 60.0)
    s = scene(
        spark,
        ("start", "2025-05-21T00:00:00", here),
        ("too_early", "2025-05-20T23:59:59", here),
        ("last", "2025-06-01T23:59:59", wide),
        ("last_b", "2025-06-01T23:59:59", here),
        ("at_event", "2025-06-02T00:00:00", here),
        ("end", "2025-06-14T00:00:00", here),
        ("away", "2025-06-03T00:00:00", away),
    )
    m = catalog.match_scenes(s, event(spark), 12)
    assert rows(m, "scene_id", "side") == [("at_event", "post"), ("last", "pre"), ("last_b", "pre"), ("start", "pre")]
    choice = catalog.scene_choice(m, event(spark))
    assert rows(catalog.nearest_scenes(choice), "side", "scene_id") == [("post", "at_event"), ("pre", "last")]
    for kept, status in ((["start"], "too_few_scenes"), (["start", "last"], "no_post_scene"), ([], "too_few_scenes")):
        c = catalog.scene_coverage(catalog.match_scenes(s.where(F.col("scene_id").isin(kept)), event(spark), 12), event(spark))
        assert c.first().status == status
        with pytest.raises(ValueError):
            catalog.require_coverage(c)
    one = s.withColumns({"instrument_mode": F.lit("IW"), "resolution_meters": F.lit(10), "cloudy_pixel_percentage": F.lit(30)})
    found = catalog.radar_scenes(one, (1.0, 6.0, 1.5, 6.5), "2025-05-21", "2025-06-14")
    assert found.count() == 4 and catalog.require_scenes(found) is found
    assert catalog.optical_scenes(one, (1.0, 6.0, 1.5, 6.5), "2025-05-21", "2025-06-14").count() == 0
    with pytest.raises(ValueError):
        catalog.require_scenes(found.limit(1))


def test_scenes_and_areas_over_180_degrees(spark):
    boxes = {"west": (-179.0, 0.0, -178.0, 1.0), "east": (178.0, 0.0, 179.0, 1.0), "over": (179.5, 0.0, 180.5, 1.0), "far": (0.0, 0.0, 1.0, 1.0), "all": (-180.0, 0.0, 180.0, 1.0)}
    s = scene(spark, *[(k, "2025-06-01T00:00:00", b) for k, b in boxes.items()])
    full = s.withColumns({"instrument_mode": F.lit("IW"), "resolution_meters": F.lit(10)})
    cases = {(177.0, 0.0, -177.0, 1.0): {"west", "east", "over", "all"}, (179.4, 0.0, 179.9, 1.0): {"over", "all"}, (-179.0, 0.0, -170.0, 1.0): {"west", "all"}, (2.0, 0.0, 3.0, 1.0): {"all"}, (175.5, 0.0, 177.5, 1.0): {"all"}}
    for box, want in cases.items():
        got = [r.scene_id for r in catalog.match_scenes(s, event(spark, box), 12).collect()]
        assert sorted(got) == sorted(want), box
        assert {r.scene_id for r in catalog.radar_scenes(full, box, "2025-06-01", "2025-06-02").collect()} == want


def pushed_filters(df):
    """What the scans of a plan push down, in full."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")
    return "\n".join(x for x in plan.splitlines() if "PushedFilters" in x)


def test_elevation_scan_is_limited_by_the_area(spark, tmp_path):
    spark.range(40).selectExpr("217677 + id AS gx", "100475 + id AS gy", "1D AS elevation").write.parquet(f"{tmp_path}/dem")
    spans = regions.polygon_spans(G.areas(spark, {1: G.rectangle(1.40, 6.26, 1.41, 6.27)}))
    box = spans.selectExpr("min(floor(x_lo / 256))", "max(floor(x_hi / 256))", "min(floor(y / 256))", "max(floor(y / 256))").first()
    dem = spark.read.parquet(f"{tmp_path}/dem")
    near = dem_near(dem, regions.cover(spans), envelope=tuple(box))
    pushed = pushed_filters(near)
    assert all(f"{c}," in pushed for c in ("GreaterThanOrEqual(gx", "LessThanOrEqual(gx", "GreaterThanOrEqual(gy", "LessThanOrEqual(gy"))
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, dem_near(dem, regions.cover(spans)).collect()))


def test_catalog_scan_is_limited_by_the_events(spark, tmp_path):
    scene(spark, ("a", "2025-06-01T00:00:00", (0.0, 5.0, 2.0, 7.0)), ("b", "2020-06-01T00:00:00", (0.0, 5.0, 2.0, 7.0))).write.parquet(f"{tmp_path}/catalog")
    met = catalog.match_scenes(spark.read.parquet(f"{tmp_path}/catalog"), event(spark), 12)
    pushed = pushed_filters(met)
    limits = ("GreaterThanOrEqual(acquired_at", "LessThan(acquired_at", "LessThanOrEqual(min_lat", "LessThanOrEqual(min_lon")
    assert all(f"{c}," in pushed for c in limits), pushed
    assert rows(met, "scene_id") == [("a",)]


def test_cells_of_events_are_merged_with_scenes_and_crowded_ones_dealt_out(spark, monkeypatch):
    rng = random.Random(5)
    boxes = [(x, y, x + 3, y + 2) for x, y in ((rng.uniform(-20, 20), rng.uniform(-10, 10)) for _ in range(60))]
    s = scene(spark, *[(f"s{i}", f"2025-06-{1 + i % 9:02d}T00:00:00", b) for i, b in enumerate(boxes)])
    ev = spark.createDataFrame(
        [(i, datetime(2025, 6, 5), x, y, x + 30, y + 15) for i, (x, y, _, _) in enumerate(boxes[:20])],
        "event_id long, event_ts timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double",
    )
    want = []
    for i, (x, y, _, _) in enumerate(boxes[:20]):
        for j, (a, b, c, d) in enumerate(boxes):
            if a <= x + 30 and c >= x and b <= y + 15 and d >= y and 2 <= 1 + j % 9 < 8:
                want.append((i, f"s{j}"))
    for part in (catalog.MATCH_PART, 2):
        monkeypatch.setattr(catalog, "MATCH_PART", part)
        met = catalog.match_scenes(s, ev, 3)
        joins = [x for x in met._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and " Inner" in x]
        # The rows of events are many times what a plan expects of them, so they must not go through the driver.
        assert joins and all("SortMergeJoin" in x for x in joins)
        assert rows(met, "event_id", "scene_id") == sorted(want)


def test_only_scenes_at_the_least_gap_are_sorted(spark):
    here = (0.0, 5.0, 2.0, 7.0)
    s = scene(spark, *[(f"s{i}", f"2025-06-{d:02d}T00:00:00", here) for i, d in enumerate((1, 1, 1, 3, 4, 4))])
    late = event(spark).selectExpr("2L AS event_id", "event_ts + INTERVAL '2' DAY AS event_ts", "min_lon", "min_lat", "max_lon", "max_lat")
    alone = event(spark, (50.0, 6.0, 51.0, 7.0)).withColumn("event_id", F.lit(3).cast("bigint"))
    events = event(spark).unionByName(late).unionByName(alone)
    matched = catalog.match_scenes(s, events, 12)
    choice = catalog.scene_choice(matched, events)
    assert rows(catalog.nearest_scenes(choice), "event_id", "side", "scene_id") == [(1, "post", "s3"), (1, "pre", "s0"), (2, "post", "s4"), (2, "pre", "s3")]
    assert rows(choice.drop("pre", "post"), "*") == rows(catalog.scene_coverage(matched, events), "*") == [(1, 6, 3, 3, "ok"), (2, 6, 4, 2, "ok"), (3, 0, 0, 0, "too_few_scenes")]
    # All pairs meet a filter by gap before any sort by event.
    assert "pre_gap" in choice._jdf.queryExecution().optimizedPlan().toString()


def test_footprints_are_tested_exactly(spark):
    ring = lambda *p: [[(float(a), float(b)) for a, b in p]]
    shapes = {
        "corner_only": ring((0.9, 5.9), (1.6, 5.9), (0.9, 5.95)),
        "crosses": ring((0.9, 5.9), (1.6, 5.9), (0.9, 6.6)),
        "around": ring((0, 5), (3, 5), (3, 8), (0, 8)),
        "within": ring((1.1, 6.1), (1.2, 6.1), (1.15, 6.2)),
    }
    data = [(k, datetime(2025, 6, 1), 0.0, 5.0, 3.0, 8.0, v) for k, v in shapes.items()]
    s = spark.createDataFrame(
        data,
        "scene_id string, acquired_at timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double, "
        "footprint array<array<struct<lon:double,lat:double>>>",
    )
    area = G.areas(spark, {1: G.rectangle(1.0, 6.0, 1.5, 6.5)})
    ev = event(spark).withColumn("parts", F.lit(None)).drop("parts").crossJoin(area.selectExpr(f"array({G.ring_edges('pts')}) AS parts"))
    assert rows(catalog.match_scenes(s, ev, 12), "scene_id") == [("around",), ("crosses",), ("within",)]


def test_events_with_parts_do_not_go_through_the_driver(spark):
    s = scene(spark, ("in", "2025-06-01T00:00:00", (1.1, 6.1, 1.2, 6.2)), ("touches", "2025-06-01T00:00:00", (1.5, 6.5, 2.0, 7.0)), ("holds", "2025-06-01T00:00:00", (0.0, 5.0, 3.0, 8.0)), ("cross", "2025-06-01T00:00:00", (0.0, 6.2, 3.0, 6.3)))
    corners = (("min_lon", "min_lat"), ("max_lon", "min_lat"), ("max_lon", "max_lat"), ("min_lon", "max_lat"))
    points = ", ".join(f"named_struct('lon', {x}, 'lat', {y})" for x, y in corners)
    ring = f"array({points})"
    ev = event(spark).withColumn("pts", F.expr(ring)).withColumn("parts", F.expr(f"array({G.ring_edges('pts')})")).drop("pts")
    met = catalog.match_scenes(s.withColumn("footprint", F.expr(f"array({ring})")), ev, 12)
    assert rows(met, "scene_id") == [("cross",), ("holds",), ("in",), ("touches",)]
    assert "BroadcastExchange" not in met._jdf.queryExecution().executedPlan().toString()


def shaped(spark, shapes, key="scene_id"):
    """Shapes given as parts, each a list of rings, with their boxes; the footprint is the first part."""
    rows_ = [(k, [[[(float(a), float(b)) for a, b in r] for r in part] for part in v]) for k, v in shapes.items()]
    df = spark.createDataFrame(rows_, f"{key} string, polygons array<array<array<struct<lon:double,lat:double>>>>")
    points = "flatten(flatten(polygons))"
    box = [f"array_{f}(transform({points}, p -> p.{c})) AS {f}_{c}" for f in ("min", "max") for c in ("lon", "lat")]
    return df.selectExpr(key, "polygons[0] AS footprint", f"transform(polygons, p -> {G.footprint_edges('p')}) AS parts", *box)


def star(rng, x, y, r, n, hole=0.0):
    """A ring around a place, concave in parts, and maybe a hole."""
    at = [2 * math.pi * i / n for i in range(n)]
    ring = [(x + r * rng.uniform(0.5, 1) * math.cos(a), y + r * rng.uniform(0.5, 1) * math.sin(a)) for a in at]
    return [ring] + ([[(x + hole * r * math.cos(a), y + hole * r * math.sin(a)) for a in at]] if hole else [])


def test_outlines_agree_with_the_polygons(spark):
    rng = random.Random(11)
    place = lambda: (rng.uniform(-4, 4), rng.uniform(-4, 4))
    shapes = {f"star{i}": [star(rng, *place(), rng.uniform(0.3, 3), rng.randint(3, 9), 0.3 * (i % 3 == 0))] for i in range(40)}
    shapes |= {f"two{i}": [star(rng, *place(), 0.6, 4), star(rng, *place(), 1.0, 5)] for i in range(10)}
    # On a lattice many only touch, by corners and sides.
    corner = lambda: (rng.randint(-4, 4), rng.randint(-4, 4))
    shapes |= {f"box{i}": [[[(x, y), (x + w, y), (x + w, y + h), (x, y + h)]]] for i, ((x, y), w, h) in enumerate((corner(), rng.randint(1, 3), rng.randint(1, 3)) for _ in range(20))}
    shapes |= {f"tip{i}": [[[(x - 1, y), (x, y - 1), (x + 1, y), (x, y + 1)]]] for i, (x, y) in enumerate(corner() for _ in range(20))}
    shapes |= {"flat": [[[(0, 0), (2, 0), (1, 0)]]], "point": [[[(1, 1)]]], "none": [[[]]]}
    made = G.outlines(shaped(spark, shapes, "k"), "parts", "o_").drop("footprint", "min_lon", "max_lon", "min_lat", "max_lat")
    sides = [made.select(*[F.col(c).alias(f"{s}_{c}") for c in made.columns]) for s in "ab"]
    tested = sides[0].crossJoin(sides[1]).withColumn("common", F.expr(G.common_box("a_o_", "b_o_"))).selectExpr(
        f"exists(a_parts, p -> exists(b_parts, q -> {G.polygons_meet('p', 'q')})) AS meet",
        f"exists(a_parts, p -> exists(b_parts, q -> {G.polygons_meet_in('common', 'p', 'q')})) AS near",
        f"{G.surely_meet('a_o_', 'b_o_')} AS sure",
        f"{G.may_meet('a_o_', 'b_o_')} AS may",
    )
    n = {tuple(r)[:4]: r.n for r in tested.groupBy("meet", "near", "sure", "may").agg(F.count("*").alias("n")).collect()}
    assert all(meet == near and (meet or not sure) and (may or not meet) for meet, near, sure, may in n), n
    # Both of them settle most pairs.
    assert n[True, True, True, True] > n[True, True, False, True] and n[False, False, False, False] > n[False, False, False, True], n


def exact_case(spark):
    ring = lambda *p: [[list(p)]]
    tip = lambda x, y: ring((x - 1, y), (x, y - 1), (x + 1, y), (x, y + 1))
    scenes_ = {"in": tip(5, 5), "side": tip(11, 5), "corner": tip(10.8, 10.15), "past": tip(10.8, 10.8), "far": tip(20, 5)}
    s = shaped(spark, scenes_).drop("parts").withColumn("acquired_at", F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'"))
    ev = shaped(spark, {"1": ring((0, 0), (10, 0), (10, 10), (0, 10))}, "event_id").drop("footprint").withColumn("event_ts", F.expr("TIMESTAMP_NTZ '2025-06-02 00:00:00'"))
    return s, ev


def test_polygons_are_tested_after_the_merge_and_only_where_outlines_leave_a_pair_open(spark, monkeypatch):
    s, ev = exact_case(spark)
    met = catalog.match_scenes(s, ev, 12)
    assert rows(met, "scene_id") == [("corner",), ("in",), ("side",)]
    joins = [x for x in met._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in x]
    assert joins and not any("exists(" in x for x in joins)
    monkeypatch.setattr(catalog, "polygons_meet_in", lambda box, a, b: "raise_error('tested') IS NULL")
    assert rows(catalog.match_scenes(s.where("scene_id != 'corner'"), ev, 12), "scene_id") == [("in",), ("side",)]
    with pytest.raises(Exception, match="tested"):
        catalog.match_scenes(s, ev, 12).collect()


def test_footprints_over_180_degrees_are_tested_exactly(spark):
    tip = lambda x: [[[(x - 1, 0), (x, -1), (x + 1, 0), (x, 1)]]]
    s = shaped(spark, {"west": tip(-178.5), "east": tip(178.5), "over": tip(179.5), "far": tip(-170)}).drop("parts").withColumn("acquired_at", F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'"))
    # Settled by outlines, and by polygons: a slanted area, of whose inner box the outer scenes keep clear.
    areas_ = {"1": [[[(177, -1), (183, -1), (183, 1), (177, 1)]]], "2": [[[(179.2, -1.4), (181.3, 0.7), (180.9, 1.5), (178.8, -0.6)]]]}
    ev = shaped(spark, areas_, "event_id").drop("footprint").withColumn("event_ts", F.expr("TIMESTAMP_NTZ '2025-06-02 00:00:00'"))
    ev = ev.withColumn("max_lon", F.expr("max_lon - 360"))
    assert rows(catalog.match_scenes(s, ev, 12), "event_id", "scene_id") == [("1", "east"), ("1", "over"), ("1", "west"), ("2", "east"), ("2", "over"), ("2", "west")]


def test_scenes_of_all_sizes_meet_an_event_once(spark):
    rng = random.Random(3)
    sizes = (0.0, 0.5, 4.0, 4.5, 8.0, 20.0, 39.0, 70.0, 110.0, 200.0, 360.0)
    boxes = []
    for i in range(150):
        w, h = rng.choice(sizes), min(rng.choice(sizes), 170.0)
        x, y = rng.choice((rng.uniform(-180, 180), -180.0, 176.0, 0.0)), rng.uniform(-90, 90 - h)
        boxes.append((x, y, x + w, y + h))
    s = scene(spark, *[(f"s{i}", "2025-06-01T00:00:00", b) for i, b in enumerate(boxes)])
    areas_ = [(x, y, x + w, y + h) for x, y, w, h in ((rng.choice((rng.uniform(-180, 180), 179.0, -180.0, 172.0)), rng.uniform(-90, 70), rng.choice((0.0, 1.0, 8.0, 50.0)), rng.choice((0.0, 1.0, 16.0))) for _ in range(40))]
    ev = spark.createDataFrame(
        [(i, datetime(2025, 6, 2), a, b, c - 360 if c > 180 else c, d) for i, (a, b, c, d) in enumerate(areas_)],
        "event_id long, event_ts timestamp_ntz, min_lon double, min_lat double, max_lon double, max_lat double",
    )
    want = [
        (i, f"s{j}")
        for i, (a, b, c, d) in enumerate(areas_)
        for j, (w, x, y, z) in enumerate(boxes)
        if x <= d and z >= b and any(w <= c + t and y >= a + t for t in (0, 360, -360))
    ]
    met = catalog.match_scenes(s, ev, 3)
    assert rows(met, "event_id", "scene_id") == sorted(want)
    # A scene is in one cell, however large it is.
    assert "explode" not in "".join(x for x in met._jdf.queryExecution().executedPlan().toString().splitlines() if "scene_id" in x)


def test_footprint_from_cells(spark):
    df = constant_raster(spark, 1.1, 6.1, 1.11, 6.12).withColumn("scene_id", F.lit(1))
    f = regions.footprints(df, ["scene_id"]).first()
    assert f.min_lon == pytest.approx(1.1, abs=STEP_DEG) and f.max_lat == pytest.approx(6.12, abs=STEP_DEG)


def test_center_expressions(spark):
    r = spark.range(1).selectExpr(f"{center_lon('2019413')} AS lon", f"{center_lat('932077')} AS lat").first()
    assert r.lon == pytest.approx((2019413 + 0.5) * STEP_DEG - 180) and r.lat == pytest.approx(90 - (932077 + 0.5) * STEP_DEG)
