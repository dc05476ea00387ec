"""Optical branch: median composites, water index, change."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import cloud_masked_reflectance, ndwi_water
from ..operators.change import common_mask, pair_counts, with_flood
from ..operators.composite import median_of
from ..operators.lookup import lookup_join
from ..operators.regions import clip_tiles
from ..sources import catalog
from ..sources.control import settle
from ..sources.rasters import read_pixels, require_bands
from .sar import Branch, footprint_before
from .scope import Scope

BANDS = ("B3", "B8")


def optical_scenes(
    scenes: DataFrame, scope: Scope, days: int = catalog.OPTICAL_DAYS, max_cloud: float = catalog.MAX_CLOUD_PERCENT
) -> tuple[DataFrame, DataFrame]:
    """All usable scenes of both sides, and coverage per event."""
    matched = settle(catalog.match_scenes(scenes.where(catalog.optical_quality(max_cloud)), scope.events, days))
    coverage = settle(catalog.scene_coverage(matched, scope.events))
    ok = coverage.where("status = 'ok'").select("event_id")
    return lookup_join(matched, ok, ["event_id"], scope.n_events, "left_semi"), coverage


def median_pairs(
    pixels: DataFrame, picks: DataFrame, scope: Scope, cloud_mask: bool = False, n_picks: int | None = None
) -> DataFrame:
    """Median image of each band before and after each event, aligned by cell and clipped.

    A median is per cell, so clipping first changes nothing and keeps outside pixels off the shuffle; one aggregation serves both
    sides.  ``n_picks`` bounds the scenes chosen for any one event.
    """
    area = scope.aoi
    rows = read_pixels(
        pixels,
        picks,
        area.cover(),
        [*BANDS, "QA60"] if cloud_mask else BANDS,
        rows=None if n_picks is None else n_picks * area.tile_rows,
        envelope=area.envelope,
    )
    if cloud_mask:
        rows = rows.withColumns({b: F.expr(cloud_masked_reflectance(b)) for b in BANDS})
    outputs = {f"{s}_{b}": f"CASE WHEN side = '{s}' THEN {b} END" for s in ("pre", "post") for b in BANDS}
    return median_of(clip_tiles(rows, area.shapes, "event_id", area.shape_rows), outputs, ["event_id", "x", "y"])


def ndwi_pairs(medians: DataFrame) -> DataFrame:
    """Water masks of both sides."""
    water = [f"{ndwi_water(f'{s}_B3', f'{s}_B8')} AS {s}_water" for s in ("pre", "post")]
    return medians.selectExpr("event_id", "x", "y", *water)


def detect_ndwi(
    water: DataFrame, coverage: DataFrame, footprint: DataFrame | None = None, n_events: int | None = None
) -> Branch:
    """Change between two water masks (``pre_water``, ``post_water``); unequal valid counts restrict both to common pixels."""
    missing = {"pre_water", "post_water"} - set(water.columns)
    if missing:
        raise ValueError(f"Water masks of both sides are needed; missing {sorted(missing)}")
    counts = settle(pair_counts(water, "water", footprint=footprint, n_events=n_events))
    masked = common_mask(water, ["water"], counts, n_events=n_events)
    detected = with_flood(
        masked.selectExpr("event_id", "x", "y", "pre_water AS water_pre", "post_water AS water_post")
    )
    return Branch(coverage, counts, detected)


def optical_branch(
    scenes: DataFrame,
    pixels: DataFrame,
    scope: Scope,
    days: int = catalog.OPTICAL_DAYS,
    max_cloud: float = catalog.MAX_CLOUD_PERCENT,
    cloud_mask: bool = False,
) -> Branch:
    """Everything from catalog to water and flood pixels for all events of the scope.

    The water masks, two bytes a pixel, are persisted between the counts and the change, so the medians are computed once.
    """
    require_bands(pixels, [*BANDS, "QA60"] if cloud_mask else BANDS, "optical")
    picks, coverage = optical_scenes(scenes, scope, days, max_cloud)
    most = coverage.agg(F.max("n_scenes")).first()[0] or 0
    medians = median_pairs(pixels, picks, scope, cloud_mask, most)
    water = ndwi_pairs(medians).persist(StorageLevel.MEMORY_AND_DISK)
    found = detect_ndwi(water, coverage, footprint_before(picks), scope.n_events)
    return Branch(coverage, found.counts, found.detected, None, (water,))
