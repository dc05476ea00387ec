"""Radar branch: scene choice, smoothing, Otsu thresholds, change."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import COLUMNS, cell_x, cell_y, radius_in_cells
from ..operators.change import common_mask, pair_counts, side_by_side, water_below, with_threshold_band
from ..operators.focal import speckle_smooth
from ..operators.histogram import otsu_threshold
from ..operators.regions import clip_tiles
from ..sources import catalog
from ..sources.control import settle
from ..sources.rasters import read_pixels, require_bands
from .scope import Area, Scope

SMOOTHING_RADIUS_M = 30.0

#: A threshold region below this share of the area is worth its own read.
SMALL_REGION = 0.1


@dataclass(frozen=True)
class Branch:
    """What a branch produced; all frames are keyed by event_id."""

    coverage: DataFrame
    counts: DataFrame
    detected: DataFrame
    thresholds: DataFrame | None = None
    kept: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Give back the storage of pixels kept for reuse."""
        for df in self.kept:
            df.unpersist()


def footprint_before(picks: DataFrame) -> DataFrame:
    """Cell range of the scenes before each event."""
    return picks.where("side = 'pre'").groupBy("event_id").agg(
        F.expr(f"min({cell_x('min_lon')}) AS x_lo"),
        F.expr(f"max({cell_x('max_lon')}) AS x_hi"),
        F.expr(f"min({cell_y('max_lat')}) AS y_lo"),
        F.expr(f"max({cell_y('min_lat')}) AS y_hi"),
    )


def smoothed_pairs(
    pixels: DataFrame, picks: DataFrame, area: Area, bands: Sequence[str], radius_m: float = SMOOTHING_RADIUS_M
) -> DataFrame:
    """Smoothed images before and after each event, aligned by cell and clipped to ``area``.

    Smoothing sees the neighbours outside the area, so tiles are read with the kernel radius around it and the clip comes after.
    The sides travel as separate bands of one image: the shuffle that feeds the smoothing also aligns them.
    """
    halo = radius_in_cells(radius_m)
    rows = read_pixels(
        pixels, picks, area.cover(halo), bands, rows=2 * area.tile_rows, envelope=area.envelope
    )
    names = [f"{s}_{b}" for s in ("pre", "post") for b in bands]
    smooth = speckle_smooth(side_by_side(rows, bands), names, by=["event_id"], radius_m=radius_m, cells=area.cells, columns=COLUMNS)
    return clip_tiles(smooth, area.shapes, "event_id", area.shape_rows)


def detect_sar(
    pairs: DataFrame,
    otsu_pairs: DataFrame,
    events: DataFrame,
    bands: Sequence[str],
    band: str = "VH",
    footprint: DataFrame | None = None,
    n_events: int | None = None,
) -> Branch:
    """Thresholds and change from aligned images.

    ``otsu_pairs`` are the same images within the threshold region.  Valid pixels are compared on the first band; where they
    differ, thresholds and water masks use the pixels valid on both sides only.
    """
    bands = list(bands)
    counts = settle(pair_counts(pairs, bands[0], footprint=footprint, n_events=n_events))

    def prepared(frame):
        return with_threshold_band(common_mask(frame, bands, counts, n_events=n_events), band)

    two = None if n_events is None else 2 * n_events
    sides = ", ".join(f"named_struct('side', '{s}', 'value', {s}_{band})" for s in ("pre", "post"))
    stacked = prepared(otsu_pairs).selectExpr("event_id", "x", "y", f"inline(array({sides}))")
    wanted = events.selectExpr("event_id", "explode(array('pre', 'post')) AS side")
    per_side = otsu_threshold(stacked, "value", ["event_id", "side"], wanted, n_images=two)
    thresholds = settle(
        per_side.groupBy("event_id").agg(
            F.expr("max(CASE WHEN side = 'pre' THEN threshold END) AS threshold_pre"),
            F.expr("max(CASE WHEN side = 'post' THEN threshold END) AS threshold_post"),
            F.expr("max(threshold_defaulted) AS threshold_defaulted"),
        )
    )
    detected = water_below(prepared(pairs), band, thresholds, n_events=n_events)
    return Branch(events, counts, detected, thresholds)


def sar_scenes(scenes: DataFrame, scope: Scope, days: int = catalog.SAR_DAYS) -> tuple[DataFrame, DataFrame]:
    """Chosen scenes (one per side) of the usable events, and coverage of all."""
    matched = catalog.match_scenes(scenes.where(catalog.RADAR_QUALITY), scope.events, days)
    choice = settle(catalog.scene_choice(matched, scope.events))
    return catalog.nearest_scenes(choice.where("status = 'ok'")), choice.drop("pre", "post")


def sar_branch(
    scenes: DataFrame,
    pixels: DataFrame,
    scope: Scope,
    days: int = catalog.SAR_DAYS,
    bands: Sequence[str] = ("VV", "VH"),
    band: str = "VH",
    radius_m: float = SMOOTHING_RADIUS_M,
) -> Branch:
    """Everything from catalog to water and flood pixels for all events of the scope.

    The smoothed pairs are read for the counts, then for the change, so they are persisted: a lost executor costs only its
    own blocks.  A threshold region that is a small part of the area is read and smoothed from its own tiles, so that
    thresholds do not go over all pixels; otherwise the pairs at hand are clipped.
    """
    require_bands(pixels, [*bands, *([band] if band != "VV_minus_VH" else [])], "radar")
    picks, coverage = sar_scenes(scenes, scope, days)
    pairs = smoothed_pairs(pixels, picks, scope.aoi, bands, radius_m).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [pairs]
    if scope.otsu is scope.aoi:
        otsu = pairs
    elif scope.otsu.cells > SMALL_REGION * scope.aoi.cells:
        otsu = clip_tiles(pairs, scope.otsu.shapes, "event_id", scope.otsu.shape_rows)
    else:
        region = smoothed_pairs(pixels, picks, scope.otsu, bands, radius_m)
        otsu = clip_tiles(region, scope.aoi.shapes, "event_id", scope.aoi.shape_rows).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(otsu)
    ok = coverage.where("status = 'ok'")
    found = detect_sar(pairs, otsu, ok, bands, band, footprint_before(picks), scope.n_events)
    return Branch(coverage, found.counts, found.detected, found.thresholds, tuple(kept))
