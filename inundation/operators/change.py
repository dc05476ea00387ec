"""Before/after images side by side, common masks, and newly wet pixels.

A *pair* frame has one row per (event, cell) with columns ``pre_<band>`` and ``post_<band>``: the pixel-aligned join of both
images, masks kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import band_difference, binary, both_valid, new_water, update_mask
from ..functions.grid import COLUMNS
from .lookup import lookup_join

SIDES = ("pre", "post")


def valid_pixel_count(images: DataFrame, bands: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Valid pixels of each band per image, as ``<band>_px``."""
    return images.groupBy(*by).agg(*[F.expr(f"count(`{b}`) AS `{b}_px`") for b in bands])


def band_validity(images: DataFrame, scenes: DataFrame, bands: Sequence[str] = ("B3", "B8"), key: str = "scene_id"):
    """Flag every scene that has at least one valid pixel in each band; scenes without pixels are false."""
    counts = valid_pixel_count(images, bands, [key])
    enough = " AND ".join(f"coalesce(`{b}_px`, 0) > 0" for b in bands)
    flagged = scenes.join(counts, key, "left").withColumn("has_required_bands_pixels", F.expr(enough))
    return flagged.drop(*[f"{b}_px" for b in bands])


def side_by_side(images: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Rows tagged pre or post, with the bands moved to the columns of their side; one row per input row."""
    kept = [c for c in images.columns if c not in bands and c != "side"]
    return images.selectExpr(
        *kept, *[f"CASE WHEN side = '{s}' THEN `{b}` END AS `{s}_{b}`" for s in SIDES for b in bands]
    )


def align(images: DataFrame, bands: Sequence[str], by: Sequence[str] = ("event_id",)) -> DataFrame:
    """Pair frame from tagged rows: one hash aggregation by cell, in place of a join of two scans."""
    names = [f"{s}_{b}" for s in SIDES for b in bands]
    return side_by_side(images, bands).groupBy(*by, "x", "y").agg(*[F.expr(f"max(`{n}`) AS `{n}`") for n in names])


def pair_counts(
    pairs: DataFrame,
    band: str,
    by: Sequence[str] = ("event_id",),
    footprint: DataFrame | None = None,
    n_events: int | None = None,
) -> DataFrame:
    """Valid pixels on each side, and whether the counts agree.

    Both sides are counted within the footprint of the image before the event, where one is given
    (``by``, x_lo, x_hi, y_lo, y_hi).
    """
    inside = "true"
    if footprint is not None:
        pairs = lookup_join(pairs, footprint, by, n_events, salt=["x", "y"])
        # A footprint over longitude 180 ends beyond the last column.
        inside = f"(x BETWEEN x_lo AND x_hi OR x + {COLUMNS} BETWEEN x_lo AND x_hi OR x - {COLUMNS} BETWEEN x_lo AND x_hi) AND y BETWEEN y_lo AND y_hi"
    counts = [F.expr(f"count(CASE WHEN {inside} THEN `{s}_{band}` END) AS {s}_px") for s in SIDES]
    return pairs.groupBy(*by).agg(*counts).withColumn("same_count", F.expr("pre_px = post_px"))


def common_mask(
    pairs: DataFrame,
    bands: Sequence[str],
    counts: DataFrame,
    by: Sequence[str] = ("event_id",),
    n_events: int | None = None,
) -> DataFrame:
    """Where the counts of an event differ, mask each band wherever either side is masked; equal counts change nothing."""
    flagged = lookup_join(pairs, counts.select(*by, "same_count"), by, n_events, salt=["x", "y"])
    masked = {
        f"{s}_{b}": update_mask(f"`{s}_{b}`", f"same_count OR {both_valid(f'`pre_{b}`', f'`post_{b}`')}")
        for s in SIDES
        for b in bands
    }
    return flagged.selectExpr(*[f"{masked[c]} AS `{c}`" if c in masked else f"`{c}`" for c in pairs.columns])


def with_threshold_band(pairs: DataFrame, band: str) -> DataFrame:
    """Make sure both sides have the band; ``VV_minus_VH`` is derived."""
    for s in SIDES:
        if band == "VV_minus_VH":
            if not {f"{s}_VV", f"{s}_VH"} <= set(pairs.columns):
                raise ValueError(f"The image {s} the event needs bands VV and VH to derive VV_minus_VH")
            pairs = pairs.selectExpr("*", f"{band_difference(f'{s}_VV', f'{s}_VH')} AS {s}_{band}")
        elif f"{s}_{band}" not in pairs.columns:
            raise ValueError(f"The image {s} the event has no band {band}")
    return pairs


def water_below(pairs: DataFrame, band: str, thresholds: DataFrame, by=("event_id",), n_events: int | None = None):
    """Water on each side (strictly below its threshold) and the flood: water after that was not there before."""
    t = lookup_join(pairs, thresholds.select(*by, "threshold_pre", "threshold_post"), by, n_events, salt=["x", "y"])
    water = [f"{binary(f'`{s}_{band}` < threshold_{s}')} AS water_{s}" for s in SIDES]
    return with_flood(t.selectExpr(*by, "x", "y", *water))


def with_flood(water: DataFrame) -> DataFrame:
    return water.selectExpr("*", f"{new_water('water_pre', 'water_post')} AS flood")
