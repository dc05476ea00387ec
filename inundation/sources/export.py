"""Raster export and names of exported extents."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import METERS_PER_DEGREE, SCALE_M, STEP_DEG, block_of
from ..operators.lookup import lookup_join
from ..operators.regions import clip, with_tile
from ..operators.terrain import regrid_nearest

#: Cells per side of an export tile; large enough for file sizes worth opening.
EXPORT_TILE = 4096
MAX_RECORDS_PER_FILE = 20_000_000

# Names of the exported extents.
SAR_EXPORT_NAME = "Effective_Flood_Extent_SAR"
OPTICAL_EXPORT_NAME = "Flood_Extent_S2_NDWI"
EXPORT_NAMES = {"sar": SAR_EXPORT_NAME, "s2": OPTICAL_EXPORT_NAME}


def export_name(prefix: str, event_date: str, run_timestamp: str) -> str:
    """``<prefix>_<yyyymmdd>_<timestamp>``; the timestamp is an argument, so a rerun can write the same name."""
    return f"{prefix}_{event_date.replace('-', '')}_{run_timestamp}"


def export_raster(
    images: DataFrame,
    path_prefix: str,
    description: str,
    spans: DataFrame,
    by: str | None = None,
    scale_m: float = SCALE_M,
    rows: int | None = None,
) -> str:
    """Clip, resample and write an image; returns the path.

    Files are split by range of (tile, row), so no task gets a whole hot tile, and stay bounded in size.
    """
    path = f"{path_prefix}{description}"
    clipped = clip(images, spans, by, rows)
    if not math.isclose(scale_m, SCALE_M):
        clipped = regrid_nearest(clipped, STEP_DEG, scale_m / METERS_PER_DEGREE)
    tiled = clipped.selectExpr("*", f"{block_of('x', EXPORT_TILE)} AS tile_x", f"{block_of('y', EXPORT_TILE)} AS tile_y")
    (
        tiled.repartitionByRange("tile_x", "tile_y", "y")
        .sortWithinPartitions("tile_x", "tile_y", "y", "x")
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("tile_x", "tile_y")
        .parquet(path)
    )
    return path


def export_extents(
    refined: Mapping[str, DataFrame], path_prefix: str, event_date: str, run_timestamp: str, spans: DataFrame, rows: int | None = None
) -> dict[str, str]:
    """Write the refined extent of each method that produced one, under the method's own name; returns the paths."""
    out = {}
    for method, extent in refined.items():
        name = export_name(EXPORT_NAMES[method], event_date, run_timestamp)
        out[method] = export_raster(extent.withColumn("flood", F.lit(1)), path_prefix, name, spans, "event_id", rows=rows)
    return out


def write_extent(extent: DataFrame, path: str) -> None:
    """Store the extents of many events (name, event_id, x, y, flood) by name, event and export tile.

    Files are split by range, so no task gets a whole event or hot tile.
    """
    keys = ["name", "event_id", "tile_x", "tile_y"]
    tiled = extent.selectExpr("*", f"{block_of('x', EXPORT_TILE)} AS tile_x", f"{block_of('y', EXPORT_TILE)} AS tile_y")
    (
        tiled.repartitionByRange(*keys, "y")
        .sortWithinPartitions(*keys, "y", "x")
        .select("x", "y", "flood", *keys)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_pixels(pixels: DataFrame, path: str, scenes: DataFrame | None = None) -> None:
    """Store a pixel table so that reads prune: partitioned by 256-cell tile, ordered by scene within files.

    With ``scenes`` (scene_id, acquired_at) also by the day of the scene, so that a read opens the days it wants and not every scene
    ever stored over a tile.  Pixels of scenes that aren't listed have no day; every read by day opens those as well.
    """
    tiled = with_tile(pixels)
    keys = ["tile_x", "tile_y"]
    if scenes is not None:
        # A scene may have many pixels, so they are spread over salts, with the scene's day beside each.
        days = scenes.selectExpr("scene_id", "to_date(acquired_at) AS acquired_on")
        tiled = lookup_join(tiled, days, ["scene_id"], None, "left", salt=["x", "y"])
        keys = ["acquired_on", *keys]
    (
        tiled.repartitionByRange(*keys, "scene_id")
        .sortWithinPartitions(*keys, "scene_id", "y", "x")
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*keys)
        .parquet(path)
    )
