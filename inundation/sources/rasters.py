"""Pixel tables: pruned reads, and generated rasters for tests and benchmarks.

``pixels``: scene_id, x, y and one nullable column per band, once per (scene, cell).  Tables written by
:func:`inundation.sources.export.write_pixels` also have tile_x and tile_y as partition columns, and acquired_on where it was given
the scenes.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import STEP_DEG, TILE, center_lat, center_lon
from ..operators.regions import in_areas


def require_bands(pixels: DataFrame, bands: Sequence[str], what: str) -> None:
    """Raise before anything is read if a band is missing."""
    missing = [b for b in dict.fromkeys(bands) if b not in pixels.columns]
    if missing:
        raise ValueError(f"The {what} pixels have no band {', '.join(missing)}")


def read_pixels(
    pixels: DataFrame,
    picks: DataFrame,
    cover: DataFrame,
    bands: Sequence[str],
    rows: int | None = None,
    envelope: tuple[int, int, int, int] | None = None,
) -> DataFrame:
    """Pixels of the chosen scenes in and around each event's area, tagged with event and side.

    The list of (scene, tile, box) to read is joined to the pixel table.  ``envelope`` (storage tiles: x from, to, y from, to)
    bounds all events and prunes statically, as do the first and the last day of the scenes where pixels are stored by day; the
    list itself then prunes days and tiles at run time.  Pixels without a day are read too, by scene.  ``rows`` bounds the list.
    """
    stored = [c for c in ("acquired_on", "tile_x", "tile_y") if c in pixels.columns]
    by_day = stored[:1] == ["acquired_on"]
    day = ["to_date(acquired_at) AS acquired_on"] if by_day else []
    chosen = picks.selectExpr("event_id", "side", "scene_id", *day)
    wanted = chosen.join(cover.withColumnRenamed("aoi_id", "event_id"), "event_id")
    if by_day:
        first, last = chosen.agg(F.min("acquired_on"), F.max("acquired_on")).first()
        dated = f"acquired_on BETWEEN DATE '{first}' AND DATE '{last}'" if first else "false"
    if envelope:
        x0, x1, y0, y1 = envelope
        box = f"x BETWEEN {x0 * TILE} AND {x1 * TILE + TILE - 1} AND y BETWEEN {y0 * TILE} AND {y1 * TILE + TILE - 1}"
        if "tile_y" in stored:
            box += f" AND tile_x BETWEEN {x0} AND {x1} AND tile_y BETWEEN {y0} AND {y1}"
        pixels = pixels.where(box)
    found = pixels.select("scene_id", *stored, "x", "y", *bands)
    out = ["event_id", "side", "x", "y", *bands]
    if not by_day:
        return in_areas(found, wanted, ("scene_id",), rows).select(*out)
    # Pixels stored before their scene was listed have no day; they match by scene alone.
    early = in_areas(found.where("acquired_on IS NULL").drop("acquired_on"), wanted.drop("acquired_on"), ("scene_id",), rows)
    return in_areas(found.where(dated), wanted, ("scene_id", "acquired_on"), rows).select(*out).unionByName(early.select(*out))


def constant_raster(
    spark: SparkSession, west: float, south: float, east: float, north: float, value: int = 1, step: float = STEP_DEG
) -> DataFrame:
    """All cells with their centre in a rectangle: x, y, lon, lat, value."""
    x0, x1 = ceil((west + 180) / step - 0.5), ceil((east + 180) / step - 0.5)
    y0, y1 = ceil((90 - north) / step - 0.5), ceil((90 - south) / step - 0.5)
    width = x1 - x0
    cells = spark.range(width * (y1 - y0)).selectExpr(f"id % {width} + {x0} AS x", f"floor(id / {width}) + {y0} AS y")
    return cells.selectExpr(
        "*", f"{center_lon('x', step)} AS lon", f"{center_lat('y', step)} AS lat", f"CAST({value} AS TINYINT) AS value"
    )
