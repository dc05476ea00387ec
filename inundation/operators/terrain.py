"""Slope from elevation, and resampling between grids by key arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import METERS_PER_DEGREE, READ_TILE, STEP_DEG, TILE, block_of, cell_x, cell_y, center_lat, center_lon, num
from .blocks import spread

#: Elevation grid: 3 arc-seconds.
DEM_STEP_DEG = 1.0 / 1200.0
DEM_BLOCK = 128


def slope_degrees(dem: DataFrame, step: float = DEM_STEP_DEG, block: int = DEM_BLOCK) -> DataFrame:
    """Slope in degrees from the four neighbours; NULL where one is missing.  ``dem`` has gx, gy, elevation.  The first column is the
    last one's neighbour, where a whole number of cells goes around the globe.

    Cells go to their block plus a one-cell halo; the windows along both axes contain the block key, so one shuffle serves
    both and a window never holds more than a block row.
    """
    n = round(360.0 / step)
    whole = math.isclose(n * step, 360.0, rel_tol=1e-12)
    turns = f"CASE WHEN gx = 0 THEN array(gx, gx + {n}) WHEN gx = {n - 1} THEN array(gx, gx - {n}) ELSE array(gx) END"
    rows = dem.selectExpr("CAST(gx AS BIGINT) AS gx", "CAST(gy AS BIGINT) AS gy", "CAST(elevation AS DOUBLE) AS z")
    if whole:
        rows = rows.selectExpr(f"explode({turns}) AS gx", "gy", "z")
    blocked = (
        rows.selectExpr("*", f"{spread('gx', 1, block)} AS bx")
        .selectExpr("*", f"{spread('gy', 1, block)} AS by")
        .repartition("bx", "by")
    )

    def neighbours(axis, across):
        window = f"OVER (PARTITION BY bx, by, {across} ORDER BY {axis})"
        return [
            f"CASE WHEN lead({axis}) {window} = {axis} + 1 THEN lead(z) {window} END AS {axis}_up",
            f"CASE WHEN lag({axis}) {window} = {axis} - 1 THEN lag(z) {window} END AS {axis}_down",
        ]

    return slope_of_differences(
        blocked.selectExpr("*", *neighbours("gx", "gy"))
        .selectExpr("*", *neighbours("gy", "gx"))
        .where(f"{block_of('gx', block)} = bx AND {block_of('gy', block)} = by" + (f" AND gx BETWEEN 0 AND {n - 1}" if whole else ""))
        .selectExpr("gx", "gy", "z", "gx_up - gx_down AS dx", "gy_up - gy_down AS dy"),
        step,
    )


def slope_of_differences(cells: DataFrame, step: float = DEM_STEP_DEG) -> DataFrame:
    """Slope in degrees from what the cells to the east and to the south have more than those to the west and to the north (dx, dy)."""
    cell = step * METERS_PER_DEGREE
    per_x = f"dx / ({num(2 * cell)} * cos(radians({center_lat('gy', step)})))"
    rates = cells.selectExpr("gx", "gy", "z AS elevation", f"{per_x} AS px", f"-dy / {num(2 * cell)} AS py")
    return rates.selectExpr("gx", "gy", "elevation", "degrees(atan(sqrt(px * px + py * py))) AS slope_deg")


def dem_cell(images: DataFrame, step: float = STEP_DEG, dem_step: float = DEM_STEP_DEG) -> DataFrame:
    """Add the elevation cell (gx, gy) holding each pixel centre: nearest-neighbour sampling."""
    return images.selectExpr(
        "*", f"{cell_x(center_lon('x', step), dem_step)} AS gx", f"{cell_y(center_lat('y', step), dem_step)} AS gy"
    )


def dem_near(
    dem: DataFrame,
    cover: DataFrame,
    tile: int = READ_TILE,
    step: float = STEP_DEG,
    dem_step: float = DEM_STEP_DEG,
    envelope: tuple[int, int, int, int] | None = None,
) -> DataFrame:
    """Elevation needed for the tiles of ``cover`` (with one cell around), by a semi-join on elevation blocks.

    ``envelope`` (storage tiles: x from, to, y from, to) bounds the cover; it becomes plain limits that reach the Parquet reader.
    """
    if envelope is not None:
        x0, x1, y0, y1 = (v * TILE * step / dem_step for v in (envelope[0], envelope[1] + 1, envelope[2], envelope[3] + 1))
        limits = (("gx", x0, x1), ("gy", y0, y1))
        dem = dem.where(" AND ".join(f"{c} BETWEEN {math.floor(a) - 2} AND {math.ceil(b) + 2}" for c, a, b in limits))
    ratio = step / dem_step
    size = max(1, int(tile * ratio))

    def blocks(t):
        return (
            f"explode(sequence(floor(({t} * {num(tile * ratio)} - 2) / {size}), "
            f"floor((({t} + 1) * {num(tile * ratio)} + 2) / {size})))"
        )

    # A block beyond one end of the grid is the one at the other.
    n = -(-round(360.0 / dem_step) // size)
    wanted = (
        cover.selectExpr("ty", f"{blocks('tx')} AS _bx")
        .selectExpr(f"CASE WHEN _bx < 0 THEN _bx + {n} WHEN _bx >= {n} THEN _bx - {n} ELSE _bx END AS _bx", f"{blocks('ty')} AS _by")
        .distinct()
    )
    keyed = dem.selectExpr("*", f"floor(gx / {size}) AS _bx", f"floor(gy / {size}) AS _by")
    return keyed.join(wanted, ["_bx", "_by"], "left_semi").drop("_bx", "_by")


def drop_steep(
    extent: DataFrame, slope: DataFrame, max_slope_deg: float = 5.0, dem_step: float = DEM_STEP_DEG
) -> DataFrame:
    """Keep pixels whose slope is known and below the limit."""
    gentle = slope.where(f"slope_deg < {num(max_slope_deg)}").select("gx", "gy")
    return dem_cell(extent, dem_step=dem_step).join(gentle, ["gx", "gy"], "left_semi").select(*extent.columns)


def regrid_nearest(images: DataFrame, src_step: float, dst_step: float) -> DataFrame:
    """Nearest-neighbour resampling: a target cell takes the source cell holding its centre.

    Written from the source side: each source cell emits the target cells whose centres it holds, none or many.  Both ends use
    one formula, so every target cell comes from exactly one source cell, and no join or shuffle is needed.
    """
    k = dst_step / src_step
    if math.isclose(k, round(k), rel_tol=1e-9) and round(k) >= 1:
        # An integer coarsening is a plain filter on the coordinates.
        n = int(round(k))
        kept = images.where(f"pmod(x, {n}) = {n // 2} AND pmod(y, {n}) = {n // 2}")
        return kept.withColumns({"x": F.expr(f"floor(x / {n})"), "y": F.expr(f"floor(y / {n})")})
    ratio = num(src_step / dst_step)

    def targets(v):
        first, last = f"ceil({v} * {ratio} - 0.5D)", f"ceil(({v} + 1) * {ratio} - 0.5D) - 1"
        return F.expr(f"explode(CASE WHEN {first} <= {last} THEN sequence({first}, {last}) END)")

    return images.withColumn("x", targets("x")).withColumn("y", targets("y"))
