"""The analysis grid: integer cells of 10 m, as SQL expressions.

Cell ``(x, y)`` spans ``x * STEP_DEG`` degrees east of -180 and ``y * STEP_DEG`` degrees south of +90.  Everything that has
to line up pixel by pixel is an equi-join or a ``groupBy`` on these integers.

Helpers here and in :mod:`.bands` build SQL text rather than trees of ``Column`` calls: a whole formula is one call into the
JVM, which is what planning time is made of.
"""

from __future__ import annotations

import math

METERS_PER_DEGREE = 111319.49
SCALE_M = 10.0
STEP_DEG = SCALE_M / METERS_PER_DEGREE
EARTH_RADIUS_M = 6371008.8

#: Columns around the globe: those with their centre west of longitude 180.  The first lies to the east of the last; the last is cut
#: short by 180, as 360 degrees aren't a whole number of cells.
COLUMNS = math.ceil(360.0 / STEP_DEG - 0.5)

#: Storage and pruning tile, in cells per side.
TILE = 256

#: Reading tile: the grain at which areas and pixels are matched.  Divides the storage tile.
READ_TILE = 64


def num(v: float) -> str:
    """A double literal."""
    return f"{float(v)!r}D"


def cell_x(lon: str, step: float = STEP_DEG) -> str:
    return f"floor(({lon} + 180.0D) / {num(step)})"


def cell_y(lat: str, step: float = STEP_DEG) -> str:
    return f"floor((90.0D - ({lat})) / {num(step)})"


def columns(step: float = STEP_DEG) -> int:
    """Columns of a grid of this step whose centres lie west of longitude 180."""
    return math.ceil(360.0 / step - 0.5)


def center_lon(x: str = "x", step: float = STEP_DEG) -> str:
    return f"(({x} + 0.5D) * {num(step)} - 180.0D)"


def center_lat(y: str = "y", step: float = STEP_DEG) -> str:
    return f"(90.0D - ({y} + 0.5D) * {num(step)})"


def block_of(v: str, size: int = TILE) -> str:
    return f"floor(({v}) / {size})"


def _spaced(v: str) -> str:
    """The low 30 bits of a number with a zero bit between each two, by halving steps."""
    out = f"({v})"
    for shift, mask in ((16, 0x00003FFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = f"(({out} | shiftleft({out}, {shift})) & {mask}L)"
    return out


def quad_key(x: str, y: str) -> str:
    """The bits of column and row by turns; without its last two bits it is the key of the cell twice as wide."""
    # Named once each: the steps repeat their argument.
    return f"aggregate(array({x}, {y}), 0L, (k, v) -> shiftleft(k, 1) | {_spaced('v')})"


def pixel_area_m2(y: str = "y", step: float = STEP_DEG) -> str:
    """Spherical area of a cell; depends on its row only.

    ``sin(top) - sin(bottom)`` is written as a product, which does not cancel for small cells.
    """
    width = math.radians(step)
    return f"(cos(radians({center_lat(y, step)})) * {num(2.0 * EARTH_RADIUS_M**2 * width * math.sin(width / 2.0))})"


def radius_in_cells(radius_m: float, step: float = STEP_DEG) -> int:
    """Cells on each side of the centre covered by a square kernel of this radius."""
    return int(math.floor(radius_m / (step * METERS_PER_DEGREE) + 1e-9))


def distance_m(lon: str, lat: str, lon0: str, lat0: str) -> str:
    """Great-circle (haversine) distance."""
    a = (
        f"pow(sin(radians({lat} - ({lat0})) / 2), 2) + cos(radians({lat0})) * cos(radians({lat}))"
        f" * pow(sin(radians({lon} - ({lon0})) / 2), 2)"
    )
    return f"({num(2.0 * EARTH_RADIUS_M)} * asin(sqrt(least({a}, 1.0D))))"
