"""Render-ready tables: stretch, palette, and zoom levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import num

# Display ranges and colours of the layers.
SAR_RANGE = (-25.0, 0.0)
SAR_BAND = "VH"
WATER_RANGE = (0.0, 1.0)
WATER_PALETTE = ("#ffffff", "#0000ff")
SAR_FLOOD_PALETTE = ("#ff0000",)
OPTICAL_FLOOD_PALETTE = ("#800080",)


def stretch(value: str, low: float, high: float) -> str:
    """Linear stretch to 0..255, clamped; masked stays masked."""
    level = f"floor(({value} - {num(low)}) / {num(high - low)} * 255)"
    return f"CASE WHEN {value} IS NOT NULL THEN CAST(greatest(0, least(255, {level})) AS INT) END"


def colour(level: str, palette: Sequence[str]) -> str:
    """Colour of a 0..255 level on a palette of evenly spaced ``#rrggbb`` stops."""
    if len(palette) == 1:
        return f"CASE WHEN {level} IS NOT NULL THEN '{palette[0]}' END"
    stops = [[int(c[i : i + 2], 16) for i in (1, 3, 5)] for c in palette]
    spacing = 255.0 / (len(stops) - 1)

    def between(i):
        t = f"({level} - {num(i * spacing)}) / {num(spacing)}"
        parts = (
            f"lpad(lower(hex(CAST(round({a} + {b - a} * {t}) AS BIGINT))), 2, '0')" for a, b in zip(stops[i], stops[i + 1])
        )
        return f"concat('#', {', '.join(parts)})"

    pieces = " ".join(f"WHEN {level} <= {num((i + 1) * spacing)} THEN {between(i)}" for i in range(len(stops) - 1))
    return f"CASE {pieces} END"


def layer(
    images: DataFrame,
    band: str,
    value_range: tuple[float, float],
    palette: Sequence[str] | None = None,
    water_only: bool = False,
    by: Sequence[str] = ("event_id",),
) -> DataFrame:
    """``by, x, y, level`` and, with a palette, ``colour``; masked pixels are left out, and dry ones with ``water_only``."""
    shown = images.where(f"`{band}` > 0" if water_only else f"`{band}` IS NOT NULL")
    out = shown.selectExpr(*by, "x", "y", f"{stretch(f'`{band}`', *value_range)} AS level")
    return out.selectExpr("*", f"{colour('level', palette)} AS colour") if palette else out


def zoom_out(layer_: DataFrame, cells: int, by: Sequence[str] = ("event_id",)) -> DataFrame:
    """Downsample to squares of ``cells`` x ``cells``: mean level and pixel count."""
    squares = layer_.selectExpr(*by, f"floor(x / {cells}) AS zx", f"floor(y / {cells}) AS zy", "level")
    return squares.groupBy(*by, "zx", "zy").agg(F.expr("avg(level) AS level"), F.expr("count(*) AS pixels"))
