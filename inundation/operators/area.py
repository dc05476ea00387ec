"""Flooded area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import pixel_area_m2


def area_km2(
    extent: DataFrame, by: Sequence[str] = ("event_id",), value: str | None = None, wanted: DataFrame | None = None
) -> DataFrame:
    """Area of valid, non-zero pixels per image.

    ``wanted`` lists the images that must be answered: those without any pixel get 0.  Without it they are left out.
    """
    by = list(by)
    counted = "true" if value is None else f"`{value}` != 0"
    total = f"sum(CASE WHEN {counted} THEN {pixel_area_m2('y')} END)"
    found = extent.groupBy(*by).agg(F.expr(f"coalesce({total}, 0.0D) / 1e6D AS area_km2"))
    if wanted is None:
        return found
    return wanted.select(*by).join(found, by, "left").selectExpr(*by, "coalesce(area_km2, 0.0D) AS area_km2")
