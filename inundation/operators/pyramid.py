"""Area within a budget of cells: sums of pixels by quad key, at every level.

A cell of level n holds 2^n by 2^n pixels.  Its quad key interleaves the bits of its row and column, so the key of the cell around it, a
level up, is the key without its last two bits.  Every pixel adds to its cell, none is left out, so the area is the same
at all levels; a budget only decides how coarse the cells are that are given out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import pixel_area_m2, quad_key
from .lookup import lookup_join

#: Fixed value: pixels that a reduction is given by default before it goes a level up.
MAX_PIXELS = 1_000_000_000
#: Levels whose cells come straight from the pixels, and the topmost, where one cell holds the grid.
BASE_LEVEL = 3
TOP_LEVEL = 22


def _cells(pixels: DataFrame, keys: list[str], level: str) -> DataFrame:
    """Pixels added up by cell; keys are made of cells, not of pixels."""
    column = lambda c: F.expr(f"shiftright(CAST({c} AS BIGINT), {level})").alias(f"c{c}")
    found = pixels.groupBy(*keys, column("x"), column("y")).agg(F.expr("count(*) AS pixels"), F.expr(f"sum({pixel_area_m2('y')}) AS area_m2"))
    return found.selectExpr(*keys, f"{quad_key('cx', 'cy')} AS quad", "pixels", "area_m2")


def cell_sums(
    images: DataFrame, by: Sequence[str] = ("event_id",), value: str | None = None, levels: Sequence[int] = range(BASE_LEVEL, TOP_LEVEL + 1)
) -> DataFrame:
    """``by``, level, quad, pixels and area_m2 of every cell with a valid, non-zero pixel, for each level that is asked for.

    Pixels are added up once, by the lowest level and before they are shuffled; the other levels are sums of its cells.
    """
    by, levels = list(by), sorted(set(levels))
    valid = images if value is None else images.where(f"`{value}` <> 0")
    low = levels[0]
    base = _cells(valid, by, str(low))
    each = base.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels])))
    return (
        each.groupBy(*by, "level", F.expr(f"shiftright(quad, 2 * (level - {low}))").alias("quad"))
        .agg(F.expr("sum(pixels) AS pixels"), F.expr("sum(area_m2) AS area_m2"))
        .select(*by, "level", "quad", "pixels", "area_m2")
    )


def level_within(images: DataFrame, by: Sequence[str] = ("event_id",), value: str | None = None, max_pixels: int = MAX_PIXELS) -> DataFrame:
    """``by`` and level: the lowest at which the box around an image's valid pixels has at most ``max_pixels`` cells."""
    if max_pixels < 1:
        raise ValueError("max_pixels must be positive")
    valid = images if value is None else images.where(f"`{value}` <> 0")
    box = valid.groupBy(*by).agg(*[F.expr(f"CAST({f}({c}) AS BIGINT) AS {c}_{f}") for f in ("min", "max") for c in ("x", "y")])
    side = lambda c, n: f"(shiftright({c}_max, {n}) - shiftright({c}_min, {n}) + 1)"
    fits = f"filter(sequence(0, {TOP_LEVEL}), n -> {side('x', 'n')} * {side('y', 'n')} <= {int(max_pixels)})"
    return box.selectExpr(*by, f"coalesce({fits}[0], {TOP_LEVEL}) AS level")


def area_within(
    images: DataFrame, by: Sequence[str] = ("event_id",), value: str | None = None, max_pixels: int = MAX_PIXELS, n_images: int | None = None
) -> DataFrame:
    """``by``, level, cells, pixels and area_km2 of each image's valid, non-zero pixels, in at most ``max_pixels`` cells.

    The area is that of all pixels, whatever the level; ``n_images`` bounds the number of images.
    """
    by = list(by)
    level = level_within(images, by, value, max_pixels)
    valid = images if value is None else images.where(f"`{value}` <> 0")
    placed = lookup_join(valid.select(*by, "x", "y"), level, by, n_images, salt=["x", "y"])
    cells = _cells(placed, [*by, "level"], "level")
    return cells.groupBy(*by, "level").agg(F.expr("count(*) AS cells"), F.expr("sum(pixels) AS pixels"), F.expr("sum(area_m2) / 1e6D AS area_km2"))
