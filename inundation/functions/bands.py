"""Per-pixel band arithmetic and mask algebra, as SQL expressions.  ``NULL`` is a masked pixel.

Arguments are column names or expressions; use the results in ``selectExpr``, ``F.expr`` or ``where``.
"""

from __future__ import annotations

import math

from .grid import num

# Fixed values the results depend on.
EDGE_LIMIT_DB = -30.0
CLOUD_BIT = 10
CIRRUS_BIT = 11
REFLECTANCE_SCALE = 10000.0
DEFAULT_OTSU_THRESHOLD = -20.0


def update_mask(value: str, condition: str) -> str:
    """Keep ``value`` where the condition holds; a masked or false condition masks it."""
    return f"CASE WHEN {condition} THEN {value} END"


def self_mask(value: str) -> str:
    """Mask zero and negative values."""
    return update_mask(value, f"({value}) > 0")


def both_valid(a: str, b: str) -> str:
    return f"({a} IS NOT NULL AND {b} IS NOT NULL)"


def edge_masked(value: str, limit: float = EDGE_LIMIT_DB) -> str:
    """Drop swath-edge noise: values strictly below the limit."""
    return update_mask(value, f"NOT ({value} < {num(limit)})")


def cloud_free(qa: str = "QA60") -> str:
    """True where both the cloud and the cirrus bit are clear."""
    return f"({qa} & {(1 << CLOUD_BIT) | (1 << CIRRUS_BIT)}) = 0"


def cloud_masked_reflectance(value: str, qa: str = "QA60") -> str:
    return update_mask(f"{value} / {num(REFLECTANCE_SCALE)}", cloud_free(qa))


def band_difference(a: str, b: str) -> str:
    return f"({a} - {b})"


def ndwi(green: str = "B3", nir: str = "B8") -> str:
    """Normalised difference water index; 0 where both bands sum to zero."""
    return f"CASE WHEN {green} + {nir} = 0 THEN 0.0D ELSE ({green} - {nir}) / ({green} + {nir}) END"


def binary(condition: str) -> str:
    """0/1 image of a condition, masked where the condition is unknown."""
    return f"CAST(({condition}) AS TINYINT)"


def ndwi_water(green: str = "B3", nir: str = "B8") -> str:
    return binary(f"{ndwi(green, nir)} > 0")


def new_water(pre: str, post: str) -> str:
    """1 where water appears, masked elsewhere and where either side is masked."""
    return f"CASE WHEN {post} - {pre} > 0 THEN CAST({post} - {pre} AS TINYINT) END"


def percent_to_degrees(percent: float) -> float:
    """Slope given in percent, as an angle."""
    return math.degrees(math.atan(percent / 100.0))
