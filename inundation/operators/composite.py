"""Per-pixel temporal median."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _middle(values: str) -> str:
    """Median of a sorted array without nulls; an even count averages the two middle values."""
    low, high = (f"get({values}, CAST(floor({i}) AS INT))" for i in (f"(size({values}) - 1) / 2", f"size({values}) / 2"))
    return f"CASE WHEN size({values}) > 0 THEN ({low} + {high}) / 2 END"


def median_of(images: DataFrame, outputs: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """Exact median of each output expression per group, ignoring masked values.

    For groups of one cell and one event, which hold one value per scene in the search window, so the arrays are short.  Sorting them is less than
    half the cost of the built-in ``median``, which builds a hash map per cell and band.
    """
    stacks = images.groupBy(*by).agg(
        *[F.expr(f"sort_array(collect_list(CAST({e} AS DOUBLE))) AS `{name}`") for name, e in outputs.items()]
    )
    return stacks.selectExpr(*by, *[f"{_middle(f'`{name}`')} AS `{name}`" for name in outputs])


def median_composite(images: DataFrame, bands: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Median image over all scenes of a group, of any number: values are counted, not listed."""
    return images.groupBy(*by, "x", "y").agg(*[F.expr(f"median(CAST(`{b}` AS DOUBLE)) AS `{b}`") for b in bands])
