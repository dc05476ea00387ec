"""Neighbourhood work on blocks of cells: one shuffle, then each block is complete on its own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.grid import block_of

_SHIFT = 1 << 28
#: Full blocks that a task is planned for.
TASK_BLOCKS = 64


def spread(v: str, halo: int, block: int) -> str:
    """All blocks along one axis whose extent, grown by ``halo`` cells, holds the coordinate."""
    return f"explode(sequence({block_of(f'{v} - {halo}', block)}, {block_of(f'{v} + {halo}', block)}))"


def map_blocks(
    images: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    halo: int,
    block: int,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    result: Sequence[str],
    result_type: str,
    cells: int | None = None,
    columns: int | None = None,
) -> DataFrame:
    """Apply ``fn`` to each block of each image, halo included.

    ``fn`` gets the ``values`` and ``at``, the cell's position ``row * side + column`` in the grown block
    (``side = block + 2 * halo``), and returns the ``result`` columns plus ``at`` for cells of the core.  Coordinates and block
    travel packed in one integer each, since sorting and the transfer to Python cost by the column.  Coordinates may be negative.

    With ``columns``, the number of columns around the globe, the last one is the first one's neighbour to the west: cells near one end
    also go to blocks at the other, as if they lay beyond it.

    ``cells`` is an estimate of the cells of all images, from which the number of tasks follows where it is large.
    """
    n = len(keys)
    side = block + 2 * halo
    names = [f"k{i}" for i in range(n)]
    along, where = spread("x", halo, block), "x"
    if columns:
        reach = lambda v: f"sequence({block_of(f'{v} - {halo}', block)}, {block_of(f'{v} + {halo}', block)})"
        beyond = f"CASE WHEN x < {halo} THEN x + {columns} WHEN x >= {columns - halo} THEN x - {columns} END"
        along = f"explode(IF(x BETWEEN {halo} AND {columns - halo - 1}, {reach('x')}, array_union({reach('x')}, coalesce({reach(f'({beyond})')}, array()))))"
        # Beside its block, or a whole turn from it.
        off = f"(x - _bx * {block})"
        where = f"(x - CASE WHEN {off} > {columns // 2} THEN {columns} WHEN {off} < -{columns // 2} THEN -{columns} ELSE 0 END)"
    packed = (
        images.selectExpr("*", f"{along} AS _bx")
        .selectExpr("*", f"{spread('y', halo, block)} AS _by")
        .selectExpr(
            *[f"`{k}` AS {name}" for k, name in zip(keys, names)],
            f"_by * {_SHIFT} + _bx + {_SHIFT // 2} AS b",
            f"CAST((y - _by * {block} + {halo}) * {side} + {where} - _bx * {block} + {halo} AS INT) AS at",
            *[f"`{v}`" for v in values],
        )
    )
    types = dict(packed.dtypes)
    schema = ", ".join(
        [*[f"`{k}` {types[k]}" for k in names], "b bigint", "at int", *[f"`{r}` {result_type}" for r in result]]
    )

    def run(key, pdf):
        out = fn(pdf)
        for name, k in zip([*names, "b"], key):
            out[name] = k
        return out

    # A number of partitions of its own: few bytes here are much work, and adaptive coalescing would judge by the bytes.
    parts = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if cells is not None:
        parts = max(parts, -(-cells // (TASK_BLOCKS * block * block)))
    done = packed.repartition(parts, *names, "b").groupBy(*names, "b").applyInPandas(run, schema).selectExpr(
        *[f"{name} AS `{k}`" for k, name in zip(keys, names)],
        f"(pmod(b, {_SHIFT}) - {_SHIFT // 2}) * {block} + at % {side} - {halo} AS x",
        f"floor(b / {_SHIFT}) * {block} + floor(at / {side}) - {halo} AS y",
        *[f"`{r}`" for r in result],
    )
    # What lies beyond an end was worked out at the other as well.
    return done.where(f"x BETWEEN 0 AND {columns - 1}") if columns else done
