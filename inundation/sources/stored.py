"""Stored forms of the catalog and of elevation that reads open only in part, or use without a shuffle.

A stored catalog is partitioned by day and zone, the 22.5-degree cell of a scene's south-west corner, and ordered by place within; scans by box and
period (:mod:`.catalog`) open the days and zones they want.  Stored elevation has a row per block, with a halo of one cell, so that slopes
are worked out block by block where the blocks lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import COLUMNS, TILE
from ..operators.blocks import spread
from ..operators.terrain import DEM_BLOCK, DEM_STEP_DEG, slope_of_differences
from .catalog import ZONE_COLUMN, zone_of
from .control import is_there, settle

#: Blocks per side of a partition of stored elevation.
BAND_BLOCKS = 16


def append_scenes(scenes: DataFrame, path: str) -> int:
    """Adds the scenes that the stored catalog doesn't have yet, by id, and returns how many; what is stored isn't rewritten.

    Only the days of the new scenes are read.  Rows of one id within ``scenes`` count once.
    """
    spark = scenes.sparkSession
    new = scenes.dropDuplicates(["scene_id"]).withColumns({"acquired_on": F.to_date("acquired_at"), ZONE_COLUMN: F.expr(zone_of())})
    if is_there(spark, path):
        stored = spark.read.parquet(path)
        first, last = scenes.agg(F.to_date(F.min("acquired_at")), F.to_date(F.max("acquired_at"))).first()
        if first is None:
            return 0
        known = stored.where(F.col("acquired_on").between(F.lit(first), F.lit(last))).select("scene_id")
        new = new.join(known, "scene_id", "left_anti")
    # What is added must not change while it is written to the folder that it was held against.
    new = settle(new)
    n = new.count()
    if n:
        keys = ["acquired_on", ZONE_COLUMN]
        new.repartitionByRange(*keys, "min_lon", "min_lat").sortWithinPartitions(*keys, "min_lon", "min_lat").write.mode("append").partitionBy(*keys).parquet(path)
    return n


def write_elevation(dem: DataFrame, path: str, block: int = DEM_BLOCK) -> None:
    """Stores elevation (gx, gy, elevation) as a row per block: ``bx, by, z``, z the cells of the block and of one cell around it, row by row.

    Cells that aren't there are NaN.  Partitioned by ``BAND_BLOCKS`` blocks both ways.
    """
    side = block + 2
    turn = round(360.0 / DEM_STEP_DEG)
    around = f"explode(CASE WHEN gx = 0 THEN array(gx, gx + {turn}) WHEN gx = {turn - 1} THEN array(gx, gx - {turn}) ELSE array(gx) END)"
    placed = (
        dem.selectExpr("CAST(gx AS BIGINT) AS gx", "CAST(gy AS BIGINT) AS gy", "CAST(elevation AS DOUBLE) AS z")
        .selectExpr(f"{around} AS gx", "gy", "z")
        .selectExpr("*", f"{spread('gx', 1, block)} AS bx")
        .selectExpr("*", f"{spread('gy', 1, block)} AS by")
        .where(f"bx BETWEEN 0 AND {(turn - 1) // block}")
        .selectExpr("bx", "by", f"CAST((gy - by * {block} + 1) * {side} + gx - bx * {block} + 1 AS INT) AS at", "z")
    )

    def pack(key, cells: pd.DataFrame) -> pd.DataFrame:
        z = np.full(side * side, np.nan)
        z[cells["at"]] = cells["z"].to_numpy(dtype=float, na_value=np.nan)
        return pd.DataFrame({"bx": [key[0]], "by": [key[1]], "z": [z]})

    blocks = placed.groupBy("bx", "by").applyInPandas(pack, "bx long, by long, z array<double>")
    banded = blocks.selectExpr("*", f"floor(bx / {BAND_BLOCKS}) AS band_x", f"floor(by / {BAND_BLOCKS}) AS band_y")
    banded.repartitionByRange("band_x", "band_y", "bx", "by").write.mode("errorifexists").partitionBy("band_x", "band_y").parquet(path)


def read_elevation(spark: SparkSession, path: str, envelope: tuple[int, int, int, int] | None = None, block: int = DEM_BLOCK, dem_step: float = DEM_STEP_DEG) -> DataFrame:
    """Stored blocks; with ``envelope`` (storage tiles of pixels: x from, to, y from, to) only those around it, by partition and by block."""
    blocks = spark.read.parquet(path)
    if envelope is None:
        return blocks
    degree = 360.0 / COLUMNS
    for axis, low, high in (("x", envelope[0], envelope[1]), ("y", envelope[2], envelope[3])):
        first, last = (int(v * TILE * degree / dem_step // block) for v in (low, high + 1))
        blocks = blocks.where(f"band_{axis} BETWEEN {(first - 1) // BAND_BLOCKS} AND {(last + 1) // BAND_BLOCKS} AND b{axis} BETWEEN {first - 1} AND {last + 1}")
    return blocks


def slope_of_blocks(blocks: DataFrame, step: float = DEM_STEP_DEG, block: int = DEM_BLOCK) -> DataFrame:
    """``gx, gy, elevation, slope_deg`` of stored blocks, as :func:`slope_degrees` gives them, without a shuffle."""
    side = block + 2

    def differences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bx, by, z in zip(batch["bx"], batch["by"], batch["z"], strict=True):
                a = np.asarray(z, float).reshape(side, side)
                core = a[1:-1, 1:-1]
                across, along = a[1:-1, 2:] - a[1:-1, :-2], a[2:, 1:-1] - a[:-2, 1:-1]
                y, x = np.nonzero(~np.isnan(core))
                out = {"gx": bx * block + x, "gy": by * block + y, "z": core[y, x], "dx": across[y, x], "dy": along[y, x]}
                yield pd.DataFrame(out)

    found = blocks.select("bx", "by", "z").mapInPandas(differences, "gx long, gy long, z double, dx double, dy double")
    return slope_of_differences(found.selectExpr("gx", "gy", "z", "nullif(dx, double('NaN')) AS dx", "nullif(dy, double('NaN')) AS dy"), step)
