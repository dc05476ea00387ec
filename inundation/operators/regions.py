"""Areas on the grid: row spans, tile covers, clipping.

A polygon becomes *spans*: for each grid row the intervals of cells whose centres lie inside, and spans become *shapes*: tiles that lie
inside as a whole, and tiles on the border with their intervals.  A clip is then an equi-join by tile, for one area or for thousands, and no
pixel ever meets a polygon edge.

``spans`` : aoi_id, tile_x, y, x_lo, x_hi (disjoint within a row)
``shapes``: aoi_id, tx, ty, inner, lo, hi
``cover`` : aoi_id, tx, ty, x0, x1, y0, y1
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import edges
from ..functions.grid import (
    COLUMNS,
    EARTH_RADIUS_M,
    READ_TILE,
    STEP_DEG,
    TILE,
    block_of,
    cell_y,
    center_lat,
    center_lon,
    columns,
    distance_m,
    num,
)
from ..sources.control import settle
from .lookup import lookup_join

#: Metres per degree of latitude, a little low, so that boxes around circles come out a little large.
_DEGREE_M = 111000.0


def _split_by_tile(rows: DataFrame) -> DataFrame:
    """Cut spans at tile borders so that they can be joined by tile."""
    return rows.withColumn("tile_x", F.expr(f"explode(sequence({block_of('x_lo')}, {block_of('x_hi')}))")).selectExpr(
        "aoi_id",
        "tile_x",
        "y",
        f"greatest(x_lo, tile_x * {TILE}) AS x_lo",
        f"least(x_hi, tile_x * {TILE} + {TILE - 1}) AS x_hi",
    )


def _around(area: DataFrame) -> DataFrame:
    """Rings that go beyond longitude 180 also as they lie a turn further, where the grid begins or ends."""
    ends = [f"array_{f}(transform(pts, p -> p.lon)) {beyond}" for f, beyond in (("max", "> 180"), ("min", "< -180"))]
    turns = f"filter(array(0.0D, IF({ends[0]}, -360.0D, NULL), IF({ends[1]}, 360.0D, NULL)), t -> t IS NOT NULL)"
    turned = area.select("aoi_id", "part", "ring", "pts", F.expr(f"explode({turns})").alias("turn"))
    moved = "transform(pts, p -> named_struct('lon', p.lon + turn, 'lat', p.lat))"
    return turned.selectExpr("aoi_id", "part", "ring", f"IF(turn = 0, pts, {moved}) AS pts")


def _on_grid(spans: DataFrame, step: float) -> DataFrame:
    """Spans within the columns of the grid."""
    last = columns(step) - 1
    inside = spans.where(f"x_hi >= 0 AND x_lo <= {last}")
    return inside.withColumns({"x_lo": F.expr("greatest(x_lo, 0L)"), "x_hi": F.expr(f"least(x_hi, {last}L)")})


def polygon_spans(area: DataFrame, step: float = STEP_DEG) -> DataFrame:
    """Cells whose centre is inside: even-odd within a part, union over the parts of an area.

    A polygon over longitude 180 has points beyond it (or beyond -180); its spans are then at both ends of the grid.
    """
    top, bottom = cell_y("greatest(lat1, lat2)", step), cell_y("least(lat1, lat2)", step)
    rows = edges(_around(area)).selectExpr("*", f"explode(sequence({top} - 1, {bottom} + 1)) AS y")
    crossed = rows.withColumn("lat", F.expr(center_lat("y", step))).where("(lat1 > lat) != (lat2 > lat)")
    at = crossed.selectExpr(
        "aoi_id", "part", "y", "(lon2 - lon1) * (lat - lat1) / (lat2 - lat1) + lon1 AS lon"
    ).selectExpr("*", f"CAST(ceil((lon + 180.0D) / {num(step)} - 0.5D) AS BIGINT) AS c")
    # The first cell with its centre at or east of the crossing; rounding can put the estimate one off either way.
    first = (
        f"CASE WHEN {center_lon('(c - 1)', step)} >= lon THEN c - 1 WHEN {center_lon('c', step)} >= lon THEN c ELSE c + 1 END"
    )
    # One shuffle serves the windows and the aggregation.
    crossings = at.selectExpr("aoi_id", "part", "y", f"{first} AS x").repartition("aoi_id", "y")
    inside = crossings.selectExpr(
        "aoi_id",
        "y",
        "x AS x_lo",
        "lead(x) OVER (PARTITION BY aoi_id, y, part ORDER BY x) - 1 AS x_hi",
        "row_number() OVER (PARTITION BY aoi_id, y, part ORDER BY x) AS n",
    ).where("n % 2 = 1 AND x_hi >= x_lo")
    by_row = "OVER (PARTITION BY aoi_id, y ORDER BY x_lo, x_hi ROWS BETWEEN UNBOUNDED PRECEDING AND"
    merged = (
        inside.selectExpr(
            "aoi_id", "y", "x_lo", "x_hi",
            f"CASE WHEN x_lo <= max(x_hi) {by_row} 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS opens",
        )
        .selectExpr("aoi_id", "y", "x_lo", "x_hi", f"sum(opens) {by_row} CURRENT ROW) AS run")
        .groupBy("aoi_id", "y", "run")
        .agg(F.expr("min(x_lo) AS x_lo"), F.expr("max(x_hi) AS x_hi"))
    )
    return _split_by_tile(_on_grid(merged, step))


def within_buffer(lon: str, lat: str, lon0: str, lat0: str, meters: float) -> str:
    """Is a point within ``meters`` of the centre?  A latitude band is tested first; it is cheap and can be pushed down."""
    reach = num(meters / _DEGREE_M)
    return (
        f"({lat} BETWEEN {lat0} - {reach} AND {lat0} + {reach} AND {distance_m(lon, lat, lon0, lat0)} <= {num(meters)})"
    )


def buffer_spans(centers: DataFrame, step: float = STEP_DEG) -> DataFrame:
    """Spans of circles: ``centers`` has aoi_id, lon, lat, meters.  A circle over longitude 180 has spans at both ends of the grid."""
    reach = f"meters / {num(_DEGREE_M)}"
    # A circle far from 180 has nothing a turn further; its spans there are off the grid.
    turns = "explode(CASE WHEN lon > 90 THEN array(0.0D, -360.0D) WHEN lon < -90 THEN array(0.0D, 360.0D) ELSE array(0.0D) END)"
    centers = centers.withColumn("turn", F.expr(turns)).withColumn("lon", F.expr("lon + turn")).drop("turn")
    rows = centers.selectExpr(
        "*", f"explode(sequence({cell_y(f'lat + {reach}', step)}, {cell_y(f'lat - {reach}', step)})) AS y"
    ).withColumn("row_lat", F.expr(center_lat("y", step)))
    # Half-width of the circle in this row, from the haversine formula solved for the longitude difference.
    left = f"pow(sin(meters / {num(2 * EARTH_RADIUS_M)}), 2) - pow(sin(radians(row_lat - lat) / 2), 2)"
    ratio = f"greatest({left}, 0.0D) / (cos(radians(lat)) * cos(radians(row_lat)))"
    ends = rows.withColumn("half", F.expr(f"degrees(2 * asin(sqrt(least({ratio}, 1.0D))))")).selectExpr(
        "*",
        f"CAST(ceil((lon - half + 180.0D) / {num(step)} - 0.5D) AS BIGINT) AS a",
        f"CAST(floor((lon + half + 180.0D) / {num(step)} - 0.5D) AS BIGINT) AS b",
    )

    def inside(x):
        return f"{distance_m(center_lon(x, step), 'row_lat', 'lon', 'lat')} <= meters"

    # Rounding can put an end one cell off; settle it with the distance itself.
    spans = ends.selectExpr(
        "aoi_id",
        "y",
        f"CASE WHEN {inside('(a - 1)')} THEN a - 1 WHEN {inside('a')} THEN a ELSE a + 1 END AS x_lo",
        f"CASE WHEN {inside('(b + 1)')} THEN b + 1 WHEN {inside('b')} THEN b ELSE b - 1 END AS x_hi",
    )
    return _split_by_tile(_on_grid(spans.where("x_lo <= x_hi"), step))


def footprints(images: DataFrame, by: list[str], step: float = STEP_DEG) -> DataFrame:
    """Extent of each image, from its cells."""
    cells = images.groupBy(*by).agg(
        *[F.expr(f"{f}({c}) AS {c}_{f}") for f in ("min", "max") for c in ("x", "y")]
    )
    s = num(step)
    return cells.selectExpr(
        *by,
        f"x_min * {s} - 180.0D AS min_lon",
        f"90.0D - (y_max + 1) * {s} AS min_lat",
        f"(x_max + 1) * {s} - 180.0D AS max_lon",
        f"90.0D - y_min * {s} AS max_lat",
    )


def cover(spans: DataFrame, halo: int = 0, tile: int = READ_TILE) -> DataFrame:
    """Tiles touched by an area grown by ``halo`` cells, each with the box of the grown area around it.

    What grows over one end of the grid goes on at the other.
    """
    n, x0, x1 = COLUMNS, f"x_lo - {halo}", f"x_hi + {halo}"
    box = lambda a, b: f"named_struct('x0', CAST({a} AS BIGINT), 'x1', CAST({b} AS BIGINT))"
    over = [f"IF({x0} < 0, {box(f'{x0} + {n}', n - 1)}, NULL)", f"IF({x1} >= {n}, {box(0, f'{x1} - {n}')}, NULL)"]
    pieces = f"array({box(f'greatest({x0}, 0)', f'least({x1}, {n - 1})')}, {', '.join(over)})"
    grown = spans.selectExpr("aoi_id", "y", f"inline(filter({pieces}, p -> p IS NOT NULL))")
    return (
        grown.selectExpr("aoi_id", "x0", "x1", "y", f"explode(sequence({block_of('x0', tile)}, {block_of('x1', tile)})) AS tx")
        .groupBy("aoi_id", "tx", "y")
        .agg(F.expr("min(x0) AS x0"), F.expr("max(x1) AS x1"))
        .selectExpr(
            "aoi_id", "tx", "x0", "x1", "y",
            f"explode(sequence({block_of(f'y - {halo}', tile)}, {block_of(f'y + {halo}', tile)})) AS ty",
        )
        .groupBy("aoi_id", "tx", "ty")
        .agg(
            F.expr("min(x0) AS x0"),
            F.expr("max(x1) AS x1"),
            F.expr(f"min(y) - {halo} AS y0"),
            F.expr(f"max(y) + {halo} AS y1"),
        )
    )


def tile_shapes(spans: DataFrame, tile: int = READ_TILE) -> DataFrame:
    """What each tile holds of an area: ``aoi_id, tx, ty, inner, lo, hi``.

    An inner tile lies in the area as a whole and needs no more than that.  A border tile has, for each of its rows, the first and the last
    column inside (64 and -1 where there is none); where a row has several spans, the tile has a row of this table for each.
    So an area sends a row per tile, and lines of cells only along its border.
    """
    cut = (
        spans.selectExpr("aoi_id", "y", "x_lo", "x_hi", f"explode(sequence({block_of('x_lo', tile)}, {block_of('x_hi', tile)})) AS tx")
        .selectExpr(
            "aoi_id", "tx", f"{block_of('y', tile)} AS ty", f"CAST(pmod(y, {tile}) AS INT) AS r", f"CAST(greatest(x_lo - tx * {tile}, 0) AS TINYINT) AS lo",
            f"CAST(least(x_hi - tx * {tile}, {tile - 1}) AS TINYINT) AS hi",
        )
        .repartition("aoi_id", "tx", "ty")
    )
    layered = cut.selectExpr("*", "row_number() OVER (PARTITION BY aoi_id, tx, ty, r ORDER BY lo) AS layer")
    grouped = layered.groupBy("aoi_id", "tx", "ty", "layer").agg(
        F.expr(f"sum(hi - lo + 1) = {tile * tile} AS inner"), F.expr("map_from_entries(collect_list(struct(r, struct(lo, hi)))) AS m")
    )
    line = lambda end, none: f"IF(inner, NULL, transform(sequence(0, {tile - 1}), i -> coalesce(m[i].{end}, CAST({none} AS TINYINT))))"
    return grouped.selectExpr("aoi_id", "tx", "ty", "inner", f"{line('lo', tile)} AS lo", f"{line('hi', -1)} AS hi")


def clip_tiles(images: DataFrame, shapes: DataFrame, by: str | None = None, rows: int | None = None, tile: int = READ_TILE) -> DataFrame:
    """Keep the pixels inside the area that :func:`tile_shapes` describes.

    ``by`` names the image column holding the area id; without it every pixel is tested against all shapes, which must then
    be of one area.  ``rows`` bounds the number of shapes; see :func:`lookup_join`.
    """
    # Spans of one row are disjoint, so a pixel meets at most one and the join cannot repeat it.
    s = shapes.selectExpr(*([f"aoi_id AS {by}"] if by else []), "tx", "ty", "inner", "lo", "hi")
    tiled = images.selectExpr("*", f"{block_of('x', tile)} AS tx", f"{block_of('y', tile)} AS ty")
    joined = lookup_join(tiled, s, [*([by] if by else []), "tx", "ty"], rows, salt=["x", "y"])
    r = f"CAST(y - ty * {tile} AS INT)"
    return joined.where(f"inner OR x - tx * {tile} BETWEEN lo[{r}] AND hi[{r}]").select(*images.columns)


def clip(images: DataFrame, spans: DataFrame, by: str | None = None, rows: int | None = None) -> DataFrame:
    """Keep the pixels inside the area that the spans give.  ``by`` as in :func:`clip_tiles`.

    ``rows`` bounds the number of spans; where it isn't known, their tiles are worked out and counted first.
    """
    shapes = tile_shapes(spans)
    if rows is not None:
        # A span goes over as many read tiles as a storage tile is wide, at most.
        return clip_tiles(images, shapes, by, rows * (TILE // READ_TILE))
    shapes = settle(shapes)
    return clip_tiles(images, shapes, by, shapes.count())


def with_tile(images: DataFrame) -> DataFrame:
    """Add the storage tile."""
    return images.selectExpr("*", f"{block_of('x')} AS tile_x", f"{block_of('y')} AS tile_y")


def in_areas(images: DataFrame, tiles: DataFrame, keys: tuple[str, ...] = (), rows: int | None = None) -> DataFrame:
    """Match pixels to the areas whose cover boxes hold them: an equi-join by reading tile (and ``keys``).

    ``tiles`` is a cover, with any further columns.  On images stored by tile, the storage tile takes part in the join, so
    that a broadcast cover prunes partitions at run time.
    """
    on = [*keys, "tx", "ty"]
    tiled = images.selectExpr("*", f"{block_of('x', READ_TILE)} AS tx", f"{block_of('y', READ_TILE)} AS ty")
    if {"tile_x", "tile_y"} <= set(images.columns):
        per = TILE // READ_TILE
        tiles = tiles.selectExpr("*", f"floor(tx / {per}) AS tile_x", f"floor(ty / {per}) AS tile_y")
        on += ["tile_x", "tile_y"]
    return lookup_join(tiled, tiles, on, rows).where("x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1")
