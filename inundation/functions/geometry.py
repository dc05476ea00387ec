"""Polygons as tables: one row per ring, vertices in an array.

An area frame has ``(aoi_id, part, ring, pts array<struct<lon,lat>>)``.  Ring 0 of a part is its shell, the others are holes.
Rings are closed implicitly, so an unclosed or slightly open last vertex does no harm.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .grid import EARTH_RADIUS_M, num

AREA_SCHEMA = "aoi_id bigint, part int, ring int, pts array<struct<lon:double,lat:double>>"

Ring = Sequence[Sequence[float]]

# The areas used when none is given.
DEFAULT_AOI: list[Ring] = [
    [(0.889893, 6.110515), (0.889893, 6.342597), (1.853943, 6.342597), (1.853943, 6.110515), (0.889893, 6.110515)]
]
DEFAULT_OTSU_AOI: list[Ring] = [
    [
        (1.406947563254846, 6.279016328141211),
        (1.406947563254846, 6.273029988557553),
        (1.4196204943754935, 6.273029988557553),
        (1.4196204943754935, 6.279016328141211),
        (1.4069475632846, 6.279016328141211),
    ]
]


def rectangle(west: float, south: float, east: float, north: float) -> list[Ring]:
    return [[(west, south), (east, south), (east, north), (west, north)]]


def areas(spark: SparkSession, polygons: Mapping[int, Sequence[Ring]]) -> DataFrame:
    """Area frame from literal polygons: ``{aoi_id: [shell, hole, ...]}``."""
    rows = [
        (aoi_id, 0, i, [(float(lon), float(lat)) for lon, lat in ring])
        for aoi_id, rings in polygons.items()
        for i, ring in enumerate(rings)
    ]
    return spark.createDataFrame(rows, AREA_SCHEMA)


def ring_edges(pts: str) -> str:
    """Array of edges of a ring, closing edge included; linear in the number of vertices."""
    following = f"concat(slice({pts}, 2, greatest(size({pts}) - 1, 0)), slice({pts}, 1, 1))"
    return (
        f"zip_with({pts}, {following}, (a, b) -> "
        "named_struct('lon1', a.lon, 'lat1', a.lat, 'lon2', b.lon, 'lat2', b.lat))"
    )


def edges(area: DataFrame) -> DataFrame:
    """One row per polygon edge, with the ring's first vertex as a local origin."""
    return area.where("size(pts) > 0").selectExpr(
        "aoi_id", "part", "ring", "pts[0].lon AS lon0", "pts[0].lat AS lat0", f"inline({ring_edges('pts')})"
    )


def bounds(area: DataFrame) -> DataFrame:
    """Bounding box per area."""
    over = lambda f, axis: f"array_{f}(transform(pts, p -> p.{axis}))"
    return area.groupBy("aoi_id").agg(
        *[F.expr(f"{f}({over(f, axis)}) AS {f}_{axis}") for f in ("min", "max") for axis in ("lon", "lat")]
    )


def ring_measures(area: DataFrame) -> DataFrame:
    """Bounding box, centroid and spherical area in m2 per area, ring by ring; holes count negative.

    For areas whose parts don't overlap; :func:`inundation.operators.overlay.measures` is for any.
    """
    local = edges(area).selectExpr(
        "*",
        "lon1 - lon0 AS x1",
        "lat1 - lat0 AS y1",
        "lon2 - lon0 AS x2",
        "lat2 - lat0 AS y2",
        "(lon1 - lon0) * (lat2 - lat0) - (lon2 - lon0) * (lat1 - lat0) AS cr",
        "radians(lon2 - lon1) * ((sin(radians(lat1)) + sin(radians(lat2))) / 2 - sin(radians(lat0))) AS strip",
    )
    rings = local.groupBy("aoi_id", "part", "ring").agg(
        *[
            F.expr(e)
            for e in (
                "first(lon0) AS lon0",
                "first(lat0) AS lat0",
                "sum(cr) / 2 AS a",
                "sum((x1 + x2) * cr) / 6 AS mx",
                "sum((y1 + y2) * cr) / 6 AS my",
                "abs(sum(strip)) AS solid",
            )
        ]
    )
    # Rings may be wound either way: the sign comes from shell or hole, not from the winding.
    signed = rings.selectExpr("*", "CASE WHEN ring = 0 THEN 1.0D ELSE -1.0D END AS s")
    total = signed.groupBy("aoi_id").agg(
        F.expr("sum(s * abs(a)) AS w"),
        F.expr("sum(s * signum(a) * (mx + a * lon0)) AS sx"),
        F.expr("sum(s * signum(a) * (my + a * lat0)) AS sy"),
        F.expr("sum(s * solid) AS solid"),
    )
    return bounds(area).join(total, "aoi_id").selectExpr(
        "aoi_id",
        "min_lon",
        "min_lat",
        "max_lon",
        "max_lat",
        "try_divide(sx, w) AS centroid_lon",
        "try_divide(sy, w) AS centroid_lat",
        f"solid * {num(EARTH_RADIUS_M**2)} AS area_m2",
    )


def _share_a_point(e: str, f: str) -> str:
    """Do two edges touch or cross?  Boxes first, then orientations."""

    def turn(a, b, n):
        """Side of edge ``a`` on which end ``n`` of edge ``b`` lies."""
        return (
            f"signum(({a}.lon2 - {a}.lon1) * ({b}.lat{n} - {a}.lat1) - ({a}.lat2 - {a}.lat1) * ({b}.lon{n} - {a}.lon1))"
        )

    boxes = " AND ".join(
        f"least({p}.{c}1, {p}.{c}2) <= greatest({q}.{c}1, {q}.{c}2)" for c in ("lon", "lat") for p, q in ((e, f), (f, e))
    )
    return f"({boxes} AND {turn(f, e, 1)} * {turn(f, e, 2)} <= 0 AND {turn(e, f, 1)} * {turn(e, f, 2)} <= 0)"


def _point_inside(edges_: str, lon: str, lat: str, v: str) -> str:
    """Even-odd containment of a point in the edges of one part, shell and holes together."""
    crossed = (
        f"CASE WHEN ({v}.lat1 > {lat}) != ({v}.lat2 > {lat}) "
        f"THEN {lon} < ({v}.lon2 - {v}.lon1) * ({lat} - {v}.lat1) / ({v}.lat2 - {v}.lat1) + {v}.lon1 ELSE false END"
    )
    return f"size(filter({edges_}, {v} -> {crossed})) % 2 = 1"


def literal_edges(polygon) -> str:
    """The edges of a polygon given as rings of (lon, lat)."""
    out = []
    for ring in polygon:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
            out.append(f"named_struct('lon1', {num(ax)}, 'lat1', {num(ay)}, 'lon2', {num(bx)}, 'lat2', {num(by)})")
    return f"array({', '.join(out)})"


def footprint_edges(footprint: str = "footprint") -> str:
    """The edges of a footprint column, an array of rings."""
    return f"flatten(transform({footprint}, r -> {ring_edges('r')}))"


def polygons_meet(edges_a: str, edges_b: str) -> str:
    """Do two polygons, each an array of edges, overlap or touch?  One holds a vertex of the other, or some edges meet.

    Vertices come first: most polygons that meet share inside, and a vertex takes one pass of edges, not all pairs of them.
    """
    return (
        f"(exists({edges_a}, e -> {_point_inside(edges_b, 'e.lon1', 'e.lat1', 'f')})"
        f" OR exists({edges_b}, f -> {_point_inside(edges_a, 'f.lon1', 'f.lat1', 'e')})"
        f" OR exists({edges_a}, e -> exists({edges_b}, f -> {_share_a_point('e', 'f')})))"
    )


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def polygons_meet_in(box: str, edges_a: str, edges_b: str) -> str:
    """:func:`polygons_meet` for polygons whose common points all lie in a box: only edges that reach it are held against each other, and only its band of latitude tells what is inside."""

    def reach(edges_, c, low, high):
        return f"filter({edges_}, v -> (v.{c}1 >= {box}.{low} OR v.{c}2 >= {box}.{low}) AND (v.{c}1 <= {box}.{high} OR v.{c}2 <= {box}.{high}))"

    def held(edges_, others, e, f):
        in_box = f"{e}.lon1 >= {box}.west AND {e}.lon1 <= {box}.east AND {e}.lat1 >= {box}.south AND {e}.lat1 <= {box}.north"
        return f"exists({edges_}, {e} -> {in_box} AND {_point_inside(others, f'{e}.lon1', f'{e}.lat1', f)})"

    meet = (
        f"{held('near_a', 'band_b', 'e', 'f')} OR {held('near_b', 'band_a', 'f', 'e')}"
        f" OR exists(near_a, e -> exists(near_b, f -> {_share_a_point('e', 'f')}))"
    )
    for name in ("b", "a"):
        meet = _let(f"near_{name}", reach(f"band_{name}", "lon", "west", "east"), meet)
    for name, edges_ in (("b", edges_b), ("a", edges_a)):
        meet = _let(f"band_{name}", reach(edges_, "lat", "south", "north"), meet)
    return meet


#: Bounds that tell shapes apart give way by this much, a tenth of a millimetre in degrees, as they are rounded.
MARGIN_DEG = 1e-9

#: Where the centre of an inner box is looked for, in shares of the box of its part.
INNER_CENTRES = tuple((x, y) for x in (0.5, 0.25, 0.75) for y in (0.5, 0.25, 0.75))

#: Columns of an outline, with their values for a shape of which nothing is known: its box, the place of an outermost vertex on each side of it, the
#: bounds of lon + lat and of lon - lat, and an inner box, whose sides change places where there is none.
OUTLINE = {
    **{"west": "-Infinity", "south": "-Infinity", "east": "Infinity", "north": "Infinity"},
    **{"west_at": "NaN", "south_at": "NaN", "east_at": "NaN", "north_at": "NaN"},
    **{"sum_lo": "-Infinity", "sum_hi": "Infinity", "dif_lo": "-Infinity", "dif_hi": "Infinity"},
    **{"in_west": "Infinity", "in_south": "Infinity", "in_east": "-Infinity", "in_north": "-Infinity"},
}


def _inner_boxes(x1, y1, x2, y2, first, of_edge):
    """For each part, whose edges start at ``first``, the largest box around one of some centres that meets no edge, or its own box if that is its shape: size, west, south, east, north."""
    west, south = np.minimum.reduceat(x1, first), np.minimum.reduceat(y1, first)
    east, north = np.maximum.reduceat(x1, first), np.maximum.reduceat(y1, first)
    w, s, e, n = (v[of_edge] for v in (west, south, east, north))
    is_box = np.logical_and.reduceat(((x1 == x2) & ((x1 == w) | (x1 == e))) | ((y1 == y2) & ((y1 == s) | (y1 == n))), first)
    half_x, half_y = (east - west) / 2, (north - south) / 2
    best = np.vstack([np.zeros_like(west), *(np.full_like(west, float(OUTLINE[f"in_{c}"])) for c in ("west", "south", "east", "north"))])
    for share_x, share_y in INNER_CENTRES:
        x, y = west + share_x * (east - west), south + share_y * (north - south)
        cx, cy = x[of_edge], y[of_edge]
        crossed = ((y1 > cy) != (y2 > cy)) & (cx < (x2 - x1) * (cy - y1) / (y2 - y1) + x1)
        inside = np.add.reduceat(crossed.astype(np.int64), first) % 2 == 1
        # Edges with the centre at 0 and the box's sides at 1: the larger of |x| and |y| is least at an end of an edge or where both are equal.
        a, b, c, d = (x1 - cx) / half_x[of_edge], (y1 - cy) / half_y[of_edge], (x2 - cx) / half_x[of_edge], (y2 - cy) / half_y[of_edge]
        reach = np.maximum(np.abs(a), np.abs(b))
        for p, q in ((a - b, c - d), (a + b, c + d)):
            reach = np.where((p * q <= 0) & (p != q), np.minimum(reach, np.abs(a * d - b * c) / np.abs(p - q)), reach)
        r = np.minimum.reduceat(reach, first)
        dx, dy = r * half_x - MARGIN_DEG, r * half_y - MARGIN_DEG
        grown = np.vstack([dx * dy * 4, x - dx, y - dy, x + dx, y + dy])
        own = np.vstack([half_x * half_y * 4, west, south, east, north])
        found = np.where(is_box, own, grown)
        better = inside & (dx > 0) & (dy > 0) & (found[0] > best[0])
        best = np.where(better, found, best)
    return best


def _outlines(parts: pa.Array) -> pa.Array:
    """Outlines of shapes, each an array of parts, each an array of edges."""
    n = len(parts)
    size = lambda v: pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    of_part, rings = np.repeat(np.arange(n), size(parts)), parts.flatten()
    sizes, edges_ = size(rings), rings.flatten()
    ends = [np.asarray(pc.fill_null(pc.struct_field(edges_, c), float("nan")).to_numpy(zero_copy_only=False), dtype=float) for c in ("lon1", "lat1", "lon2", "lat2")]
    shape = np.repeat(of_part, sizes)
    known = np.ones(n, bool)
    known[shape[~np.isfinite(np.sum(ends, axis=0))]] = False
    values = {k: np.full(n, float(v)) for k, v in OUTLINE.items()}
    keep = known[shape]
    if keep.any():
        ends, shape = [v[keep] for v in ends], shape[keep]
        part = np.repeat(np.arange(len(sizes)), sizes)[keep]
        new_part, new_shape = (np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) for v in (part, shape))
        ids, x, y = shape[new_shape], ends[0], ends[1]
        at = np.cumsum(np.r_[False, shape[1:] != shape[:-1]])
        for side, u, v, f in (("west", x, y, np.minimum), ("south", y, x, np.minimum), ("east", x, y, np.maximum), ("north", y, x, np.maximum)):
            values[side][ids] = outermost = f.reduceat(u, new_shape)
            values[f"{side}_at"][ids] = np.minimum.reduceat(np.where(u == outermost[at], v, np.inf), new_shape)
        for name, v in (("sum", x + y), ("dif", x - y)):
            values[f"{name}_lo"][ids], values[f"{name}_hi"][ids] = np.minimum.reduceat(v, new_shape), np.maximum.reduceat(v, new_shape)
        with np.errstate(all="ignore"):
            boxes = _inner_boxes(*ends, new_part, np.cumsum(np.r_[False, part[1:] != part[:-1]]))
        # The largest of a shape's parts comes last and stays.
        owner = shape[new_part]
        order = np.lexsort((boxes[0], owner))
        for name, v in zip(("in_west", "in_south", "in_east", "in_north"), boxes[1:]):
            values[name][owner[order]] = v[order]
    return pa.StructArray.from_arrays([pa.array(v) for v in values.values()], names=list(values))


def outlines(shapes: DataFrame, parts: str, prefix: str) -> DataFrame:
    """Adds the outlines of shapes given by an expression for their parts, each an array of edges, as columns of :data:`OUTLINE` with a prefix.

    They are made once a shape, and settle most pairs of shapes by a few comparisons (:func:`surely_meet`, :func:`may_meet`).
    """
    make = F.arrow_udf(_outlines, ", ".join(f"{c} double" for c in OUTLINE))
    named = [f"coalesce(_outline.{c}, double('{v}')) AS {prefix}{c}" for c, v in OUTLINE.items()]
    return shapes.withColumn("_outline", make(F.expr(parts))).selectExpr("*", *named).drop("_outline")


def _holds(box: str, points: str) -> str:
    """Does the inner box of one outline hold an outermost vertex of the other?"""
    vertices = (("west", "west_at"), ("east", "east_at"), ("south_at", "south"), ("north_at", "north"))
    return " OR ".join(
        f"({points}{x} >= {box}in_west AND {points}{x} <= {box}in_east AND {points}{y} >= {box}in_south AND {points}{y} <= {box}in_north)" for x, y in vertices
    )


def surely_meet(a: str, b: str) -> str:
    """Two shapes share a point by their outlines, whose columns have these prefixes: inner boxes overlap, or one holds an outermost vertex of the other shape."""
    inner = f"{a}in_west <= {b}in_east AND {a}in_east >= {b}in_west AND {a}in_south <= {b}in_north AND {a}in_north >= {b}in_south"
    return f"(({inner}) OR {_holds(b, a)} OR {_holds(a, b)})"


def may_meet(a: str, b: str) -> str:
    """No line along an axis or a diagonal lies between two shapes by their outlines; see :func:`surely_meet`."""
    m = num(MARGIN_DEG)
    sides = (("west", "east"), ("south", "north"), ("sum_lo", "sum_hi"), ("dif_lo", "dif_hi"))
    return "(" + " AND ".join(f"{a}{lo} <= {b}{hi} + {m} AND {a}{hi} + {m} >= {b}{lo}" for lo, hi in sides) + ")"


def common_box(a: str, b: str) -> str:
    """The box in which all points that two shapes share lie, by their outlines; see :func:`surely_meet`."""
    m = num(MARGIN_DEG)
    sides = [f"'{c}', greatest({a}{c}, {b}{c}) - {m}" for c in ("west", "south")] + [f"'{c}', least({a}{c}, {b}{c}) + {m}" for c in ("east", "north")]
    return f"named_struct({', '.join(sides)})"


def outline_moved(prefix: str, turn: str) -> list[str]:
    """The columns of an outline ``turn`` degrees further east."""
    still = {"south", "north", "west_at", "east_at", "in_south", "in_north"}
    return [f"{prefix}{c}" if c in still else f"{prefix}{c} + {turn} AS {prefix}{c}" for c in OUTLINE]


def moved_edges(edges_: str, turn: str) -> str:
    """Edges ``turn`` degrees further east."""
    return f"transform({edges_}, v -> named_struct('lon1', v.lon1 + {turn}, 'lat1', v.lat1, 'lon2', v.lon2 + {turn}, 'lat2', v.lat2))"
