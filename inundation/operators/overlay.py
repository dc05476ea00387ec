"""Union, intersection and difference of polygons, as joins of their edges.

Edges of one area meet where they pass the same cell of a grid made for that area, and are cut where they cross or touch.  What is
left are pieces that share end points at most.  A ray to the east from the middle of each piece counts the parts on either
side of it, and a piece belongs to the result's border where only one of its sides does.  Border pieces run with the result on
their left, so sums over them give areas and centroids; rings are made only where geometry is asked for.

Coordinates are whole picodegrees in doubles, so points that are equal are equal to the last bit.  Parts of an area are even-odd by
themselves (shell and holes) and united with each other.  The grid of an area has about as many cells as it has edges.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import AREA_SCHEMA, ring_edges, ring_measures
from ..functions.grid import EARTH_RADIUS_M, num
from ..sources.control import settle
from .components import least_linked

#: Picodegrees in a degree, and the distance within which a point counts as lying on an edge.
UNIT = 1e12
TOUCH = 2.0

#: Pieces of borders that are traced together.
TRACE_EDGES = 8192

_SEGMENT = ["x1", "y1", "x2", "y2"]
#: Which points belong to the result, from the numbers of parts of the first (``a``) and the second area (``b``) that hold them.
OPERATIONS = {"union": "{a} + {b} > 0", "intersection": "{a} > 0 AND {b} > 0", "difference": "{a} > 0 AND {b} = 0"}


def _segments(area: DataFrame) -> DataFrame:
    """Distinct edges of each area, west end first, with the parts that have them an odd number of times."""
    shape = "array_sort(collect_list(array_sort(transform(pts, p -> struct(p.lon, p.lat)))))"
    once = area.groupBy("aoi_id", "operand", "part").agg(F.expr(f"{shape} AS shape"))
    # Parts that are copies of each other count once.
    once = once.groupBy("aoi_id", "operand", F.xxhash64("shape").alias("shape")).agg(F.min("part").alias("part")).drop("shape")
    edge = area.where("size(pts) > 0").join(once, ["aoi_id", "operand", "part"], "left_semi")
    edge = edge.selectExpr("aoi_id", "operand", "part", f"inline({ring_edges('pts')})")
    whole = ", ".join(f"round({c} * {num(UNIT)}) AS {c}" for c in ("lon1", "lat1", "lon2", "lat2"))
    edge = edge.selectExpr("aoi_id", "operand", "part", *whole.split(", "))
    return _odd(edge.selectExpr("aoi_id", "operand", "part", *_west_first("lon1", "lat1", "lon2", "lat2")))


def _west_first(x1: str, y1: str, x2: str, y2: str) -> list[str]:
    swap = f"({x1} > {x2} OR {x1} = {x2} AND {y1} > {y2})"
    return [f"IF({swap}, {a}, {b}) AS {c}" for a, b, c in ((x2, x1, "x1"), (y2, y1, "y1"), (x1, x2, "x2"), (y1, y2, "y2"))]


def _odd(segments: DataFrame) -> DataFrame:
    """One row per segment with its ``owners``, the parts of which it is an edge."""
    some = segments.where("x1 <> x2 OR y1 <> y2").groupBy("aoi_id", *_SEGMENT, "operand", "part").agg(F.expr("count(*) AS n")).where("n % 2 = 1")
    return some.groupBy("aoi_id", *_SEGMENT).agg(F.expr("array_sort(collect_list(struct(operand, part))) AS owners"))


def _grids(segments: DataFrame) -> DataFrame:
    """Origin and cell size of each area's grid."""
    size = "greatest(max(x2) - min(x1), max(greatest(y1, y2)) - min(least(y1, y2)), 1.0D) / ceil(sqrt(count(*)))"
    return segments.groupBy("aoi_id").agg(F.expr("min(x1) AS ox"), F.expr("min(least(y1, y2)) AS oy"), F.expr(f"{size} AS cell"))


def _in_bands(segments: DataFrame) -> DataFrame:
    """Segments once per band of the grid that they pass."""
    low, high = (f"CAST(floor(({f}(y1, y2) - oy) / cell) AS BIGINT)" for f in ("least", "greatest"))
    return segments.withColumn("band", F.expr(f"explode(sequence({low}, {high}))"))


def _in_cells(segments: DataFrame) -> DataFrame:
    """Segments once per cell that they pass, or come within ``TOUCH`` of."""
    at = lambda y: f"x1 + (x2 - x1) * ({y} - y1) / (y2 - y1)"
    ends = [f"CASE WHEN y1 = y2 THEN {x} ELSE least(greatest({at(f'(oy + (band + {k}) * cell)')}, x1), x2) END" for k, x in ((0, "x1"), (1, "x2"))]
    # A band holds the part of a segment between the band's two lines.
    column = lambda f, d: f"CAST(floor(({f}(c0, c1) {d} {num(TOUCH)} - ox) / cell) AS BIGINT)"
    banded = _in_bands(segments).selectExpr("*", f"{ends[0]} AS c0", f"{ends[1]} AS c1")
    return banded.withColumn("col", F.expr(f"explode(sequence({column('least', '-')}, {column('greatest', '+')}))")).drop("c0", "c1")


def _turn(a: str, b: str, i: int) -> str:
    """Twice the area of the triangle of segment ``a`` and end ``i`` of ``b``: its sign is the side on which that end lies."""
    return f"(({a}.x2 - {a}.x1) * ({b}.y{i} - {a}.y1) - ({a}.y2 - {a}.y1) * ({b}.x{i} - {a}.x1))"


def _on(a: str, b: str, i: int) -> str:
    """Does end ``i`` of ``b`` lie on ``a``?"""
    box = " AND ".join(
        f"{b}.{c}{i} BETWEEN least({a}.{c}1, {a}.{c}2) - {num(TOUCH)} AND greatest({a}.{c}1, {a}.{c}2) + {num(TOUCH)}" for c in "xy"
    )
    return f"(abs({_turn(a, b, i)}) <= {num(TOUCH)} * sqrt(pow({a}.x2 - {a}.x1, 2) + pow({a}.y2 - {a}.y1, 2)) AND {box})"


def _pieces(segments: DataFrame, grids: DataFrame) -> DataFrame:
    """Segments cut at all points where they cross or touch another of their area."""
    placed = _in_cells(segments.drop("owners").join(grids, "aoi_id")).select("aoi_id", "band", "col", F.struct(*_SEGMENT).alias("s"))
    met = placed.withColumnRenamed("s", "a").join(placed.withColumnRenamed("s", "b"), ["aoi_id", "band", "col"]).where("a < b")
    touch = {f"on_{a}{i}": _on(a, b, i) for a, b in ("ab", "ba") for i in (1, 2)}
    turns = {f"t_{a}{i}": _turn(a, b, i) for a, b in ("ab", "ba") for i in (1, 2)}
    met = met.selectExpr("aoi_id", "a", "b", *[f"{e} AS {c}" for c, e in (touch | turns).items()])
    met = met.withColumn("cross", F.expr(f"NOT ({' OR '.join(touch)}) AND t_a1 * t_a2 < 0 AND t_b1 * t_b2 < 0"))
    # The point is worked out once per pair, so both segments are cut at the very same one.
    share = "t_b1 / (t_b1 - t_b2)"
    point = f"struct(round(a.x1 + (a.x2 - a.x1) * {share}) AS x, round(a.y1 + (a.y2 - a.y1) * {share}) AS y)"
    met = met.where(f"cross OR {' OR '.join(touch)}").withColumn("p", F.expr(f"IF(cross, {point}, NULL)"))
    ends = lambda a, b: ", ".join(f"IF(on_{a}{i}, struct({b}.x{i} AS x, {b}.y{i} AS y), NULL)" for i in (1, 2))
    cuts = met.selectExpr("aoi_id", f"inline(array(struct(a AS s, array(p, {ends('a', 'b')}) AS ps), struct(b AS s, array(p, {ends('b', 'a')}) AS ps)))")
    cuts = cuts.selectExpr("aoi_id", "s", "explode(filter(ps, p -> p IS NOT NULL)) AS p")
    cuts = cuts.groupBy("aoi_id", "s").agg(F.expr("collect_set(p) AS ps")).selectExpr("aoi_id", *[f"s.{c}" for c in _SEGMENT], "ps")
    along = "(p.x - x1) * (x2 - x1) + (p.y - y1) * (y2 - y1)"
    inner = f"array_sort(transform(coalesce(ps, array()), p -> struct({along} AS t, p.x AS x, p.y AS y)))"
    inner = f"filter({inner}, p -> p.t > 0 AND p.t < pow(x2 - x1, 2) + pow(y2 - y1, 2))"
    chain = f"concat(array(struct(x1 AS x, y1 AS y)), transform({inner}, p -> struct(p.x AS x, p.y AS y)), array(struct(x2 AS x, y2 AS y)))"
    steps = "zip_with(slice(line, 1, size(line) - 1), slice(line, 2, size(line) - 1), (p, q) -> struct(p, q))"
    line = segments.join(cuts, ["aoi_id", *_SEGMENT], "left").selectExpr("aoi_id", "owners", f"{chain} AS line")
    cut = line.selectExpr("aoi_id", "owners", f"inline({steps})").selectExpr("aoi_id", "explode(owners) AS o", "p", "q")
    return _odd(cut.selectExpr("aoi_id", "o.operand", "o.part", *_west_first("p.x", "p.y", "q.x", "q.y")))


def _holders(probes: DataFrame, segments: DataFrame) -> DataFrame:
    """The owners that hold each probe: those with an odd number of segments to the east of it.

    ``probes``: aoi_id, probe, px, py and the grid; ``segments`` with the grid and ``owners``.  A segment named by the probe isn't
    counted.  A point on the line of a horizontal piece is taken to be just above it.
    """
    banded = _in_bands(segments).select("aoi_id", "band", F.struct(*_SEGMENT).alias("s"), "owners")
    asked = probes.selectExpr("aoi_id", "probe", "px", "py", "CAST(floor((py - oy) / cell) AS BIGINT) AS band")
    east = "(s.y1 > py) <> (s.y2 > py) AND s.x1 + (s.x2 - s.x1) * (py - s.y1) / (s.y2 - s.y1) > px AND s <> probe"
    hit = asked.join(banded, ["aoi_id", "band"]).where("greatest(s.x1, s.x2) > px").where(east)
    odd = hit.selectExpr("aoi_id", "probe", "explode(owners) AS o").groupBy("aoi_id", "probe", "o").agg(F.expr("count(*) AS n")).where("n % 2 = 1")
    return odd.groupBy("aoi_id", "probe").agg(F.expr("collect_list(o) AS holders"))


def border(area: DataFrame, other: DataFrame | None = None, operation: str = "union") -> DataFrame:
    """``aoi_id, x1, y1, x2, y2``: the border of the result, in picodegrees, with the result on the left.

    Areas are united with the ``other`` ones of the same id, cut with them, or rid of them; without ``other`` the parts of each are
    united.  Edges that bound the result on neither or on both sides are gone.
    """
    both = area.select("aoi_id", "part", "ring", "pts", F.lit(0).alias("operand"))
    if other is not None:
        both = both.unionByName(other.select("aoi_id", "part", "ring", "pts", F.lit(1).alias("operand")))
    # Each of these is read several times below.
    segments = settle(_segments(both))
    grids = settle(_grids(segments))
    pieces = settle(_pieces(segments, grids).join(grids, "aoi_id"))
    probe = F.struct(*_SEGMENT).alias("probe")
    probes = pieces.select("aoi_id", probe, F.expr("(x1 + x2) / 2 AS px"), F.expr("(y1 + y2) / 2 AS py"), "oy", "cell")
    found = _holders(probes, pieces).selectExpr("aoi_id", *[f"probe.{c}" for c in _SEGMENT], "holders")
    seen = pieces.join(found, ["aoi_id", *_SEGMENT], "left").withColumn("east", F.expr("coalesce(holders, array())"))
    seen = seen.withColumn("west", F.expr("concat(array_except(east, owners), array_except(owners, east))"))
    depth = lambda side, k: f"size(filter({side}, o -> o.operand = {k}))"
    rule = lambda side: "(" + OPERATIONS[operation].format(a=depth(side, 0), b=depth(side, 1)) + ")"
    kept = seen.selectExpr("*", f"{rule('east')} AS in_east", f"{rule('west')} AS in_west").where("in_east <> in_west")
    # To the east of a level piece means above it.  The piece runs south, or east if level, where that side is in.
    back = "IF(y1 = y2, NOT in_east, (y1 < y2) = in_east)"
    ends = (("x2", "x1", "x1"), ("y2", "y1", "y1"), ("x1", "x2", "x2"), ("y1", "y2", "y2"))
    return kept.selectExpr("aoi_id", f"{back} AS back", *_SEGMENT).selectExpr("aoi_id", *[f"IF(back, {a}, {b}) AS {c}" for a, b, c in ends])


def border_measures(edges: DataFrame) -> DataFrame:
    """Bounding box, centroid and spherical area in m2 of what a :func:`border` encloses, per area."""
    least = edges.groupBy("aoi_id").agg(*[F.expr(f"min(least({c}1, {c}2)) AS o{c}") for c in "xy"], *[F.expr(f"max(greatest({c}1, {c}2)) AS t{c}") for c in "xy"])
    u = num(UNIT)
    local = edges.join(least, "aoi_id").selectExpr(
        "aoi_id", "ox", "oy", "tx", "ty", f"(x1 - ox) / {u} AS x1", f"(y1 - oy) / {u} AS y1", f"(x2 - ox) / {u} AS x2", f"(y2 - oy) / {u} AS y2",
        f"sin(radians(oy / {u})) AS s0", f"sin(radians(y1 / {u})) AS s1", f"sin(radians(y2 / {u})) AS s2",
    )
    sums = local.groupBy("aoi_id", "ox", "oy", "tx", "ty").agg(
        F.expr("sum(x1 * y2 - x2 * y1) / 2 AS a"),
        F.expr("sum((x1 + x2) * (x1 * y2 - x2 * y1)) / 6 AS mx"),
        F.expr("sum((y1 + y2) * (x1 * y2 - x2 * y1)) / 6 AS my"),
        F.expr("sum(radians(x1 - x2) * ((s1 + s2) / 2 - s0)) AS solid"),
    )
    return sums.selectExpr(
        "aoi_id", f"ox / {u} AS min_lon", f"oy / {u} AS min_lat", f"tx / {u} AS max_lon", f"ty / {u} AS max_lat",
        f"ox / {u} + try_divide(mx, a) AS centroid_lon", f"oy / {u} + try_divide(my, a) AS centroid_lat", f"solid * {num(EARTH_RADIUS_M**2)} AS area_m2",
    )


def _trace(edges: pd.DataFrame) -> list[list[int]]:
    """Rings of directed edges, each the row numbers of its edges in order; edges of different borders share no point.

    Where several edges leave a point, the ring goes on along the first one clockwise from where it came, which bounds the same corner of
    the inside.
    """
    own = edges["aoi_id"], edges["root"]
    start = list(zip(*own, edges["x1"], edges["y1"], strict=True))
    end = list(zip(*own, edges["x2"], edges["y2"], strict=True))
    angle = np.arctan2(edges["y2"] - edges["y1"], edges["x2"] - edges["x1"]).to_numpy()
    leaving: dict[tuple, list[int]] = {}
    for i, p in enumerate(start):
        leaving.setdefault(p, []).append(i)
    used, rings = [False] * len(edges), []
    for first in range(len(edges)):
        ring, i = [], first
        while not used[i]:
            used[i] = True
            ring.append(i)
            can = [j for j in leaving.get(end[i], ()) if not used[j]]
            if not can:
                break
            back = angle[i] + np.pi
            i = min(can, key=lambda j: ((back - angle[j]) % (2 * np.pi)) or 2 * np.pi)
        if ring:
            rings.append(ring)
    return rings


def _rings_of(group: pd.DataFrame) -> pd.DataFrame:
    """The rings of some whole borders."""
    group = group.sort_values(["aoi_id", "root", *_SEGMENT], ignore_index=True)
    ids, ends = group["aoi_id"].to_numpy(), group[_SEGMENT].to_numpy()
    out = []
    for ring in _trace(group):
        xy = ends[ring, :2]
        x, y = (xy - xy[0]).T
        area = float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)
        # Points on a straight line between their neighbours were cuts, not corners.
        before, after = np.roll(xy, 1, axis=0), np.roll(xy, -1, axis=0)
        d, e = xy - before, after - xy
        bend = np.abs(d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]) > 4 * TOUCH * np.maximum(np.hypot(*d.T), np.hypot(*e.T))
        corner = xy[bend] if bend.sum() >= 3 else xy
        out.append((ids[ring[0]], area, *ends[ring[0]], [{"lon": a / UNIT, "lat": b / UNIT} for a, b in corner.tolist()]))
    return pd.DataFrame(out, columns=["aoi_id", "a", "ex1", "ey1", "ex2", "ey2", "pts"])


def rings(edges: DataFrame) -> DataFrame:
    """The area frame (``aoi_id, part, ring, pts``) that a :func:`border` encloses: a part per outer ring, with its holes.

    Pieces that hang together are found by merging labels, so a ring is traced from the pieces of one connected border, which is the row
    that a ring is.  Small borders are traced some at a time: a group holds about ``TRACE_EDGES`` pieces, or one border that has more.
    """
    edges = settle(edges)
    point = lambda x, y: f"xxhash64({x}, {y})"
    named = edges.selectExpr("*", f"{point('x1', 'y1')} AS a", f"{point('x2', 'y2')} AS b")
    roots = least_linked(named.select("aoi_id", "a", "b"), ["aoi_id"]).withColumnRenamed("label", "a")
    # The least label of a group has no link to a lesser one.
    grouped = named.join(roots, ["aoi_id", "a"], "left").selectExpr("aoi_id", *_SEGMENT, "coalesce(root, a) AS root")
    schema = "aoi_id bigint, a double, ex1 double, ey1 double, ex2 double, ey2 double, pts array<struct<lon:double,lat:double>>"
    n = edges.count() // TRACE_EDGES + 1
    traced = grouped.groupBy(F.expr(f"pmod(xxhash64(aoi_id, root), {n})")).applyInPandas(lambda g: _rings_of(g), schema)
    traced = settle(traced.where("a <> 0").withColumn("id", F.struct(F.signum("a").alias("s"), F.abs("a").alias("size"), "ex1", "ey1", "ex2", "ey2")))
    shells, holes = traced.where("a > 0"), traced.where("a < 0")
    # A hole belongs to the smallest outer ring around it.
    whole = [f"round({c} * {num(UNIT)}) AS {d}" for c, d in (("lon1", "x1"), ("lat1", "y1"), ("lon2", "x2"), ("lat2", "y2"))]
    sides = shells.selectExpr("aoi_id", "id", f"inline({ring_edges('pts')})").selectExpr("aoi_id", "array(id) AS owners", *whole)
    grids = _grids(sides.selectExpr("aoi_id", "least(x1, x2) AS x1", "y1", "greatest(x1, x2) AS x2", "y2"))
    probe = holes.selectExpr("aoi_id", "id", "(ex1 + ex2) / 2 AS px", "(ey1 + ey2) / 2 AS py", "struct(ex1 AS x1, ey1 AS y1, ex2 AS x2, ey2 AS y2) AS probe")
    around = _holders(probe.join(grids, "aoi_id"), sides.join(grids, "aoi_id"))
    home = around.selectExpr("aoi_id", "probe", "array_min(holders) AS shell")
    placed = probe.select("aoi_id", "id", "probe").join(home, ["aoi_id", "probe"]).select("aoi_id", "id", "shell")
    every = shells.selectExpr("aoi_id", "id", "id AS shell", "pts").unionByName(holes.join(placed, ["aoi_id", "id"]).select("aoi_id", "id", "shell", "pts"))
    return every.selectExpr(
        "aoi_id",
        "CAST(dense_rank() OVER (PARTITION BY aoi_id ORDER BY shell) - 1 AS INT) AS part",
        "CAST(row_number() OVER (PARTITION BY aoi_id, shell ORDER BY id.s DESC, id) - 1 AS INT) AS ring",
        "pts",
    ).select(*[c.split(" ")[0] for c in AREA_SCHEMA.split(", ")])


def dissolve(area: DataFrame) -> DataFrame:
    """Each area with its parts united: no two parts overlap or share an edge."""
    return rings(border(area))


def intersect(area: DataFrame, other: DataFrame) -> DataFrame:
    """What each area has in common with the other one of the same id; areas without anything in common have no rows."""
    return rings(border(area, other, "intersection"))


def subtract(area: DataFrame, other: DataFrame) -> DataFrame:
    """What is left of each area without the other one of the same id."""
    return rings(border(area, other, "difference"))


def measures(area: DataFrame) -> DataFrame:
    """Bounding box, centroid and spherical area in m2 per area; what several parts hold counts once.

    Only areas of several parts go through the overlay.
    """
    parts = area.groupBy("aoi_id").agg(F.expr("count(DISTINCT part) > 1 AS several"))
    found = {r.several for r in parts.select("several").distinct().collect()}
    if True not in found:
        return ring_measures(area)
    marked = area.join(parts, "aoi_id")
    united = border_measures(border(marked.where("several")))
    return ring_measures(marked.where("NOT several").select(*area.columns)).unionByName(united) if False in found else united


def covered_share(areas: DataFrame, footprints: DataFrame, pairs: DataFrame) -> DataFrame:
    """``event_id, scene_id, covered_m2, share``: how much of its area each event's scenes cover.

    ``areas`` have the event's id as ``aoi_id``; ``footprints``: scene_id, min_lon, min_lat, max_lon, max_lat of the pixels there are;
    ``pairs``: event_id, scene_id.  A scene without pixels, or with none in the area, covers 0.
    """
    pairs = settle(pairs.select("event_id", "scene_id").distinct().withColumn("pair", F.xxhash64("event_id", "scene_id")))
    one = areas.withColumnRenamed("aoi_id", "event_id").join(pairs, "event_id").selectExpr("pair AS aoi_id", "part", "ring", "pts")
    corners = (("min_lon", "min_lat"), ("max_lon", "min_lat"), ("max_lon", "max_lat"), ("min_lon", "max_lat"))
    box = ", ".join(f"named_struct('lon', {x}, 'lat', {y})" for x, y in corners)
    other = footprints.join(pairs, "scene_id").selectExpr("pair AS aoi_id", "0 AS part", "0 AS ring", f"array({box}) AS pts")
    covered = border_measures(border(one, other, "intersection")).selectExpr("aoi_id AS pair", "area_m2 AS covered_m2")
    whole = measures(areas).selectExpr("aoi_id AS event_id", "area_m2 AS whole_m2")
    found = pairs.join(whole, "event_id").join(covered, "pair", "left")
    return found.selectExpr("event_id", "scene_id", "coalesce(covered_m2, 0.0D) AS covered_m2", "coalesce(covered_m2, 0.0D) / whole_m2 AS share")
