"""What a run covers: events, their areas on the grid, and proven bounds for everything that may be broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import DEFAULT_OTSU_AOI, bounds, ring_edges
from ..functions.grid import COLUMNS, READ_TILE, STEP_DEG, TILE, block_of, num
from ..operators.regions import cover, polygon_spans, tile_shapes
from ..sources.aoi import same_area_for
from ..sources.control import settle


#: Parts over which the events of one place are spread.
EVENT_SALTS = 64


@dataclass(frozen=True)
class Area:
    """Spans of an area per event and their number, the shapes of its tiles and their number, the cells in them, a bound for the rows of a tile
    cover, and the tiles around all of them."""

    spans: DataFrame
    span_rows: int
    shapes: DataFrame
    shape_rows: int
    cells: int
    tile_rows: int
    envelope: tuple[int, int, int, int]

    def cover(self, halo: int = 0) -> DataFrame:
        return cover(self.spans, halo)


@dataclass(frozen=True)
class Scope:
    events: DataFrame
    n_events: int
    aoi: Area
    otsu: Area


def _before(table: DataFrame, keys: list[str], within: list[str], name: str) -> DataFrame:
    """``keys`` and ``name``, the sum of ``n`` over the groups that come before, among those that agree on ``within``."""
    over = f"({f'PARTITION BY {', '.join(within)} ' if within else ''}ORDER BY {', '.join(keys)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return table.groupBy(*keys).agg(F.expr("sum(n) AS n")).selectExpr(*keys, f"coalesce(sum(n) OVER {over}, 0) AS {name}")


def place_batches(events: DataFrame, aois: DataFrame, most_rows: int) -> list[tuple[str, DataFrame]]:
    """Events in groups that lie together and whose areas have at most about ``most_rows`` tiles each, or one event.

    What a run joins pixels to then stays small enough to be sent to every task, for any number of events.  Each group comes with
    a name that depends on its events, their dates and areas only.  An event without an area goes with the first.

    Groups are cut where a running sum of tiles passes a multiple of ``most_rows``.  The sum is taken in steps, over cells of 4
    degrees (some thousands, whatever the events), over quarter degrees in them, over ``EVENT_SALTS`` parts of each, and over the events
    of a part, so that no task has all events, nor all of one place.
    """
    size = " * ".join(f"((max(max_{c}) - min(min_{c})) / {num(READ_TILE * STEP_DEG)} + 2)" for c in ("lat", "lon"))
    boxes = bounds(aois).groupBy("aoi_id").agg(F.expr(f"CAST({size} AS BIGINT) AS n"), F.expr("min(min_lon) AS lon"), F.expr("min(min_lat) AS lat"))
    shapes = aois.groupBy(F.col("aoi_id").alias("event_id")).agg(F.expr("bit_xor(xxhash64(part, ring, pts)) AS shape"))
    sized = events.join(boxes.withColumnRenamed("aoi_id", "event_id"), "event_id", "left").join(shapes, "event_id", "left").selectExpr(
        *[f"`{c}`" for c in events.columns],
        "coalesce(n, 0) AS n", "floor(coalesce(lon, -200) / 4) AS _cx", "floor(coalesce(lat, -200) / 4) AS _cy", "floor(coalesce(lon, -200) * 4) AS _sx",
        "floor(coalesce(lat, -200) * 4) AS _sy", f"pmod(xxhash64(event_id), {EVENT_SALTS}) AS _salt", "xxhash64(event_id, event_ts, shape) AS _hash",
    )
    sized = settle(sized)
    named = [F.expr("count(*) AS events"), F.expr("hex(bit_xor(_hash)) AS name"), F.expr("sum(n) AS rows")]
    whole = sized.agg(*named).first()
    if (whole.rows or 0) <= most_rows:
        return [(f"{whole.events}-{whole.name}", events)]
    cell, place, part = ["_cx", "_cy"], ["_cx", "_cy", "_sx", "_sy"], ["_cx", "_cy", "_sx", "_sy", "_salt"]
    steps = ((cell, [], "_a"), (place, cell, "_b"), (part, place, "_c"))
    placed = sized
    for keys, within, name in steps:
        placed = placed.join(_before(sized, keys, within, name), keys)
    upto = f"_a + _b + _c + sum(n) OVER (PARTITION BY {', '.join(part)} ORDER BY event_id ROWS UNBOUNDED PRECEDING)"
    batched = settle(placed.selectExpr(*[f"`{c}`" for c in events.columns], "n", "_hash", f"CAST(floor(greatest({upto} - 1, 0) / {int(most_rows)}) AS BIGINT) AS batch"))
    groups = batched.groupBy("batch").agg(*named).orderBy("batch").collect()
    return [(f"{g.events}-{g.name}", batched.where(f"batch = {g.batch}").select(*events.columns)) for g in groups]


def make_scope(events: DataFrame, aois: DataFrame, otsu_aois: DataFrame | None = None) -> Scope:
    """Bind events (event_id, event_ts) to their areas (``aoi_id`` is the event id).

    Works on geometry only, nothing per pixel runs here.  Without ``otsu_aois`` thresholds come from the default polygon; pass
    ``aois`` itself to take them from the whole area, which then also shares its reads.
    """
    if otsu_aois is None:
        otsu_aois = same_area_for(events, DEFAULT_OTSU_AOI)
    same = otsu_aois is aois
    spans = polygon_spans(aois).selectExpr("*", "0 AS kind")
    if not same:
        spans = spans.unionByName(polygon_spans(otsu_aois).selectExpr("*", "1 AS kind"))
    spans = settle(spans)
    ends = [(f, axis) for f in ("min", "max") for axis in ("lon", "lat")]
    shapes = (
        aois.groupBy("aoi_id")
        .agg(
            F.expr(f"collect_list(struct(part, {ring_edges('pts')} AS e)) AS rings"),
            *[F.expr(f"{f}(array_{f}(transform(pts, p -> p.{axis}))) AS {f}_{axis}") for f, axis in ends],
        )
        .selectExpr(
            "aoi_id",
            "transform(array_distinct(rings.part), p -> flatten(transform(filter(rings, r -> r.part = p), r -> r.e))) AS parts",
            *[f"{f}_{axis}" for f, axis in ends],
        )
    )
    # An event without an area stays, and is reported as such.
    placed = settle(events.select("event_id", "event_ts").join(shapes.withColumnRenamed("aoi_id", "event_id"), "event_id", "left"))

    # A cover spans at most one more tile than the extent fills, and a halo adds one on each side.
    tiles = f"((x1 - x0) / {READ_TILE} + 4) * ((y1 - y0) / {READ_TILE} + 4)"
    measured = (
        spans.groupBy("kind", "aoi_id")
        .agg(*[F.expr(e) for e in ("count(*) AS n", "sum(x_hi - x_lo + 1) AS cells", "min(x_lo) AS x0", "max(x_hi) AS x1", "min(y) AS y0", "max(y) AS y1")])
        .groupBy("kind")
        .agg(
            F.expr("sum(n) AS n"),
            F.expr("sum(cells) AS cells"),
            F.expr(f"CAST(sum({tiles}) AS BIGINT) AS tiles"),
            *[F.expr(f"{block_of(f'{f}({c})')} AS {c}") for f, c in (("min", "x0"), ("max", "x1"), ("min", "y0"), ("max", "y1"))],
        )
    )
    found = {r.kind: r for r in measured.collect()}
    # Both kinds at once: an area's id is made its own by its kind.
    named = spans.withColumn("aoi_id", F.struct("kind", "aoi_id"))
    shapes = settle(tile_shapes(named).selectExpr("aoi_id.kind", "aoi_id.aoi_id", "tx", "ty", "inner", "lo", "hi"))
    counted = {r.kind: r["count"] for r in shapes.groupBy("kind").count().collect()}

    def area(kind):
        own, cut = (df.where(f"kind = {kind}").drop("kind") for df in (spans, shapes))
        r = found.get(kind)
        if not r:
            return Area(own, 0, cut, 0, 0, 0, (0, 0, 0, 0))
        # Beside one end of the grid, what is near may lie at the other.
        last = (COLUMNS - 1) // TILE
        x0, x1 = (0, last) if r.x0 < 1 or r.x1 > last - 1 else (r.x0 - 1, r.x1 + 1)
        return Area(own, r.n, cut, counted.get(kind, 0), r.cells, r.tiles, (x0, x1, r.y0 - 1, r.y1 + 1))

    aoi = area(0)
    return Scope(placed, placed.count(), aoi, aoi if same else area(1))
