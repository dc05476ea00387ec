"""Scene catalogs: metadata, date and bounds filters, and the choice of scenes per event.

``scenes``: scene_id, acquired_at, min_lon, min_lat, max_lon, max_lat; radar catalogs add instrument_mode and
resolution_meters, optical ones cloudy_pixel_percentage; ``footprint array<array<struct<lon,lat>>>`` is optional.  The box of a scene
over longitude 180 ends beyond 180.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import (
    MARGIN_DEG,
    OUTLINE,
    common_box,
    footprint_edges,
    literal_edges,
    may_meet,
    moved_edges,
    outline_moved,
    outlines,
    polygons_meet,
    polygons_meet_in,
    surely_meet,
)
from ..functions.grid import num
from ..operators.lookup import lookup_join
from .control import settle

# What the radar archive is filtered on, and the default windows and limits.
INSTRUMENT_MODE = "IW"
RESOLUTION_M = 10
MAX_CLOUD_PERCENT = 30
SAR_DAYS = 12
OPTICAL_DAYS = 20
MIN_SCENES = 2

#: Zones of a stored catalog: their column, side in degrees, and number around and from pole to pole.
ZONE_COLUMN = "zone"
ZONE_DEG = 22.5
_ZONES_AROUND, _ZONES_UP = 16, 8

#: Sides of the matching cells, in degrees, by whole numbers around the globe.  A scene lies in the smallest it isn't larger than.
MATCH_SIDES_DEG = (4, 8, 24, 40, 72, 120, 360)
#: Scenes that a part of a cell and period holds; those of fuller ones are dealt over parts.
MATCH_PART = 1024

RADAR_QUALITY = f"instrument_mode = '{INSTRUMENT_MODE}' AND resolution_meters = {RESOLUTION_M}"

_BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


def optical_quality(max_cloud: float = MAX_CLOUD_PERCENT) -> str:
    return f"cloudy_pixel_percentage < {max_cloud}"


def in_dates(start: str | datetime, end: str | datetime) -> str:
    """Start included, end excluded; plain strings are ``yyyy-MM-dd`` dates."""

    def instant(t):
        if isinstance(t, str):
            t = datetime.strptime(t, "%Y-%m-%d")
        # Without time zone: compared as it stands with either timestamp type.
        return f"TIMESTAMP_NTZ '{t.isoformat(sep=' ')}'"

    return f"acquired_at >= {instant(start)} AND acquired_at < {instant(end)}"


def in_bounds(min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> str:
    """Footprint box overlaps the given box; plain comparisons, so they reach the Parquet reader.

    Longitudes may run on over 180: a scene there ends at more than 180 degrees.  A given box may also be written with its east end
    west of its west end.
    """
    east = max_lon + 360 if min_lon > max_lon else max_lon
    turns = " OR ".join(f"(min_lon <= {num(east + t)} AND max_lon >= {num(min_lon + t)})" for t in (0, 360, -360))
    return f"min_lat <= {num(max_lat)} AND max_lat >= {num(min_lat)} AND ({turns})"


def zone_of() -> str:
    """The zone of a scene, which a stored catalog is partitioned by: the cell of its south-west corner, or -1 for a scene larger than that."""
    column = f"CAST(pmod(floor((min_lon + 180) / {num(ZONE_DEG)}), {_ZONES_AROUND}) AS INT)"
    row = f"CAST(least(greatest(floor((min_lat + 90) / {num(ZONE_DEG)}), 0), {_ZONES_UP - 1}) AS INT)"
    return f"CASE WHEN max_lon - min_lon <= {num(ZONE_DEG)} AND max_lat - min_lat <= {num(ZONE_DEG)} THEN {column} * {_ZONES_UP} + {row} ELSE -1 END"


def in_zones(min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> str:
    """The zones that hold all scenes over the given box: a scene's corner lies at most a zone to the west or south of it."""
    east = max_lon + 360 if min_lon > max_lon else max_lon
    west = floor((min_lon - ZONE_DEG + 180) / ZONE_DEG)
    across = {c % _ZONES_AROUND for c in range(west, min(floor((east + 180) / ZONE_DEG), west + _ZONES_AROUND - 1) + 1)}
    rows = (min(max(floor((v + 90) / ZONE_DEG), 0), _ZONES_UP - 1) for v in (min_lat - ZONE_DEG, max_lat))
    low, high = rows
    zones = sorted(c * _ZONES_UP + r for c in across for r in range(low, high + 1))
    return f"{ZONE_COLUMN} IN ({', '.join(map(str, [-1, *zones]))})"


def over_area(polygon) -> str:
    """The footprint itself overlaps or touches a polygon given as rings of (lon, lat)."""
    return polygons_meet(footprint_edges(), literal_edges(polygon))


def _scan(scenes: DataFrame, quality: str, bounds, start, end, polygon) -> DataFrame:
    if bounds is None:
        ring = polygon[0]
        bounds = tuple(f(p[i] for p in ring) for f in (min, max) for i in (0, 1))
    found = scenes.where(f"{quality} AND {in_bounds(*bounds)} AND {in_dates(start, end)}")
    if {"acquired_on", ZONE_COLUMN} <= set(scenes.columns):
        # A stored catalog is opened by day and zone; the last day may be cut short, but holds no scene after its end.
        days = [t[:10] if isinstance(t, str) else t.date().isoformat() for t in (start, end)]
        found = found.where(f"acquired_on BETWEEN DATE '{days[0]}' AND DATE '{days[1]}' AND {in_zones(*bounds)}").drop("acquired_on", ZONE_COLUMN)
    # The box goes to the reader and leaves few scenes to be tested exactly.
    return found if polygon is None or "footprint" not in scenes.columns else found.where(over_area(polygon))


def radar_scenes(scenes: DataFrame, bounds: tuple[float, float, float, float] | None, start, end, polygon=None) -> DataFrame:
    """Radar scenes of one area and period: of a box, or of a polygon (rings of (lon, lat)), exactly where scenes have footprints."""
    return _scan(scenes, RADAR_QUALITY, bounds, start, end, polygon)


def optical_scenes(
    scenes: DataFrame, bounds: tuple[float, float, float, float] | None, start, end, max_cloud: float = MAX_CLOUD_PERCENT, polygon=None
) -> DataFrame:
    """Optical scenes of one area and period with cloud cover strictly below the limit; see :func:`radar_scenes`."""
    return _scan(scenes, optical_quality(max_cloud), bounds, start, end, polygon)


def require_scenes(scenes: DataFrame, what: str = "scenes") -> DataFrame:
    """The single-area guard: fewer than two scenes is an error."""
    if scenes.limit(MIN_SCENES).count() < MIN_SCENES:
        raise ValueError(f"Fewer than {MIN_SCENES} {what} in this period and area; widen the period or check the area")
    return scenes


def match_scenes(scenes: DataFrame, events: DataFrame, days: int) -> DataFrame:
    """Scenes within ``days`` of each event whose footprint meets its area, tagged pre or post.

    ``events``: event_id, event_ts, min_lon, min_lat, max_lon, max_lat and optionally ``parts``, the area's polygon parts as
    arrays of edges, against which a catalog with footprints is tested exactly.  Event-time scenes are post.

    Candidates meet on (period, matching cell), so any number of events is one equi-join.  A period is as long as the search
    window, so an event touches two of them.  A scene is in the cell of its south-west corner only, and an area in all cells where such a
    corner may lie, for the scenes of each side of cells that there are; so a pair meets once.  Footprints and areas have outlines, made
    once each, that settle most pairs by a few comparisons; only the other pairs have their polygons tested.  Scenes of a crowded cell
    and period are dealt over parts, with the events of the cell beside each, so that a popular place isn't one task's work; other cells
    are one part.  Both sides are sorted and merged, as the sizes that a plan expects don't tell how many cells an event has.  The span
    of all events in time and latitude, and in longitude where no area goes over 180 degrees, limits the scan of the catalog.
    """

    exact = "parts" in events.columns and "footprint" in scenes.columns

    def cell(v):
        return f"CAST(floor(({v}) / cell_deg) AS INT)"

    # Longitudes run on over 180 degrees; the cells of the turn that follows are those of this one.
    around = "CAST(360 / cell_deg AS INT)"

    def east(low, high):
        return f"CASE WHEN {low} > {high} THEN {high} + 360 ELSE {high} END"

    # Where the south-west corners of scenes over an area are.
    m = num(MARGIN_DEG)
    west_cells = f"sequence({cell(f'a_min_lon - wide - {m}')}, least({cell(f'a_max_lon + {m}')}, {cell(f'a_min_lon - wide - {m}')} + {around} - 1))"
    lon_cells = f"explode(array_distinct(transform({west_cells}, c -> pmod(c, {around}))))"
    lat_cells = f"explode(sequence({cell(f'a_min_lat - high - {m}')}, {cell('a_max_lat')}))"

    window = f"make_dt_interval({int(days)})"

    def period(day):
        return f"floor(unix_date(to_date({day})) / {2 * int(days)})"

    events = events.where("min_lon IS NOT NULL")
    first, last, south, north, west, end, over = events.agg(
        *[F.expr(e) for e in ("date_format(min(event_ts), 'yyyy-MM-dd')", "date_format(max(event_ts), 'yyyy-MM-dd')", "min(min_lat)", "max(max_lat)", "min(min_lon)", "max(max_lon)", "max(min_lon > max_lon)")]
    ).first()
    if first is not None:
        day = lambda d, n: datetime.strptime(d, "%Y-%m-%d") + timedelta(days=n)
        scenes = scenes.where(f"{in_dates(day(first, -int(days)), day(last, int(days) + 1))} AND min_lat <= {num(north)} AND max_lat >= {num(south)}")
        if not over:
            scenes = scenes.where(in_bounds(west, south, end, north))
    across = ("max_lon - min_lon", "max_lat - min_lat")
    sides = " ".join(f"WHEN greatest({', '.join(across)}) <= {s} THEN {s}" for s in MATCH_SIDES_DEG)
    scenes = scenes.withColumn("cell_deg", F.expr(f"CASE {sides} ELSE {MATCH_SIDES_DEG[-1]} END"))
    # The largest scene of each side; none has to reach around more than once.
    largest = scenes.groupBy("cell_deg").agg(*[F.expr(f"coalesce(max(least(nanvl({d}, 360D), 360D)), 0D)") for d in across]).collect()
    reach = ", ".join(f"named_struct('cell_deg', {s}, 'wide', {num(w)}, 'high', {num(h)})" for s, w, h in largest or [(MATCH_SIDES_DEG[0], 0, 0)])
    ev = (
        events.selectExpr(
            "event_id",
            "event_ts",
            f"event_ts - {window} AS opens_at",
            f"event_ts + {window} AS closes_at",
            "min_lon AS a_min_lon", "min_lat AS a_min_lat", f"{east('min_lon', 'max_lon')} AS a_max_lon", "max_lat AS a_max_lat",
            *(["parts"] if exact else []),
            f"explode(sequence({period(f'event_ts - {window}')}, {period(f'event_ts + {window}')})) AS period",
        )
        # One file of events may be one task's, whose rows are many times as many from here on.
        .repartition("event_id", "period")
        .transform(lambda df: outlines(df, "parts", "a_") if exact else df)
        .selectExpr("*", f"inline(array({reach}))")
        .selectExpr("*", f"{lon_cells} AS cx")
        .selectExpr("*", f"{lat_cells} AS cy")
        .drop("wide", "high")
    )
    sc = scenes.selectExpr(
        "scene_id",
        "acquired_at",
        *_BOX,
        *([f"{footprint_edges()} AS fp"] if exact else []),
        f"{period('acquired_at')} AS period",
        "cell_deg",
        # Never null, or the join would have the formulas tested for it over and over in the scan; a scene without a box fails the comparisons.
        f"coalesce(pmod({cell('min_lon')}, {around}), 0) AS cx",
        f"coalesce({cell('min_lat')}, 0) AS cy",
    ).transform(lambda df: outlines(df, "array(fp)", "f_") if exact else df)
    on = ["period", "cell_deg", "cx", "cy"]
    crowded = settle(sc.groupBy(*on).agg(F.expr(f"CAST(ceil(count(*) / {MATCH_PART}) AS INT) AS parts_of_cell")).where("parts_of_cell > 1"))
    if n_crowded := crowded.count():
        sc = lookup_join(sc, crowded, on, n_crowded, "left").withColumn("part_of_cell", F.expr("pmod(xxhash64(scene_id), coalesce(parts_of_cell, 1))"))
        ev = lookup_join(ev, crowded, on, n_crowded, "left").withColumn("part_of_cell", F.expr("explode(sequence(0L, coalesce(parts_of_cell, 1) - 1L))"))
        sc, ev, on = sc.drop("parts_of_cell"), ev.drop("parts_of_cell"), [*on, "part_of_cell"]
    # A scene may meet an area a turn further on; of wide ones that do so twice, one turn counts.
    meets = "(min_lon <= a_max_lon + {0} AND max_lon >= a_min_lon + {0})"
    shift = " ".join(f"WHEN {meets.format(n)} THEN {n}" for n in (0, 360, -360))
    met = (
        sc.join(ev.hint("merge"), on)
        .where("acquired_at >= opens_at AND acquired_at < closes_at AND min_lat <= a_max_lat AND max_lat >= a_min_lat")
        .selectExpr("*", f"CASE {shift} END AS turn")
        .where("turn IS NOT NULL")
    )
    if exact:
        pair = ("event_id", "event_ts", "scene_id", "acquired_at", *_BOX)
        # Only pairs left open keep their polygons.  The task's number, which is never negative, keeps their test out of the merge, which
        # would then run uncompiled for all pairs of a cell.
        kept = {"fp": "fp", "parts": "parts", "common": common_box("f_", "a_")}
        left_open = (f"IF(meets IS NULL AND spark_partition_id() >= 0, {e}, NULL) AS {c}" for c, e in kept.items())
        moved = f"IF(turn = 0, parts, transform(parts, p -> {moved_edges('p', 'turn')}))"
        met = (
            met.selectExpr(*pair, "fp", "parts", *[f"f_{c}" for c in OUTLINE], *[f"a_{c}" for c in OUTLINE], "CAST(coalesce(turn, 0) AS DOUBLE) AS turn")
            .selectExpr(*pair, "fp", "parts", "turn", *[f"f_{c}" for c in OUTLINE], *outline_moved("a_", "turn"))
            .selectExpr("*", f"CASE WHEN {surely_meet('f_', 'a_')} THEN true WHEN NOT {may_meet('f_', 'a_')} THEN false END AS meets")
            .selectExpr(*pair, "turn", "meets", *left_open)
            .where(f"coalesce(meets, exists({moved}, p -> {polygons_meet_in('common', 'fp', 'p')}))")
        )
    before = "acquired_at < event_ts"
    return met.selectExpr(
        "event_id",
        f"CASE WHEN {before} THEN 'pre' ELSE 'post' END AS side",
        # Distance in time, the nearer the smaller, on either side.
        f"CASE WHEN {before} THEN event_ts - acquired_at ELSE acquired_at - event_ts END AS gap",
        "scene_id",
        "acquired_at",
        *_BOX,
    )


_SCENE = ("gap", "scene_id", "acquired_at", *_BOX)
_SIDES = ("pre", "post")


def _listed(events: DataFrame, counts: DataFrame) -> DataFrame:
    """All events with their counts (event_id, n, pre_n, post_n and more) and usability; those without scenes too."""
    known = "min_lon IS NOT NULL" if "min_lon" in events.columns else "true"
    more = [c for c in counts.columns if c not in ("event_id", "n", "pre_n", "post_n")]
    return events.selectExpr("event_id", f"{known} AS has_area").join(counts, "event_id", "left").selectExpr(
        "event_id",
        "coalesce(n, 0L) AS n_scenes",
        "coalesce(pre_n, 0L) AS n_pre",
        "coalesce(post_n, 0L) AS n_post",
        f"CASE WHEN NOT has_area THEN 'no_area' WHEN coalesce(n, 0) < {MIN_SCENES} THEN 'too_few_scenes' WHEN pre_n = 0 THEN 'no_pre_scene' "
        "WHEN post_n = 0 THEN 'no_post_scene' ELSE 'ok' END AS status",
        *more,
    )


_COUNTS = ("count(*) AS n", *(f"count_if(side = '{s}') AS {s}_n" for s in _SIDES))


def scene_choice(matched: DataFrame, events: DataFrame) -> DataFrame:
    """Per event: scene counts, usability, and the scene nearest in time on each side (structs ``pre``, ``post``).

    The last scene before the event and the first from it on; ties go to the smaller scene id.  Events without scenes are
    listed too.  Counts and least gaps are sums in memory; only scenes at those gaps are compared by id, so the many others are never
    sorted.
    """
    gaps = (f"min(CASE WHEN side = '{s}' THEN gap END) AS {s}_gap" for s in _SIDES)
    counts = settle(matched.groupBy("event_id").agg(*[F.expr(e) for e in (*_COUNTS, *gaps)]))
    least = counts.select("event_id", *[f"{s}_gap" for s in _SIDES])
    nearest = lookup_join(matched, least, ["event_id"], counts.count()).where("gap = IF(side = 'pre', pre_gap, post_gap)")
    scene = f"struct({', '.join(_SCENE)})"
    picks = nearest.groupBy("event_id").agg(*[F.expr(f"min(CASE WHEN side = '{s}' THEN {scene} END) AS {s}") for s in _SIDES])
    return _listed(events, counts.drop("pre_gap", "post_gap").join(picks, "event_id", "left"))


def scene_coverage(matched: DataFrame, events: DataFrame) -> DataFrame:
    """Scene counts and usability per event."""
    return _listed(events, matched.groupBy("event_id").agg(*[F.expr(e) for e in _COUNTS]))


def nearest_scenes(choice: DataFrame) -> DataFrame:
    """Chosen scenes, one row per event and side."""
    fields = ("scene_id", "acquired_at", *_BOX)
    side = lambda s: f"named_struct('side', '{s}', {', '.join(f'{f!r}, {s}.{f}' for f in fields)})"
    return choice.selectExpr("event_id", f"inline(array({side('pre')}, {side('post')}))").where("scene_id IS NOT NULL")


def require_coverage(coverage: DataFrame) -> None:
    """Raise if any event lacks scenes; names a few of them."""
    bad = coverage.where("status != 'ok'").select("event_id", "status").limit(5).collect()
    if bad:
        raise ValueError("No usable scenes for " + ", ".join(f"event {r.event_id} ({r.status})" for r in bad))
