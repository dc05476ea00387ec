"""Refinement, area and the report over both methods."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.bands import percent_to_degrees
from ..functions.grid import COLUMNS
from ..operators.area import area_km2
from ..operators.components import drop_small_patches
from ..operators.lookup import BROADCAST_ROWS, lookup_join
from ..operators.regions import clip_tiles
from ..operators.terrain import DEM_STEP_DEG, dem_near, drop_steep, slope_degrees
from ..sources import catalog
from ..sources.control import is_there, is_written, remove, settle, shared_folder
from ..sources.export import EXPORT_NAMES, write_extent
from .optical import optical_branch
from .sar import SMOOTHING_RADIUS_M, Branch, sar_branch
from .scope import Scope, make_scope, place_batches

# Fixed values.
MIN_CONNECTED_PIXELS = 8
MAX_SLOPE_DEG = 5.0

METHODS = ("sar", "s2", "both")

#: Groups of events that run at once.
GROUPS_AT_A_TIME = 4
REPORT_COLUMNS = (
    "method string, status string, area_km2 double, threshold_pre double, threshold_post double, threshold_defaulted boolean, pre_px bigint, post_px bigint"
)


def refine_extent(
    flood: DataFrame,
    dem: DataFrame,
    scope: Scope | None = None,
    by=("event_id",),
    min_connected: int = MIN_CONNECTED_PIXELS,
    max_slope_deg: float = MAX_SLOPE_DEG,
    dem_step: float = DEM_STEP_DEG,
    max_slope_percent: float | None = None,
) -> DataFrame:
    """Drop small patches, then steep pixels; patches are judged before the slope.  ``flood`` holds the flooded pixels.

    The limit of the slope is an angle; ``max_slope_percent`` gives it as rise over run instead.  With a scope, slopes are computed only around its areas.
    """
    if max_slope_percent is not None:
        max_slope_deg = percent_to_degrees(max_slope_percent)
    patches = drop_small_patches(flood, by, min_connected, None if scope is None else scope.aoi.cells, COLUMNS)
    near = dem if scope is None else dem_near(dem, scope.aoi.cover(), dem_step=dem_step, envelope=scope.aoi.envelope)
    return drop_steep(patches, slope_degrees(near, dem_step), max_slope_deg, dem_step)


def flooded(branch: Branch) -> DataFrame:
    return branch.detected.where("flood = 1").select("event_id", "x", "y")


def branch_runs(
    scenes_s1: DataFrame | None,
    pixels_s1: DataFrame | None,
    scenes_s2: DataFrame | None,
    pixels_s2: DataFrame | None,
    dem: DataFrame,
    scope: Scope,
    method: str = "both",
    sar_days: int = catalog.SAR_DAYS,
    optical_days: int = catalog.OPTICAL_DAYS,
    band: str = "VH",
    radius_m: float = SMOOTHING_RADIUS_M,
    min_connected: int = MIN_CONNECTED_PIXELS,
    max_slope_deg: float = MAX_SLOPE_DEG,
    dem_step: float = DEM_STEP_DEG,
    max_slope_percent: float | None = None,
) -> dict[str, Callable[[], tuple[Branch, DataFrame]]]:
    """What gives the branch and the refined extent of each requested method."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    run = {
        "sar": lambda: sar_branch(scenes_s1, pixels_s1, scope, sar_days, band=band, radius_m=radius_m),
        "s2": lambda: optical_branch(scenes_s2, pixels_s2, scope, optical_days),
    }

    def refined(name):
        b = run[name]()
        return b, refine_extent(flooded(b), dem, scope, ("event_id",), min_connected, max_slope_deg, dem_step, max_slope_percent)

    return {name: partial(refined, name) for name in (["sar", "s2"] if method == "both" else [method])}


def side_by_side_runs(spark, runs: Mapping[str, Callable]) -> dict[str, object]:
    """Each run's result, or the exception it ended with.

    The branches share nothing but the scope: their jobs may overlap, and one that fails doesn't take the other along.
    """
    with ThreadPoolExecutor(len(runs)) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run)) for name, run in runs.items()}
        return {name: task.exception() or task.result() for name, task in started.items()}


def branch_report(name: str, branch: Branch, refined: DataFrame, n_events: int) -> DataFrame:
    """One row per event; the area is NULL (not available) where the branch could not run, 0 where it found no flood."""
    # A fresh event_id: were it the very attribute the pixels carry, Spark would rename that inside the joined pixel plans, and
    # those would no longer match what is persisted.
    out = branch.coverage.selectExpr("event_id AS event_id", "status")
    out = lookup_join(out, area_km2(refined), ["event_id"], n_events, "left")
    out = lookup_join(out, branch.counts.select("event_id", "pre_px", "post_px"), ["event_id"], n_events, "left")
    if branch.thresholds is None:
        nothing = [f"CAST(NULL AS DOUBLE) AS threshold_{s}" for s in ("pre", "post")]
        out = out.selectExpr("*", *nothing, "CAST(NULL AS BOOLEAN) AS threshold_defaulted")
    else:
        t = branch.thresholds.select("event_id", "threshold_pre", "threshold_post", "threshold_defaulted")
        out = lookup_join(out, t, ["event_id"], n_events, "left")
    available = lambda v: f"CASE WHEN status = 'ok' THEN coalesce({v}, 0) END AS {v}"
    return out.selectExpr(
        "event_id",
        f"'{name}' AS method",
        "status",
        available("area_km2"),
        "threshold_pre",
        "threshold_post",
        "threshold_defaulted",
        available("pre_px"),
        available("post_px"),
    )


def failed_report(name: str, error: BaseException, events: DataFrame) -> DataFrame:
    """Rows of a branch that could not be run to its end: all figures are NULL and the status says why."""
    why = f"failed: {type(error).__name__}: {str(error).strip().splitlines()[0][:200] if str(error).strip() else ''}"
    null = lambda kind, c: F.lit(None).cast(kind).alias(c)
    return events.select(
        "event_id", F.lit(name).alias("method"), F.lit(why).alias("status"), null("double", "area_km2"), null("double", "threshold_pre"),
        null("double", "threshold_post"), null("boolean", "threshold_defaulted"), null("bigint", "pre_px"), null("bigint", "post_px"),
    )


def _run_group(group, aois, dem, inputs, otsu_aois, method, options, folder: str, write: Callable, failed: str | None = None) -> list[BaseException]:
    """Writes what a group's methods give and isn't there yet; the errors of those that failed, if all of its methods did.

    ``write`` takes method, branch, refined extent, scope and path.  What a method writes is committed as a whole, so what is in the folder is
    finished.  Rows that say why a method failed go to a folder of their own, and a later run tries again.
    """
    name, events = group
    spark = events.sparkSession
    methods = ["sar", "s2"] if method == "both" else [method]
    todo = [m for m in methods if not is_written(spark, f"{folder}/grp=g{name}/kind={m}")]
    if not todo:
        return []
    ids = events.selectExpr("event_id AS aoi_id")
    own = aois.join(ids, "aoi_id", "left_semi")
    own_otsu = own if otsu_aois is aois else otsu_aois and otsu_aois.join(ids, "aoi_id", "left_semi")
    scope = make_scope(events, own, own_otsu)

    def written(m, run):
        branch = None
        try:
            branch, refined = run()
            # Once this is written, the pixels behind it can go.
            write(m, branch, refined, scope, f"{folder}/grp=g{name}/kind={m}")
        finally:
            if branch is not None:
                branch.release()

    runs = branch_runs(*inputs, dem, scope, method, **options)
    done = side_by_side_runs(spark, {m: partial(written, m, runs[m]) for m in todo})
    errors = {m: e for m, e in done.items() if isinstance(e, BaseException)}
    if len(errors) == len(methods):
        return list(errors.values())
    for m, e in errors.items() if failed else ():
        failed_report(m, e, scope.events).coalesce(1).write.parquet(f"{failed}/grp=g{name}/kind={m}")
    return []


def _run_groups(events, aois, batch_rows: int, at_a_time: int, run: Callable) -> list[tuple[str, DataFrame]]:
    """All groups of the events, some at a time; an error is raised once all have had their turn."""
    groups = place_batches(events, aois, batch_rows)
    with ThreadPoolExecutor(max(1, min(at_a_time, len(groups)))) as pool:
        errors = [e for found in pool.map(inheritable_thread_target(events.sparkSession)(run), groups) for e in found]
    if errors:
        raise errors[0]
    return groups


def _how(options: Mapping, otsu_aois, aois) -> str:
    """What results depend on beside the group of events."""
    return hashlib.sha256(repr((sorted(options.items()), otsu_aois is None, otsu_aois is aois)).encode()).hexdigest()[:16]


def flood_exports(
    events: DataFrame,
    aois: DataFrame,
    dem: DataFrame,
    path_prefix: str,
    run_timestamp: str,
    scenes_s1: DataFrame | None = None,
    pixels_s1: DataFrame | None = None,
    scenes_s2: DataFrame | None = None,
    pixels_s2: DataFrame | None = None,
    otsu_aois: DataFrame | None = None,
    method: str = "both",
    batch_rows: int = BROADCAST_ROWS // 2,
    at_a_time: int = GROUPS_AT_A_TIME,
    **options,
) -> DataFrame:
    """From events to the exported extents of all of them and of both methods, in one call; returns what was written.

    Rows are x, y and flood, stored by ``name``, event and export tile under ``<path_prefix>extents``; a name is made of the method's, the event's
    own date and ``run_timestamp``.  Events run in groups as in :func:`flood_report`, and a call with the same events, options, prefix and
    timestamp writes only what is missing.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    spark, inputs = events.sparkSession, (scenes_s1, pixels_s1, scenes_s2, pixels_s2)
    folder = f"{path_prefix}extents/{run_timestamp}-{_how(options, otsu_aois, aois)}"

    def write(m, branch, refined, scope, path):
        inside = clip_tiles(refined.select("event_id", "x", "y"), scope.aoi.shapes, "event_id", scope.aoi.shape_rows)
        named = scope.events.selectExpr("event_id", f"concat('{EXPORT_NAMES[m]}_', date_format(event_ts, 'yyyyMMdd'), '_{run_timestamp}') AS name")
        write_extent(lookup_join(inside, named, ["event_id"], scope.n_events, salt=["x", "y"]).withColumn("flood", F.lit(1)), path)

    groups = _run_groups(events, aois, batch_rows, at_a_time, lambda g: _run_group(g, aois, dem, inputs, otsu_aois, method, options, folder, write))
    schema = StructType([StructField("x", LongType()), StructField("y", LongType()), StructField("flood", IntegerType())])
    for c, kind in (("grp", "string"), ("kind", "string"), ("name", "string"), ("event_id", events.schema["event_id"].dataType), ("tile_x", "long"), ("tile_y", "long")):
        schema = schema.add(c, kind)
    mine = spark.createDataFrame([(f"g{name}",) for name, _ in groups], "grp string")
    found = spark.read.schema(schema).parquet(folder) if is_there(spark, folder) else spark.createDataFrame([], schema)
    kinds = ["sar", "s2"] if method == "both" else [method]
    return found.where(F.col("kind").isin(kinds)).join(F.broadcast(mine), "grp", "left_semi").select("name", "event_id", "tile_x", "tile_y", "x", "y", "flood")


def flood_report(
    events: DataFrame,
    aois: DataFrame,
    dem: DataFrame,
    scenes_s1: DataFrame | None = None,
    pixels_s1: DataFrame | None = None,
    scenes_s2: DataFrame | None = None,
    pixels_s2: DataFrame | None = None,
    otsu_aois: DataFrame | None = None,
    method: str = "both",
    batch_rows: int = BROADCAST_ROWS // 2,
    results: str | None = None,
    at_a_time: int = GROUPS_AT_A_TIME,
    **options,
) -> DataFrame:
    """Flooded area of every event by radar, by optical water index, or by both, side by side.

    ``events``: event_id, event_ts; ``aois``: the area of each event under its id.  Every event gets a row per method.  A method
    that lacks scenes or an area for an event, or that fails, reports why and does not touch the other; only if all fail is the
    error raised.  Events run in groups that lie together, each with areas of at most about ``batch_rows`` tiles, so what a
    run keeps and sends to every task doesn't grow with the number of events, and ``at_a_time`` groups at once.  ``options`` are those of
    :func:`branch_runs`.

    ``results`` names a folder that keeps each group's rows as they are finished.  A run that is given it again, with the same events, areas and
    options, does only what is missing; it belongs to one set of scenes, pixels and elevation.  An error is raised after all groups have had
    their turn.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    inputs = (scenes_s1, pixels_s1, scenes_s2, pixels_s2)
    spark = events.sparkSession
    base = f"{results.rstrip('/')}" if results else f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    folder, failed = f"{base}/rows-{_how(options, otsu_aois, aois)}", f"{base}/failed-{uuid.uuid4().hex}"

    def write(m, branch, refined, scope, path):
        branch_report(m, branch, refined, scope.n_events).coalesce(1).write.mode("overwrite").parquet(path)

    run = lambda g: _run_group(g, aois, dem, inputs, otsu_aois, method, options, folder, write, failed)
    groups = _run_groups(events, aois, batch_rows, at_a_time, run)
    schema = StructType([events.schema["event_id"], *StructType.fromDDL(REPORT_COLUMNS).fields])
    # One table, however many groups; rows of other events or methods that the folder holds are not part of this report.
    schema = schema.add("grp", "string").add("kind", "string")
    rows = spark.createDataFrame([], schema)
    for part in (p for p in (folder, failed) if is_there(spark, p)):
        rows = rows.unionByName(spark.read.schema(schema).parquet(part))
    mine = spark.createDataFrame([(f"g{name}",) for name, _ in groups], "grp string")
    report = rows.where(F.col("kind").isin(["sar", "s2"] if method == "both" else [method])).join(F.broadcast(mine), "grp", "left_semi").drop("grp", "kind")
    if results:
        return report
    report = settle(report)
    remove(spark, base)
    return report
