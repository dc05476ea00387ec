"""Band histograms and Otsu thresholds, for any number of images at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import DEFAULT_OTSU_THRESHOLD
from ..functions.grid import num
from .lookup import lookup_join

# Fixed values.
MAX_BUCKETS = 256
VARIANCE_EPSILON = 1e-10

#: Buckets that a task holds before it adds them up again.
HELD_BUCKETS = 1 << 16
_PARTIAL = ["w", "b", "n", "total", "lo", "hi"]


def _widths(lo: np.ndarray, hi: np.ndarray, max_buckets: int) -> np.ndarray:
    """The smallest powers of two by which the ranges fit; 0 where a range is a single value or has no end."""
    spread = hi - lo
    some = (spread > 0) & np.isfinite(spread)
    width = np.exp2(np.ceil(np.log2(np.where(some, spread, 1.0) / max_buckets)))
    crowded = np.floor(hi / width) - np.floor(lo / width) + 1 > max_buckets
    return np.where(some, np.where(crowded, width * 2, width), 0.0)


def _coarsen(keys: list[pa.Array], columns: list[np.ndarray], max_buckets: int) -> pa.Table:
    """Adds up rows of ``n, total, lo, hi`` by image and bucket, with the image's width in these rows.

    A part of an image has at most the range of the whole, so its width, a power of two, is at most that of the whole: its buckets
    lie within the final ones, and rows added up here can be added up again.
    """
    n, total, lo, hi = columns
    code = np.zeros(len(n), np.int64)
    for k in keys:
        d = k.dictionary_encode("encode")
        _, code = np.unique(code * len(d.dictionary) + d.indices.to_numpy(), return_inverse=True)
    images = int(code.max()) + 1
    least, most = np.full(images, np.inf), np.full(images, -np.inf)
    np.minimum.at(least, code, lo)
    np.maximum.at(most, code, hi)
    width = _widths(least, most, max_buckets)[code]
    bucket = np.where(width > 0, np.floor(lo / np.where(width > 0, width, 1.0)), lo)
    order = np.lexsort((bucket, code))
    code, bucket = code[order], bucket[order]
    first = np.flatnonzero(np.append(True, (np.diff(code) != 0) | (bucket[1:] != bucket[:-1])))
    add = [f.reduceat(c[order], first) for f, c in zip((np.add, np.add, np.minimum, np.maximum), (n, total, lo, hi))]
    at = pa.array(order[first])
    return pa.table([*[k.take(at) for k in keys], width[order][first], bucket[first], *add], [*[f"k{i}" for i in range(len(keys))], *_PARTIAL])


def _partial_buckets(n_keys: int, max_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            t = pa.concat_tables(held).combine_chunks()
            arrays = [c.chunk(0) for c in t.columns]
            return _coarsen(arrays[:n_keys], [a.to_numpy() for a in arrays[n_keys + 2 :]], max_buckets)

        for b in batches:
            if not len(b):
                continue
            v = b.column(n_keys).to_numpy()
            held.append(_coarsen([b.column(i) for i in range(n_keys)], [np.ones(len(v), np.int64), v, v, v], max_buckets))
            if sum(map(len, held)) > HELD_BUCKETS:
                held = [merged()]
                # Many images at once: their buckets go on, and meet again in the shuffle.
                if len(held[0]) > HELD_BUCKETS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from merged().to_batches()

    return run


def band_histogram(images: DataFrame, band: str, by: Sequence[str], max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """At most ``max_buckets`` buckets per image: ``bucket, width, n, total, mean``; empty buckets are left out.

    The width is the smallest power of two that fits, so bucket borders are exact.  One pass over the pixels: each task adds its own
    up in buckets of powers of two, which fit into those of the whole image, so an image holding most of the pixels sends only
    some hundred rows a task through the shuffle.  What an image then has is a bucket per width that some task had.
    """
    by = list(by)
    names = [f"k{i}" for i in range(len(by))]
    values = images.selectExpr(*by, f"CAST(`{band}` AS DOUBLE) AS v").where("v IS NOT NULL AND NOT isnan(v)")
    types = dict(values.dtypes)
    schema = ", ".join([*[f"{n} {types[k]}" for n, k in zip(names, by)], "w double, b double, n bigint, total double, lo double, hi double"])
    # Twice the buckets, so that rounding of a logarithm can't make a part's buckets wider than the final ones.
    parts = values.mapInArrow(_partial_buckets(len(by), 2 * max_buckets), schema).groupBy(*names, "w", "b")
    parts = parts.agg(F.expr("sum(n) AS n"), F.expr("sum(total) AS total"), F.expr("min(lo) AS lo"), F.expr("max(hi) AS hi"))
    image = f"OVER (PARTITION BY {', '.join(names)})"
    fit = f"pow(2.0D, ceil(log2((image_hi - image_lo) / {max_buckets}) - 1e-9D))"
    return (
        parts.selectExpr("*", f"min(lo) {image} AS image_lo", f"max(hi) {image} AS image_hi")
        .selectExpr("*", f"CASE WHEN image_hi > image_lo THEN {fit} ELSE 1.0D END AS fitting")
        # The range may straddle one border more than it fills.
        .selectExpr(
            *[f"{n} AS `{k}`" for n, k in zip(names, by)], "n", "total", "lo", "hi",
            f"CASE WHEN floor(image_hi / fitting) - floor(image_lo / fitting) + 1 > {max_buckets} THEN fitting * 2 ELSE fitting END AS width",
        )
        .selectExpr("*", "floor(lo / width) AS bucket")
        .groupBy(*by, "width", "bucket")
        .agg(
            F.expr("sum(n) AS n"),
            F.expr("sum(total) AS total"),
            # A mean lies between the extremes; rounding must not push it past them, or a constant bucket would test as water.
            F.expr("least(greatest(sum(total) / sum(n), min(lo)), max(hi)) AS mean"),
        )
    )


def otsu_curve(histogram: DataFrame, by: Sequence[str]) -> DataFrame:
    """Between-class variance at each bucket and the bucket chosen: the first with the largest variance."""
    group = f"PARTITION BY {', '.join(by)}"
    upto = f"OVER ({group} ORDER BY bucket ROWS UNBOUNDED PRECEDING)"
    return (
        histogram.selectExpr(
            "*",
            f"sum(n) {upto} / sum(n) OVER ({group}) AS omega",
            f"sum(total) {upto} / sum(n) OVER ({group}) AS mu",
            f"sum(total) OVER ({group}) / sum(n) OVER ({group}) AS mu_all",
        )
        .selectExpr("*", f"pow(mu_all * omega - mu, 2) / (omega * (1 - omega) + {num(VARIANCE_EPSILON)}) AS s")
        .selectExpr(
            *by, "bucket", "width", "n", "mean", "CASE WHEN isnan(s) OR s = double('inf') THEN 0.0D ELSE s END AS sigma_b2"
        )
        .selectExpr("*", f"row_number() OVER ({group} ORDER BY sigma_b2 DESC, bucket) = 1 AS is_threshold")
    )


def otsu_threshold(
    images: DataFrame,
    band: str,
    by: Sequence[str],
    wanted: DataFrame | None = None,
    max_buckets: int = MAX_BUCKETS,
    n_images: int | None = None,
    default: float = DEFAULT_OTSU_THRESHOLD,
) -> DataFrame:
    """One threshold per image.

    ``wanted`` lists the images that must be answered; those without any valid pixel get the default and are flagged.
    """
    by = list(by)
    curve = otsu_curve(band_histogram(images, band, by, max_buckets), by)
    found = curve.where("is_threshold").selectExpr(*by, "mean AS threshold")
    if wanted is None:
        return found.selectExpr("*", "false AS threshold_defaulted")
    return lookup_join(wanted.select(*by), found, by, n_images, "left").selectExpr(
        *by, f"coalesce(threshold, {num(default)}) AS threshold", "threshold IS NULL AS threshold_defaulted"
    )
