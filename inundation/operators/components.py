"""Connected pixels: the size of each patch, and the minimum-patch filter."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import block_of
from ..sources.control import settle
from .blocks import map_blocks
from .lookup import lookup_join

BLOCK = 256

#: A cell as one number, and the steps to the four neighbours that follow it in reading order.
_CELL = "shiftleft(CAST({y} AS BIGINT), 32) + CAST({x} AS BIGINT)"
_FORWARD = ((1, 0), (-1, 1), (0, 1), (1, 1))


def _roots(x: np.ndarray, y: np.ndarray, side: int) -> np.ndarray:
    """For each cell the first cell of its 8-connected component within one block."""
    at = np.full((side + 2, side + 2), -1, dtype=np.int64)
    at[y + 1, x + 1] = np.arange(len(x))
    # Each adjacent pair once: east, south-west, south, south-east.
    pairs = []
    for dx, dy in ((1, 0), (-1, 1), (0, 1), (1, 1)):
        other = at[y + 1 + dy, x + 1 + dx]
        here = np.nonzero(other >= 0)[0]
        pairs.append((here, other[here]))
    a = np.concatenate([p[0] for p in pairs])
    b = np.concatenate([p[1] for p in pairs])
    parent = np.arange(len(x))
    while len(a):
        # Hook the larger root under the smaller, then flatten; the live edges at least halve in roots each round.
        ra, rb = parent[a], parent[b]
        live = ra != rb
        if not live.any():
            break
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def least_linked(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``label`` and ``root``, the least label that ``edges`` (a, b) lead to, per keys; only labels with an edge are listed.

    Star steps by turns: the larger neighbours of a label, then the smaller ones, are linked to the least of them.  Each round is a
    few joins of the links that are left, kept in the shared folder; long patches need a number of rounds that grows with the
    logarithm of their blocks.
    """
    keys = list(keys)

    def star(links: DataFrame, larger: bool) -> DataFrame:
        pairs = links.selectExpr(*keys, "greatest(a, b) AS u", "least(a, b) AS v")
        if larger:
            pairs = pairs.unionByName(links.selectExpr(*keys, "least(a, b) AS u", "greatest(a, b) AS v"))
        least = pairs.groupBy(*keys, "u").agg(F.expr("least(u, min(v)) AS m"))
        moved = pairs.join(least, [*keys, "u"]).where("v > u" if larger else "true").selectExpr(*keys, "v AS a", "m AS b")
        if not larger:
            moved = moved.unionByName(least.selectExpr(*keys, "u AS a", "m AS b"))
        return moved.where("a <> b").distinct()

    def mark(links: DataFrame) -> tuple:
        row = f"xxhash64({', '.join([*keys, 'a', 'b'])})"
        return tuple(links.agg(F.expr("count(*)"), F.expr(f"bit_xor({row})"), F.expr(f"sum(pmod({row}, 1000003))")).first())

    now = settle(edges.distinct())
    before = None
    while (after := mark(now)) != before:
        before = after
        now = settle(star(star(now, True), False))
    return now.selectExpr(*keys, "greatest(a, b) AS label", "least(a, b) AS root")


def _local_patches(at: np.ndarray, block: int, at_end: np.ndarray | bool = False) -> pd.DataFrame:
    """Each cell's patch within its block: the first cell, the size, and whether it reaches the block's border or an end of the grid."""
    x, y = at % block, at // block
    root = _roots(x, y, block)
    edge = at_end | (x == 0) | (x == block - 1) | (y == 0) | (y == block - 1)
    reaches = np.bincount(root, weights=edge, minlength=len(at)) > 0
    size = np.bincount(root, minlength=len(at))
    return pd.DataFrame({"at": at, "first": at[root], "n": size[root].astype(np.int32), "open": reaches[root].astype(np.int32)})


def connected_pixel_count(
    images: DataFrame, by: Sequence[str] = ("event_id",), value: str | None = None, block: int = BLOCK, cells: int | None = None,
    columns: int | None = None,
) -> DataFrame:
    """Size of each pixel's 8-connected patch, itself included, however large.

    ``images`` holds the valid pixels, each cell once per ``by``; with ``value`` only equal-valued neighbours connect.  Adds
    ``component_size``.  ``cells`` estimates the cells of all images, ``columns`` joins the ends of the grid; see :func:`map_blocks`.

    Pixels are labelled block by block, and a patch that doesn't reach its block's border is done.  Only cells on a border are matched
    to their neighbours in other blocks, what is merged are labels, a few per block, and only pixels of merged labels look up
    their size, which is sent to them as long as the labels are few.
    """
    keys = [*by, *([value] if value else [])]
    pixels = images.select(*keys, "x", "y")
    if value:
        pixels = pixels.where(f"`{value}` IS NOT NULL")

    def label(frame):
        return _local_patches(frame["at"].to_numpy(), block, frame["at_end"].to_numpy() == 1 if columns else False)

    named = [f"`{k}` AS k{i}" for i, k in enumerate(keys)]
    short = [f"k{i}" for i in range(len(keys))]
    # The last column may lie anywhere in its block.
    at_end = f"x = {columns - 1}" if columns else "false"
    marked = pixels.selectExpr("*", f"CAST({at_end} AS TINYINT) AS at_end") if columns else pixels
    labelled = map_blocks(marked, keys, ["at_end"] if columns else [], 0, block, label, ["first", "n", "open"], "int", cells).selectExpr(
        *named, "x", "y", f"{block_of('x', block)} AS bx", f"{block_of('y', block)} AS by", "first", "n", "open"
    )
    label_of = _CELL.format(x=f"(bx * {block} + first % {block})", y=f"(by * {block} + floor(first / {block}))")
    found = settle(labelled.selectExpr(*short, "x", "y", f"IF(open = 1, {label_of}, NULL) AS label", "n"))
    # A patch that reaches a border has cells on it.
    inner = f"pmod(x, {block}) BETWEEN 1 AND {block - 2} AND pmod(y, {block}) BETWEEN 1 AND {block - 2}"
    border = found.where(f"label IS NOT NULL AND (NOT ({inner}) OR {at_end})")
    steps = ", ".join(f"named_struct('nx', x + {dx}, 'ny', y + {dy})" for dx, dy in _FORWARD)
    other_block = f"{block_of('nx', block)} <> {block_of('x', block)} OR {block_of('ny', block)} <> {block_of('y', block)}"
    reach = border.selectExpr(*short, "x", "y", "label AS a", f"inline(array({steps}))")
    reach = (reach.withColumn("nx", F.expr(f"pmod(nx, {columns})")) if columns else reach).where(other_block)
    met = reach.drop("x", "y").join(border.selectExpr(*short, "x AS nx", "y AS ny", "label AS b"), [*short, "nx", "ny"])
    merged = least_linked(met.selectExpr(*short, "greatest(a, b) AS a", "least(a, b) AS b"), short)
    # A label has a block's border at most, so this join has no hot key; a patch of any size adds up map-side.
    sizes = border.groupBy(*short, "label").agg(F.expr("max(n) AS n"))
    rooted = sizes.join(merged, [*short, "label"], "left").selectExpr(*short, "label", "n", "coalesce(root, label) AS root")
    patches = rooted.groupBy(*short, "root").agg(F.expr("sum(n) AS component_size"))
    by_label = settle(rooted.select(*short, "label", "root").join(patches, [*short, "root"]).drop("root"))
    out = [*[f"k{i} AS `{k}`" for i, k in enumerate(keys)], "x", "y"]
    closed = found.where("label IS NULL").selectExpr(*out, "CAST(n AS BIGINT) AS component_size")
    opened = lookup_join(found.where("label IS NOT NULL").drop("n"), by_label, [*short, "label"], by_label.count(), salt=["x", "y"])
    return closed.unionByName(opened.selectExpr(*out, "component_size"))


def _counted_up_to(images: DataFrame, by: Sequence[str], enough: int, cells: int | None = None, columns: int | None = None) -> DataFrame:
    """``component_size`` as far as ``enough``, which a look ``enough - 1`` cells beyond each block decides.

    A patch that leaves this window has a path from the pixel to the outside, which already counts ``enough`` cells inside; one
    that doesn't leave is seen whole.  So each block is exact on its own, in one shuffle.
    """
    halo = enough - 1
    side = BLOCK + 2 * halo

    def label(frame):
        at = frame["at"].to_numpy()
        x, y = at % side, at // side
        core = (x >= halo) & (x < halo + BLOCK) & (y >= halo) & (y < halo + BLOCK)
        root = _roots(x, y, side)
        sizes = np.minimum(np.bincount(root, minlength=len(x))[root], enough).astype(np.int32)
        return pd.DataFrame({"at": at[core], "component_size": sizes[core]})

    return map_blocks(images.select(*by, "x", "y"), by, [], halo, BLOCK, label, ["component_size"], "int", cells, columns)


def drop_small_patches(
    extent: DataFrame, by: Sequence[str] = ("event_id",), min_connected: int = 8, cells: int | None = None, columns: int | None = None
) -> DataFrame:
    """Keep pixels of patches with at least ``min_connected`` cells; returns the ``by`` columns, x and y.  ``cells`` and ``columns`` as above.

    The question needs no sizes beyond the minimum, so blocks look that far over their border; a minimum beyond a quarter of
    a block is answered by the sizes themselves.
    """
    if min_connected <= 1:
        return extent.select(*by, "x", "y")
    sized = (
        _counted_up_to(extent, by, min_connected, cells, columns)
        if min_connected <= BLOCK // 4
        else connected_pixel_count(extent, by, cells=cells, columns=columns)
    )
    return sized.where(f"component_size >= {int(min_connected)}").select(*by, "x", "y")
