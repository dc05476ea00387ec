"""Groups that links form, by alternating star steps on a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inundation.llm.shared import keep


def _towards(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: the neighbours of a node are linked to the least node among it and them.

    With ``larger_only`` the larger neighbours move (large star), else the smaller ones and the node itself (small star).
    """
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger_only:
        pairs = pairs.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # A node's least neighbour combines before the shuffle; a node with very many links is split by the join.
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = pairs.join(least, "u")
    if larger_only:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def least_reachable(edges: DataFrame, name: str = "groups") -> DataFrame:
    """``node`` and ``root``, the least node that its links lead to, for all nodes that have a link.

    ``edges`` holds ``a`` and ``b`` with ``b < a``.  Each round is written to the shared folder; it ends when links stay as they are.
    """
    now = keep(edges.distinct(), name)
    while True:
        after = keep(_towards(_towards(now, True), False), name)
        if _mark(after) == _mark(now):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = after


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free hashes of the links."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())
