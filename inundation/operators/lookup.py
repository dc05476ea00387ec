"""Joining a large frame with a small one whose size is known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast.  At well under 100 bytes a row this stays below 200 MB.
BROADCAST_ROWS = 2_000_000
SALTS = 64


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    rows: int | None,
    how: str = "inner",
    salt: Sequence[str] = (),
) -> DataFrame:
    """Join ``small`` to ``big`` on ``on``.

    ``rows`` is an upper bound for the rows of ``small``.  Up to ``BROADCAST_ROWS`` it is broadcast.  Beyond, or with no bound
    known, the join shuffles; with ``salt`` columns a key holding much of ``big`` is spread over ``SALTS`` partitions, and
    ``small`` is repeated for each.  ``how`` is inner, left or left_semi.
    """
    on = list(on)
    if rows is not None and rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on, how)
    if not salt:
        return big.join(small, on, how)
    salted = big.withColumn("_salt", F.expr(f"CAST(pmod(xxhash64({', '.join(salt)}), {SALTS}) AS INT)"))
    repeated = small.withColumn("_salt", F.expr(f"explode(sequence(0, {SALTS - 1}))"))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
