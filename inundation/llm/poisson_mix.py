"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated k times, where k is drawn from a Poisson distribution with the mean repetition rate of s:
target weight of s times all documents, over the documents of s.  The draw inverts the distribution at a number in [0, 1) hashed
from the seed and the document's id, so it is the same on every run and every cluster, and each document decides for itself:
no source is gathered anywhere.  The copies are then dealt out by a hash and ordered by it, a shuffle of the whole result.

Defined cases: rows without a source form a source of their own; a null id counts as the text "null"; rows that repeat with the
same id are repeated alike.  Empty and null texts are documents like any other.  Other columns are carried along; those named like the
operator's two (which are parameters) are replaced, and names that start with ``_mix_`` are its own.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inundation.llm.shared import keep

SEED = 42
#: Target weights follow the size of a source to this power; 1 keeps the sources as they are, 0 makes them equal.
TEMPERATURE = 0.7
#: Documents in the result over documents in the input.
EPOCHS = 1.0
#: More sources than this are joined by a shuffle instead of a broadcast.
MOST_BROADCAST_SOURCES = 10_000
_DIGITS = 13


def uniform(id_col: Column, seed: int = SEED, salt: str = "") -> Column:
    """A number in [0, 1), a multiple of 2 ** -52, from the seed and the id."""
    key = F.concat(F.lit(f"{seed}:{salt}"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, _DIGITS), 16, 10).cast("double") / F.lit(float(1 << 4 * _DIGITS))


def poisson_steps(rate: float) -> list[float]:
    """P(k <= 0), P(k <= 1), ... as far as they differ from 1; a number u gives as many copies as steps are at most u."""
    steps, k = [], 0
    total, log_rate = 0.0, math.log(rate) if rate > 0 else 0.0
    while rate > 0:
        p = math.exp(k * log_rate - rate - math.lgamma(k + 1))
        # From here on the shares only fall, and the sum can't tell them any more.
        if k > rate and p < 2.0**-64:
            break
        total += p
        steps.append(total)
        k += 1
    return steps


def source_counts(docs: DataFrame, source_col: str = "source") -> DataFrame:
    return docs.groupBy(F.col(source_col).alias("mix_source")).agg(F.count("*").alias("n"))


def tempered_weights(counts: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Target weights by size: ``mix_source``, ``n``, ``weight``."""
    return counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))


def given_weights(counts: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Target weights stated by the caller; a source that isn't named gets 0."""
    pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
    named = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
    return counts.withColumn("weight", F.coalesce(F.try_element_at(named, F.coalesce("mix_source", F.lit(""))), F.lit(0.0)))


def repetition_rates(weighted: DataFrame, epochs: float = EPOCHS) -> DataFrame:
    """``mix_source``, ``rate`` and ``steps``, one row per source; weights that are all 0 give rate 0."""
    steps = F.udf(lambda rate: poisson_steps(rate), T.ArrayType(T.DoubleType()))
    all_n, all_weight = weighted.agg(F.sum("n"), F.sum("weight")).first()
    rate = F.coalesce(F.try_divide(F.lit(epochs * (all_n or 0)) * F.col("weight"), F.lit(all_weight or 0.0) * F.col("n")), F.lit(0.0))
    return weighted.select("mix_source", rate.alias("rate")).withColumn("steps", steps("rate"))


def poisson_mix(
    docs: DataFrame, weighted: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source",
    epochs: float = EPOCHS, seed: int = SEED, copy_col: str = "copy", key_col: str = "mix_key",
) -> DataFrame:
    """The mixed rows, shuffled: ``docs`` with ``copy_col`` (from 1) and ``key_col``, by which partitions are ordered."""
    weighted = keep(tempered_weights(source_counts(docs, source_col)) if weighted is None else weighted, "weights")
    rates = keep(repetition_rates(weighted, epochs), "rates")
    steps = rates.select(F.col("mix_source").alias("_mix_source"), F.col("steps").alias("_mix_steps"))
    steps = F.broadcast(steps) if rates.count() <= MOST_BROADCAST_SOURCES else steps
    docs = docs.drop(copy_col, key_col)
    number = lambda text: F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("long")
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    repeated = (
        docs.join(steps, F.col(source_col).eqNullSafe(F.col("_mix_source")))
        .withColumn("_mix_u", uniform(F.col(id_col), seed))
        .withColumn("_mix_n", F.expr("size(filter(_mix_steps, s -> s <= _mix_u))"))
        .where("_mix_n > 0")
        .withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("_mix_n"))))
        .withColumn(key_col, number(F.concat(F.lit(f"{seed}:shuffle:"), ident, F.lit(":"), F.col(copy_col).cast("string"))))
        .drop("_mix_source", "_mix_steps", "_mix_u", "_mix_n")
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return repeated.repartition(parts, key_col).sortWithinPartitions(key_col)
