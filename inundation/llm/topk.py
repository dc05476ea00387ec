"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are dealt into ranges of ids.  A range is a run of blocks; a block has the largest and the smallest value of every
dimension, whose products with a query, summed, bound the score of any vector in it, and a forward index, the vectors' values.
For each query, blocks come in the order of their bounds and are scored whole until a bound falls below the kth best score so far.

Two passes share that score: first each query searches the range it lies in, then all ranges with the kth best score of the
first pass as its start, so that most blocks elsewhere fall at once.  Ranges and groups of queries are rows of packed arrays; a
range meets every group, in blocks, and only k rows per query and range leave a task, so nothing grows with the number of pairs.

Scores are sums of whole numbers below 2 ** 53 and so exact in any order.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no part, nor do rows without an id.  Short
vectors are filled with zeros.  A row that repeats with the same id and values counts once; rows with the same id and other values
are candidates of their own for other queries, and queries of their own, of which the results are merged; each is a row of its
own among the k, also at equal scores.  Columns besides the id
and the vector are ignored.  An empty table gives no rows; fewer than k candidates give all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inundation.llm.shared import keep

K = 5
#: Rows of a block, of a range of blocks and of a group of queries.  A range of 64 dimensions is 4 MB.
BLOCK_ROWS = 64
RANGE_ROWS = 8192
GROUP_ROWS = 1024
_PACKED = "seq long, ids binary, values binary, width int"


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of each component, as doubles; rows that take no part are left out."""
    v = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    valid = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()
    picked = rows.where(valid).where(finite).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return picked.dropDuplicates(["id", "v"])


def _pack(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts a partition's rows into packed rows of up to ``rows`` vectors; ``seq`` counts them, partitions apart."""
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        seq, apart = TaskContext.get().partitionId(), 1 << 32

        def out() -> pa.RecordBatch:
            width = max(len(v) for v in vectors)
            values = np.zeros((len(vectors), width))
            for i, v in enumerate(vectors):
                values[i, : len(v)] = v
            return pa.RecordBatch.from_pydict(
                {"seq": [seq], "ids": [np.array(ids, np.int64).tobytes()], "values": [values.tobytes()], "width": [width]},
                schema=pa.schema({"seq": pa.int64(), "ids": pa.binary(), "values": pa.binary(), "width": pa.int32()}),
            )

        for b in batches:
            for i, v in zip(b.column("id").to_pylist(), b.column("v"), strict=True):
                ids.append(i)
                vectors.append(v.values.to_numpy(zero_copy_only=False))
                if len(ids) == rows:
                    yield out()
                    ids, vectors, seq = [], [], seq + apart
        if ids:
            yield out()

    return run


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Packed rows of up to ``rows`` vectors of the partitions as they are."""
    return vectors.select("id", "v").mapInArrow(_pack(rows), _PACKED)


def numbered(packs: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Packed rows with ``number`` below the returned count; not every number need be there."""
    kept = keep(packs, name)
    parts, each = kept.agg(F.max(F.col("seq") % (1 << 32)), F.max(F.floor(F.col("seq") / (1 << 32)))).first()
    if parts is None:
        return kept.withColumn("number", F.lit(0).cast("long")), 0
    number = (F.col("seq") % (1 << 32)) * (each + 1) + F.floor(F.col("seq") / (1 << 32))
    return kept.withColumn("number", number.cast("long")).drop("seq"), (parts + 1) * (each + 1)


def _arrays(ids: bytes, values: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(values, np.float64).reshape(len(i), width)


def _fit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    fill = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x
    return fill(a), fill(b)


def search_range(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, block: int = BLOCK_ROWS):
    """The best k of a range for each query, as (query, score, id), and the number of blocks scored.

    ``floor`` is a score that the kth best of the query is known to reach; ties with it stay.
    """
    q, v = _fit(q, v)
    starts = np.arange(0, len(v), block)
    top, low = np.maximum.reduceat(v, starts, axis=0), np.minimum.reduceat(v, starts, axis=0)
    bounds = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    out, scored = [], 0
    for i in range(len(q)):
        best_s, best_i, least = np.zeros(0), np.zeros(0, np.int64), floor[i]
        for b in order[i]:
            if bounds[i, b] < least:
                break
            part = slice(starts[b], starts[b] + block)
            s, who = v[part] @ q[i], ids[part]
            scored += 1
            fits = (s >= least) & (who != q_ids[i])
            if fits.any():
                best_s, best_i = np.concatenate([best_s, s[fits]]), np.concatenate([best_i, who[fits]])
                first = np.lexsort((best_i, -best_s))[:k]
                best_s, best_i = best_s[first], best_i[first]
                if len(best_s) == k:
                    least = max(least, best_s[-1])
        out += [(int(q_ids[i]), float(s), int(w)) for s, w in zip(best_s, best_i, strict=True)]
    return out, scored


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range comes first, then the groups of queries that are to search it; only the range is held."""
        number, ids, v = None, None, None
        for b in batches:
            for i in range(len(b)):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                mine = _arrays(row["ids"], row["values"], row["width"])
                if not row["is_group"]:
                    number, (ids, v) = row["number"], mine
                elif row["number"] == number:
                    floor = np.frombuffer(row["floors"], np.float64) if row["floors"] else np.full(len(mine[0]), -np.inf)
                    found, _ = search_range(*mine, floor, ids, v, k)
                    cols = list(zip(*found, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64())],
                        names=["query_id", "score", "vec_id"],
                    )

    return run


def _found(ranges: DataFrame, groups: DataFrame, n_ranges: int, k: int) -> DataFrame:
    """Searches range ``number`` for the groups that carry the same number; each is shipped to its task once."""
    names = ["number", "is_group", "ids", "values", "width", "floors"]
    held = ranges.withColumns({"is_group": F.lit(False), "floors": F.lit(None).cast("binary")}).select(*names)
    rows = held.unionByName(groups.withColumn("is_group", F.lit(True)).select(*names))
    # A task for each range: few bytes are much work here, and Spark would put them together by the bytes, or several by a hash.
    dealt = rows.repartitionById(max(1, n_ranges), F.col("number").cast("int")).sortWithinPartitions("number", "is_group")
    return dealt.mapInArrow(_search(k), "query_id long, score double, vec_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """A query has k rows per range; the window ranks them by query, without an order across queries."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _with_floors(groups: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Adds ``floors``, the kth best score of each query of a group so far, or minus infinity."""
    kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    each = groups.select("group", F.posexplode("q_list").alias("at", "query_id")).join(kth, "query_id", "left")
    one = F.struct("at", F.coalesce("kth", F.lit(float("-inf"))).alias("s"))
    listed = each.groupBy("group").agg(F.array_sort(F.collect_list(one)).alias("f"))  # a group has so many queries at most

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            floors = [np.array([x["s"] for x in row], np.float64).tobytes() for row in b.column("f").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("group"), pa.array(floors, pa.binary())], names=["group", "floors"])

    return groups.drop("floors").join(listed.mapInArrow(pack, "group long, floors binary"), "group")


def _with_ids(groups: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = pa.array([np.frombuffer(x, np.int64) for x in b.column("ids").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("seq", "ids", "values", "width")] + [lists], names=["group", "ids", "values", "width", "q_list"])

    return groups.mapInArrow(run, "group long, ids binary, values binary, width int, q_list array<long>")


def top_k(
    rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = 256,
    range_rows: int = RANGE_ROWS, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the best k rows for each row that ``is_query`` (of ``id``) picks."""
    vectors = keep(whole_vectors(rows, id_col, vector_col, scale), "vectors")
    parts = max(1, -(-vectors.count() // range_rows))
    ranges, n = numbered(packed(vectors.repartitionByRange(parts, "id").sortWithinPartitions("id"), range_rows), "ranges")
    asked = vectors.where(is_query)
    n_groups = max(1, -(-asked.count() // group_rows))
    groups = keep(_with_ids(packed(asked.repartition(n_groups), group_rows)), "query-groups").withColumn("floors", F.lit(None).cast("binary"))
    # One range for each group, by turns, gives the first floors; a number without a range gives none, and the bounds prune less.
    home = F.pmod(F.col("group"), F.lit(max(n, 1)))
    first = keep(_best(_found(ranges, groups.withColumn("number", home), n, k), k), "first-pass")
    # The stated queries against all rows, in blocks: every range meets every group.
    every = _with_floors(groups, first, k).withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n - 1, 0)).cast("long"))))
    # Rows with the same id and other values were searched for one by one; their results meet here, those of equal score too.
    found = _found(ranges, every, n, k)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score"))
