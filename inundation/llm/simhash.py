"""SimHash near-duplicates: fingerprints of word shingles, BK-trees of them, and the groups that their links form.

Fingerprints that differ in at most ``radius`` bits are linked.  They are cut into ``radius + 3`` blocks of bits; two linked ones
agree on at least three whole blocks, so each distinct fingerprint goes to the shard of every choice of three of its blocks, and a
shard's BK-tree answers its own fingerprints, following only edges within the radius.  The trees reach their tasks by a shuffle: all
trees together grow with the corpus, so no broadcast of them has a bound.  A shard with more than ``MOST_IN_TREE``
fingerprints is cut again, by the fingerprints with one bit flipped: two that are linked share such a neighbour, and at most 65
fingerprints have one in common, so no shard is ever too large, and none is cut off.

Copies meet before anything is compared: a fingerprint is one row, however many documents have it.  A tree emits a link from each of
its fingerprints to the least one reached within the shard, not all pairs.

Defined cases: a null or empty text has no shingles and the fingerprint zero, and so is linked like any other.  Rows with the same
id are one document with several texts: they get a row each, in one group.  Rows with a null id are in no group and get a null
component.  Columns besides id and text are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inundation.llm.components import least_reachable
from inundation.llm.flat import slices, words
from inundation.llm.shared import keep

#: Seed of the shingle hashes, words in a shingle, most bits that linked fingerprints differ in.
HASH_SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2
BITS = 64
#: Fingerprints in one tree; shards with more are cut by flipped bits.
MOST_IN_TREE = 4096


def _lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def fingerprint_of(hashes: list[int]) -> int:
    """Bit i is set if it is set in over half of the hashes; 0 without any."""
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    high = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(high, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch, t in slices(batches, "text"):
            w = words(t)
            # Words one space apart: each byte keeps its place among the words' bytes, plus a space before it.
            sizes = w.end - w.start
            at = np.concatenate([[0], np.cumsum(sizes + 1)])
            out = np.full(at[-1], 32, np.uint8)
            keep_byte = np.repeat(w.start - at[:-1], sizes) + (pos := np.repeat(at[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()))
            out[pos] = _lower(t.data)[keep_byte]
            joined = out.tobytes()
            start, end = at[:-1].tolist(), (at[1:] - 1).tolist()
            first, found = w.first.tolist(), []
            for a, b in zip(first[:-1], first[1:], strict=True):
                if a == b:
                    found.append(0)
                elif b - a < shingle:
                    found.append(fingerprint_of([digest(joined[start[a] : end[b - 1]], seed)]))
                else:
                    found.append(fingerprint_of([digest(joined[s:e], seed) for s, e in zip(start[a : b - shingle + 1], end[a + shingle - 1 : b], strict=True)]))
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(signed)], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> DataFrame:
    """``id`` and ``fp``, the fingerprint as a signed 64-bit number."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(_fingerprints(shingle, seed), "id long, fp long")


class BKTree:
    """Children are keyed by their distance to the parent, so a search follows only edges within the radius."""

    def __init__(self, root: int):
        self.keys = [root]
        self.children: list[dict[int, int]] = [{}]

    def search(self, key: int, radius: int) -> list[int]:
        """Positions of the keys at most ``radius`` bits away."""
        keys, children, found, todo = self.keys, self.children, [], [0]
        while todo:
            node = todo.pop()
            d = (keys[node] ^ key).bit_count()
            if d <= radius:
                found.append(node)
            edges = children[node]
            for e in range(max(d - radius, 0), d + radius + 1):
                if e in edges:
                    todo.append(edges[e])
        return found

    def add(self, key: int) -> int:
        """The key's position; a key that is there already isn't added again."""
        node = 0
        while d := (self.keys[node] ^ key).bit_count():
            if d not in self.children[node]:
                self.children[node][d] = len(self.keys)
                self.keys.append(key)
                self.children.append({})
                return len(self.keys) - 1
            node = self.children[node][d]
        return node


def links_within(prints: list[int], ids: list[int], radius: int) -> list[tuple[int, int]]:
    """(larger id, least id) for every fingerprint that is linked to a smaller one through the shard."""
    tree, parent = BKTree(prints[0]), [0]
    where = [ids[0]]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for key, ident in zip(prints[1:], ids[1:], strict=True):
        near = tree.search(key, radius)
        me = tree.add(key)
        if me == len(parent):
            parent.append(me)
            where.append(ident)
        for other in near:
            a, b = root(me), root(other)
            if a != b:
                lo, hi = (a, b) if where[a] < where[b] else (b, a)
                parent[hi] = lo
    return [(where[i], where[r]) for i in range(len(parent)) if (r := root(i)) != i]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by shard; only the open shard is held, and it has at most ``MOST_IN_TREE`` rows."""
        held: tuple[list, list, list] = ([], [], [])

        def flush(shard, prints, ids):
            cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            out = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a > 1:
                    out += links_within(prints[a:b].tolist(), ids[a:b].tolist(), radius)
            high, low = zip(*out, strict=True) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["a", "b"])

        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "fp", "id")]
            shard, prints, ids = (np.concatenate([*h, x]) for h, x in zip(held, new, strict=True))
            if not len(shard):
                continue
            last = np.flatnonzero(shard != shard[-1])
            done = int(last[-1]) + 1 if len(last) else 0
            held = tuple([x[done:]] for x in (shard, prints, ids))
            if done:
                yield flush(shard[:done], prints[:done].view(np.uint64), ids[:done])
        if held[0]:
            shard, prints, ids = (h[0] for h in held)
            yield flush(shard, prints.view(np.uint64), ids)

    return run


def _shards_of(radius: int) -> list:
    """Expressions of the shards of a fingerprint: the bits of three of ``radius + 3`` blocks, and which three."""
    n = radius + 3
    edges = [BITS * i // n for i in range(n + 1)]
    # Blocks of a fingerprint as masks; a signed 64-bit number holds the same bits.
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(n)]
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    return [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(sum(masks[j] for j in c))))) for i, c in enumerate(combinations(range(n), 3))]


def _neighbours() -> list:
    flips = [0] + [1 << i for i in range(BITS - 1)] + [-(1 << (BITS - 1))]
    return [F.col("fp").bitwiseXOR(F.lit(f)) for f in flips]


def links(prints: DataFrame, radius: int = RADIUS, most: int = MOST_IN_TREE) -> DataFrame:
    """``a`` and ``b`` (``b < a``): links that connect all ``id`` whose distinct ``fp`` differ in at most ``radius`` bits."""
    if radius > 2:
        raise ValueError("Shards that are too large are cut for a radius of 2 or less only")
    dealt = prints.select("fp", "id", F.explode(F.array(*_shards_of(radius))).alias("shard"))
    sizes = dealt.groupBy("shard").count()
    # Shards of one fingerprint have no link.  Both kinds are few beside all shards.
    shared, crowded = sizes.where(f"count BETWEEN 2 AND {most}").select("shard"), sizes.where(f"count > {most}").select("shard")
    small = dealt.join(shared, "shard", "left_semi")
    hot = dealt.join(crowded, "shard", "left_semi").select("fp", "id").distinct()
    cut = hot.select("fp", "id", F.explode(F.array(*_neighbours())).alias("shard"))
    ordered = lambda df: df.select("shard", "fp", "id").repartition("shard").sortWithinPartitions("shard", "id")
    found = [ordered(x).mapInArrow(_links(radius), "a long, b long") for x in (small, cut)]
    return found[0].unionByName(found[1]).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
    seed: int = HASH_SEED,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id that links lead to."""
    prints = keep(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    distinct = prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least"))
    # An id with several texts ties their fingerprints together.
    several = prints.where("id IS NOT NULL").groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("id")
    by_print = keep(distinct, "simhash-prints")
    ties = (
        prints.join(several, "id", "left_semi").distinct().join(by_print, "fp")
        .where("id <> least").select(F.greatest("id", "least").alias("a"), F.least("id", "least").alias("b"))
    )
    edges = links(by_print.select("fp", F.col("least").alias("id"))).unionByName(ties)
    group = least_reachable(edges)
    of_print = by_print.join(group, F.col("least") == F.col("node"), "left").select(
        F.col("fp").alias("print"), F.coalesce("root", "least").alias("component_id")
    )
    joined = prints.join(of_print, F.col("fp") == F.col("print"), "left")
    return joined.select(
        F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, and of rows with the same id that with the least text.

    Rows without an id are in no group and stay.
    """
    chosen = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_chosen_id")).distinct()
    kept = docs.join(chosen, F.col(id_col) == F.col("_chosen_id"), "left_semi")
    # The join has dealt the rows by id already.
    nth = F.row_number().over(Window.partitionBy(id_col).orderBy(text_col))
    one = kept.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
    return one.unionByName(docs.where(F.col(id_col).isNull()))


def hex_print(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
