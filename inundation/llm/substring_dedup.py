"""Substring deduplication with a compressed FM-index per shard.

A window is ``window`` consecutive words of one document; one whose words also start anywhere else is repeated, and every word that
a repeated window covers is removed.

Shards are formed by content, so that no document has to be held against all of them.  The words of a window hold
``window - SEED_WORDS + 1`` seeds (runs of ``SEED_WORDS`` words); the one with the least hash, the first of equal ones, stands for it.
Neighbouring windows mostly share it and form a stretch.  Equal windows have equal seeds, so only stretches of a seed that occurs twice
can hold a repeated window, and these go to the shard of their seed.  There the words of the distinct stretches are indexed, and each
is streamed backward through the index, which says for every window whether it is found elsewhere.

Equal stretches meet before that: a stretch goes to its shard once, with the number of its places, however many copies of it there
are.  The stretches of a seed with more than ``MOST_STRETCHES`` distinct ones (a phrase in very many contexts) are cut into their
windows, which are dealt by their own content instead, and equal ones again meet first.  So no shard depends on one phrase.

Words are compared by 64-bit hashes, stretches by the hash of their words together with their seed's, 128 bits in all.

Defined cases: a null or empty text has no words; what is kept of it is the empty string.  Rows that repeat are documents of their
own and thus copies of each other; rows with a null id as well.  Columns besides id and text are ignored.  A text may be of any
length.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inundation.llm.flat import SLICE_BYTES, Words, mix, slices, span_hash, texts, words
from inundation.llm.fm_index import repeated_windows
from inundation.llm.shared import keep

WINDOW = 35
SEED_WORDS = 8
#: Words that a shard's index is planned for, and distinct stretches of a seed from which they are cut.
SHARD_WORDS = 400_000
MOST_STRETCHES = 4096
#: A seed is hot from so many stretches, or if one task in so many parts has fewer on average.
LEAST_HOT = 1000
HOT_PARTS = 4


def stretches(w: Words, hashes: np.ndarray, window: int, seed_words: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same seed at the same place: first word, number of windows, seed, and a hash of all their words."""
    n = len(hashes)
    if n < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(n - seed_words + 1)
    best, place = span_hash(hashes, at, at + seed_words), at
    seeds = best
    # The least of the seeds from a word on, for 2, 4, ... seeds and last for all of a window.
    width, want = 1, window - seed_words + 1
    while width < want:
        step = min(width, want - width)
        other, there = best[step:], place[step:]
        lower = other < best[:-step]
        best, place = np.where(lower, other, best[:-step]), np.where(lower, there, place[:-step])
        width += step
    at = w.windows(window)
    place = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    edge = np.append(np.flatnonzero(new), len(at))
    first, count = at[edge[:-1]], np.diff(edge)
    return first, count, seeds[place[edge[:-1]]], span_hash(hashes, first, first + count + window - 1)


def _find(window: int, seed_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in slices(batches, "text", SLICE_BYTES):
            w = words(t)
            first, count, seed, content = stretches(w, span_hash(t.byte_values(), w.start, w.end), window, seed_words)
            row = np.searchsorted(w.first, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), batch.column("key").take(pa.array(row)), pa.array((first - w.first[row]).astype(np.int32)),
                 pa.array(count.astype(np.int32)), pa.array(seed.view(np.int64)), pa.array(content.view(np.int64))],
                names=["id", "key", "start", "n", "seed", "content"],
            )

    return run


def _cut_out(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of the wanted stretches of a document; crowded ones window by window."""
        for batch, t in slices(batches, "text", SLICE_BYTES):
            w, buffer = words(t), t.data.tobytes()
            lists = batch.column("wanted")
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            start, n, seed, content, places, crowded = (c.to_numpy(zero_copy_only=False) for c in flat.flatten())
            a = w.first[row] + start
            offset = np.full(len(a), -1, np.int64)
            if crowded.any():
                each = np.where(crowded, n, 1)
                nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                a, seed, content, places, crowded = (np.repeat(x, each) for x in (a, seed, content, places, crowded))
                n = np.where(crowded, 1, np.repeat(n, each))
                a = a + np.where(crowded, nth, 0)
                offset = np.where(crowded, nth, -1)
            b = a + n + window - 1
            hashes = span_hash(t.byte_values(), w.start, w.end)
            own = span_hash(hashes, a, b).view(np.int64) if len(a) else content
            cut = [buffer[i:j] for i, j in zip(w.start[a].tolist(), w.end[b - 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed), pa.array(content), pa.array(offset.astype(np.int32)), pa.array(places), pa.array(own), pa.array(cut, pa.binary())],
                names=["seed", "content", "offset", "places", "own", "cut"],
            )

    return run


def _search(window: int):
    def one_shard(part: list[pa.RecordBatch]) -> pa.RecordBatch:
        b = pa.Table.from_batches(part)
        hi, lo, places = (b.column(c).to_numpy() for c in ("hi", "lo", "places"))
        # Rows that repeat with the same id and text bring the same stretch twice; it is one here.
        _, first = np.unique(mix(hi.view(np.uint64)) ^ lo.view(np.uint64), return_index=True)
        hi, lo, places = hi[first], lo[first], places[first]
        t = texts(b.column("cut").combine_chunks().take(pa.array(first)).cast(pa.large_binary()))
        w = words(t)
        hashes = span_hash(t.byte_values(), w.start, w.end)
        _, ids = np.unique(hashes, return_inverse=True)
        # Symbol 0 ends each stretch.
        size = w.per_text
        at = np.arange(len(ids)) + w.text
        seq = np.zeros(len(ids) + len(t), np.int64)
        seq[at] = ids + 1
        start = w.first[:-1] + np.arange(len(t))
        windows = size - window + 1
        found = np.where(places > 1, (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1), np.uint64(0))
        # A stretch of one place is streamed; one of several is a repeat as a whole, and in the index for the others.
        single = np.flatnonzero(places == 1)
        found[single] = repeated_windows(seq, start[single], windows[single], window)
        some = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(hi[some]), pa.array(lo[some]), pa.array(found[some].view(np.int64))], names=["hi", "lo", "found"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            shard = b.column("shard").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                part = b.slice(i, j - i)
                if held and held[0].column("shard")[0] != part.column("shard")[0]:
                    yield one_shard(held)
                    held = []
                held.append(part)
        if held:
            yield one_shard(held)

    return run


def _by_shard(units: DataFrame, n_words: int, shard_words: int, window: int, route: str) -> DataFrame:
    """``hi`` and ``lo`` of each unit with a repeated window, and which ones, as bits; units that share ``route`` share a shard."""
    n = max(1, -(-n_words // shard_words))
    dealt = units.select(F.pmod(F.xxhash64(route), F.lit(n)).alias("shard"), "hi", "lo", "places", "cut")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(_search(window), "hi long, lo long, found long")


def repeated_stretches(
    docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS, shard_words: int = SHARD_WORDS, most_stretches: int = MOST_STRETCHES
) -> DataFrame:
    """``id``, ``key``, ``start`` and ``found``: bit i is set if the window that starts i words on is repeated."""
    if window - seed_words + 1 > 62:
        raise ValueError("A stretch may have up to 62 windows: take longer seeds")
    schema = "id long, key long, start int, n int, seed long, content long"
    all_found = keep(docs.mapInArrow(_find(window, seed_words), schema), "stretches")
    twice = keep(all_found.groupBy("seed").count().where("count > 1"), "seeds")
    # Seeds with more than a part of a task's share: at most HOT_PARTS per task, so they can be sent everywhere, and the stretches
    # that have them are picked out where they are.  Those of all others are few, and are shuffled by seed.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot_from = max(LEAST_HOT, all_found.count() // (HOT_PARTS * parts))
    hot = F.broadcast(twice.where(F.col("count") > hot_from).select("seed"))
    cold = twice.where(F.col("count") <= hot_from).select("seed")
    candidates = all_found.join(hot, "seed", "left_anti").join(cold, "seed", "left_semi").unionByName(all_found.join(hot, "seed", "left_semi"))
    # One place stands for all places of equal stretches.
    distinct = keep(
        candidates.groupBy("seed", "content").agg(F.count("*").alias("places"), F.min(F.struct("id", "key", "start", "n")).alias("at")), "distinct"
    )
    crowded = keep(distinct.groupBy("seed").count().where(f"count > {most_stretches}").select("seed", F.lit(True).alias("crowded")), "crowded")
    some_crowded = not crowded.isEmpty()
    n_words = distinct.agg(F.sum(F.col("at.n") + window - 1)).first()[0] or 0
    flagged = distinct.join(crowded, "seed", "left") if some_crowded else distinct.withColumn("crowded", F.lit(False))
    wanted = flagged.groupBy(F.col("at.id").alias("at_id"), F.col("at.key").alias("at_key")).agg(
        F.collect_list(F.struct("at.start", "at.n", "seed", "content", "places", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("wanted")
    )
    here = docs.join(wanted, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key"))).select("text", "wanted")
    cut = here.mapInArrow(_cut_out(window), "seed long, content long, offset int, places long, own long, cut binary")
    cut = keep(cut, "cut") if some_crowded else cut
    units = cut.where("offset < 0").select(F.col("seed").alias("hi"), F.col("content").alias("lo"), "places", "cut")
    verdicts = _by_shard(units, n_words, shard_words, window, "hi")
    if some_crowded:
        single = cut.where("offset >= 0")
        # The words of a window are its own route and, with a second hash of them, its name.
        name = [F.xxhash64("cut").alias("hi"), F.col("own").alias("lo")]
        # Rows that repeat with the same id and text bring a window of a stretch twice.
        placed = single.dropDuplicates(["seed", "content", "offset"]).select("seed", "content", "offset", "places", *name, "cut")
        equal = placed.groupBy("lo").agg(F.sum("places").alias("places"), F.min("hi").alias("hi"), F.min("cut").alias("cut"))
        total = equal.agg(F.count("*")).first()[0] * window
        by_window = keep(_by_shard(equal, total, shard_words, window, "lo"), "windows").select(F.col("lo").alias("own_lo"))
        bits = placed.join(by_window, F.col("lo") == F.col("own_lo"), "left_semi").groupBy("seed", "content").agg(
            F.bit_or(F.expr("shiftleft(1L, offset)")).alias("found")
        )
        verdicts = verdicts.unionByName(bits.select(F.col("seed").alias("hi"), F.col("content").alias("lo"), "found"))
    verdicts = keep(verdicts, "verdicts")
    return candidates.join(verdicts, (F.col("seed") == F.col("hi")) & (F.col("content") == F.col("lo"))).select("id", "key", "start", "found")


def _remove(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in slices(batches, "text", SLICE_BYTES):
            w, n = words(t), len(t)
            lists = batch.column("removed")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            start, found = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            first = np.repeat(w.first[:-1], sizes) + start
            edge = np.zeros(len(w.start) + 1, np.int64)
            bits, any_bit = found.view(np.uint64), int(np.bitwise_or.reduce(found, initial=0))
            for i in range(any_bit.bit_length() if any_bit >= 0 else 64):
                at = first[(bits >> np.uint64(i)) & np.uint64(1) == 1] + i
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed = np.bincount(w.text[gone], minlength=n)
            # The kept words, each after a space.
            a, b = w.start[~gone], w.end[~gone]
            size = b - a
            place = np.concatenate([[0], np.cumsum(size + 1)])
            out = np.full(place[-1], 32, np.uint8)
            total = np.cumsum(size) - size
            run_on = np.arange(size.sum())
            out[np.repeat(place[:-1] + 1 - total, size) + run_on] = t.data[np.repeat(a - total, size) + run_on]
            kept_before = np.concatenate([[0], np.cumsum(~gone)])[w.first]
            buffer = out.tobytes()
            kept = [buffer[i + 1 : j] for i, j in zip(place[kept_before[:-1]].tolist(), place[kept_before[1:]].tolist(), strict=True)]
            columns = [batch.column("id"), pa.array(w.per_text), pa.array(removed), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array([x.decode() for x in kept], pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed_words: int = SEED_WORDS,
    shard_words: int = SHARD_WORDS, most_stretches: int = MOST_STRETCHES, with_text: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if wanted, ``kept_text``: the words that stay, a space apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("key", F.xxhash64("id", "text")).select("id", "key", "text")
    found = repeated_stretches(rows, window, seed_words, shard_words, most_stretches)
    by_doc = found.groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key")).agg(F.collect_set(F.struct("start", "found")).alias("removed"))
    marked = rows.join(by_doc, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left").select("id", "text", "removed")
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return marked.mapInArrow(_remove(window, with_text), schema).withColumnRenamed("id", id_col)
