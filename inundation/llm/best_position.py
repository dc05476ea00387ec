"""Ranked lexical search by the Best Position Algorithm.

Documents are indexed once per block of items: a shard has, for every term that an item of the block holds, an impact list (documents by
falling impact) and a forward index (a document's terms with their places in the lists).  For an item, lists are read from the top
in rounds.  A document met for the first time is looked up in the forward index, which gives its whole score and marks its
place in every list as seen.  A list's best position is the last one up to which all places are seen; no document that hasn't been
seen can score more than the impacts at the first places after the best positions, summed.  That sum falls
faster than the one at the last-read places, and reading stops once it is strictly below the kth best score, so ties are all found.

A few shards are searched first; the kth scores they give are floors for all others.  Only k rows per shard and item leave a task.
Counts that scores need from the corpus (documents, terms, documents of each term) are sums over all documents.

Terms are told apart by 64-bit hashes.  Scores are whole numbers; 50 * terms of a document * documents must stay below 2 ** 63.

Defined cases: a null or empty text has no terms and is never a result, nor does it count as a document.  Rows that repeat are documents of
their own, results of their own and ranked one after another; a document with a null id comes last among equal scores.  Items
with the same id are one item with the terms of all; an item with a null id is an item like any other, one
without terms that occur has no rows.  Long texts are read whole.  Columns besides ids and texts are ignored, whatever their names.
Empty tables give no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inundation.llm.flat import SLICE_BYTES, Texts, byte_values, runs, slices, span_hash, texts
from inundation.llm.shared import keep

K = 50
#: Items that the driver and every task hold at a time, on average; bytes of text of a shard; shards searched for the floors.
BLOCK_ITEMS = 2000
SHARD_BYTES = 32 << 20
FIRST_SHARDS = 8
#: Places read from each list in the first round, and in any at most.
ROUND, LONGEST_ROUND = 8, 1024

#: Fixed value: bytes of terms, which are ASCII letters and digits and all other scripts.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_SHARD = "shard long, ids array<long>, n binary, sizes binary, terms binary, tf binary, n_docs long, n_terms long"
_FOUND = "item int, doc_id long, score long"


def term_hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of the texts in order, and how many each text has."""
    w = runs(t, _IN_TERM)
    return span_hash(byte_values(_LOWER[t.data]), w.start, w.end), w.per_text


def _numbers(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int32).astype(np.int64)


def _bytes(x) -> bytes:
    return np.concatenate([*x, np.zeros(0, np.int32)]).astype(np.int32).tobytes()


def _index(vocabulary: np.ndarray, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards of a partition's documents: the terms of the vocabulary that each has, and how often."""
        schema = pa.schema(
            [("shard", pa.int64()), ("ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("n", "sizes", "terms", "tf")],
             ("n_docs", pa.int64()), ("n_terms", pa.int64())]
        )
        names = ("ids", "n", "sizes", "terms", "tf")
        held = {c: [] for c in names}
        size = 0

        def flush() -> pa.RecordBatch:
            n = np.concatenate(held["n"])
            packed = {c: [_bytes(held[c])] for c in names[1:]}
            ids = [[i for x in held["ids"] for i in x]]
            return pa.RecordBatch.from_pydict(
                {"shard": [uuid.uuid4().int >> 65], "ids": ids, **packed, "n_docs": [int((n > 0).sum())], "n_terms": [int(n.sum())]}, schema=schema
            )

        for batch, t in slices(batches, "text", SLICE_BYTES):
            h, n = term_hashes(t)
            at = np.minimum(np.searchsorted(vocabulary, h), max(len(vocabulary) - 1, 0))
            hit = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
            key, tf = np.unique(np.repeat(np.arange(len(n)), n)[hit] * len(vocabulary) + at[hit], return_counts=True)
            doc, term = np.divmod(key, max(len(vocabulary), 1))
            for c, v in zip(names, (batch.column("id").to_pylist(), n, np.bincount(doc, minlength=len(n)), term, tf), strict=True):
                held[c].append(v)
            size += len(t.data)
            if size >= most:
                yield flush()
                held, size = {c: [] for c in names}, 0
        if held["ids"]:
            yield flush()

    return run


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for terms in b.column("terms").to_pylist():
            term, df = np.unique(_numbers(terms), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df)], names=["term", "df"])


@dataclass(frozen=True)
class Weights:
    """What scores need from the whole corpus."""

    of_term: np.ndarray
    n_docs: int
    n_terms: int

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + (50 * n * self.n_docs) // max(self.n_terms, 1)
        return self.of_term[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def weigh(df: np.ndarray, n_docs: int, n_terms: int) -> Weights:
    """Weights of terms from the documents that hold them."""
    w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
    return Weights(np.array(w, np.int64), n_docs, n_terms)


class Shard:
    """Impact lists and forward index of a shard's documents."""

    def __init__(self, ids: list, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, w: Weights):
        doc = np.repeat(np.arange(len(n)), sizes)
        impact = w.impacts(term, tf, n[doc])
        some = impact > 0
        self.doc, self.term, self.impact = doc[some], term[some], impact[some]
        self.first = np.searchsorted(self.doc, np.arange(len(n) + 1))
        order = np.lexsort((self.doc, -self.impact, self.term))
        #: Where each entry of the forward index stands in the lists, and the lists themselves.
        self.place = np.empty_like(order)
        self.place[order] = np.arange(len(order))
        self.list_doc, self.list_impact = self.doc[order], self.impact[order]
        self.list_first = np.searchsorted(self.term[order], np.arange(len(w.of_term) + 1))
        self.no_id = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)

    def search(self, terms: np.ndarray, floor: int, k: int = K) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents (their places) and scores of the best k that reach ``floor``, best first, and the number looked up."""
        begin, end = self.list_first[terms], self.list_first[terms + 1]
        begin, end = begin[begin < end], end[begin < end]
        asked = np.zeros(len(self.list_first), bool)
        asked[terms] = True
        seen, known = np.zeros(len(self.list_doc), bool), np.zeros(len(self.ids), bool)
        best, read = begin.copy(), begin.copy()
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least, looked_up, step = max(floor, 1), 0, ROUND
        # The most that a document can score of which no place is seen.
        while len(best) and (bound := int(self.list_impact[best].sum())) >= least and bound > 0:
            n = np.minimum(read + step, end) - read
            at = np.repeat(read, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            seen[at] = True
            new = np.unique(self.list_doc[at])
            new = new[~known[new]]
            known[new] = True
            looked_up += len(new)
            if len(new):
                width = self.first[new + 1] - self.first[new]
                entry = np.repeat(self.first[new], width) + np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
                mine = asked[self.term[entry]]
                seen[self.place[entry[mine]]] = True
                # Every new document is on a list, so each has an entry.
                score = np.add.reduceat(np.where(mine, self.impact[entry], 0), np.cumsum(width) - width)
                fits = score >= least
                docs, scores = np.concatenate([docs, new[fits]]), np.concatenate([scores, score[fits]])
                first = np.lexsort((self.ids[docs], self.no_id[docs], -scores))[:k]
                docs, scores = docs[first], scores[first]
                if len(docs) == k:
                    least = max(least, int(scores[-1]))
            for i in range(len(best)):
                rest = seen[best[i] : end[i]]
                run = int(rest.argmin())
                best[i] += len(rest) if rest[run] else run
            on = best < end
            best, end = best[on], end[on]
            # Places up to the best position are seen and needn't be read.
            read = np.maximum((read + step)[on], best)
            step = min(2 * step, LONGEST_ROUND)
        return docs, scores, looked_up


def _search(items: list[np.ndarray], w: Weights, floors: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row["ids"], *(_numbers(row[c]) for c in ("n", "sizes", "terms", "tf")), w)
                found = [shard.search(terms, int(floors[i]), k) for i, terms in enumerate(items)]
                item = np.repeat(np.arange(len(items), dtype=np.int32), [len(d) for d, _, _ in found])
                doc, score = (np.concatenate([f[c] for f in found] + [np.zeros(0, np.int64)]) for c in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item), pa.array(shard.ids[doc], mask=shard.no_id[doc]), pa.array(score)], names=["item", "doc_id", "score"]
                )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _block(docs: DataFrame, asked: dict, k: int, shard_bytes: int, first_shards: int) -> DataFrame:
    """The results of the items ``asked`` (id to term hashes), as ``item_id``, ``rank``, ``doc_id`` and ``score``."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([*asked.values(), np.zeros(0, np.uint64)]))
    items = [np.searchsorted(vocabulary, h) for h in asked.values()]
    shards = keep(docs.mapInArrow(_index(vocabulary, shard_bytes), _SHARD), "impact-shards")
    n_docs, n_terms = (x or 0 for x in shards.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    df = np.zeros(len(vocabulary), np.int64)
    # At most a row for each term of the block's items.
    for term, n in shards.select("terms").mapInArrow(_term_counts, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        df[term] = n
    w = weigh(df, n_docs, n_terms)
    names = ["ids", "n", "sizes", "terms", "tf"]
    few = [r[0] for r in shards.select("shard").orderBy("shard").limit(first_shards).collect()]
    search = lambda rows, floors: rows.select(*names).mapInArrow(_search(items, w, floors, k), _FOUND)
    first = keep(_ranked(search(shards.where(F.col("shard").isin(few)), np.zeros(len(items), np.int64)), k), "first-shards")
    floors = np.zeros(len(items), np.int64)
    for item, score in first.where(F.col("rank") == k).select("item", "score").collect():
        floors[item] = score
    others = search(shards.where(~F.col("shard").isin(few)), floors)
    numbers = spark.createDataFrame([(i, x) for i, x in enumerate(asked)], "item int, item_id long")
    ranked = _ranked(first.drop("rank").unionByName(others), k).join(F.broadcast(numbers), "item")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    k: int = K, block_items: int = BLOCK_ITEMS, shard_bytes: int = SHARD_BYTES, first_shards: int = FIRST_SHARDS,
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of the best k documents for each item.

    Items are a stated query set: blocks of about ``block_items`` by a hash of their id meet all documents, block by block.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    queries = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
    blocks = max(1, -(-queries.count() // block_items))
    out = None
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        asked: dict = {}
        for r in rows:
            asked[r.id] = np.union1d(asked.get(r.id, np.zeros(0, np.uint64)), term_hashes(texts(pa.array([r.text], pa.string())))[0])
        found = _block(picked, asked, k, shard_bytes, first_shards)
        out = found if out is None else out.unionByName(found)
    return out
