"""Cross-entropy difference of word bigram models that grow with the corpus.

A target and a background model are matched: same vocabulary, same order, same smoothing.  A document's score is the mean over its
words of the target model's loss less the background model's; low scores read like the target.

The vocabulary is every word of every document (bytes between separators, nothing folded), so no word is unknown.  Words and
bigrams go by 64-bit hashes.  Texts become chunks of about ``CHUNK_WORDS`` words: their distinct words and the words' places among
them.  Each chunk adds up its own bigrams and deals them by hash into buckets, where all chunks' counts meet and go back to those
that asked; then the same for words, with the counts of histories.  A chunk sends a bigram once, so a hot one is a number per
chunk and needs no salt.  Beyond ``FAN`` buckets there are steps between: about as many chunks meet in a node for each of ``FAN``
ranges of hashes, which adds them up and sends them on as a chunk does, and answers come back the same way.  So a chunk sends at most
``FAN`` rows a step, and rows grow with the words.  No model is ever held whole: a bucket has a part of it, a chunk what its
texts need.  The driver gets four sums.

Shares are interpolated by Witten-Bell: ``p(w | h) = (c(hw) + t(h) p(w)) / (c(h) + t(h))`` where ``t(h)`` is the number of kinds
of words seen after ``h``, and ``p(w) = (c(w) + T / V) / (N + T)`` with the T kinds and N words of the model and the V words of
the vocabulary.  A history that a model hasn't seen gives p(w); a model of nothing gives 1 / V.  Before a text stands a mark.
Each text is scored by models without it: its own counts are taken off both (the target's where it is one), kinds that only it has
too.  The vocabulary stays.

Defined cases: a text that is null or without words has null losses.  Repeated rows are counted and scored one by one.  Columns
besides id and text are ignored.  An empty table gives no rows.  A text of any length is scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inundation.llm.flat import SLICE_BYTES, mix, slices, span_hash, words
from inundation.llm.shared import keep

#: Words of a chunk (a longer text is a chunk of its own) and entries of a bucket, about.
CHUNK_WORDS = 1 << 19
BUCKET_KEYS = 1 << 19
#: Parts that a chunk's entries are cut into at most by a step.
FAN = 1024
#: Chunks or buckets that have a task each; of more, a task takes 64 or so.
MOST_SINGLE = 4096
_CHUNK = "chunk long, ids array<long>, sizes binary, is_target binary, vocabulary binary, tokens binary, n_words long, n_kinds long"
_PART = "bucket long, chunk long, keys binary, counts binary"
_SUMS = "bucket long, chunk long, n long, counts binary, firsts binary, targets binary, totals array<long>"
_START = np.uint64(0)


def _batch(schema: str, **columns) -> pa.RecordBatch:
    kind = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kind[k]) for n, k in fields], names=[n for n, _ in fields])


def _narrow(a: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs, all first bytes first, as the others mostly are zeros."""
    least = a.astype(np.min_scalar_type(int(a.max())) if a.size else np.uint8)
    return least.reshape(-1, 1).view(np.uint8).T.tobytes()


def _wide(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    each = np.frombuffer(b, np.uint8).reshape(-1, n)
    return np.ascontiguousarray(each.T).view(f"u{len(each)}").ravel().astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as their differences, byte by byte, whose upper bytes are zeros that compress."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _keys(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _chunks(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n = TaskContext.get().partitionId() << 32, 0
        ids, sizes, target, hashes = [], [], [], []

        def flush() -> pa.RecordBatch:
            kinds, at = np.unique(np.concatenate(hashes), return_inverse=True)
            return _batch(
                _CHUNK, chunk=[number], ids=[[i for x in ids for i in x]], sizes=[np.concatenate(sizes).astype(np.int64).tobytes()],
                is_target=[np.concatenate(target).astype(np.uint8).tobytes()], vocabulary=[_pack_keys(np.append(_START, kinds))],
                tokens=[_narrow(at + 1)], n_words=[n], n_kinds=[len(kinds) + 1],
            )

        for batch, t in slices(batches, "text", SLICE_BYTES):
            w = words(t)
            ids.append(batch.column("id").to_pylist())
            sizes.append(w.per_text)
            target.append(batch.column("is_target").to_numpy(zero_copy_only=False))
            hashes.append(span_hash(t.byte_values(), w.start, w.end))
            n += len(w.start)
            if n >= most:
                yield flush()
                ids, sizes, target, hashes, n, number = [], [], [], [], 0, number + 1
        if ids:
            yield flush()

    return run


def _bigrams(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct bigrams in the order of their hashes: history, word, hash; then each token's bigram and its text."""
    vocabulary, tokens = _keys(row["vocabulary"]), _wide(row["tokens"], row["n_words"]).astype(np.uint32)
    sizes = np.frombuffer(row["sizes"], np.int64)
    before = np.zeros(len(tokens), np.uint32)
    before[1:] = tokens[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    pairs, at = np.unique((before.astype(np.uint64) << np.uint64(32)) | tokens, return_inverse=True)
    h, w = (pairs >> np.uint64(32)).astype(np.uint32), (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    key = mix(mix(vocabulary[h] + np.uint64(0x9E3779B97F4A7C15)) + vocabulary[w])
    order = np.argsort(key, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return h[order], w[order], key[order], place[at], np.repeat(np.arange(len(sizes)), sizes)


def _parts(chunk: int, keys: np.ndarray, counts: np.ndarray, step: int) -> pa.RecordBatch:
    """Sorted keys cut into a part per bucket, a bucket being ``step`` hashes; parts of nothing are left out."""
    of = keys // np.uint64(step)
    edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else [], len(of)).astype(np.int64)
    cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return _batch(
        _PART, bucket=of[edges[:-1]].astype(np.int64), chunk=np.full(len(cut), chunk), keys=[_pack_keys(keys[c]) for c in cut],
        counts=[_narrow(counts[:, c]) for c in cut],
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(len(b)):
            yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    held: list[dict] = []
    for row in _rows(batches):
        if held and held[0][by] != row[by]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _send_bigrams(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, _, key, at, text = _bigrams(row)
            target = np.frombuffer(row["is_target"], np.uint8)[text]
            counts = np.stack([np.bincount(at, weights=target, minlength=len(key)), np.bincount(at, minlength=len(key))])
            yield _parts(row["chunk"], key, counts, step)

    return run


def _union(parts: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of some parts; where each part ends, each entry's key, and whether it is a key's first."""
    keys = [_keys(r["keys"]) for r in parts]
    every, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    is_first = np.zeros(len(at), bool)
    is_first[first] = True
    return every, np.cumsum([len(k) for k in keys]), at, is_first


def _sums(parts: list[dict], n: int, ends: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The parts' counts, summed by key."""
    sizes = np.diff(ends, prepend=0)
    counts = np.concatenate([_wide(r["counts"], width * k).reshape(width, -1) for r, k in zip(parts, sizes, strict=True)], axis=1)
    sums = np.zeros((width, n), np.int64)
    for k in range(width):
        np.add.at(sums[k], at, counts[k])
    return sums


def _answers(parts: list[dict], ends: np.ndarray, counts: np.ndarray, firsts: np.ndarray, targets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each part's share of what its entries were answered, in the order it asked."""
    for r, a, b in zip(parts, np.append(0, ends[:-1]), ends, strict=True):
        yield _batch(
            _SUMS, bucket=[r["bucket"]], chunk=[r["chunk"]], n=[b - a], counts=[_narrow(counts[:, a:b])], firsts=[np.packbits(firsts[a:b]).tobytes()],
            targets=[np.packbits(targets[a:b]).tobytes()], totals=[None],
        )


def _add_up(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums the counts of a bucket's keys and answers each part.

        The first part with a key is told so, and whether the target has it, so that a key is counted as one kind.
        """
        for parts in _runs(batches, "bucket"):
            every, ends, at, first = _union(parts)
            sums = _sums(parts, len(every), ends, at, width)
            yield from _answers(parts, ends, sums[:, at], first, first & (sums[0] > 0)[at])
            totals = [int((sums[0] > 0).sum()), int((sums[1] > 0).sum()), int(sums[0].sum()), int(sums[1].sum())]
            yield _batch(_SUMS, bucket=[parts[0]["bucket"]], chunk=[None], n=[None], counts=[None], firsts=[None], targets=[None], totals=[totals])

    return run


def _merge(width: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A node sends on what its parts have in common, once, cut for the next step."""
        for parts in _runs(batches, "node"):
            every, ends, at, _ = _union(parts)
            yield _parts(parts[0]["node"], every, _sums(parts, len(every), ends, at, width), step)

    return run


def _pass_on(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A node's parts, then what the node was answered: each part gets its entries' share, the first with a key what the node was told."""
        for both in _runs(batches, "node"):
            parts, told = [r for r in both if r["kind"] == 0], [r for r in both if r["kind"] == 1]
            _, ends, at, first = _union(parts)
            counts = np.concatenate([_wide(r["counts"], width * r["n"]).reshape(width, -1) for r in told], axis=1)
            firsts, targets = (np.concatenate([np.unpackbits(np.frombuffer(r[c], np.uint8), count=r["n"]) for r in told]).astype(bool) for c in ("firsts", "targets"))
            yield from _answers(parts, ends, counts[:, at], first & firsts[at], first & targets[at])

    return run


def _steps(buckets: int, fan: int) -> list[int]:
    """Hashes of a bucket at each step, the last having about ``buckets`` of them; a bucket is cut into ``fan`` at the next step."""
    fans = []
    while buckets > fan:
        fans.append(fan)
        buckets = -(-buckets // fan)
    fans.append(buckets)
    steps = [(1 << 64) // math.prod(fans) + 1]
    for f in reversed(fans[1:]):
        steps.insert(0, steps[0] * f)
    return [min(s, (1 << 64) - 1) for s in steps]


def _tasks(n: int) -> int:
    """Tasks for n chunks, nodes or buckets, which a task takes one after another."""
    return max(1, min(n, MOST_SINGLE), n // 64)


def _added(sent: DataFrame, senders: int, steps: list[int], width: int, fan: int, name: str) -> DataFrame:
    """What each part of ``sent`` is answered.  ``senders`` is how many parts a bucket has at most; ``sent`` is cut by the first step."""
    buckets = -(-(1 << 64) // steps[0])
    if len(steps) == 1:
        dealt = sent.repartition(_tasks(buckets), "bucket").sortWithinPartitions("bucket", "chunk")
        return _keep(dealt.mapInArrow(_add_up(width), _SUMS), name)
    # About ``fan`` senders of a bucket meet in a node.
    groups = -(-senders // fan)
    parts = sent.withColumn("node", F.pmod(F.xxhash64("chunk"), F.lit(groups)) * buckets + F.col("bucket"))
    tasks = _tasks(groups * buckets)
    up = parts.repartition(tasks, "node").sortWithinPartitions("node", "chunk").mapInArrow(_merge(width, steps[1]), _PART)
    above = _added(up, groups, steps[1:], width, fan, name)
    told = above.where("chunk IS NOT NULL").withColumn("kind", F.lit(1)).withColumnRenamed("chunk", "node").drop("totals")
    # The parts are made again rather than kept, without their counts.
    both = parts.drop("counts").withColumn("kind", F.lit(0)).unionByName(told, allowMissingColumns=True)
    down = both.repartition(tasks, "node").sortWithinPartitions("node", "kind", "bucket", "chunk").mapInArrow(_pass_on(width), _SUMS)
    return _keep(down.unionByName(above.where("chunk IS NULL")), name)


def _send_words(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of words and of histories, and the kinds after a history that this chunk was the first to have."""
        for run_ in _runs(batches, "chunk"):
            row, sums = run_[0], run_[1:]
            vocabulary, tokens, n = _keys(row["vocabulary"]), _wide(row["tokens"], row["n_words"]), row["n_kinds"]
            sizes = np.frombuffer(row["sizes"], np.int64)
            target, last = np.repeat(np.frombuffer(row["is_target"], np.uint8), sizes).astype(bool), np.cumsum(sizes)[sizes > 0] - 1
            as_word = [np.bincount(tokens[target], minlength=n), np.bincount(tokens, minlength=n)]
            as_history = [as_word[0] - np.bincount(tokens[last[target[last]]], minlength=n), as_word[1] - np.bincount(tokens[last], minlength=n)]
            as_history[0][0], as_history[1][0] = target[last].sum(), len(last)
            h, bits = _bigrams(row)[0], lambda c: [np.unpackbits(np.frombuffer(s[c], np.uint8), count=s["n"]) for s in sums]  # noqa: E731, B023
            kinds = [np.bincount(h[np.concatenate([*bits(c), h[:0]]).astype(bool)], minlength=n) for c in ("targets", "firsts")]
            yield _parts(row["chunk"], vocabulary, np.stack([*as_word, *as_history, *kinds]), step)

    return run


def _score(totals: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_ in _runs(batches, "chunk"):
            row, sums = run_[0], run_[1:]
            bigram = [_wide(s["counts"], 2 * s["n"]).reshape(2, -1) for s in sums if s["kind"] == 1]
            word = [_wide(s["counts"], 6 * s["n"]).reshape(6, -1) for s in sums if s["kind"] == 2]
            h, w, _, at, text = _bigrams(row)
            n = np.frombuffer(row["sizes"], np.int64)
            is_target = np.frombuffer(row["is_target"], np.uint8)
            losses = [np.zeros(len(n)), np.zeros(len(n))]
            if len(at):
                bigram, word = np.concatenate(bigram, axis=1), np.concatenate(word, axis=1)
                # A text's distinct bigrams, and its distinct histories and words by which they are found.
                own = np.unique(text * len(h) + at, return_counts=True)
                doc, pair, count = own[0] // len(h), own[0] % len(h), own[1]
                size, h, w = word.shape[1], h[pair], w[pair]
                _, by_h = np.unique(doc * size + h, return_inverse=True)
                words_, by_w = np.unique(doc * size + w, return_inverse=True)
                as_history, as_word = np.bincount(by_h, weights=count), np.bincount(by_w, weights=count)
                for m in (0, 1):
                    # What the text itself gave to the model is taken off.
                    mine = is_target if m == 0 else np.ones(len(n), np.int64)
                    gone = np.bincount(words_ // size, weights=word[m][words_ % size] == as_word, minlength=len(n))
                    kinds, every = totals[m] - mine * gone, totals[2 + m] - mine * n
                    mine = mine[doc]
                    after = word[2 + m][h] - mine * as_history[by_h]
                    after_kinds = word[4 + m][h] - mine * np.bincount(by_h, weights=bigram[m][pair] == count)[by_h]
                    some = every[doc] > 0
                    one = (word[m][w] - mine * as_word[by_w] + kinds[doc] / totals[1]) / np.where(some, every[doc] + kinds[doc], 1)
                    one = np.where(some, one, 1 / totals[1])
                    two = (bigram[m][pair] - mine * count + after_kinds * one) / np.maximum(after + after_kinds, 1)
                    losses[m] = np.bincount(doc, weights=-np.log(np.where(after > 0, two, one)) * count, minlength=len(n))
            none = n == 0
            means = [pa.array(x / np.maximum(n, 1), mask=none) for x in (*losses, losses[0] - losses[1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(n), *means], names=["id", "n_tokens", "target_loss", "background_loss", "ce_difference"]
            )

    return run


def _beside(chunks: DataFrame, sums: list[DataFrame], parts: int) -> DataFrame:
    """Each chunk, then what it was answered, in the order of the buckets."""
    held = chunks.withColumns({"kind": F.lit(0), "bucket": F.lit(0).cast("long")})
    for kind, s in enumerate(sums, 1):
        held = held.unionByName(s.where("chunk IS NOT NULL").withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    return held.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "bucket")


def _keep(df: DataFrame, name: str) -> DataFrame:
    """Keeps a table, without the shuffle files that led to it: nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return keep(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def cross_entropy_difference(
    docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_words: int = CHUNK_WORDS, bucket_keys: int = BUCKET_KEYS, fan: int = FAN
) -> DataFrame:
    """Scores every document against the documents whose ids (``target_id``) are given: ``n_tokens``, the mean loss per word of
    both models and ``ce_difference``, target less background."""
    # One way at every size: the documents are shuffled by id once, for they can be marked without sending all ids everywhere.
    ids = target_ids.select("target_id").where("target_id IS NOT NULL").distinct().hint("merge")
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    flagged = picked.join(ids, F.col("id") == F.col("target_id"), "left").select("id", "text", F.col("target_id").isNotNull().alias("is_target"))
    chunks = _keep(flagged.mapInArrow(_chunks(chunk_words), _CHUNK), "lm-chunks")
    n, n_words, n_kinds = chunks.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_kinds"), F.lit(0))).first()
    tasks, by_bigram, by_word = _tasks(n), _steps(max(1, -(-n_words // bucket_keys)), fan), _steps(max(1, -(-n_kinds // bucket_keys)), fan)
    bigrams = _added(chunks.mapInArrow(_send_bigrams(by_bigram[0]), _PART), n, by_bigram, 2, fan, "lm-bigrams")
    sent = _beside(chunks.drop("ids"), [bigrams.select("chunk", "bucket", "n", "firsts", "targets")], tasks).mapInArrow(_send_words(by_word[0]), _PART)
    each = _added(sent, n, by_word, 6, fan, "lm-words")
    totals = [x or 0 for x in each.agg(*[F.sum(F.col("totals")[i]) for i in range(4)]).first()]
    scored = _beside(chunks, [x.select("chunk", "bucket", "n", "counts") for x in (bigrams, each)], tasks)
    schema = "id long, n_tokens long, target_loss double, background_loss double, ce_difference double"
    return scored.mapInArrow(_score(totals), schema).withColumnRenamed("id", id_col)
