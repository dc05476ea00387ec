"""Quality rules: statistics that simple rules judge, and an isolation forest over them.

``rule_statistics`` counts, ``fit_forest`` grows random trees on a sample, ``apply_rules`` scores every row and sets the threshold
from all labelled rows.

Defined cases: a null or empty text has no words, so all its counts are 0 and the base rule rejects it.  Rows that repeat are
judged alike, one by one; a null id is kept.  Columns besides the id and the text are ignored, whatever their names.  An empty
table gives no rows; without labels nothing is rejected by the forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inundation.llm.flat import SLICE_BYTES, mix, lines, slices, span_hash, words
from inundation.llm.shared import keep

#: Fixed values of the rules: symbols, words in a repeated window, fewest words, largest share of repeated words.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: The forest: trees, rows drawn for each tree, and so the largest sample that is ever gathered (25,600 rows).
TREES = 100
TREE_ROWS = 256
#: The threshold keeps all but this share of the labelled good rows that pass the base rule.
MOST_LOST = 0.002
SCORE_STEPS = 10_000
#: What a text's shares are drawn to where it is short: so many plain words and lines, characters in a word and share of capitals.
PRIOR_WORDS = 20
PRIOR_LINES = 2
PLAIN_WORD_CHARS = 5
PLAIN_UPPER = 0.03

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper"]

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))


def _of_text(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return mix(values + mix(text.astype(np.uint64) + np.uint64(1)))


def count_repeats(word_hashes: np.ndarray, w, n_texts: int, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text that lie in a run of ``window`` words found at least twice in it."""
    at = w.windows(window)
    if not len(at):
        return np.zeros(n_texts, np.int64)
    text = w.text
    key = _of_text(span_hash(word_hashes, at, at + window), text[at])
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(word_hashes) + 1, np.int64)
    edge[at[twice]] += 1
    edge[at[twice] + window] -= 1  # each index occurs once at most, so plain indexing adds right
    return np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=n_texts)


def count_dup_lines(t, byte_values: np.ndarray, w) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of the text, and all lines with a word."""
    row = lines(t)
    has_word = np.searchsorted(w.start, row.end) > np.searchsorted(w.start, row.start)
    start, end, text = row.start[has_word], row.end[has_word], row.text[has_word]
    key = _of_text(span_hash(byte_values, start, end), text)
    _, first = np.unique(key, return_index=True)
    total = np.bincount(text, minlength=len(t))
    return total - np.bincount(text[first], minlength=len(t)), total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, t in slices(batches, "text", SLICE_BYTES):
        w, values, n = words(t), t.byte_values(), len(t)
        inside = np.zeros(len(t.data) + 1, np.int8)
        inside[w.start] = 1
        inside[w.end] -= 1
        new_char = (t.data & 0xC0) != 0x80
        dup, with_word = count_dup_lines(t, values, w)
        found = {
            "n_words": w.per_text,
            "word_chars": t.per_text(new_char & (np.cumsum(inside[:-1], dtype=np.int8) > 0)),
            "n_symbols": t.per_text(_IS_SYMBOL[t.data]),
            "n_dup_lines": dup,
            "n_repeat_words": count_repeats(span_hash(values, w.start, w.end), w, n),
            "n_lines": with_word,
            "n_chars": t.per_text(new_char),
            "n_upper": t.per_text(_IS_UPPER[t.data]),
        }
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *[pa.array(found[c].astype(np.int64)) for c in COUNTS]], names=["id", *COUNTS]
        )


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``COUNTS``."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return picked.mapInArrow(_count, schema).withColumnRenamed("id", id_col)


def _features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Shares, so that a long text is no outlier for its length alone, nor a short one by chance.

    Each text counts as if it had ``PRIOR_WORDS`` plain words more, in ``PRIOR_LINES`` lines.
    """
    n_words, n_lines = counts["n_words"] + PRIOR_WORDS, counts["n_lines"] + PRIOR_LINES
    plain_chars = PLAIN_WORD_CHARS * PRIOR_WORDS
    return np.column_stack(
        [
            (counts["word_chars"] + plain_chars) / n_words,
            counts["n_symbols"] / n_words,
            counts["n_dup_lines"] / n_lines,
            counts["n_repeat_words"] / n_words,
            (counts["n_upper"] + PLAIN_UPPER * plain_chars) / (counts["n_chars"] + plain_chars),
        ]
    ).astype(np.float64)


def mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth at which a search in a random binary tree of n rows ends."""
    n = np.asarray(n, np.float64)
    many = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(many - 1) + np.euler_gamma) - 2 * (many - 1) / many, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays, all of one shape: the children of node i are 2 i + 1 and 2 i + 2; a leaf has feature -1."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    rows: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; near 1 where random splits isolate a row early."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(feature) + 1))):
                f = feature[node]
                right = x[rows, np.maximum(f, 0)] >= split[node]
                node = np.where(f < 0, node, 2 * node + 1 + right)
            total += path[node]
        return np.exp2(-total / max(len(self.feature), 1) / mean_path(max(self.rows, 2)))


def grow_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 42) -> Forest:
    rng = np.random.default_rng(seed)
    rows = max(1, min(rows, len(x)))
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    size = 2 ** (depth + 1) - 1
    feature, split, path = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees if len(x) else 0):
        todo = [(0, 0, x[rng.choice(len(x), rows, replace=False)])]
        while todo:
            node, level, part = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            can = np.flatnonzero(high > low)
            if level == depth or len(part) < 2 or not len(can):
                path[t, node] = level + mean_path(len(part))
                continue
            f = rng.choice(can)
            # Above the least value, so that both sides get a row.
            at = high[f] - rng.random() * (high[f] - low[f])
            feature[t, node], split[t, node] = f, at
            right = part[:, f] >= at
            todo += [(2 * node + 1, level + 1, part[~right]), (2 * node + 2, level + 1, part[right])]
    return Forest(feature, split, path, rows)


def fit_forest(stats: DataFrame, id_col: str = "doc_id", trees: int = TREES, rows: int = TREE_ROWS, seed: int = 42) -> Forest:
    """Grows the trees on ``trees * rows`` documents, those with the smallest hashes of their id."""
    # Rows below a bound of their hash, a fifth more than are drawn, so that partitions don't each send a whole sample.
    share, u = 1.2 * trees * rows / max(stats.count(), 1), F.xxhash64(F.lit(seed), id_col)
    few = stats if share >= 1 else stats.where(u < int(share * (1 << 64)) - (1 << 63))
    drawn = few.orderBy(u, *COUNTS).limit(trees * rows).select(*COUNTS).toPandas()
    return grow_forest(_features({c: drawn[c].to_numpy(np.float64) for c in COUNTS}), trees, rows, seed)


def with_scores(stats: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``anomaly``, the forest's score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _features({c: b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in COUNTS})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.score(x))], names=[*b.schema.names, "anomaly"])

    return stats.mapInArrow(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema) + ", anomaly double")


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def calibrate(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", most_lost: float = MOST_LOST) -> float:
    """The smallest step of the score above which at most ``most_lost`` of the good labelled rows lie, over all of them."""
    good = labels.where("quality = 1").select(F.col(id_col).alias("label_id"))
    judged = scored.where(~base_failed()).join(good, F.col(id_col) == F.col("label_id"))
    steps = judged.groupBy(F.floor(F.col("anomaly") * SCORE_STEPS).alias("step")).count().toPandas().sort_values("step")
    if not len(steps):
        return float("inf")
    left = steps["count"].sum() - steps["count"].cumsum()
    return float(steps["step"][left <= most_lost * steps["count"].sum()].iloc[0] + 1) / SCORE_STEPS


def apply_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES,
    rows: int = TREE_ROWS, most_lost: float = MOST_LOST, seed: int = 42,
) -> DataFrame:
    """Counts, ``base_failed``, ``anomaly``, the threshold and the verdict ``kept`` of every document."""
    stats = keep(rule_statistics(docs, id_col, text_col), "rules")
    scored = with_scores(stats, fit_forest(stats, id_col, trees, rows, seed))
    threshold = calibrate(scored, labels, id_col, most_lost)
    failed = base_failed()
    return scored.withColumns(
        {"threshold": F.lit(threshold), "base_failed": failed, "kept": ~failed & (F.col("anomaly") < threshold)}
    )
