"""Quality classifier from positive and unlabelled rows.

A linear model on text statistics is fitted by the non-negative unbiased risk: trusted positives, unlabelled web text and the
share of positives estimated from labelled rows.  No negative row is ever shown to it.  Unlabelled rows are in the risk without exception:
each Newton step takes their sums by partition.

Defined cases: a null or empty text has the features of a text without characters and gets a score like any other.  Repeated
rows are scored one by one; a null id is held out by no fold and gets a score.  Columns besides id and text are ignored, whatever
their names.  An empty table gives no rows.  Without trusted positives or unlabelled rows every score is the prior (0.5 if there
is no labelled row).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inundation.llm.flat import SLICE_BYTES, slices, span_hash, words
from inundation.llm.shared import keep
from inundation.llm.sums import centre_and_scale, packed_rows, rows_of, sigmoid, steady, symmetric, vector_sum
from inundation.llm.text_rules import count_dup_lines, count_repeats

#: About how many trusted positives the fit gathers at most; unlabelled rows stay where they are.
MOST_POSITIVE = 20_000
FOLDS = 5
THRESHOLD = 0.3
#: Newton steps at most, how far one goes in any weight, and the fall of the risk below which the fit ends.
STEPS = 15
MOST_STEP = 2.0
ENOUGH = 1e-4

#: Character classes whose shares are features: bytes 33 to 64 and 91 to 96, 123 to 126 one by one, then groups.
_SINGLE = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
_CLASS = np.zeros(256, np.int64)
for _i, _b in enumerate(_SINGLE):
    _CLASS[_b] = 6 + _i
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[128:] = 5
CLASSES = 6 + len(_SINGLE)
FEATURES = CLASSES + 6


def features_of(t) -> np.ndarray:
    """A row of ``FEATURES`` numbers per text."""
    n, w, values = len(t), words(t), t.byte_values()
    text_of_byte = np.repeat(np.arange(n), np.diff(t.offset))
    classes = np.bincount(text_of_byte * CLASSES + _CLASS[t.data], minlength=n * CLASSES).reshape(n, CLASSES)
    n_words = np.maximum(w.per_text, 1)
    hashes = span_hash(values, w.start, w.end)
    text = w.text
    again = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    dup, with_word = count_dup_lines(t, values, w)
    # Shares of rare characters are told apart on a root scale.
    return np.column_stack(
        [
            np.sqrt(classes / np.maximum(np.diff(t.offset), 1)[:, None]),
            np.bincount(text[1:][again], minlength=n) / n_words,
            count_repeats(hashes, w, n) / n_words,
            dup / np.maximum(with_word, 1),
            np.bincount(text, weights=w.end - w.start, minlength=n) / n_words / 10,
            np.log1p(w.per_text) / 10,
            w.per_text > 0,
        ]
    ).astype(np.float32)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, t in slices(batches, "text", SLICE_BYTES):
        x = features_of(t)
        yield pa.RecordBatch.from_arrays([batch.column("id"), packed_rows(x)], names=["id", "x"])


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``x``, the features as 32-bit floats."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_featurise, "id long, x binary")


def held_out(id_col: str | Column) -> Column:
    """Rows that the fit never learns a label from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Linear:
    weight: np.ndarray
    bias: float
    centre: np.ndarray
    scale: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(((x - self.centre) / self.scale) @ self.weight + self.bias)


def unlabelled_sums(x: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """What unlabelled rows add to the risk as negatives, to its gradient and to the upper triangle of its Hessian; the last feature is 1."""
    z = x @ theta
    p = sigmoid(z)
    hessian = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate([[np.logaddexp(0, z).sum()], x.T @ p, hessian[np.triu_indices(x.shape[1])]])


def nnpu_step(positive: np.ndarray, sums: np.ndarray, n: int, theta: np.ndarray, prior: float, decay: float) -> tuple[float, np.ndarray]:
    """The risk at ``theta``, from the ``n`` unlabelled rows' sums, and the Newton step that lowers it.

    The risk is ``prior R_p+ + max(0, R_u- - prior R_p-)`` for the logistic loss.  Where the estimate of the negatives' risk falls below
    zero, the step goes against it, as the method has it.
    """
    width = len(theta)
    z = positive @ theta
    ridge = np.append(np.full(width - 1, decay), 1e-9)
    as_negative = sums[0] / n - prior * np.logaddexp(0, z).mean()
    risk = prior * np.logaddexp(0, -z).mean() + max(0.0, as_negative) + 0.5 * float(ridge @ theta**2)
    to_positive = prior * positive.T @ (sigmoid(z) - 1) / len(z)
    to_negative = sums[1 : 1 + width] / n - prior * positive.T @ sigmoid(z) / len(z)
    gradient = to_positive + to_negative + ridge * theta if as_negative >= 0 else -to_negative
    # The logistic loss is convex in the sum of both parts, whose curvature is that of the unlabelled rows.
    step = np.linalg.solve(symmetric(sums[1 + width :], width) / n + np.diag(ridge), gradient)
    return risk, step * min(1.0, MOST_STEP / max(float(np.abs(step).max()), 1e-12))


def fit_nnpu(positive: np.ndarray, unlabelled: DataFrame, prior: float, steps: int = STEPS, decay: float = 1e-3) -> Linear:
    """Minimises the non-negative risk over all rows of ``unlabelled`` (``x``), whose centre, scale and sums are taken by partition."""
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    start = float(np.log(prior / (1 - prior)))
    centre, scale, n = centre_and_scale(unlabelled, "x", FEATURES, 1e-2)
    if not len(positive) or not n:
        return Linear(np.zeros(FEATURES), start, np.zeros(FEATURES), np.ones(FEATURES))
    width = FEATURES + 1
    p = np.column_stack([(positive - centre) / scale, np.ones(len(positive))])
    theta = np.append(np.zeros(FEATURES), start)
    best = (np.inf, theta)
    for _ in range(steps):

        def sums(b: pa.RecordBatch, theta=theta) -> np.ndarray:
            return unlabelled_sums(np.column_stack([(rows_of(b.column(0), FEATURES) - centre) / scale, np.ones(len(b))]), theta)

        risk, step = nnpu_step(p, vector_sum(unlabelled.select("x"), sums, 1 + width + width * (width + 1) // 2), n, theta, prior, decay)
        done = best[0] - risk < ENOUGH * abs(risk) and risk <= best[0]
        if risk < best[0]:
            best = (risk, theta)
        if done:
            break
        theta = theta - step
    theta = steady(best[1], 6)
    return Linear(theta[:-1], float(theta[-1]), centre, scale)


def _drawn(rows: DataFrame, most: int, seed: int) -> np.ndarray:
    """About ``most`` rows, those below a bound of their hash; all where they are no more."""
    n = rows.count()
    share = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < int(min(1.0, most / max(n, 1)) * (1 << 30))
    x = rows.where(share).orderBy(F.xxhash64(F.lit(seed), "id"), "x").select("x").toPandas()["x"]
    return np.frombuffer(b"".join(map(bytes, x)), np.float32).reshape(-1, FEATURES).astype(np.float64)


def fit_quality(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", most_positive: int = MOST_POSITIVE, seed: int = 42) -> Linear:
    """Fits on about ``most_positive`` good rows outside the held-out fold and all unlabelled rows.

    The prior is the share of good rows among all labelled ones outside the fold.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).select(F.col(id_col).alias("label_id"), "quality")
    learn = known.where(~held_out("label_id"))
    prior = learn.agg(F.avg("quality")).first()[0]
    good = learn.where("quality = 1").select("label_id").distinct()
    positive = _drawn(features.join(good, F.col("id") == F.col("label_id"), "left_semi"), most_positive, seed)
    unlabelled = keep(features.join(known, F.col("id") == F.col("label_id"), "left_anti").select("x"), "unlabelled")
    return fit_nnpu(positive, unlabelled, 0.5 if prior is None else prior)


def score_quality(features: DataFrame, model: Linear) -> DataFrame:
    """``id`` and ``score``, 0 to 1."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = rows_of(b.column("x"), FEATURES)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(model.score(x).astype(np.float64))], names=["id", "score"])

    return features.mapInArrow(score, "id long, score double")


def score_rows(docs: DataFrame, model: Linear, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows themselves with their score, in one pass and without a shuffle."""
    names = [c for c in docs.columns if c != score_col]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in slices(batches, text_col, SLICE_BYTES):
            score = pa.array(model.score(features_of(t)).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=schema.names)

    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    features = keep(text_features(docs, id_col, text_col), "quality")
    scored = score_quality(features, fit_quality(features, labels, id_col, **fit))
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
