"""Weak supervision: voters against plain counts, the label model on simulated votes, the classifier on held-out labels."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inundation.llm import flat, queries, sums, weak_labels

TEXTS = [
    "You are a stupid IDIOT, and pathetic.", None, "", " \n ", "Your words, garbage! f**k and sh*t but **bold** *", "SHUT UP!! NOW!! KILL", "die stupid stupid moron clown trash",
    "escoria imbécil réeuxan réeux réeuxment", "you " + "word " * 50 + "fool", "idiot" * 4000, "fool " * 300_000, "no harm " * 10, "you\nidiot", "a fool. You",
]
WORD = re.compile(r"[A-Za-z\u0080-\U0010ffff]+")


def lexicon():
    stem = weak_labels.mix(flat.span_hash(flat.byte_values(np.frombuffer("réeux".encode(), np.uint8)), np.array([0]), np.array([6])) + np.uint64(6))
    return weak_labels.Lexicon(((6, int(stem[0])), (0, int(weak_labels._hashes(("word",))[0]))))


def plain_votes(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    shown = []
    for w in words:
        groups = [g for g, s in enumerate(weak_labels.STATED) if w in s]
        groups += [4] if len(w.encode()) > 6 and w.encode().startswith("réeux".encode()) else []
        groups += [5] if w == "word" else []
        shown.append(groups)
    hits = [i for i, g in enumerate(shown) if g]
    fired = {g for groups in shown for g in groups}
    near = any(w in weak_labels.SECOND_PERSON for i in hits for w in words[max(0, i - weak_labels.NEAR) : i])
    upper, letters = len(re.findall("[A-Z]", text or "")), sum(len(w.encode()) for w in WORD.findall(text or ""))
    votes = [g in fired for g in range(10)]
    votes += [len({words[i] for i in hits}) >= 2, len(hits) >= 3, len(hits) >= weak_labels.DENSE * max(len(words), 1) + 1, near]
    votes += [(text or "").count("!") >= 3 and 2 * upper >= max(letters, 1), bool(re.search(r"[A-Za-z\u0080-\U0010ffff]\*+[A-Za-z\u0080-\U0010ffff]", text or ""))]
    return votes


def test_votes_equal_plain_ones():
    votes, x = weak_labels.evidence(flat.texts(pa.array(TEXTS)), lexicon())
    assert votes.tolist() == [plain_votes(t) for t in TEXTS] and len(weak_labels.VOTERS) == votes.shape[1] == 16
    assert x.shape == (len(TEXTS), weak_labels.FEATURES) and np.isfinite(x).all() and not x[1].any() and not x[2].any()
    alone = np.concatenate([weak_labels.evidence(flat.texts(pa.array([t], pa.string())), lexicon())[1] for t in TEXTS])
    assert np.array_equal(alone, x)


def _simulated(rng, n, copies=()):
    """Voters with known rates; each of ``copies`` repeats the one before it, mostly."""
    toxic = rng.random(n) < 0.2
    high, low = np.array([0.8, 0.7, 0.6, 0.75, 0.5, 0.65]), np.array([0.05, 0.1, 0.02, 0.08, 0.03, 0.3])
    votes = rng.random((n, 6)) < np.where(toxic[:, None], high, low)
    for j in copies:
        same = rng.random(n) < 0.9
        votes[:, j] = np.where(same, votes[:, j - 1], votes[:, j])
    return toxic, votes, high, low


def _patterns(votes, known=None):
    keys, at = np.unique(votes @ (1 << np.arange(votes.shape[1])), return_inverse=True)
    flags = (keys[:, None] >> np.arange(votes.shape[1])) & 1 == 1
    known = np.zeros(len(votes), int) if known is None else known
    return at, flags, [np.bincount(at[known == k], minlength=len(keys)).astype(float) for k in range(3)]


def test_label_model_finds_accuracies_without_labels():
    toxic, votes, high, low = _simulated(np.random.default_rng(1), 40_000)
    at, flags, counts = _patterns(votes)
    m = weak_labels.fit_label_model(flags, *counts)
    assert abs(m.prior - 0.2) < 0.02
    firing = m.fires.mean(axis=2)
    assert np.abs(firing[1] - high).max() < 0.05 and np.abs(firing[0] - low).max() < 0.03
    assert ((m.posterior(votes) >= 0.5) == toxic).mean() > 0.95


def test_label_model_finds_correlated_voters():
    rng = np.random.default_rng(2)
    toxic, votes, *_ = _simulated(rng, 40_000, copies=(1, 5))
    known = np.where(rng.random(len(toxic)) < 0.1, 1 + toxic, 0)
    at, flags, counts = _patterns(votes, known)
    m = weak_labels.fit_label_model(flags, *counts)
    links = {frozenset((j, int(p))) for j, p in enumerate(m.parent) if p >= 0}
    assert {frozenset((0, 1)), frozenset((4, 5))} <= links and m.correlation[0, 0, 1] > 0.5 > abs(m.correlation[0, 2, 3])
    # A copy adds nothing: the two voters together say hardly more than one of them does.
    alone = m.posterior(np.array([[1, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0], [1, 0, 0, 1, 0, 0]], bool))
    assert alone[1] < alone[2]


def test_posterior_is_bayes_rule():
    fires = np.array([[[0.1, 0.1], [0.2, 0.7]], [[0.6, 0.6], [0.3, 0.9]]])
    m = weak_labels.LabelModel(0.25, np.array([-1, 0]), fires, np.zeros((2, 2, 2)))
    up, down = 0.25 * 0.6 * 0.9, 0.75 * 0.1 * 0.7
    assert np.isclose(m.posterior(np.array([[True, True]]))[0], up / (up + down))
    up, down = 0.25 * 0.4 * 0.3, 0.75 * 0.9 * 0.2
    assert np.isclose(m.posterior(np.array([[False, True]]))[0], up / (up + down))


def test_newton_sums_are_the_derivatives_of_the_loss():
    rng = np.random.default_rng(3)
    x, y, theta = rng.normal(size=(50, 4)), rng.random(50), rng.normal(size=4)
    loss = lambda v: (np.logaddexp(0, x @ v) - y * (x @ v)).sum()
    s = weak_labels.newton_sums(x, y, theta)
    step = 1e-5 * np.eye(4)
    assert np.allclose(s[:4], [(loss(theta + e) - loss(theta - e)) / 2e-5 for e in step], atol=1e-5)
    want = np.array([(weak_labels.newton_sums(x, y, theta + e)[:4] - weak_labels.newton_sums(x, y, theta - e)[:4]) / 2e-5 for e in step])
    assert np.allclose(sums.symmetric(s[4:], 4), want, atol=1e-4)


@pytest.mark.parametrize("parts", [1, 7])
def test_linear_fit_is_the_optimum_however_rows_are_dealt(spark, parts):
    rng = np.random.default_rng(4)
    x = np.zeros((400, weak_labels.FEATURES))
    x[:, :3] = rng.normal(size=(400, 3))
    votes = rng.integers(0, 4, 400)
    rows = [(int(v), bytes(r)) for v, r in zip(votes, (a.tobytes() for a in x.astype(np.float32)), strict=True)]
    df = spark.createDataFrame(rows, "votes int, x binary").repartition(parts)
    posterior = np.array([0.1, 0.9, 0.4, 0.7])
    m = weak_labels.fit_linear(df, posterior)
    z = np.column_stack([(x.astype(np.float32) - m.centre) / m.scale, np.ones(400)])
    gradient = weak_labels.newton_sums(z, posterior[votes], np.append(m.weight, m.bias))[: weak_labels.FEATURES + 1] / 400
    assert np.abs(gradient + np.append(1e-3 * m.weight, 0)).max() < 1e-5


def test_cover_takes_one_word_of_a_group_of_copies():
    toxic, clean = np.zeros((100, 5), bool), np.zeros((200, 5), bool)
    toxic[:60, [0, 1, 2]] = True  # copies: three words say the same
    toxic[60:90, 3] = True
    toxic[:, 4] = clean[:, 4] = True
    clean[:3, 3] = True
    assert weak_labels.cover(toxic, clean, 10) == [0, 3]
    assert weak_labels.cover(toxic[:0], clean, 10) == [] and weak_labels.cover(toxic[:, :0], clean[:, :0], 10) == []


def test_held_out_rows_are_classified_and_their_labels_not_read(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op11_weak_labels(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    changed = labels.withColumn("toxic", F.when(weak_labels.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [{r.doc_id: r.score for r in weak_labels.classify(docs, x).collect()} for x in (labels, changed)]
    assert scores[0] == scores[1]


def test_odd_rows_and_empty_tables(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "you idiot"), (None, None)]
    clash = {c: F.lit("clash") for c in ("id", "label", "label_id", "votes", "x", "score", "posterior")}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash)
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (4, 1), (6, 1), (11, 0), (None, 1), (8, None), (9, 1)], "doc_id long, toxic int").withColumn("n_toxic", F.lit(1))
    got = weak_labels.classify(docs, labels).collect()
    assert sorted((r.doc_id, r.held_out) for r in got if r.doc_id is not None) == sorted((i, zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows if i is not None)
    assert sum(r.doc_id is None and not r.held_out for r in got) == 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    no_docs, no_labels = docs.limit(0), labels.limit(0)
    assert weak_labels.classify(no_docs, labels).count() == 0 and weak_labels.classify(docs, no_labels).count() == len(rows)
