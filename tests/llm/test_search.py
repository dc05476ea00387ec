"""Ranked lexical search against a plain version of it."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inundation.llm import best_position, flat

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = [
    (1, "The quick brown fox"), (2, "the the the FOX"), (3, None), (4, ""), (5, " ,.; "), (6, "quick quick"), (6, "quick quick"), (7, "quick quick"),
    (None, "brown fox no id"), (8, "Éa éa ÉA 中文 fox_fox fox-9"), (9, "lazy dog " * 3000), (10, "nospaces" * 4000), (11, "fox"), (12, "dog, fox. DOG!"),
]
ITEMS = [
    (1, "quick fox"), (2, "the lazy Dog"), (3, None), (4, ""), (5, "never heard"), (6, "fox"), (6, "brown"), (None, "éa 中文 9"), (7, "fox fox FOX quick"),
    (8, "nospaces the"),
]


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **how):
    return sorted((tuple(r) for r in best_position.search(docs, items, **how).collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"k": 2}, {"k": 3, "shard_bytes": 20, "first_shards": 2}, {"block_items": 2, "shard_bytes": 1}])
def test_odd_rows(spark, how):
    clash = {c: F.lit("clash") for c in ("id", "item", "rank", "score", "shard", "terms", "term", "df")}
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns(clash)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns(clash)
    assert found(docs, items, **how) == plain(DOCS, ITEMS, how.get("k", best_position.K))


@pytest.mark.parametrize("how", [{}, {"shard_bytes": 50_000, "first_shards": 3}, {"k": 1, "shard_bytes": 50_000}])
def test_documents(spark, how):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = [[tuple(r) for r in t.select(c, "text").collect()] for t, c in ((docs, "doc_id"), (items, "item_id"))]
    assert found(docs, items, **how) == plain(*pairs, how.get("k", best_position.K))


def test_empty_tables_and_a_long_text(spark):
    docs, items = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame(DOCS, "doc_id long, text string")
    asked = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(docs, asked) == found(some, items) == found(docs, items) == []
    text = "fox trot " * 150_000 + "quick"
    assert len(text) > flat.SLICE_BYTES
    assert found(some.unionByName(spark.createDataFrame([(99, text)], some.schema)), asked) == plain([*DOCS, (99, text)], ITEMS, best_position.K)


def test_terms_match_the_regular_expression():
    texts = [t for _, t in DOCS]
    h, n = best_position.term_hashes(flat.texts(pa.array(texts)))
    want = [terms(t) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    by_term = {}
    for t, x in zip((t for w in want for t in w), h.tolist(), strict=True):
        assert by_term.setdefault(t, x) == x
    assert len(set(by_term.values())) == len(by_term)


def _shard(seed, docs=3000, vocabulary=40):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, vocabulary // 2, docs)
    term = np.concatenate([np.sort(rng.choice(vocabulary, s, replace=False)) for s in sizes])
    tf = rng.geometric(0.5, len(term))
    n = np.bincount(np.repeat(np.arange(docs), sizes), weights=tf, minlength=docs).astype(np.int64) + 1
    w = best_position.weigh(np.bincount(term, minlength=vocabulary), docs, int(n.sum()))
    return best_position.Shard(list(range(docs)), n, sizes, term, tf, w)


def test_reading_stops_at_the_best_positions():
    s = _shard(1)
    every = np.zeros((3000, 40), np.int64)
    every[s.doc, s.term] = s.impact
    for terms_ in (np.array([3]), np.array([1, 5, 9]), np.arange(12)):
        total = every[:, terms_].sum(axis=1)
        order = np.lexsort((np.arange(3000), -total))[:10]
        docs, scores, looked_up = s.search(terms_, 0, 10)
        assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
        assert looked_up <= (total > 0).sum() and (len(terms_) > 3 or looked_up < (total > 0).sum())
        # A floor at the kth score loses none that ties with it; one above the best score looks nothing up.
        assert s.search(terms_, int(scores[-1]), 10)[0].tolist() == order.tolist()
        assert s.search(terms_, int(total.max()) * 50, 10)[2] == 0
