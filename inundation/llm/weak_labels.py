"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on the labels it gives.

A voter fires or not on a text: lexicons (stated ones, and words and stems mined from a bounded sample of labelled texts) and patterns.  With
16 voters a text's votes are one of 65,536 patterns, so the counts of all patterns over all documents are a small table however many
documents there are.  On it the label model is fitted by expectation-maximisation: how often each voter fires on toxic and on clean texts (its accuracy) and,
for the pairs that go together beyond that (its correlations), how often it fires given another voter: a tree of the
strongest conditional dependences.  Patterns of labelled rows outside the held-out fold keep their label.

The classifier is a logistic regression on word counts and style whose targets are the model's posteriors.  It is fitted on all
documents by Newton steps, whose sums are taken by partition.

Defined cases: a null or empty text gives no votes and is scored like any other.  Repeated rows are voted on and scored one by
one; a null id has no label, is held out by no fold and gets a score.  Ids whose labels differ have none.  Columns besides id and text
are ignored, whatever their names.  An empty table gives no rows.  Without labels nothing is mined and the model starts from the
votes alone; without any vote scores are the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inundation.llm.flat import SLICE_BYTES, Texts, byte_values, mix, runs, slices, span_hash, texts
from inundation.llm.shared import keep
from inundation.llm.sums import centre_and_scale, packed_rows, rows_of, sigmoid, steady, symmetric, vector_sum

FOLDS = 5
THRESHOLD = 0.5
#: Labelled texts of each kind from which is mined, at most; the words and stems that are looked at closely, and that are taken.
MOST_LABELLED = 10_000
CANDIDATES = 1024
MOST_WORDS = 48
#: A candidate is in at least so many toxic texts and so many times as often as in clean ones.
LEAST_TEXTS = 4
LEAST_RATIO = 4.0
#: Bytes of a stem, which starts a longer word.
STEMS = range(4, 10)

#: Lexicons of the stated voters.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "fool", "fools", "loser", "losers", "clown", "clowns", "imbecile", "dimwit", "halfwit",
    "jerk", "liar", "coward",
)
CONTEMPT = (
    "disgusting", "pathetic", "worthless", "useless", "trash", "garbage", "scum", "filth", "filthy", "vermin", "rubbish", "ugly", "vile",
    "despicable", "contemptible",
)
HARM = ("hate", "hated", "kill", "murder", "stab", "punch", "strangle", "destroy", "suffer", "rot")
OTHER_LANGUAGES = (
    "idiota", "imbécil", "estúpido", "estúpida", "basura", "escoria", "asqueroso", "dumm", "dummkopf", "trottel", "abschaum", "müll", "ekelhaft",
    "ordure", "crétin", "débile", "racaille", "dégoûtant",
)
SECOND_PERSON = ("you", "your", "youre", "yourself", "tu", "usted", "vous", "toi", "du", "dich", "dein")
STATED = (INSULTS, CONTEMPT, HARM, OTHER_LANGUAGES)

MINED_GROUPS = 6
VOTERS = (
    "insults", "contempt", "harm", "other languages", *[f"mined {i}" for i in range(MINED_GROUPS)], "two words", "three hits", "dense", "second person",
    "shouting", "masked",
)
DENSE = 0.005
#: How far before a word of a lexicon a second person counts.
NEAR = 3

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_STAR = np.arange(256) == ord("*")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

FEATURES = MOST_WORDS + len(STATED) + 8


def _word_hashes(t: Texts):
    w = runs(t, _LETTERS)
    return w, span_hash(byte_values(_LOWER[t.data]), w.start, w.end)


def _hashes(words_: tuple[str, ...]) -> np.ndarray:
    return _word_hashes(texts(pa.array(list(words_), pa.string())))[1]


def _features_of(t: Texts, w, whole: np.ndarray, kinds) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words (their places) and a hash for each kind of what they show: 0 for the word itself, n for a stem of n bytes."""
    values = None
    size = w.end - w.start
    for kind in kinds:
        if kind == 0:
            yield np.arange(len(whole)), whole
            continue
        longer = np.flatnonzero(size > kind)
        # A stem ends with a character.
        longer = longer[(t.data[w.start[longer] + kind] & 0xC0) != 0x80]
        values = byte_values(_LOWER[t.data]) if values is None else values
        yield longer, mix(span_hash(values, w.start[longer], w.start[longer] + kind) + np.uint64(kind))


@dataclass
class Lexicon:
    """What voters know, by hash: stated words, and mined words (kind 0) and stems (their length), best first."""

    mined: tuple[tuple[int, int], ...] = ()
    known: dict = field(init=False)
    person: np.ndarray = field(init=False)

    def __post_init__(self):
        entries = [(0, int(h), group, -1) for group, s in enumerate(STATED) for h in _hashes(s)]
        entries += [(kind, h, len(STATED) + i % MINED_GROUPS, i) for i, (kind, h) in enumerate(self.mined)]
        self.known = {}
        for kind in sorted({e[0] for e in entries}):
            mine = [e for e in entries if e[0] == kind]
            keys = np.unique(np.array([e[1] for e in mine], np.uint64))
            member, place = np.zeros((len(keys), len(STATED) + MINED_GROUPS), bool), np.full(len(keys), -1)
            for _, h, group, i in mine:
                at = np.searchsorted(keys, np.uint64(h))
                member[at, group] = True
                place[at] = max(place[at], i)
            self.known[kind] = keys, member, place
        self.person = np.sort(_hashes(SECOND_PERSON))


def _is_in(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_, values), max(len(sorted_) - 1, 0))
    return sorted_[at] == values, at


def evidence(t: Texts, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Votes (a flag per voter) and features of every text."""
    n = len(t)
    w, h = _word_hashes(t)
    text, n_words = w.text, np.maximum(w.per_text, 1)
    counts, single = np.zeros((n, len(STATED) + MINED_GROUPS), np.int64), np.zeros((n, MOST_WORDS))
    found = np.zeros(len(h), bool)
    for (at, key), (keys, member, place) in zip(_features_of(t, w, h, lexicon.known), lexicon.known.values(), strict=True):
        hit, which = _is_in(keys, key)
        at, which = at[hit], which[hit]
        found[at] = True
        for g in np.flatnonzero(member.any(axis=0)):
            counts[:, g] += np.bincount(text[at[member[which, g]]], minlength=n)
        mined = place[which] >= 0
        np.add.at(single, (text[at[mined]], place[which[mined]]), 1)
    where = np.flatnonzero(found)
    of = text[where]
    hits = np.bincount(of, minlength=n)
    order = np.lexsort((h[where], of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (h[where][order][1:] != h[where][order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order[fresh]], minlength=n)
    person = _is_in(lexicon.person, h)[0]
    near = np.zeros(len(where), bool)
    for k in range(1, NEAR + 1):
        before = np.maximum(where - k, 0)
        near |= (where >= k) & person[before] & (text[before] == of)
    near = np.bincount(of[near], minlength=n)
    letters, upper = t.per_text(_LETTERS[t.data]), t.per_text(_UPPER[t.data])
    marks = t.per_text(t.data == ord("!"))
    stars = runs(t, _STAR)
    padded = np.concatenate([_LETTERS[t.data], [False]])
    inside = ~np.isin(stars.start, t.offset[:-1]) & ~np.isin(stars.end, t.offset[1:])
    masked = np.bincount(stars.text[inside & padded[stars.start - 1] & padded[stars.end]], minlength=n)
    shout = (marks >= 3) & (2 * upper >= np.maximum(letters, 1))
    votes = np.column_stack([counts > 0, distinct >= 2, hits >= 3, hits >= DENSE * n_words + 1, near > 0, shout, masked > 0])
    style = [distinct, np.log1p(hits), 100 * hits / n_words, np.log1p(near), np.log1p(masked), upper / np.maximum(letters, 1), marks / n_words, np.log1p(w.per_text) / 10]
    return votes, np.column_stack([np.log1p(single), np.log1p(counts[:, : len(STATED)]), *style])


def held_out(id_col: str | Column) -> Column:
    """Rows that nothing learns a label from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``label_id`` and ``label`` of the ids outside the held-out fold, once each."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    one = known.groupBy(F.col(id_col).cast("long").alias("label_id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("_high"))
    return one.where("label = _high").select("label_id", F.col("label").cast("int").alias("label"))


def _sample(labels: DataFrame, most: int, seed: int) -> DataFrame:
    """At most about ``most`` ids of each label, those below a bound of their hash; all of them where they are no more."""
    counted = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    u = F.pmod(F.xxhash64(F.lit(seed), "label_id"), F.lit(1 << 30))
    bound = F.lit(0)
    for label, n in counted.items():
        bound = F.when(F.col("label") == label, int(min(1.0, most / n) * (1 << 30))).otherwise(bound)
    return labels.where(u < bound)


def _once(batch: pa.RecordBatch, t: Texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each kind of feature, every text with each of its features once."""
    w, h = _word_hashes(t)
    kinds = (0, *STEMS)
    for kind, (at, key) in zip(kinds, _features_of(t, w, h, kinds), strict=True):
        text = w.text[at]
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        first = np.ones(len(order), bool)
        first[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        yield kind, text[first], key[first]


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, t in slices(batches, "text", SLICE_BYTES):
        toxic = batch.column("label").to_numpy(zero_copy_only=False) == 1
        for kind, text, key in _once(batch, t):
            keys, at = np.unique(key, return_inverse=True)
            n, a = np.bincount(at, minlength=len(keys)), np.bincount(at, weights=toxic[text], minlength=len(keys)).astype(np.int64)
            columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(a), pa.array(n - a)]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "key", "n_toxic", "n_clean"])


def _which(candidates: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The candidates that each text has."""
        for batch, t in slices(batches, "text", SLICE_BYTES):
            lists: list[list[int]] = [[] for _ in range(len(batch))]
            for kind, text, key in _once(batch, t):
                for i, k in zip(text.tolist(), key.tolist(), strict=True):
                    if (kind, k) in candidates:
                        lists[i].append(candidates[kind, k])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(lists, pa.list_(pa.int32()))], names=["label", "has"])

    return run


def cover(toxic: np.ndarray, clean: np.ndarray, most: int, least: int = LEAST_TEXTS, ratio: float = LEAST_RATIO) -> list[int]:
    """Candidates (columns) that together are in most toxic texts and in few clean ones, chosen one after another.

    Each is the one that adds most, a clean text weighing ``ratio`` times its share; words of one group of copies add nothing to each other.
    """
    price = ratio * len(toxic) / max(len(clean), 1)
    chosen: list[int] = []
    toxic, clean = toxic.copy(), clean.copy()
    while len(chosen) < most:
        gain = toxic.sum(axis=0) - price * clean.sum(axis=0)
        best = int(gain.argmax()) if gain.size else 0
        if not gain.size or gain[best] < least:
            break
        chosen.append(best)
        toxic, clean = toxic[~toxic[:, best]], clean[~clean[:, best]]
    return chosen


def mine_words(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_labelled: int = MOST_LABELLED, most_words: int = MOST_WORDS, seed: int = 42
) -> tuple[tuple[int, int], ...]:
    """Words and stems (kind and hash) of toxic texts that clean ones seldom have, from a bounded sample of learnable labels.

    The sample's ids are broadcast (2 * ``most_labelled`` rows, about), so no text is shuffled; what comes to the driver are
    ``CANDIDATES`` counts and which of them the sample's texts have.
    """
    picked = keep(_sample(labels, most_labelled, seed), "toxic-sample")
    size = {r.label: r["count"] for r in picked.groupBy("label").count().collect()}
    n1, n0 = float(size.get(1, 0)), float(size.get(0, 0))
    if not n1 or not n0:
        return ()
    texts_of = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marked = keep(texts_of.join(F.broadcast(picked), F.col("id") == F.col("label_id")).select("text", "label"), "toxic-texts")
    counted = marked.mapInArrow(_count_features, "kind int, key long, n_toxic long, n_clean long").groupBy("kind", "key")
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    every = a + b
    term = lambda n, want: F.when(n > 0, n * F.log(n / want)).otherwise(0.0)
    tells = term(a, every * n1 / (n1 + n0)) + term(b, every * n0 / (n1 + n0))
    rare = (a >= LEAST_TEXTS) & (a / n1 >= LEAST_RATIO * b / n0)
    best = counted.agg(F.sum("n_toxic").alias("a"), F.sum("n_clean").alias("b")).where(rare).select("kind", "key", tells.alias("g"))
    # The shorter stem first among those that tell as much.
    top = best.orderBy(F.desc("g"), "kind", "key").limit(CANDIDATES).select("kind", "key").collect()
    unsigned = [(r.kind, r.key % (1 << 64)) for r in top]
    rows = marked.mapInArrow(_which({c: i for i, c in enumerate(unsigned)}), "label int, has array<int>").collect()
    has = {y: np.zeros((sum(r.label == y for r in rows), len(top)), bool) for y in (0, 1)}
    for y in (0, 1):
        for i, r in enumerate(r for r in rows if r.label == y):
            has[y][i, r.has] = True
    return tuple(unsigned[i] for i in cover(has[1], has[0], most_words))


def _featurise(lexicon: Lexicon):
    weight = 1 << np.arange(len(VOTERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in slices(batches, "text", SLICE_BYTES):
            votes, x = evidence(t, lexicon)
            mask = pa.array((votes * weight).sum(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), mask, packed_rows(x)], names=["id", "votes", "x"])

    return run


@dataclass
class LabelModel:
    """What the votes say: the share of toxic texts, each voter's firing given its parent and the class, and who the parents are.

    ``fires[y, j, v]`` is how likely voter j fires on class y where its parent did (v = 1) or not; without a parent (-1) both are the same.
    """

    prior: float
    parent: np.ndarray
    fires: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability that a text with these votes is toxic."""
        of = np.where(self.parent >= 0, votes[:, np.maximum(self.parent, 0)], 0).astype(int)
        j = np.arange(votes.shape[1])
        logs = []
        for y, p in ((0, 1 - self.prior), (1, self.prior)):
            f = self.fires[y][j, of]
            logs.append(np.log(p) + np.log(np.where(votes, f, 1 - f)).sum(axis=1))
        return sigmoid(logs[1] - logs[0])


def _spanning_forest(strength: np.ndarray, least: float) -> np.ndarray:
    """Parents in the forest of the strongest links that are at least ``least``; -1 for roots."""
    k = len(strength)
    group, links = list(range(k)), [[] for _ in range(k)]
    for s, i, j in sorted(((strength[i, j], i, j) for i in range(k) for j in range(i)), key=lambda e: (-e[0], e[1], e[2])):
        if s < least or group[i] == group[j]:
            continue
        old, new = group[j], group[i]
        group = [new if g == old else g for g in group]
        links[i].append(j)
        links[j].append(i)
    parent, done = np.full(k, -1), [False] * k
    for root in range(k):
        todo = [] if done[root] else [root]
        done[root] = True
        while todo:
            i = todo.pop()
            for j in links[i]:
                if not done[j]:
                    parent[j], done[j] = i, True
                    todo.append(j)
    return parent


def fit_label_model(votes: np.ndarray, unknown: np.ndarray, clean: np.ndarray, toxic: np.ndarray, steps: int = 60, least: float = 2e-3) -> LabelModel:
    """Fits the model to distinct patterns of votes and how many texts without a label, labelled clean and labelled toxic have each.

    ``least`` is the conditional mutual information (nats) from which two voters count as correlated.
    """
    v, k = votes.astype(np.float64), votes.shape[1]
    n = max(float(unknown.sum() + clean.sum() + toxic.sum()), 1.0)
    given = clean.sum() > 0 and toxic.sum() > 0
    # Voters are taken to be better than chance: with no label at hand, two votes are a first sign.
    share = np.where(votes.sum(axis=1) >= 2, 0.9, 0.05)
    model = None
    for step in range(steps):
        soft = np.zeros(len(v)) if model is None and given else unknown
        weight = np.stack([clean + soft * (1 - share), toxic + soft * share])
        size = weight.sum(axis=1)
        one = weight @ v
        both = np.stack([(v * w[:, None]).T @ v for w in weight])
        # Two pseudo-texts for each class keep probabilities off 0 and 1.
        marginal = (one + 0.5) / (size + 1)[:, None]
        info = np.zeros((k, k))
        phi = np.zeros((2, k, k))
        for y in (0, 1):
            p11 = both[y] / max(size[y], 1e-9)
            p1 = one[y] / max(size[y], 1e-9)
            cells = ((p11, p1[:, None] * p1), (p1[:, None] - p11, p1[:, None] * (1 - p1)), (p1 - p11, (1 - p1)[:, None] * p1), (1 - p1[:, None] - p1 + p11, (1 - p1)[:, None] * (1 - p1)))
            for p, q in cells:
                ok = (p > 1e-12) & (q > 1e-12)
                info += size[y] / size.sum() * np.where(ok, p * np.log(np.where(ok, p, 1) / np.where(ok, q, 1)), 0)
            spread = np.sqrt(np.outer(p1 * (1 - p1), p1 * (1 - p1)))
            phi[y] = np.where(spread > 1e-12, (p11 - np.outer(p1, p1)) / np.maximum(spread, 1e-12), 0)
        if step < steps // 3:
            parent = _spanning_forest(info, least)  # later steps keep it, so that they converge
        fires = np.empty((2, k, 2))
        for y in (0, 1):
            for j in range(k):
                i = parent[j]
                if i < 0:
                    fires[y, j] = marginal[y, j]
                else:
                    # Counts given the parent, drawn to the voter's own rate by one text.
                    fires[y, j, 1] = (both[y, i, j] + marginal[y, j]) / (one[y, i] + 1)
                    fires[y, j, 0] = (one[y, j] - both[y, i, j] + marginal[y, j]) / (size[y] - one[y, i] + 1)
        fires = np.clip(fires, 1e-6, 1 - 1e-6)
        model = LabelModel(float(np.clip(size[1] / size.sum(), 1 / (n + 2), 1 - 1 / (n + 2))), parent, fires, phi)
        before, share = share, model.posterior(votes.astype(bool))
        if step > steps // 3 and np.abs(before - share).max() < 1e-9:
            break
    return model


@dataclass
class Linear:
    weight: np.ndarray
    bias: float
    centre: np.ndarray
    scale: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(((x - self.centre) / self.scale) @ self.weight + self.bias)


def newton_sums(x: np.ndarray, target: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Gradient and upper triangle of the Hessian of the logistic loss, summed over rows; the last feature is 1."""
    p = sigmoid(x @ theta)
    hessian = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate([x.T @ (p - target), hessian[np.triu_indices(x.shape[1])]])


def fit_linear(rows: DataFrame, posterior: np.ndarray, steps: int = 12, decay: float = 1e-3, enough: float = 1e-7) -> Linear:
    """Logistic regression of the posterior of a row's ``votes`` on its ``x``, over all rows, by Newton steps."""
    centre, scale, n = centre_and_scale(rows, "x", FEATURES, 1e-2)
    width = FEATURES + 1
    theta = np.zeros(width)
    for _ in range(steps if n else 0):

        def sums(b: pa.RecordBatch, theta=theta) -> np.ndarray:
            x = np.column_stack([(rows_of(b.column("x"), FEATURES) - centre) / scale, np.ones(len(b))])
            return newton_sums(x, posterior[b.column("votes").to_numpy()], theta)

        s = vector_sum(rows.select("votes", "x"), sums, width + width * (width + 1) // 2) / n
        ridge = np.append(np.full(FEATURES, decay), 1e-9)
        gradient = s[:width] + ridge * theta
        move = np.linalg.solve(symmetric(s[width:], width) + np.diag(ridge), gradient)
        theta = theta - move * min(1.0, 4 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < enough:
            break
    theta = steady(theta, 6)
    return Linear(theta[:-1], float(theta[-1]), centre, scale)


def vote_counts(rows: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The patterns there are, as flags, and how many rows without a label, clean and toxic have each; 3 * 65,536 rows at most."""
    marked = rows.select("id", "votes").join(labels, F.col("id") == F.col("label_id"), "left")
    found = marked.groupBy("votes", "label").count().collect()
    masks = np.array(sorted({r.votes for r in found}), np.int64)
    place = {m: i for i, m in enumerate(masks.tolist())}
    counts = np.zeros((3, len(masks)))
    for r in found:
        counts[0 if r.label is None else 1 + r.label, place[r.votes]] += r["count"]
    return (masks[:, None] >> np.arange(len(VOTERS))) & 1 == 1, *counts


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **mining) -> DataFrame:
    """``held_out``, ``score`` (0 to 1), ``predicted`` and ``posterior``, what the votes alone say, of every row."""
    known = keep(learnable(labels, id_col), "toxic-labels")
    lexicon = Lexicon(mine_words(docs, known, id_col, text_col, **mining))
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = keep(picked.mapInArrow(_featurise(lexicon), "id long, votes int, x binary"), "votes")
    votes, *counts = vote_counts(rows, known)
    posterior = np.zeros(1 << len(VOTERS))
    if len(votes):
        model = fit_label_model(votes, *counts)
        posterior[(votes << np.arange(len(VOTERS))).sum(axis=1)] = model.posterior(votes)
    linear = fit_linear(rows, posterior)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = linear.score(rows_of(b.column("x"), FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s), pa.array(posterior[b.column("votes").to_numpy()])], names=["id", "score", "posterior"])

    scored = rows.mapInArrow(score, "id long, score double, posterior double")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", predicted, "posterior")
