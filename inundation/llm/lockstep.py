"""Alignment of two tokenizers' tokens by lockstep merging of their byte offsets.

Both sides cut space + text into byte ranges.  All documents of a chunk are merged at once: one state array holds a pair of pointers
per document, each step moves the pointer whose token ends first (both where the ends meet, which is a cut), and documents that
are through leave the array.  Between two cuts lies a group, and all its A tokens are linked with all its B tokens.

A linked pair of ids counts once per document.  Chunks add up their documents' pairs, so the rows that are summed over the corpus are
the distinct pairs of each chunk, in proportion to the input; their sums go back to the chunks by a join on the pair, and a chunk
puts them to its documents' links.  Nothing is gathered or broadcast but the two vocabularies.

Defined cases: a null or empty text has no tokens, nor has one whose joined token bytes on either side differ from space + text (with
the space mark U+2581 in it, say): zeros, and '' for the hash.  Rows that repeat are documents of their own, each counted; a null id stays
null.  A text of any length is one document of one chunk; a group of any size is multiplied out by its distinct ids.  Columns
besides id and text are ignored, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inundation.llm.flat import SLICE_BYTES, Texts, byte_values, slices, span_hash
from inundation.llm.shared import keep

#: Bytes of text from which a chunk is closed; links that are multiplied out and tokens that are written as text at a time.
CHUNK_BYTES = 4 << 20
BLOCK_LINKS = 1 << 18
BLOCK_TOKENS = 1 << 18
BATCH_PARTS = 1 << 14
#: Distinct parts that a worker remembers, at under 100 bytes each.
MEMO_PARTS = 1 << 19

_CHUNK = (
    "chunk long, ids array<long>, n_a binary, n_b binary, n_groups binary, n_links binary, hashes array<string>, "
    "pairs binary, pair_docs binary, sizes binary, entries binary, times binary"
)
_TOTALS = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


@dataclass(frozen=True)
class Tokenizers:
    """Both files' content and the bytes of every token, which tasks get with the code (under 5 MB)."""

    a_json: str
    b_model: bytes
    a_bytes: tuple[bytes, ...]
    b_bytes: tuple[bytes, ...]


def _byte_of_letter() -> dict[str, int]:
    """Byte-level alphabets show printable Latin-1 bytes as themselves and the others as the letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_tokenizers(a_file: str, b_file: str) -> Tokenizers:
    """Reads a byte-level vocabulary (A) and a piece model (B) on the driver."""
    import sentencepiece
    from tokenizers import Tokenizer

    with open(a_file, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_file, "rb") as f:
        b_model = f.read()
    letters, vocabulary = _byte_of_letter(), Tokenizer.from_str(a_json).get_vocab()
    a_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    m = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    piece = lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
    return Tokenizers(a_json, b_model, tuple(a_bytes), tuple(piece(i) for i in range(m.get_piece_size())))


class _Bytes:
    """Byte strings back to back, from which runs of them are joined."""

    def __init__(self, parts):
        self.size = np.array([len(p) for p in parts], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids one after another, and where each ends."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.flat[np.arange(end[-1] if len(end) else 0) + np.repeat(self.at[ids] - end + size, size)], end

    def show(self, ids: np.ndarray, counts: np.ndarray, wanted: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which runs of ids (``counts`` long) join up to their run of ``wanted`` (``sizes`` long)?"""
        got, end = self.joined(ids)
        lengths = np.diff(np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])])
        same = lengths == sizes
        differ = got[np.repeat(same, lengths)] != wanted[np.repeat(same, sizes)]
        if differ.any():
            same[np.unique(np.repeat(np.flatnonzero(same), sizes[same])[differ])] = False
        return same


class _Worker:
    """The tokenizers as a Python worker holds them."""

    def __init__(self, t: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(t.a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=t.b_model)
        self.shown = _Bytes(t.a_bytes), _Bytes(t.b_bytes)
        self.digits = [_Bytes([b"%d," % i for i in range(len(p))]) for p in (t.a_bytes, t.b_bytes)]
        self.memo = _Memo()
        #: Bytes that some piece of B has before a space.
        self.glued = np.zeros(256, bool)
        self.glued[[x for p in t.b_bytes for x, y in zip(p, p[1:], strict=False) if y == 32]] = True

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A for space + text and of B, which puts the space itself."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)


_workers: dict[str, _Worker] = {}


def _worker(t: Tokenizers) -> _Worker:
    """Built once in each Python worker."""
    key = hashlib.sha256(t.a_json.encode() + t.b_model).hexdigest()
    if key not in _workers:
        _workers.clear()
        _workers[key] = _Worker(t)
    return _workers[key]


@dataclass
class _Parts:
    """Texts of a slice with a space before each, cut into parts; ``first`` has the parts of each text, none for an empty one."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    key: np.ndarray


def parts(t: Texts, glued: np.ndarray) -> _Parts:
    """Cuts before a space with an ASCII letter after it, unless ``glued`` has the byte before it.

    A's pattern always ends a word there, and B has no piece with that byte and a space, so no token of either goes over a cut.
    """
    size = np.diff(t.offset)
    some = np.flatnonzero(size)
    n = size[some]
    data = np.full(int(n.sum()) + len(some), ord(" "), np.uint8)
    data[np.arange(int(n.sum())) + np.repeat(np.arange(len(some)) + 1, n)] = t.data
    cut = np.zeros(len(data) + 1, bool)
    letter = (data[2:] | 32) - np.uint8(97) < 26
    cut[1 : len(data) - 1] = (data[1:-1] == ord(" ")) & letter & ~glued[data[:-2]]
    begins = np.cumsum(n + 1) - n - 1
    cut[begins] = True
    cut[len(data)] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))[: len(start)]
    first = np.searchsorted(start, np.append(begins, len(data)))
    every = np.zeros(len(size), np.int64)
    every[some] = np.diff(first)
    return _Parts(data, start, end, np.concatenate([[0], np.cumsum(every)]), span_hash(byte_values(data), start, end))


class _Memo:
    """Parts that a worker has encoded, by hash, with both sides' ids; it starts anew at ``MEMO_PARTS``."""

    def __init__(self):
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.fits = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32)] * 2
        self.counts = [np.zeros(0, np.int64)] * 2

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def add(self, keys: np.ndarray, fits: list, ids: list, counts: list) -> None:
        every = np.concatenate([self.keys, keys])
        slot = np.concatenate([self.slot, len(self.slot) + np.arange(len(keys))])
        order = np.argsort(every, kind="stable")
        self.keys, self.slot = every[order], slot[order]
        self.fits = np.concatenate([self.fits, *fits])
        self.ids = [np.concatenate([x, *y]) for x, y in zip(self.ids, ids, strict=True)]
        self.counts = [np.concatenate([x, *y]) for x, y in zip(self.counts, counts, strict=True)]


def _encode(w: _Worker, held: list[_Parts], places: np.ndarray):
    """Encodes the parts at ``places`` of all held ones: whether each joins up, and both sides' ids and counts, in runs."""
    shift = np.cumsum([0] + [len(p.key) for p in held])
    of = np.searchsorted(shift[1:], places, side="right")
    raw = {h: held[h].data.tobytes() for h in np.unique(of).tolist()}
    fits, ids, counts = [], ([], []), ([], [])
    for lo in range(0, len(places), BATCH_PARTS):
        few = [(raw[h], held[h].start[i], held[h].end[i]) for h, i in zip(of[lo : lo + BATCH_PARTS].tolist(), (places - shift[of])[lo : lo + BATCH_PARTS], strict=True)]
        sizes = np.array([e - s for _, s, e in few], np.int64)
        wanted = np.frombuffer(b"".join(d[s:e] for d, s, e in few), np.uint8)
        same = np.ones(len(few), bool)
        for k, lists in enumerate(w.encode([d[s + 1 : e].decode() for d, s, e in few])):
            n = np.array([len(x) for x in lists], np.int64)
            i = np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum()))
            ids[k].append(i)
            counts[k].append(n)
            same &= w.shown[k].show(i, n, wanted, sizes)
        fits.append(same)
    return fits, ids, counts


def tokens(w: _Worker, held: list[_Parts]):
    """Ids of both sides, how many each text has and where in space + text each token ends; nothing for texts that don't join up.

    Each distinct part is encoded once.  (Parts are told apart by 64-bit hashes.)
    """
    keys, where, part = np.unique(np.concatenate([p.key for p in held]), return_index=True, return_inverse=True)
    slot = w.memo.find(keys)
    if len(w.memo.keys) + (slot < 0).sum() > MEMO_PARTS:
        w.memo = _Memo()
        slot[:] = -1
    new = slot < 0
    w.memo.add(keys[new], *_encode(w, held, where[new]))
    slot = w.memo.find(keys)[part]
    per_text = np.concatenate([np.diff(p.first) for p in held])
    text = np.repeat(np.arange(len(per_text)), per_text)
    whole = np.ones(len(per_text), bool)
    whole[text[~w.memo.fits[slot]]] = False
    used = slot[whole[text]]
    out = []
    for ids, counts, shown in zip(w.memo.ids, w.memo.counts, w.shown, strict=True):
        n = counts[used]
        mine = ids[np.repeat((np.cumsum(counts) - counts)[used], n) + _within(n)]
        per = np.zeros(len(per_text), np.int64)
        np.add.at(per, text[whole[text]], n)
        size = shown.size[mine]
        end = np.cumsum(size)
        first = (np.cumsum(per) - per)[per > 0]
        out.append((mine, per, end - np.repeat(end[first] - size[first], per[per > 0])))
    return tuple(zip(*out, strict=True))


def merge(ends_a: np.ndarray, n_a: np.ndarray, ends_b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Groups of all documents, a column each: document, first A token, the one after the last, and the same of B.

    ``ends_*`` are offsets within each document, whose last ones are equal on both sides.
    """
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    docs = np.flatnonzero(n_a > 0)
    first = (stop_a - n_a)[docs], (stop_b - n_b)[docs]
    # The state of every document that is not through: where its pointers are and where its A tokens stop.
    a, b, stop = first[0].copy(), first[1].copy(), stop_a[docs]
    cuts_a, cuts_b = [stop_a[:0]], [stop_b[:0]]
    while len(a):
        x, y = ends_a[a], ends_b[b]
        a += x <= y
        b += y <= x
        at = np.flatnonzero(x == y)
        if len(at):
            cuts_a.append(a[at])
            cuts_b.append(b[at])
            through = cuts_a[-1] == stop[at]
            if through.any():
                on = np.ones(len(a), bool)
                on[at[through]] = False
                a, b, stop = a[on], b[on], stop[on]
    # Cuts in the order of the tokens; a group reaches back to the cut before it or the start of its document.
    to_a, to_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    order = np.argsort(to_a, kind="stable")
    to_a, to_b = to_a[order], to_b[order]
    doc = np.searchsorted(stop_a, to_a, side="left")
    from_a, from_b = np.zeros_like(to_a), np.zeros_like(to_b)
    from_a[1:], from_b[1:] = to_a[:-1], to_b[:-1]
    return np.stack([doc, from_a, to_a, from_b, to_b])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _added(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate([*keys, np.zeros(0, np.int64)]), np.concatenate([*times, np.zeros(0, np.int64)])
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(n, first) if len(k) else n


def document_pairs(groups: np.ndarray, a: np.ndarray, b: np.ndarray, n_b: int, kinds: int, most: int = BLOCK_LINKS):
    """``document * kinds + a id * n_b + b id`` of all links, distinct and in order, and how often each occurs."""
    doc, na, nb = groups[0], groups[2] - groups[1], groups[4] - groups[3]
    keys, times, again = [], [], False
    ends = np.cumsum(np.minimum(na * nb, most + 1))
    lo = 0
    while lo < len(doc):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right"))
        if hi < len(doc) and doc[hi] == doc[lo]:
            again = True  # a document of several blocks
        elif hi < len(doc):
            hi = int(np.searchsorted(doc, doc[hi]))
        if hi <= lo:
            # One group above the size: its distinct ids meet.
            d, a0, a1, b0, b1 = groups[:, lo]
            ua, ca = np.unique(a[a0:a1], return_counts=True)
            ub, cb = np.unique(b[b0:b1], return_counts=True)
            step = max(1, most // len(ub))
            for i in range(0, len(ua), step):
                keys.append((d * kinds + ua[i : i + step, None].astype(np.int64) * n_b + ub).ravel())
                times.append((ca[i : i + step, None] * cb).ravel())
            again, lo = True, lo + 1
            continue
        g, x, y = groups[:, lo:hi], na[lo:hi], nb[lo:hi]
        link = _within(x * y)
        width = np.repeat(y, x * y)
        pair = a[np.repeat(g[1], x * y) + link // width].astype(np.int64) * n_b + b[np.repeat(g[3], x * y) + link % width]
        k, n = np.unique(np.repeat(g[0], x * y) * kinds + pair, return_counts=True)
        keys.append(k)
        times.append(n)
        lo = hi
    if again:
        return _added(keys, times)
    return np.concatenate([*keys, np.zeros(0, np.int64)]), np.concatenate([*times, np.zeros(0, np.int64)])


def group_hashes(groups: np.ndarray, a: np.ndarray, b: np.ndarray, docs: int, digits, most: int = BLOCK_TOKENS) -> list[str]:
    """SHA-256 of each document's groups as text; '' without tokens."""
    hashes = [None] * docs
    shown = np.concatenate([d.flat for d in digits])
    na, nb = groups[2] - groups[1], groups[4] - groups[3]
    sizes = na + nb
    ends = np.cumsum(sizes)
    lo = 0
    while lo < groups.shape[1]:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        g, x, y = groups[:, lo:hi], na[lo:hi], nb[lo:hi]
        base = np.cumsum(x + y) - x - y
        place = np.repeat(base, x) + _within(x), np.repeat(base + x, y) + _within(y)
        ids = a[g[1][0] : g[2][-1]], b[g[3][0] : g[4][-1]]
        size = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        at = np.empty_like(size)
        for where, who, d, shift in zip(place, ids, digits, (0, len(digits[0].flat)), strict=True):
            size[where] = d.size[who]
            at[where] = d.at[who] + shift
        end = np.cumsum(size)
        text = shown[np.arange(end[-1]) + np.repeat(at - end + size, size)]
        text[end[base + x - 1] - 1] = ord("|")
        text[end[base + x + y - 1] - 1] = ord(";")
        stop = np.concatenate([[0], end[base + x + y - 1]])
        firsts = np.flatnonzero(np.concatenate([[True], g[0][1:] != g[0][:-1]]))
        for f, e in zip(firsts, np.append(firsts[1:], hi - lo), strict=True):
            doc = int(g[0][f])
            ends_here = lo + e == groups.shape[1] or groups[0][lo + e] != doc
            hashes[doc] = hashes[doc] or hashlib.sha256()
            hashes[doc].update(text[stop[f] : stop[e] - int(ends_here)])  # no mark after the last group
        lo = hi
    return ["" if h is None else h.hexdigest() for h in hashes]


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, the lowest bytes of all first, in as many bytes as the largest needs: it compresses well."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : b[0]] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def _rising(x: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Differences of numbers that rise, from the start or within runs that begin at ``first``."""
    d = np.diff(x, prepend=0)
    if first is not None:
        d[first] = x[first]
    return d


def _align(t: Tokenizers, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _worker(t)
        schema = pa.schema(
            [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("n_a", "n_b", "n_groups", "n_links")],
             ("hashes", pa.list_(pa.string())), *[(c, pa.binary()) for c in ("pairs", "pair_docs", "sizes", "entries", "times")]]
        )
        ids, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            (a, b), (n_a, n_b), ends = tokens(w, held)
            groups = merge(ends[0], n_a, ends[1], n_b)
            docs, kinds = len(n_a), len(t.a_bytes) * len(t.b_bytes)
            keys, times = document_pairs(groups, a, b, len(t.b_bytes), kinds)
            pairs, entries = np.unique(keys % kinds, return_inverse=True)
            sizes = np.bincount(keys // kinds, minlength=docs)
            first = (np.cumsum(sizes) - sizes)[sizes > 0]
            links = (groups[2] - groups[1]) * (groups[4] - groups[3])
            n_links = np.zeros(docs, np.int64)
            np.add.at(n_links, groups[0], links)
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": [uuid.uuid4().int >> 65], "ids": [[i for x in ids for i in x]], "n_a": [_planes(n_a)], "n_b": [_planes(n_b)],
                    "n_groups": [_planes(np.bincount(groups[0], minlength=docs))], "n_links": [_planes(n_links)],
                    "hashes": [group_hashes(groups, a, b, docs, w.digits)], "pairs": [_planes(_rising(pairs))],
                    "pair_docs": [_planes(np.bincount(entries, minlength=len(pairs)))], "sizes": [_planes(sizes)],
                    "entries": [_planes(_rising(entries, first))], "times": [_planes(times)],
                },
                schema=schema,
            )

        for batch, s in slices(batches, "text", min(SLICE_BYTES, most)):
            ids.append(batch.column("id").to_pylist())
            held.append(parts(s, w.glued))
            size += len(s.data)
            if size >= most:
                yield flush()
                ids, held, size = [], [], 0
        if held:
            yield flush()

    return run


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "pairs", "pair_docs")), strict=True):
            pair = np.cumsum(_numbers(pairs))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), chunk)), pa.array(pair), pa.array(_numbers(docs))], names=["chunk", "pair", "docs"])


def _sum_links(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk's documents with the counts of their links put to them."""
    out = []
    pair = answers.column("pair").to_numpy()
    order = np.argsort(pair, kind="stable")
    count, best = answers.column("n").to_numpy()[order], answers.column("best").to_numpy(zero_copy_only=False)[order]
    for row in chunk.to_pylist():
        sizes, times = _numbers(row["sizes"]), _numbers(row["times"])
        step = np.cumsum(_numbers(row["entries"]))
        some = sizes > 0
        first = (np.cumsum(sizes) - sizes)[some]
        entries = step - np.repeat(np.concatenate([[0], step])[first], sizes[some])
        sums = np.zeros((2, len(sizes)), np.int64)
        if len(first):
            sums[0, some] = np.add.reduceat(times * best[entries], first)
            sums[1, some] = np.add.reduceat(times * count[entries], first)
        named = [_numbers(row[c]) for c in ("n_a", "n_b", "n_groups", "n_links")]
        columns = [pa.array(row["ids"], pa.int64()), *[pa.array(x) for x in (*named, *sums)], pa.array(row["hashes"], pa.string())]
        out.append(pa.Table.from_arrays(columns, names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
    return pa.concat_tables(out)


def pair_counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of each chunk's distinct pairs, and every pair's ``n`` documents with ``best``, whether no pair of its A id has more."""
    rows = chunks.select("chunk", "pairs", "pair_docs").mapInArrow(_pair_rows, "chunk long, pair long, docs long")
    return rows, rows.groupBy("pair").agg(F.sum("docs").alias("n"))


def align(docs: DataFrame, t: Tokenizers, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Tokens, groups and links of every document, with the links' counts over all documents (see the module)."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chunks = keep(picked.mapInArrow(_align(t, chunk_bytes), _CHUNK), "aligned")
    rows, counts = pair_counts(chunks)
    # An A id meets at most all B ids, so its window has a bound.
    of_a = Window.partitionBy(F.floor(F.col("pair") / F.lit(len(t.b_bytes))))
    judged = counts.withColumn("best", F.col("n") == F.max("n").over(of_a))
    answers = rows.select("chunk", "pair").join(judged, "pair")
    names = ["chunk", "ids", "n_a", "n_b", "n_groups", "n_links", "hashes", "sizes", "entries", "times"]
    summed = chunks.select(*names).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_sum_links, _TOTALS)
    return summed.withColumnRenamed("id", id_col)
