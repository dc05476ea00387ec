"""SentencePiece encoding and decoding with an Aho-Corasick automaton and a single-pass Viterbi search.

The automaton runs over the UTF-8 bytes of a text, with each space as the piece mark.  At every byte the pieces that end there
are on its chain of output links, longest first; each relaxes the best score at that byte from the one where the piece starts.
A character without a piece of its own costs ``UNKNOWN_PENALTY`` below the lowest score and is written as its bytes, if the
model has byte pieces.  Equal scores keep the longer last piece.

A text is cut wherever no piece holds the two bytes beside the cut, which changes no path.  The parts (words, mostly) are the
same again and again: each distinct part of a slice is searched once, all of them side by side, byte by byte.

Defined cases: a null text has null ids, an empty one no ids.  Repeated rows are encoded alike.  A text may be of any length, also
without a space.  The piece mark itself in a text is read as a space, as the model can't tell them apart, so such a text doesn't
decode to itself.  Columns besides the text are carried along; result columns replace columns of the same name.  An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inundation.llm.flat import Texts, slices, span_hash, texts

#: The mark that stands for a space, and what an unknown character costs below the lowest score.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Parts longer than this are searched one by one, as few others go along with them.
LONG_PART = 64
CHUNK = 1 << 14

_SPACE = 32
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes with spaces for marks; ``byte_ids`` are the ids of the 256 byte pieces, or empty."""

    pieces: tuple[bytes, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    shown: tuple[bytes, ...]
    byte_ids: tuple[int, ...]
    unknown_id: int
    prefix: bool

    @property
    def key(self) -> str:
        return hashlib.sha256(repr(self).encode()).hexdigest()


def read_vocabulary(model_file: str) -> Vocabulary:
    """The vocabulary of a model file, which only the driver reads; tasks get the pieces (under 1 MB for 32,000)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = m.get_piece_size()
    plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    text = lambda i: m.id_to_piece(i).replace(MARK, " ").encode()
    byte = {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)}
    known = set(plain)
    shown = [
        text(i) if i in known else bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else " ⁇ ".encode() if m.is_unknown(i) else b""
        for i in range(n)
    ]
    prefix = bool(m.encode("a", out_type=str)[0].startswith(MARK))
    return Vocabulary(
        tuple(text(i) for i in plain), tuple(plain), tuple(m.get_score(i) for i in plain), tuple(shown),
        tuple(byte[b] for b in range(256)) if len(byte) == 256 else (), m.unk_id(), prefix,
    )


class Automaton:
    """Dense transitions by state and byte class, and output links."""

    def __init__(self, v: Vocabulary):
        used = sorted(set(b"".join(v.pieces)))
        self.byte_class = np.zeros(256, np.int64)
        self.byte_class[used] = np.arange(1, len(used) + 1)
        children: list[dict[int, int]] = [{}]
        length, ident, score = [0], [-1], [0.0]
        for piece, i, s in zip(v.pieces, v.ids, v.scores, strict=True):
            node = 0
            for b in piece:
                c = int(self.byte_class[b])
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    length.append(0)
                    ident.append(-1)
                    score.append(0.0)
                node = children[node][c]
            length[node], ident[node], score[node] = len(piece), i, s
        n = len(children)
        self.width = len(used) + 1
        go = np.zeros((n, self.width), np.int32)
        fail, self.link, shortest = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int16)
        todo = [0]
        for node in todo:  # breadth first; a state is complete before its children are
            if node:
                f = fail[node]
                go[node] = go[f]
                self.link[node] = f if length[f] else self.link[f]
                shortest[node] = shortest[f] or length[node]
            for c, child in children[node].items():
                fail[child] = go[fail[node], c] if node else 0
                go[node, c] = child
                todo.append(child)
        self.length, self.ident, self.score = np.array(length, np.int16), np.array(ident, np.int32), np.array(score)
        #: The longest piece that ends at a state, or 0; and the length of the shortest.
        self.first = np.where(self.length > 0, np.arange(n, dtype=np.int32), self.link).astype(np.int32)
        self.shortest = shortest
        self.go = go.reshape(-1)
        self.unknown = min(v.scores, default=0.0) - UNKNOWN_PENALTY
        inside = np.zeros((256, 256), bool)
        for piece in v.pieces:
            p = np.frombuffer(piece, np.uint8)
            inside[p[:-1], p[1:]] = True
        inside[:, 0x80:0xC0] = True  # never within a character
        self.inside = inside
        shown = [np.frombuffer(s, np.uint8) for s in v.shown]
        self.shown = np.concatenate([*shown, np.zeros(0, np.uint8)])
        self.shown_at = np.concatenate([[0], np.cumsum([len(s) for s in shown], dtype=np.int64)])
        self.byte_ids = np.array(v.byte_ids, np.int32)
        self.unknown_id, self.prefix = v.unknown_id, v.prefix


_automata: dict[str, Automaton] = {}


def automaton(v: Vocabulary) -> Automaton:
    """Built once in each Python worker."""
    if v.key not in _automata:
        _automata.clear()
        _automata[v.key] = Automaton(v)
    return _automata[v.key]


def _best_long(a: Automaton, part: bytes) -> list[int]:
    """The ids of one part, by the same search, byte by byte."""
    n = len(part)
    go, width, first, link = a.go, a.width, a.first, a.link
    classes = a.byte_class[np.frombuffer(part, np.uint8)].tolist()
    best, back, ident = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
    state, begin = 0, 0
    for p in range(1, n + 1):
        if part[p - 1] & 0xC0 != 0x80:
            begin = p - 1
        state = int(go[state * width + classes[p - 1]])
        o = int(first[state])
        while o:
            start = p - int(a.length[o])
            s = best[start] + float(a.score[o])
            if s > best[p]:
                best[p], back[p], ident[p] = s, start, int(a.ident[o])
            o = int(link[o])
        ends = p == n or part[p] & 0xC0 != 0x80
        if ends and a.shortest[state] != p - begin and best[begin] + a.unknown > best[p]:
            best[p], back[p], ident[p] = best[begin] + a.unknown, begin, -1
    out, p = [], n
    while p:
        if ident[p] >= 0:
            out.append(ident[p])
        elif len(a.byte_ids):
            out += a.byte_ids[np.frombuffer(part[back[p] : p], np.uint8)[::-1]].tolist()
        else:
            out.append(a.unknown_id)
        p = back[p]
    return out[::-1]


def _best_short(a: Automaton, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and numbers of ids of many parts, which go through the automaton side by side; longest part first."""
    n, longest = len(start), int(size[0])
    best = np.full((longest + 1, n), -np.inf)
    best[0] = 0
    step, ident = np.zeros((longest + 1, n), np.int16), np.full((longest + 1, n), -1, np.int32)
    state, begin = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at_least = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # parts of p bytes or more
    for p in range(1, longest + 1):
        m = at_least[p - 1]
        byte = data[start[:m] + (p - 1)]
        here = begin[:m]
        here[(byte & 0xC0) != 0x80] = p - 1
        state[:m] = a.go[state[:m] * a.width + a.byte_class[byte]]
        now = state[:m]
        top, to, who = best[p], step[p], ident[p]
        out = a.first[now]
        row = np.flatnonzero(out)
        out = out[row]
        while len(row):
            length = a.length[out]
            s = best[p - length, row] + a.score[out]
            better = s > top[row]
            r, o = row[better], out[better]
            top[r], to[r], who[r] = s[better], length[better], a.ident[o]
            out = a.link[out]
            on = out > 0
            row, out = row[on], out[on]
        # Characters that end here and have no piece of their own.
        odd = np.flatnonzero(a.shortest[now] != p - here)
        if len(odd):
            more = size[odd] > p
            after = data[np.minimum(start[odd] + p, len(data) - 1)]
            odd = odd[~more | ((after & 0xC0) != 0x80)]
            s = best[here[odd], odd] + a.unknown
            better = s > top[odd]
            r = odd[better]
            top[r], to[r], who[r] = s[better], p - here[r], -1
    # Back from the ends; an unknown character yields its bytes one by one.
    found, counts = [], np.zeros(n, np.int64)
    row, pos, left = np.arange(n), size.astype(np.int64), np.zeros(n, np.int64)
    while len(row):
        fresh = left == 0
        who, to = ident[pos, row], step[pos, row].astype(np.int64)
        unknown = fresh & (who < 0)
        if len(a.byte_ids):
            left = np.where(unknown, to, left)
            by_byte = left > 0
            token = np.where(by_byte, a.byte_ids[data[start[row] + pos - 1]], who)
            pos = pos - np.where(by_byte, 1, to)
            left = np.maximum(left - 1, 0)
        else:
            token = np.where(unknown, a.unknown_id, who)
            pos = pos - to
        found.append((row, counts[row].copy(), token))
        counts[row] += 1
        on = pos > 0
        row, pos, left = row[on], pos[on], left[on]
    at = np.concatenate([[0], np.cumsum(counts)])
    ids = np.empty(at[-1], np.int32)
    for r, k, token in found:
        ids[at[r + 1] - 1 - k] = token
    return ids, counts


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all runs ``starts[i]`` to ``starts[i] + sizes[i]``, one after another."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - sizes), sizes)


def _prepared(a: Automaton, t: Texts) -> Texts:
    """Texts with a leading space where the model wants one, marks read as spaces."""
    data, offset = t.data, t.offset
    marks = np.flatnonzero(data[:-2] == _MARK_BYTES[0]) if len(data) > 2 else np.zeros(0, np.int64)
    marks = marks[(data[marks + 1] == _MARK_BYTES[1]) & (data[marks + 2] == _MARK_BYTES[2])]
    if len(marks):
        stay = np.ones(len(data), bool)
        stay[marks + 1] = stay[marks + 2] = False
        data = data.copy()
        data[marks] = _SPACE
        kept = np.concatenate([[0], np.cumsum(stay)])
        data, offset = data[stay], kept[offset]
    if a.prefix:
        some = np.diff(offset) > 0
        data = np.insert(data, offset[:-1][some], _SPACE)
        offset = offset + np.concatenate([[0], np.cumsum(some)])
    return Texts(data, offset)


def encode_texts(a: Automaton, t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and where those of each text start."""
    t = _prepared(a, t)
    data, n = t.data, len(t.data)
    cut = np.zeros(n + 1, bool)
    cut[t.offset] = True
    cut[1:n] |= ~a.inside[data[:-1], data[1:]]
    edges = np.flatnonzero(cut)
    start, size = edges[:-1], np.diff(edges)
    _, first, inverse = np.unique(span_hash(t.byte_values(), start, start + size), return_index=True, return_inverse=True)
    order = np.argsort(-size[first], kind="stable")
    u_start, u_size = start[first][order], size[first][order]
    n_long = int(np.searchsorted(-u_size, -LONG_PART, side="left"))
    parts = [np.array(_best_long(a, data[s : s + k].tobytes()), np.int32) for s, k in zip(u_start[:n_long], u_size[:n_long], strict=True)]
    counts = [np.array([len(x) for x in parts], np.int64)]
    for lo in range(n_long, len(u_start), CHUNK):
        ids, k = _best_short(a, data, u_start[lo : lo + CHUNK], u_size[lo : lo + CHUNK])
        parts.append(ids)
        counts.append(k)
    u_ids, u_count = np.concatenate([*parts, np.zeros(0, np.int32)]), np.concatenate(counts)
    u_at = np.cumsum(u_count) - u_count
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    which = place[inverse] if len(order) else np.zeros(0, np.int64)
    sizes = u_count[which]
    total = np.concatenate([[0], np.cumsum(sizes)])
    return u_ids[_ragged(u_at[which], sizes)], total[np.searchsorted(edges, t.offset)] if n else np.zeros(len(t.offset), np.int64)


def decode_ids(a: Automaton, ids: np.ndarray, at: np.ndarray) -> Texts:
    """The texts of runs of ids.  The space that encoding put first is taken off."""
    sizes = a.shown_at[ids + 1] - a.shown_at[ids]
    data = a.shown[_ragged(a.shown_at[ids], sizes)]
    offset = np.concatenate([[0], np.cumsum(sizes)])[at]
    if a.prefix and len(data):
        led = (np.diff(offset) > 0) & (data[np.minimum(offset[:-1], len(data) - 1)] == _SPACE)
        data = np.delete(data, offset[:-1][led])
        offset = offset - np.concatenate([[0], np.cumsum(led)])
    return Texts(data, offset)


def _same(a: Texts, b: Texts) -> np.ndarray:
    if np.array_equal(a.offset, b.offset) and np.array_equal(a.data, b.data):
        return np.ones(len(a), bool)
    part = lambda t, i: t.data[t.offset[i] : t.offset[i + 1]]
    return np.array([np.array_equal(part(a, i), part(b, i)) for i in range(len(a))], bool)


def _lists(ids: np.ndarray, at: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(null) if null.any() else None)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """Adds ``ids_col``, ``n_tokens`` and ``round_trip`` (the ids decode to the text) and drops the text."""
    rest = [f for f in docs.schema if f.name not in (text_col, ids_col, "n_tokens", "round_trip")]
    names = [f.name for f in rest]
    out = T.StructType([*rest, T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType()), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        for batch, t in slices(batches, text_col):
            null = batch.column(text_col).is_null().to_numpy(zero_copy_only=False)
            ids, at = encode_texts(a, t)
            count, same = np.diff(at), _same(decode_ids(a, ids, at), t)
            found = [pa.array(count, mask=null), pa.array(same, mask=null), _lists(ids, at, null)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *found], names=out.names)

    return docs.select(*[f"`{c}`" for c in names], text_col).mapInArrow(run, out)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """Turns ``ids_col`` into ``text_col``; bytes that are no UTF-8 become the replacement character, null ids a null text."""
    rest = [f for f in encoded.schema if f.name not in (text_col, ids_col)]
    names = [f.name for f in rest]
    out = T.StructType([*rest, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        for batch in batches:
            lists = batch.column(ids_col)
            null = lists.is_null().to_numpy(zero_copy_only=False)
            sizes = np.where(null, 0, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            t = decode_ids(a, ids, np.concatenate([[0], np.cumsum(sizes)]))
            text = [None if x else t.data[i:j].tobytes().decode("utf-8", "replace") for x, i, j in zip(null, t.offset[:-1], t.offset[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(text, pa.string())], names=out.names)

    return encoded.select(*[f"`{c}`" for c in names], ids_col).mapInArrow(run, out)
