"""A compressed FM-index over a sequence of symbols, for many backward searches side by side.

The Burrows-Wheeler transform is held in a wavelet tree whose codes are as long as the symbols are rare, as packed bits with a count
of ones before every 64.  Suffixes are told apart by their first ``depth`` symbols only, which suffices for patterns up to that length.
"""

from __future__ import annotations

import numpy as np


def suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` symbols or more, by doubling."""
    n, rank, k = len(seq), seq.astype(np.uint64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        key = rank << np.uint64(32)
        key[: n - k] |= rank[k:] + np.uint64(1)
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]).astype(np.uint64)
        if n and rank[order[-1]] == n - 1:
            break
        k *= 2
    return order


class FMIndex:
    """``seq`` has symbols from 0; every symbol up to the largest occurs."""

    def __init__(self, seq: np.ndarray, depth: int):
        seq = np.asarray(seq, np.int64)
        self.n = len(seq)
        bwt = seq[suffix_order(seq, depth) - 1]
        counts = np.bincount(seq)
        self.before = np.cumsum(counts) - counts
        self._build(bwt, counts)

    def _build(self, bwt: np.ndarray, counts: np.ndarray) -> None:
        # Codes of at most one bit more than the symbol's information, shortest first.
        length = np.maximum(np.ceil(np.log2(self.n / counts)).astype(np.int64), 1)
        longest = int(length.max())
        by_length = np.argsort(length, kind="stable")
        room = np.int64(1) << (longest - length[by_length])
        self.code, self.length, self.longest = np.empty(len(counts), np.int64), length, longest
        self.code[by_length] = np.cumsum(room) - room
        now, size = self.code[bwt], length[bwt]
        bits, starts, prefixes, levels, base = [], [], [], [], 0
        for level in range(longest):
            if not len(now):
                break
            prefix, bit = now >> (longest - level), (now >> (longest - 1 - level)) & 1
            new = np.concatenate([[True], prefix[1:] != prefix[:-1]])
            start, node = np.flatnonzero(new), np.cumsum(new) - 1
            bits.append(bit.astype(bool))
            starts.append(base + start)
            prefixes.append(prefix[start])
            levels.append(len(start))
            ones = np.cumsum(bit) - bit
            in_node = np.arange(len(now)) - start[node]
            ones_in_node = ones - ones[start][node]
            zeros = np.add.reduceat(1 - bit, start)
            to = start[node] + np.where(bit == 1, zeros[node] + ones_in_node, in_node - ones_in_node)
            base += len(now)
            after, after_size = np.empty_like(now), np.empty_like(size)
            after[to], after_size[to] = now, size
            on = after_size > level + 1
            now, size = after[on], after_size[on]
        first = np.concatenate([[0], np.cumsum(levels)])
        self.child = np.full((first[-1], 2), -1, np.int64)
        for level in range(len(levels) - 1):
            below = prefixes[level + 1]
            for b in (0, 1):
                want = 2 * prefixes[level] + b
                at = np.minimum(np.searchsorted(below, want), len(below) - 1)
                there = below[at] == want
                self.child[first[level] : first[level + 1], b] = np.where(there, first[level + 1] + at, -1)
        packed = np.packbits(np.concatenate(bits), bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ones = np.cumsum(ones) - ones
        self.start = np.concatenate(starts)
        self.start_ones = self._ones_before(self.start)

    def _ones_before(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.ones[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def occurrences(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``end`` of the transform."""
        out, row = end.astype(np.int64), np.arange(len(end))
        node, code, length = np.zeros(len(end), np.int64), self.code[symbol], self.length[symbol]
        for level in range(int(length.max(initial=0))):
            if level:
                on = length > level
                row, node, code, length = row[on], node[on], code[on], length[on]
            here = out[row]
            ones = self._ones_before(self.start[node] + here) - self.start_ones[node]
            bit = (code >> (self.longest - 1 - level)) & 1
            out[row] = np.where(bit == 1, ones, here - ones)
            node = self.child[node, bit]
        return out

    def backward(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes ``lo`` to ``hi`` that start with a pattern, for the pattern with one more symbol before it."""
        n, found = len(symbol), self.occurrences(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return self.before[symbol] + found[:n], self.before[symbol] + found[n:]

    @property
    def bytes(self) -> int:
        return self.words.nbytes + self.ones.nbytes + self.child.nbytes + self.start.nbytes + self.start_ones.nbytes


def repeated_windows(seq: np.ndarray, start: np.ndarray, windows: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` symbols occur twice or more in ``seq``, for parts of it, as bits of a number per part.

    Part i has ``windows[i]`` (up to 62) windows, the first at ``start[i]``.  A window is read backward from its end.  Once what was
    read is found nowhere else, no window that holds it is repeated, and the search goes on behind it, often a whole window
    further.  After a hit, all windows that are left are tried at once, backward from the end of the last.
    """
    index, m = FMIndex(seq, size + int(windows.max(initial=1))), len(start)
    found = np.zeros(m, np.uint64)
    part, left, right = np.arange(m), np.zeros(m, np.int64), windows.astype(np.int64) - 1
    whole = np.zeros(m, bool)  # tries all windows from left to right
    at = left + size - 1
    lo, hi = np.zeros(m, np.int64), np.full(m, index.n, np.int64)
    ones = lambda a, b: np.where(b >= a, (np.uint64(1) << (np.maximum(b - a, -1) + 1).astype(np.uint64)) - np.uint64(1), np.uint64(0)) << np.maximum(a, 0).astype(np.uint64)
    while len(part):
        lo, hi = index.backward(seq[start[part] + at], lo, hi)
        once, reached = hi - lo <= 1, at == left
        hit = ~once & reached
        a, b = ~whole & once, ~whole & hit
        c, d = whole & hit, whole & once
        mark = np.zeros(len(part), np.uint64)
        mark[b] = ones(left[b], left[b])
        mark[c] = ones(left[c], right[c])
        # Read back to behind the last window's start or not: either the windows from there are repeated, or the last isn't.
        far = d & (at < right)
        mark[far] = ones(at[far] + 1, right[far])
        found[part] |= mark
        left = np.where(a, at + 1, np.where(b, left + 1, np.where(c, right + 1, left)))
        right = np.where(far, at, np.where(d & ~far, right - 1, right))
        again = a | b | c | d
        whole = np.where(again, b, whole)
        at = np.where(again, np.where(whole, right, left) + size - 1, at - 1)
        lo, hi = np.where(again, 0, lo), np.where(again, index.n, hi)
        on = left <= right
        part, left, right, whole, at, lo, hi = (x[on] for x in (part, left, right, whole, at, lo, hi))
    return found
