"""Periodic runs of words: suffix trees of a document and of its reversal give every maximal run.

A run is a stretch of consecutive words with smallest period q and at least max(``LEAST``, ``REPEATS`` * q) words that no
neighbouring word extends keeping period q. ``with_runs`` finds all runs of every whole text and the text without the repeats:
a word goes if a run holds it after that run's first q words.

Method. Ukkonen's construction builds the suffix tree of the document's words and that of their reversal. An Euler tour of each,
with range minima over the tour's depths, gives the longest common extension of any two places in constant time. The order of
the leaves, once with ascending and once with descending words, gives at each place the longest Lyndon word: it ends where the
next smaller suffix starts. Each is the root of a candidate, extended to the right by the tree and to the left by the tree of
the reversal. Every run has such a root in one of the two orders, and a Lyndon root's length is the run's smallest period.

Before that, words that cannot be in a run are cut away (``reduce``): a run of four periods and six words holds every five-word
sequence of its own twice or more, and every word of its own four times or more. What is left are pieces, joined by separators that occur once; a run never crosses one.
The work follows the words of the text; the trees hold about 0.8 KB for each word that is left, in the task of its document.

Cases: null, empty or blank text has no words and no run and stays an empty text; a text of any length is one document; rows are
judged one by one, so ties, repeated rows and null ids need no rule; an empty table gives an empty result; the other columns stay
as they are, whatever their names (the new column takes a free name). 64-bit hashes stand for words until the pieces are cut.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import cover, gram_hash, mix, run_bounds, ship, slices, spread, utf8, word_hash, word_spans
from shelfwise.llm.tables import append_column, free_name

LEAST = 6  # words of the shortest run
REPEATS = 4  # periods of the shortest run
GRAM = 5  # words of the sequences that a run repeats
ROUNDS = 8  # of cutting; further rounds would only save time
RUNS = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
BLOCK = 16  # neighbours of a tour whose minima are looked up by scanning


class SuffixTree:
    """Ukkonen's suffix tree of a list of whole numbers whose last one occurs once, with its Euler tour."""

    def __init__(self, s: list[int]):
        self.s, self.n = s, len(s)
        self.sigma = max(s) + 1
        self._build()

    def _build(self) -> None:
        s, n, sigma = self.s, self.n, self.sigma
        start, stop, link, go = [0], [0], [0], {}
        node = edge = length = remaining = 0  # the active point, and the suffixes that are still implicit
        for i, c in enumerate(s):
            pending = 0
            remaining += 1
            while remaining:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if pending:
                        link[pending] = node
                        pending = 0
                else:
                    at, size = start[child], stop[child] - start[child]
                    if length >= size and stop[child] <= i:
                        edge += size
                        length -= size
                        node = child
                        continue
                    if s[at + length] == c:
                        length += 1
                        if pending:
                            link[pending] = node
                        break
                    split = len(start)
                    start += (at, i)
                    stop += (at + length, n)
                    link += (0, 0)
                    go[key] = split
                    go[split * sigma + c] = split + 1
                    start[child] = at + length
                    go[split * sigma + s[at + length]] = child
                    if pending:
                        link[pending] = split
                    pending = split
                remaining -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - remaining + 1
        self.length = [b - a for a, b in zip(start, stop)]
        keys = np.fromiter(go.keys(), np.int64, len(go))
        self.child = np.fromiter(go.values(), np.int64, len(go))
        self.parent, self.symbol = keys // sigma, keys % sigma

    def _children(self, order: np.ndarray) -> list[list[int]]:
        """The children of every node, those with the largest ``order`` first (a stack turns them round)."""
        by = np.lexsort((-order, self.parent))
        first = np.searchsorted(self.parent[by], np.arange(len(self.length) + 1)).tolist()
        sorted_child = self.child[by].tolist()
        return [sorted_child[a:b] for a, b in zip(first, first[1:])]

    def tour(self) -> np.ndarray:
        """Makes the Euler tour's range minima; returns the suffixes in ascending order."""
        children, length, n = self._children(self.symbol), self.length, self.n
        depth = [0] * len(length)
        seen, leaves, when = [], [], []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back at a parent, whose depth was kept
                seen.append(~v)
                continue
            d = depth[v]
            below = children[v]
            if below:
                back = ~d
                for c in below:
                    depth[c] = d + length[c]
                    stack.append(back)
                    stack.append(c)
            else:
                leaves.append(n - d)
                when.append(len(seen))
            seen.append(d)
        order = np.array(leaves, np.int64)
        self.visit = np.empty(n, np.int64)
        self.visit[order] = when
        self._minima(np.array(seen, np.int32))
        return order

    def descending(self, separators: int) -> np.ndarray:
        """The suffixes in the order that turns all symbols but the ``separators`` smallest ones round."""
        turned = np.where(self.symbol < separators, self.symbol, self.sigma + separators - self.symbol)
        children, length, n = self._children(turned), self.length, self.n
        leaves, stack = [], [(0, 0)]
        while stack:
            v, d = stack.pop()
            below = children[v]
            if below:
                stack += [(c, d + length[c]) for c in below]
            else:
                leaves.append(n - d)
        return np.array(leaves, np.int64)

    def _minima(self, depth: np.ndarray) -> None:
        """Minima up to and from every place inside its block, and a sparse table over whole blocks."""
        blocks = -(-len(depth) // BLOCK)
        whole = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        whole[:len(depth)] = depth
        whole = whole.reshape(blocks, BLOCK)
        self.upto = np.minimum.accumulate(whole, 1).ravel()
        self.onward = np.minimum.accumulate(whole[:, ::-1], 1)[:, ::-1].ravel()
        self.flat = whole.ravel()
        self.table = [whole.min(1)]
        while (width := 1 << len(self.table)) <= blocks:
            last = self.table[-1]
            self.table.append(np.minimum(last[:blocks - width + 1], last[width // 2:blocks - width + 1 + width // 2]))

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes x and y (different ones), pair by pair."""
        a, b = self.visit[x], self.visit[y]
        a, b = np.minimum(a, b), np.maximum(a, b)
        low, high = a // BLOCK, b // BLOCK
        out = np.minimum(self.onward[a], self.upto[b])
        inner = high - low - 1
        for level in range(len(self.table)):
            here = np.flatnonzero((inner >> level == 1) & (inner > 0))
            if len(here):
                t = self.table[level]
                out[here] = np.minimum(out[here], np.minimum(t[low[here] + 1], t[high[here] - (1 << level)]))
        same = np.flatnonzero(low == high)
        if len(same):  # both in one block: its entries between them
            places = a[same, None] + np.arange(BLOCK)
            inside = places <= b[same, None]
            got = self.flat[np.minimum(places, len(self.flat) - 1)]
            out[same] = np.where(inside, got, np.iinfo(np.int32).max).min(1)
        return out


def _next_smaller(order: np.ndarray) -> np.ndarray:
    """For each place the next one whose suffix stands earlier in ``order`` (the number of places if there is none)."""
    n = len(order)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    rank, out, stack = rank.tolist(), [n] * n, []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(words: np.ndarray, pieces: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period; ``pieces`` are the ends of the parts no run crosses."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    k = len(pieces)  # separators are 1..k; 0 ends the whole and is the smallest symbol, k + 1.. are words
    _, code = np.unique(words, return_inverse=True)
    s = np.insert(code + k + 1, pieces, np.arange(1, k + 1))
    m = len(s)
    here = np.ones(m, bool)
    here[pieces + np.arange(k)] = False
    tree = SuffixTree([*s.tolist(), 0])
    back = SuffixTree([*s[::-1].tolist(), 0])
    back.tour()
    found = []
    for order in (tree.tour(), tree.descending(k + 1)):
        j = _next_smaller(order)[:m]
        i = np.flatnonzero(here & (j < m + 1))
        i, j = i[j[i] < m], j[i][j[i] < m]
        right = tree.common(i, j).astype(np.int64)
        left = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        left[inner] = back.common(m - i[inner], m - j[inner])
        period, length = j - i, right + left + (j - i)
        good = length >= np.maximum(least, repeats * period)
        found.append(np.stack([i - left, length, period], 1)[good])
    out = np.unique(np.concatenate(found), axis=0)
    out = out[np.lexsort((out[:, 2], out[:, 0]))]
    out[:, 0] -= np.searchsorted(pieces + np.arange(k), out[:, 0])  # without the separators before it
    return out


def reduce(symbols: np.ndarray, row: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Mask of the words that may lie in a run; ``symbols`` are the words' hashes, ``row`` their texts' numbers (ascending).

    A run of length n >= max(least, repeats * q) holds each of its words floor(n / q) >= repeats times, and each sequence of
    GRAM words that starts in it floor((n - GRAM + 1) / q) times, which is 2 or more from least 6 and 4 repeats on.
    """
    keep = np.ones(len(symbols), bool)
    grams = repeats >= REPEATS and least >= LEAST
    for _ in range(ROUNDS):
        at = np.flatnonzero(keep)
        if not len(at):
            break
        new = np.append(True, (np.diff(at) > 1) | (row[at[1:]] != row[at[:-1]]))
        piece = np.cumsum(new) - 1
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        good = size[piece] >= least
        mark = mix(piece.astype(np.uint64) + np.uint64(1))
        good &= _often(symbols[at] ^ mark, repeats)
        if grams and len(at) >= GRAM:
            start = np.flatnonzero(piece[GRAM - 1:] == piece[:-GRAM + 1])
            twice = start[_often(gram_hash(symbols[at], GRAM)[start] ^ mark[start], 2)]
            good &= cover(len(at), twice, twice + GRAM)
        if good.all():
            break
        keep[at[~good]] = False
    return keep


def _often(keys: np.ndarray, times: int) -> np.ndarray:
    """Mask of the keys that occur ``times`` times or more."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))[:len(keys)]
    count = np.diff(np.append(first, len(keys)))
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(count >= times, count)
    return out


def _texts(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[bytes]]:
    """Per text its runs and the words that stay, joined by one space."""
    starts, ends, first = word_spans(data, offsets)
    symbols = word_hash(data, starts, ends)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keep = reduce(symbols, row)
    dropped = np.zeros(len(starts), bool)
    runs = [np.zeros((0, 3), np.int64)] * (len(first) - 1)
    for r in np.unique(row[keep]).tolist():
        at = first[r] + np.flatnonzero(keep[first[r]:first[r + 1]])
        ends_here = np.append(np.flatnonzero(np.diff(at) > 1) + 1, len(at))
        found = runs_of(symbols[at], ends_here)
        if len(found):
            found[:, 0] = at[found[:, 0]] - first[r]
            runs[r] = found
            begin = first[r] + found[:, 0]
            dropped[first[r]:first[r + 1]] = cover(first[r + 1] - first[r], begin + found[:, 2] - first[r], begin + found[:, 1] - first[r])
    stay = np.flatnonzero(~dropped)
    size = ends[stay] - starts[stay]
    taken = np.full(int((size + 1).sum()), 32, np.uint8)  # each word and a space after it
    ahead = np.cumsum(size + 1) - (size + 1)
    taken[spread(ahead, size)] = data[spread(starts[stay], size)]
    bounds = np.append(ahead, len(taken))[np.searchsorted(stay, first)]
    raw = taken.tobytes()
    return runs, [raw[a:max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def with_runs(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and one struct: the runs of ``text`` and the collapsed text; also its name. No shuffle."""
    def kernel(column: pa.Array) -> pa.Array:
        data, off = utf8(column)
        runs, collapsed = [], []
        for a, b in slices(off):
            r, c = _texts(data[off[a]:off[b]], off[a:b + 1] - off[a])
            runs += r
            collapsed += c
        table = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
        items = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(3)], ["start", "length", "period"])
        ends = np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32)
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, items), pa.array(collapsed, pa.binary()).cast(pa.string())],
                                          ["runs", "collapsed"])
    name = free_name(docs, "periodic")
    return append_column(docs, name, RUNS, [text], kernel), name


def with_planted_periods(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and the text in which one of ten documents, by its key's crc32, has a periodic tail.

    With h = crc32(decimal key) and g = h // 10, a text of n words with h % 10 = 0 keeps its words below a = g % n; each later
    word i becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). The other texts, and rows without a key, stay as they are.
    """
    def kernel(keys: pa.Array, column: pa.Array) -> pa.Array:
        out = []
        for k, t in zip(keys, column):
            k, h = k.as_py(), 1
            if k is not None:
                h = zlib.crc32(str(k).encode())
            if k is None or h % 10 or not t.is_valid:
                out.append(t.as_py())
                continue
            raw = t.as_py()
            b = np.frombuffer(raw.encode(), np.uint8)
            starts, ends, _ = word_spans(b, np.array([0, len(b)]))
            n, g = len(starts), h // 10
            if not n:
                out.append(raw)
                continue
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            at = np.arange(n)
            at[a:] = a + (at[a:] - a) % p
            out.append(b" ".join(b[s:e].tobytes() for s, e in zip(starts[at].tolist(), ends[at].tolist())).decode())
        return pa.array(out, pa.string())
    name = free_name(docs, "planted")
    return append_column(docs, name, "string", [key, text], kernel), name


def run_lines(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def longest(runs: Column) -> Column:
    """The run with the greatest length, then the smallest start, then the smallest period; null without runs."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"], (-r["start"]).alias("back"), (-r["period"]).alias("p"))))


ship(__name__)
