"""Substring dedup: relative Lempel-Ziv factors of at least ``length`` words are duplicate spans.

Contract: each word covered by a ``length``-word window whose word sequence also starts anywhere else, same
document included, is removed (the first occurrence too). Windows are judged on the input.

Method. ``segments`` deals the windows so that equal ones meet in one reference block. Each block's distinct
segments are suffix-sorted; every segment is factored greedily against the block: at a position the factor is
the longest string that occurs at another place of the block. All windows inside a factor of ``length`` words
are duplicates. A window that crosses a factor boundary can still be one, so the positions whose window
reaches over the boundary get a look-up of their own. A segment with several places matches itself as a whole.

Words are maximal runs of bytes other than U+0020 and U+0009..U+000D, compared by a 64-bit hash.

Cases: null text has no words (kept hash of the empty string); texts under ``length`` words are kept; rows that
repeat id and text are one document and not repeats of each other; null ids stay null; an empty table gives an
empty result; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from shelfwise.llm.common import run_bounds, ship, slices, spread, word_hash, word_spans
from shelfwise.llm.segments import NULL_ID, number_lists, repeated_windows, verdicts, window_cover
from shelfwise.llm.suffix import join, ranks

GRAM = 8  # words of an anchor


class ReferenceBlock:
    """Suffix array of a block of word sequences with the longest match elsewhere at every position."""

    def __init__(self, sequences: list[np.ndarray], copies: np.ndarray):
        self.lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.starts, left = join(self.lengths)
        words = np.zeros(len(left), np.uint64)
        inside = left > 0
        words[inside] = np.concatenate(sequences)
        _, symbol = np.unique(words[inside], return_inverse=True)
        key = np.zeros(len(left), np.uint64)
        key[inside] = symbol.astype(np.uint64) + np.uint64(1)
        order, by_depth = ranks(key, left, 1, int(self.lengths.max()) + 1)
        above, below = order[1:], order[:-1]
        same = np.zeros(len(above), np.int64)  # symbols that neighbours in suffix order share, by halving depths
        for depth in sorted(by_depth, reverse=True):
            rank = by_depth[depth]
            a, b = above + same, below + same
            hit = (left[above] - same >= depth) & (left[below] - same >= depth)
            hit[hit] = rank[a[hit]] == rank[b[hit]]
            same += depth * hit
        longest = np.zeros(len(left), np.int64)
        np.maximum.at(longest, above, same)
        np.maximum.at(longest, below, same)
        owner = np.repeat(np.arange(len(sequences)), self.lengths + 1)
        self.longest = np.where(copies[owner] > 1, left, longest)

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """Greedy factors of all sequences, one factor of each per step: (text position, length)."""
        place, end = self.starts.copy(), self.starts + self.lengths
        at, size = [], []
        while len(place):
            step = np.maximum(self.longest[place], 1)
            at.append(place)
            size.append(step)
            place = place + step
            live = place < end
            place, end = place[live], end[live]
        return np.concatenate(at), np.concatenate(size)

    def duplicates(self, length: int) -> np.ndarray:
        """Mask over text positions: the window of ``length`` words that starts there occurs elsewhere."""
        at, size = self.factors()
        mask = np.zeros(len(self.longest), bool)
        inner = np.maximum(size - length + 1, 0)
        mask[spread(at, inner)] = True
        across = spread(at + inner, size - inner)  # windows that start in the factor and reach over its end
        mask[across] = self.longest[across] >= length
        return mask


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``word_hash`` over about a megabyte of the text at a time."""
    out = [np.zeros(0, np.uint64)]
    for a, b in slices(np.append(starts, len(data))):
        low, high = starts[a], ends[b - 1]
        out.append(word_hash(data[low:high], starts[a:b] - low, ends[a:b] - low))
    return np.concatenate(out)


def word_slices(text: bytes):
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    return starts, ends


def remove_shared_passages(docs: DataFrame, length: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (the removed word ranges) of every row of ``docs``."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM} words")

    def symbols(data, offsets):
        starts, ends, first = word_spans(data, offsets)
        return hashes(data, starts, ends), first

    def slicer(text: bytes):
        starts, ends = word_slices(text)

        def take(at, run):
            last = at + run + length - 2
            return b" ".join(text[starts[at]:ends[last]].split())
        return take

    def engine(strings, copies, runs):
        data = np.frombuffer(b"".join(strings), np.uint8)
        offsets = np.cumsum([0, *map(len, strings)])
        starts, ends, first = word_spans(data, offsets)
        block = ReferenceBlock(np.split(word_hash(data, starts, ends), first[1:-1]), copies)
        stay = ~block.duplicates(length)
        windows = np.zeros(len(stay), bool)
        windows[spread(block.starts, runs)] = True
        low, high = run_bounds(stay & windows)  # length - 1 positions without a window end every sequence
        seg = np.searchsorted(block.starts, low, "right") - 1
        return seg, low - block.starts[seg], high - block.starts[seg]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for did, z, packs, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1), *map(number_lists, batch.columns[2:])):
                words = unpress.decompress(z.as_py()).split()
                kept, low, high = words, [], []
                if len(packs):
                    gone = window_cover(repeated_windows(len(words), packs, starts, ends), len(words), length)
                    low, high = (x.tolist() for x in run_bounds(gone))
                    kept = [w for a, b in zip([0, *high], [*low, len(words)]) for w in words[a:b]]
                row = (None if did == NULL_ID else did, len(words), len(words) - len(kept),
                       hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": s, "end": e} for s, e in zip(low, high)])
                for column, value in zip(out, row):
                    column.append(value)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), spans]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], list(NAMES))

    found = verdicts(docs, symbols, slicer, engine, length, GRAM)
    return found.select("did", "z", "packs", "starts", "ends").mapInArrow(finish, OUT)


NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256", "spans")
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>"
ship(__name__)
