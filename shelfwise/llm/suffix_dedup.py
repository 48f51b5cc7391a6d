"""Suffix-array dedup: a run-length index marks byte strings that occur earlier in the corpus.

Contract: every byte covered by a ``length``-byte string that also starts earlier (smaller doc_id, or same
document and smaller offset) is removed. Strings are judged on the input; matches never cross documents.

Method. ``segments`` deals the windows so that equal ones meet in one block. A block's distinct segments,
joined in text order, are suffix-sorted; the Burrows-Wheeler transform is kept as runs, with the suffix
position sampled at each run end and the row that each run start maps to. Every segment is then streamed
through the runs from its end to its start: each step maps the current row to the row of the one symbol
longer suffix, and the matching statistic there (capped at ``length``) comes with the interval of rows that
share it. An interval's earliest text position is its first occurrence; other members are repeats.

Cases: null text is empty (nothing removed, hash of the empty string); texts under ``length`` bytes are kept;
null ids come last in order and stay null; rows repeating id and text are one document; rows repeating only the
id are ordered by a hash of their texts; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from shelfwise.llm.common import run_bounds, ship
from shelfwise.llm.segments import NULL_ID, number_lists, repeated_windows, verdicts, window_cover
from shelfwise.llm.suffix import join, ranks

GRAM = 24  # bytes of an anchor
BASE = 7  # bytes in the first sort key; the eighth byte is how many of them there are


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of short byte strings, with sampled run ends."""

    def __init__(self, strings: list[bytes], length: int):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts, left = join(lengths)
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        key = _first_bytes(text, left)
        order, by_depth = ranks(key, left, BASE, int(lengths.max()) + 1)
        head = order == 0
        before = np.where(head, 256, text[order - 1].astype(np.int64))
        before[left[order - 1] == 0] = 256  # a string's first symbol follows a terminator
        change = np.append(True, before[1:] != before[:-1])
        self.run_start = np.flatnonzero(change)
        run_symbol = before[self.run_start]
        run_length = np.diff(np.append(self.run_start, len(text)))
        self.sample = order[np.append(self.run_start[1:], len(text)) - 1]  # text position at each run end
        by_symbol = np.argsort(run_symbol, kind="stable")
        self.run_to = np.empty(len(by_symbol), np.int64)
        # rows 0..strings-1 are the terminators' own suffixes; then the suffixes by first symbol
        self.run_to[by_symbol] = np.cumsum(run_length[by_symbol]) - run_length[by_symbol] + len(strings)
        # rows that share their first ``length`` symbols with the row above belong to one interval
        depth = max(d for d in by_depth if d <= length)
        rank = by_depth[depth]
        rest = np.minimum(order + length - depth, len(text) - 1)
        full = left[order] >= length
        same = np.zeros(len(text), bool)
        same[1:] = (full[1:] & full[:-1] & (rank[order[1:]] == rank[order[:-1]]) & (rank[rest[1:]] == rank[rest[:-1]]))
        self.interval = np.cumsum(~same) - 1
        self.size = len(text)

    def step(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one symbol longer."""
        run = np.searchsorted(self.run_start, rows, "right") - 1
        return self.run_to[run] + rows - self.run_start[run]


def _first_bytes(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Sort key of every position: its next ``BASE`` bytes, up to the end of its string, and how many they are."""
    key = np.zeros(len(text) + 8, np.uint64)
    key[:len(text)] = text
    for width in (1, 2, 4):  # 2, 4, then 8 bytes from every position, the first one highest
        key[:-width] = (key[:-width] << np.uint64(8 * width)) | key[width:]
    size = np.minimum(left, BASE).astype(np.uint64)
    drop = np.uint64(64) - np.uint64(8) * size
    drop[size == 0] = 63
    return ((key[:len(text)] >> drop) << drop) * (size > 0) | size


def matching_windows(strings: list[bytes], runs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, interval) of every window, found by streaming the strings through their index."""
    index = RunLengthIndex(strings, length)
    by_size = np.argsort(-runs, kind="stable")
    rows = np.arange(len(strings))[by_size]  # the suffix row of each string's terminator
    total = (runs + length - 1)[by_size]
    who, at, interval = [], [], []
    for done in range(1, int(total[0]) + 1):
        live = int(np.searchsorted(-total, -done, "right"))
        rows = index.step(rows[:live])
        if done >= length:  # the statistic has reached the cap: these positions start a full window
            who.append(by_size[:live])
            at.append(total[:live] - done)
            interval.append(index.interval[rows])
    return np.concatenate(who), np.concatenate(at), np.concatenate(interval)


def stays(strings: list[bytes], copies: np.ndarray, runs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that occur for the first time, as (string, from, to)."""
    who, at, interval = matching_windows(strings, runs, length)
    order = np.lexsort((at, who, interval))
    first = np.append(True, interval[order][1:] != interval[order][:-1])
    keep = np.zeros((len(strings), int(runs.max()) + 1), bool)
    chosen = order[first]
    keep[who[chosen], at[chosen]] = True
    low, high = run_bounds(keep.ravel())  # a column of False ends every row
    return low // keep.shape[1], low % keep.shape[1], low % keep.shape[1] + (high - low)


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (the removed byte ranges) of every row of ``docs``."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM} bytes")

    def symbols(data, offsets):
        return data, offsets  # widened a piece at a time

    def slicer(text: bytes):
        return lambda at, run: text[at:at + run + length - 1]

    def engine(strings, copies, runs):
        return stays(strings, copies, runs, length)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for did, z, packs, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1), *map(number_lists, batch.columns[2:])):
                text = unpress.decompress(z.as_py())
                low = high = np.zeros(0, np.int64)
                kept = text
                if len(packs):
                    gone = window_cover(repeated_windows(len(text), packs, starts, ends), len(text), length)
                    low, high = run_bounds(gone)
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                row = (None if did == NULL_ID else did, len(text), len(text) - len(kept), len(low),
                       hashlib.sha256(kept).hexdigest(), [{"start": s, "end": e} for s, e in zip(low.tolist(), high.tolist())])
                for column, value in zip(out, row):
                    column.append(value)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), spans]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], list(NAMES))

    found = verdicts(docs, symbols, slicer, engine, length, GRAM)
    return found.select("did", "z", "packs", "starts", "ends").mapInArrow(finish, OUT)


NAMES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
OUT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
       "spans array<struct<start: long, end: long>>")
ship(__name__)
