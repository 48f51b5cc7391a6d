"""Shared helpers of the training-data operators: text buffers, vectorised words and rolling hashes.

Kernels work on whole Arrow batches: the UTF-8 bytes of many documents are one numpy array plus offsets,
so the per-document cost in Python is small. Nothing here depends on Spark beyond shipping by value.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

CHUNK_BYTES = 1 << 20  # texts are handled in slices of about this size; one longer text is a slice of its own
SPACES = b" \t\n\x0b\x0c\r"  # U+0020 and U+0009..U+000D separate words


def ship(name: str) -> None:
    """Pickle a module's functions by value, so executors need no package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose texts take about ``limit`` bytes; every row is in exactly one."""
    n = len(offsets) - 1
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < max(n, 1):
        size = max(n, 1 << 20)
        _POWERS["up"] = np.cumprod(np.full(size, _MULT, np.uint64))
        _POWERS["down"] = np.cumprod(np.full(size, _INV, np.uint64))
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer: spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums of a rolling hash over 64-bit symbols."""
    up, _ = _powers(len(symbols))
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up[:len(symbols)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:end] for each pair, independent of where the span stands."""
    _, down = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hash(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k symbols (n - k + 1 values, none if there are fewer symbols)."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(symbols)
    _, down = _powers(len(prefix))
    return mix((prefix[k:] - prefix[:-k]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data`` and, per row, the index of its first word (n + 1 values).

    ``apart`` says which bytes separate words; words never cross rows. Offsets are relative to ``data``.
    """
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(apart[data], out=inside[1:-1])
    edge = inside[1:] != inside[:-1]
    edges = np.flatnonzero(edge)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a row border within a run of word bytes ends one word, starts another
    if len(cuts):
        cuts = np.unique(cuts)
        edges = np.sort(np.concatenate([edges, cuts, cuts]))
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    return span_hash(prefix_hash(byte_symbols(data)), starts, ends)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row number of every item, from the first-item index of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges [start, start + length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return base + np.arange(total)


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of the positions below n that lie in any [start, end)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def run_bounds(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    padded = np.concatenate([[False], mask, [False]])
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[0::2], edges[1::2]


ship(__name__)
