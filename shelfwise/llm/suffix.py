"""Suffix sorting of a set of short sequences, in numpy."""
from __future__ import annotations

import numpy as np

from shelfwise.llm.common import ship


def ranks(keys: np.ndarray, remaining: np.ndarray, first_depth: int, longest: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffix array of all positions, and the rank of each position by its first d symbols for each d reached.

    ``keys`` orders positions by their first ``first_depth`` symbols (ends included), ``remaining`` is the
    number of symbols up to the end of the position's sequence (0 at its terminator). Depths double until
    ``longest`` is covered or no two positions tie; only ties are sorted again. A rank is the row at which its
    group starts. Equal suffixes stand in text order, as if every terminator were unique.
    """
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])  # rows that start a group
    rank = np.empty(len(keys), np.uint64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0)).astype(np.uint64)
    by_depth, depth = {first_depth: rank.copy()}, first_depth
    while True:
        rows = np.flatnonzero(~(new & np.append(new[1:], True)))
        tied = order[rows]
        last = depth >= longest or not len(rows)
        if last:
            ahead = tied.astype(np.uint64)
        else:
            ahead = np.zeros(len(tied), np.uint64)
            inside = np.flatnonzero(remaining[tied] >= depth)
            ahead[inside] = rank[tied[inside] + depth] + np.uint64(1)
        key = (rank[tied] << np.uint64(32)) | ahead
        by_key = np.argsort(key)
        tied, key = tied[by_key], key[by_key]
        order[rows] = tied
        if last:
            return order, by_depth
        new[rows[1:]] |= key[1:] != key[:-1]
        rank[tied] = np.maximum.accumulate(np.where(new[rows], rows, 0)).astype(np.uint64)
        depth *= 2
        by_depth[depth] = rank.copy()


def join(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each sequence in the joined text (one terminator after each), and symbols left at every position."""
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    total = int((lengths + 1).sum())
    left = np.repeat(starts + lengths, lengths + 1) - np.arange(total)
    return starts, left


ship(__name__)
