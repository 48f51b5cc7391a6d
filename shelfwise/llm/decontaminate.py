"""Benchmark decontamination: Wu-Manber search for benchmark windows in every document.

Contract: A-Z are lower-cased; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is ``width`` consecutive
words of an item; an item of fewer words (but not none) is one window. A document word inside any occurrence of
a window is hit.

Method: texts become words with one blank around each, so a window is a byte string that starts and ends with a
blank. Windows are put in classes by length; a class's tables use blocks of B bytes: the shift table says how far the end of the search
window may move for the block that stands there (blocks in no window allow the full shift), a shift of zero
leads to the bucket of windows whose prefix ends in that block, and these are compared byte by byte. A batch of
texts is searched by many pointers at once, each over its own short stretch of window ends.

The documents are never shuffled. The benchmark comes to the driver and to the tasks in blocks of about
``block_bytes`` of item text (one longer item is a block); several blocks are searched one after the other in a
chain of narrow steps, and a task builds a block's tables once. At most ``at_once`` blocks live together: after so many the documents
are written with the hits so far, the blocks are released and the next pass reads the written table. So the memory of driver and
tasks is bounded whatever the benchmark's size; each further pass writes and reads the documents once more.

Cases: null or empty text has no words; items without words or null are ignored; equal windows of several items
count for each; items with a null id mark words but are not listed; repeated items list once; without items
nothing is hit; null document ids, repeated rows and extra columns pass through.
"""
from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import cover, lower_ascii, rows_of, run_bounds, ship, slices, spread, utf8, word_spans
from shelfwise.llm.tables import append_column, free_name, written

_APART = np.ones(256, bool)
_APART[0x30:0x3A] = False
_APART[0x61:0x7B] = False
_APART[0x80:] = False
CLASSES = ((3, 3), (8, 4), (24, 8))  # least window length in bytes, block length
AT_ONCE = 4  # blocks whose tables live together
STRETCH = 256  # window ends that one pointer goes over
FOUND = "struct<n_words: long, starts: array<long>, ends: array<long>, items: array<string>>"


def blank_separated(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, place of every word in it, first word of each row): rows look like `` w1 w2 `` and two blanks part rows."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets, _APART)
    sizes = ends - starts
    row = rows_of(first)
    place = np.cumsum(sizes + 1) - (sizes + 1) + row + 1
    buffer = np.full(int((sizes + 1).sum()) + len(offsets) + 8, 0x20, np.uint8)
    buffer[spread(place, sizes)] = data[spread(starts, sizes)]
    return buffer, place, first


def windows(texts: Iterable[str], width: int) -> list[list[bytes]]:
    """The windows of every item, with blanks around the words."""
    out = []
    for text in texts:
        data = lower_ascii(np.frombuffer((text or "").encode(), np.uint8))
        starts, ends, _ = word_spans(data, np.array([0, len(data)]), _APART)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        out.append([b" " + b" ".join(words[i:i + width]) + b" " for i in range(max(len(words) - width, 0) + 1)] if words else [])
    return out


class _Class:
    """Shift and bucket tables of windows that are at least ``least`` bytes long."""

    def __init__(self, patterns: list[bytes], ids: np.ndarray, block: int):
        self.block, self.ids = block, ids
        self.sizes = np.array([len(p) for p in patterns])
        self.least = int(self.sizes.min())
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.buffer = np.frombuffer(b"".join(patterns) + b"\0" * 8, np.uint8)
        prefix = self.starts[:, None] + np.arange(self.least - block + 1)[None, :]
        blocks = _blocks(self.buffer, block)[prefix]  # every block of every window's prefix
        self.bits = max(12, int(8 * blocks.size).bit_length())
        self.shift = np.full(1 << min(self.bits, 22), self.least - block + 1, np.int64)
        self.bits = min(self.bits, 22)
        for j in range(blocks.shape[1]):  # later blocks allow smaller shifts
            np.minimum.at(self.shift, self._slot(blocks[:, j]), self.least - block - j)
        order = np.argsort(blocks[:, -1], kind="stable")
        self.bucket, self.members = blocks[order, -1], order

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start in the text, window) of all occurrences."""
        n = len(text) - 8
        blocks = _blocks(text, self.block)
        place = np.arange(self.least, n + 1, STRETCH)  # ends of the search windows
        stop = np.minimum(place + STRETCH, n + 1)
        ends = []
        while len(place):
            step = self.shift[self._slot(blocks[place - self.block])]
            ends.append(place[step == 0])
            place = place + np.maximum(step, 1)
            live = place < stop
            place, stop = place[live], stop[live]
        end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        here = blocks[end - self.block]
        low, high = np.searchsorted(self.bucket, here, "left"), np.searchsorted(self.bucket, here, "right")
        start = np.repeat(end - self.least, high - low)
        window = self.members[spread(low, high - low)]
        fits = start + self.sizes[window] <= n
        start, window = start[fits], window[fits]
        at = 0
        mine = _blocks(self.buffer, 8)
        whole = _blocks(text, 8) if self.block != 8 else blocks
        while len(start) and at < int(self.sizes[window].max()):  # eight bytes of every pair at a time
            tail = np.clip(self.sizes[window] - at, 0, 8).astype(np.uint64)
            mask = np.where(tail == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.uint64(8) * tail)) - np.uint64(1))
            more = np.minimum(start + at, len(whole) - 1)
            same = ((whole[more] ^ mine[np.minimum(self.starts[window] + at, len(mine) - 1)]) & mask) == 0
            start, window = start[same], window[same]
            at += 8
        return start, self.ids[window]


def _blocks(data: np.ndarray, block: int) -> np.ndarray:
    """The ``block`` bytes from every position, as a number (little endian); the last 7 positions have none."""
    out = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64).ravel()
    return out if block == 8 else out & np.uint64((1 << (8 * block)) - 1)


class Matcher:
    """All windows of a block of items, ready to search texts."""

    def __init__(self, texts: list[str], width: int):
        self.width = width
        self.items: dict[bytes, list[int]] = {}
        for i, found in enumerate(windows(texts, width)):
            for w in dict.fromkeys(found):
                self.items.setdefault(w, []).append(i)
        self.patterns = list(self.items)
        self.n_words = np.array([p.count(b" ") - 1 for p in self.patterns], np.int64)
        owners = list(self.items.values())
        self.owner_first = np.cumsum([0, *map(len, owners)])
        self.owners = np.array([i for x in owners for i in x], np.int64)
        self.classes = []
        bounds = [c[0] for c in CLASSES[1:]] + [1 << 62]
        for (least, block), top in zip(CLASSES, bounds):
            ids = [k for k, p in enumerate(self.patterns) if least <= len(p) < top]
            if ids:
                self.classes.append(_Class([self.patterns[k] for k in ids], np.array(ids), block))

    def search(self, data: np.ndarray, offsets: np.ndarray):
        """n_words per row, hit mask over all words, first word of each row, (row, item) pairs."""
        text, place, first = blank_separated(data, offsets)
        hits, pairs = [], []
        for c in self.classes:
            start, window = c.find(text)
            hits.append((np.searchsorted(place, start + 1), window))
        at = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, np.int64)
        window = np.concatenate([h[1] for h in hits]) if hits else np.zeros(0, np.int64)
        mask = cover(len(place), at, at + self.n_words[window]) if len(at) else np.zeros(len(place), bool)
        if len(at):
            row = np.searchsorted(first, at, "right") - 1
            n = np.diff(self.owner_first)[window]
            items = self.owners[spread(self.owner_first[window], n)]
            pairs = np.unique(np.stack([np.repeat(row, n), items]), axis=1).T.tolist()
        return np.diff(first), mask, first, pairs


def _blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterable[tuple[list, list]]:
    """The items in blocks of about ``block_bytes``: each is collected on its own, dealt by hash of the item."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")).filter(
        "text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(-(-total // block_bytes)), 1)  # without items one empty block gives the column
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        part.sort(key=lambda r: (r.item_id is None, r.item_id or "", r.text))
        yield [r.item_id for r in part], [r.text for r in part]


def find_windows(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 1 << 20,
                 at_once: int = AT_ONCE) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): n_words, hit word ranges and the items found."""
    out = free_name(docs, "benchmark_hits")
    blocks = _blocks_of(benchmark, block_bytes)
    spark, live = docs.sparkSession, []
    for k, (ids, texts) in enumerate(blocks):
        if len(live) == at_once:
            docs = written(docs, "benchmark-hits")
            while live:
                live.pop().destroy()  # the written table does not need it
        shared = spark.sparkContext.broadcast((ids, texts))  # about block_bytes
        live.append(shared)
        column = out if k == 0 else free_name(docs, f"{out}_{k}")

        def kernel(text, before=None, shared=shared, held=[]):  # noqa: B006 - one list a task: the tables are built once
            ids, texts = shared.value
            if not held:
                held.append(Matcher(texts, width))
            matcher = held[0]
            data, off = utf8(text)
            words, lows, highs, items = [], [], [], []
            for a, b in slices(off):
                n, mask, first, pairs = matcher.search(data[off[a]:off[b]], off[a:b + 1] - off[a])
                named: list[set] = [set() for _ in range(b - a)]
                for row, item in pairs:
                    if ids[item] is not None:
                        named[row].add(ids[item])
                hit = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(mask)])[first]))
                ranges = {int(r): run_bounds(mask[first[r]:first[r + 1]]) for r in hit}
                for r in range(b - a):
                    low, high = ranges.get(r, ((), ()))
                    words.append(int(n[r]))
                    lows.append(list(map(int, low)))
                    highs.append(list(map(int, high)))
                    items.append(sorted(named[r]))
            if before is not None:
                for i, old in enumerate(before.to_pylist()):
                    lows[i] = old["starts"] + lows[i]
                    highs[i] = old["ends"] + highs[i]
                    items[i] = sorted({*old["items"], *items[i]})
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            return pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip((words, lows, highs, items), kinds)],
                                              ["n_words", "starts", "ends", "items"])
        docs = append_column(docs, column, FOUND, ["text"] if k == 0 else ["text", out], kernel)
        if k:
            docs = docs.drop(out).withColumnRenamed(column, out)
    return docs, out


def hit_words(found: Column) -> Column:
    """Number of words inside any of the ranges; ranges of several blocks may overlap."""
    ranges = F.array_sort(F.arrays_zip(found["starts"], found["ends"]))
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(ranges, state, lambda s, r: F.struct(
        (s["n"] + F.greatest(r["ends"] - F.greatest(r["starts"], s["upto"]), F.lit(0))).alias("n"),
        F.greatest(s["upto"], r["ends"]).alias("upto")), lambda s: s["n"])


def report(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    found, out = find_windows(docs.select("doc_id", "text"), benchmark, width, block_bytes)
    hits = F.col(out)
    return found.select("doc_id", hits["n_words"].alias("n_words"), hit_words(hits).alias("n_hit"),
                        F.size(hits["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
                        (F.size(hits["starts"]) > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 1 << 20) -> DataFrame:
    """The rows of ``docs`` without any hit, with their own columns."""
    found, out = find_windows(docs, benchmark, width, block_bytes)
    return found.filter(F.size(F.col(out)["starts"]) == 0).select(*docs.columns)


ship(__name__)
