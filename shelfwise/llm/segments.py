"""Bring equal windows of a corpus together without an all-pairs join.

A *window* is L consecutive symbols (bytes or words) of one document. Its *anchor* is the smallest hash
among the k-grams inside it, so equal windows have equal anchors. Neighbouring windows with one anchor
and place form a *segment* of ``run + L - 1`` symbols. Only segments whose anchor occurs in two places can hold a
repeated window; those are cut out of the texts and dealt by anchor, so that every occurrence of a window
meets in one block. An engine then indexes the block and says which windows of each distinct segment,
at its first place, stay; at all its later places every window is a repeat.

An anchor with very many different segments (a frequent line shorter than a window) would make a block without bound.
Such hot anchors are found on a sample, and their windows are dealt by the smallest of longer grams instead, those of
grams that are hot again by the whole window. Only the content of a window decides, so equal windows still meet.

Shuffles: 1. (anchor, place) of every segment, about one per (L - k + 2) / 2 symbols; 2. the packed texts
joined to their repeated segments; 3. the repeated segments, copies of one task merged beforehand;
4. the packed texts joined to the verdicts. Anchors that the sample shows at two places or more need not be brought together to be
known as shared: the places of the FREQUENT commonest ones are dealt by place, so none of them is one task's work. Only anchors are
collected and broadcast, 8 bytes each: at most FREQUENT, and HOT_ANCHORS per level (of more, the largest are split and
the others stay whole).

Long texts are cut into pieces of PIECE symbols that overlap by a window less one symbol, so every window is in one piece; the memory
of a piece does not grow with its text.

A place is (doc_id, hash of the text, offset); null ids come last. Rows that repeat both the id and the
text are one document: each gets the same result, and none is a repeat of the other.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_symbols, gram_hash, prefix_hash, ship, slices, sliding_min, span_hash, spread, utf8
from shelfwise.llm.tables import written

MAX_RUN = 256  # windows that one segment can hold
PLACE_BITS = (1 << 28) - 1  # low bits of a ranked gram tell where it stands
NULL_ID = np.iinfo(np.int64).max
BLOCK_BYTES = 1 << 19  # an engine gets whole anchors of about this size at a time; small blocks sort in cache
SAMPLE = 128  # one of so many chunks of the texts is searched for hot anchors
SAMPLE_BYTES = 1 << 16  # of a chunk; a shorter text is one chunk
HOT = 32  # different segments of an anchor in the sample from which it is hot: about BLOCK_BYTES in the corpus
HOT_ANCHORS = 1 << 18  # hot anchors of a level that are split, those with the most segments first
FREQUENT = 1 << 10  # commonest anchors whose places are dealt by place
PIECE = 1 << 18  # symbols of a text that are searched at a time

DOC = "did long, h long, z binary"
PLACE = "anchor long, did long, h long, pack long"
CHUNK = "did long, h long, begin long, chunk binary"
SEGMENT = "anchor long, did long, h long, pack long, copies long, seg binary"
KEPT = "did long, h long, starts array<long>, ends array<long>"


def pack_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as (did, h, z): z is the compressed text, since it is shuffled twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, off = utf8(batch.column(2))
            raw = data.tobytes() if len(off) < 2 else data[off[0]:off[-1]].tobytes()
            at = off - off[0]
            z = [press.compress(raw[at[i]:at[i + 1]]) for i in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z, pa.binary())], ["did", "h", "z"])
    return keyed(docs).mapInArrow(run, DOC)


def keyed(docs: DataFrame) -> DataFrame:
    """did, h, text of every row; other columns are left out, whatever their names."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.hash(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("h"), F.col("text").alias("text"))


def gram_sizes(length: int, k: int) -> list[int]:
    """Symbols of the anchors by level: the first, those of hot first ones, and the whole window, which need not be split."""
    return [k, (k + length + 1) // 2, length]


def segments_of(symbols: np.ndarray, first: np.ndarray, length: int, k: int,
                hot: list[tuple[int, np.ndarray]] | None = None) -> tuple[np.ndarray, ...]:
    """Segments of the rows whose symbols stand one after the other: (row, offset in the row, run, anchor).

    The leftmost smallest gram decides, so equal windows that overlap (periodic texts) are in segments of their own.
    ``hot`` has per level the sorted hot anchors and the symbols of the grams that their windows get instead.
    """
    grams = gram_hash(symbols, k)
    starts = spread(first[:-1], np.maximum(np.diff(first) - length + 1, 0))
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    ranked = (grams & ~np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    ranked = sliding_min(ranked, length - k + 1)[starts]
    at = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    run = np.diff(np.append(at, len(starts)))
    anchor = grams[(ranked[at] & np.uint64(PLACE_BITS)).astype(np.int64)]
    row = np.searchsorted(first, starts[at], "right") - 1
    offset = starts[at] - first[row]
    if not hot or not (split := np.isin(anchor, hot[0][1])).any():
        return row, offset, run, anchor
    size = run[split] + length - 1
    sub = segments_of(symbols[spread(starts[at][split], size)], np.append(0, np.cumsum(size)), length, hot[0][0], hot[1:])
    parts = (row[split][sub[0]], offset[split][sub[0]] + sub[1], *sub[2:])
    return tuple(np.concatenate([whole[~split], part]) for whole, part in zip((row, offset, run, anchor), parts))


def segments_in(symbols: np.ndarray, first: np.ndarray, length: int, k: int,
                hot: list[tuple[int, np.ndarray]] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """``segments_of`` piece by piece. Symbols may be raw bytes (uint8), which are widened a piece at a time."""
    for a in range(0, max(len(symbols) - length + 1, 1), PIECE):
        part = symbols[a:a + PIECE + length - 1]
        row, at, run, anchor = segments_of(widened(part), np.clip(first, a, a + len(part)) - a, length, k, hot)
        if len(row):
            yield row, at + np.maximum(a - first[row], 0), run, anchor


def widened(symbols: np.ndarray) -> np.ndarray:
    return byte_symbols(symbols) if symbols.dtype == np.uint8 else symbols


def sampled(docs: DataFrame) -> DataFrame:
    """One of SAMPLE chunks of all texts, by a hash of the document; written, since it is searched twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(2))
            for i, (did, h, begin) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)))):
                text = data[off[i]:off[i + 1]]
                for a in range(begin * SAMPLE_BYTES, len(text), SAMPLE * SAMPLE_BYTES):
                    yield pa.RecordBatch.from_arrays([pa.array([did], pa.int64()), pa.array([h], pa.int64()), pa.array([a], pa.int64()),
                                                      pa.array([text[a:a + SAMPLE_BYTES].tobytes()], pa.binary())], ["did", "h", "begin", "chunk"])
    begin = F.pmod(F.xxhash64("did", "h"), F.lit(SAMPLE))
    some = keyed(docs).withColumn("first", begin).filter(F.col("first") * SAMPLE_BYTES < F.octet_length("text"))
    return written(some.mapInArrow(run, CHUNK), "text-sample")


def hot_anchors(chunks: DataFrame, symbols: Callable, length: int, k: int) -> list[tuple[int, np.ndarray]]:
    """Per level the symbols of the next level's grams and the sorted anchors with HOT or more different segments in the sample."""
    sizes = gram_sizes(length, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(3):
                text = np.frombuffer(chunk.as_py(), np.uint8)
                sym, first = symbols(text, np.array([0, len(text)]))
                sym = widened(sym)
                prefix = prefix_hash(sym)
                for level, size in enumerate(sizes[:-1]):
                    _, at, n, anchor = segments_of(sym, first, length, size)
                    if len(at):
                        seg = span_hash(prefix, at, at + n + length - 1)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), level)), pa.array(anchor.view(np.int64)),
                                                          pa.array(seg.view(np.int64))], ["level", "anchor", "seg"])
    found = chunks.mapInArrow(run, "level long, anchor long, seg long").distinct().groupBy("level", "anchor").count()
    hot = found.filter(F.col("count") >= HOT)
    out = []
    for level in range(len(sizes) - 1):
        rows = hot.filter(F.col("level") == level).orderBy(F.col("count").desc(), "anchor").limit(HOT_ANCHORS).select("anchor").collect()
        out.append((sizes[level + 1], np.sort(np.array([r.anchor for r in rows], np.int64).view(np.uint64))))
    return out


def frequent_anchors(chunks: DataFrame, symbols: Callable, length: int, k: int, hot: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """The anchors of the most places in the sample, sorted: FREQUENT at most, each of two places or more.

    A chunk may begin or end within a word; an anchor that is in the list for that alone, and has one place in the corpus,
    costs a look at its segment and changes no result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for did, h, begin, chunk in zip(*(c.to_pylist() for c in batch.columns)):
                text = np.frombuffer(chunk, np.uint8)
                sym, first = symbols(text, np.array([0, len(text)]))
                _, at, _, anchor = segments_of(widened(sym), first, length, k, hot)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(np.full(len(at), did)), pa.array(np.full(len(at), h)),
                                                      pa.array(begin + at)], ["anchor", "did", "h", "pack"])
    count = chunks.mapInArrow(run, PLACE).distinct().groupBy("anchor").count().filter("count > 1")
    rows = count.orderBy(F.col("count").desc(), "anchor").limit(FREQUENT).collect()
    return np.sort(np.array([r.anchor for r in rows], np.int64).view(np.uint64))


def places(docs: DataFrame, symbols: Callable, length: int, k: int) -> DataFrame:
    """One row per segment of the corpus; ``symbols(data, offsets)`` gives a slice's symbols and first indices.

    ``known`` says that the sample shows the anchor at two places.
    """
    chunks = sampled(docs)
    levels = hot_anchors(chunks, symbols, length, k)
    shared_state = docs.sparkSession.sparkContext.broadcast((levels, frequent_anchors(chunks, symbols, length, k, levels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, frequent = shared_state.value
        for batch in batches:
            data, off = utf8(batch.column(2))
            did, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in slices(off):
                sym, first = symbols(data[off[a]:off[b]], off[a:b + 1] - off[a])
                for row, at, n, anchor in segments_in(sym, first, length, k, hot):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(did[a + row]), pa.array(h[a + row]),
                         pa.array(at * MAX_RUN + n - 1), pa.array(np.isin(anchor, frequent))], ["anchor", "did", "h", "pack", "known"])
    return keyed(docs).mapInArrow(run, f"{PLACE}, known boolean")


def shared(found: DataFrame) -> DataFrame:
    """The places whose anchor has two or more; a stream over sorted partitions that holds one batch.

    Known anchors are dealt by place and pass; the others are dealt by anchor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, False  # the last row so far, and whether it is known or the row before it has its anchor
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            anchor = whole.column(0).to_numpy()
            keep = np.array(whole.column(4).to_numpy())
            same = anchor[1:] == anchor[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= before
            last = len(anchor) - 1
            before = bool(keep[last])
            yield from whole.slice(0, last).filter(pa.array(keep[:last])).select(PLACES).to_batches()
            held = whole.slice(last, 1).to_batches()[0]
        if held is not None and before:
            yield held.select(PLACES)
    dealt = found.withColumn("deal", F.when(F.col("known"), F.xxhash64("did", "h", "pack")).otherwise(F.col("anchor")))
    return dealt.repartition("deal").drop("deal").sortWithinPartitions("anchor").mapInArrow(run, PLACE)


PLACES = ["anchor", "did", "h", "pack"]


def cut(packed: DataFrame, lists: DataFrame, slicer: Callable) -> DataFrame:
    """The bytes of every shared segment; equal ones of a batch are merged, keeping the first place.

    ``slicer(text)`` gives a function (offset, run) -> bytes of the segment.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            best: dict[tuple[int, bytes], list] = {}
            size = 0
            for did, h, z, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                take = slicer(unpress.decompress(z.as_py()))
                for anchor, pack in _listed(parts):
                    if size > 32 * BLOCK_BYTES:
                        yield _segment_batch(best)
                        best, size = {}, 0
                    key = (anchor, take(pack // MAX_RUN, pack % MAX_RUN + 1))
                    place = (did, h, pack)
                    if (old := best.get(key)) is None:
                        best[key] = [place, 1]
                        size += len(key[1])
                    else:
                        old[1] += old[0] != place
                        old[0] = min(old[0], place)
            if best:
                yield _segment_batch(best)
    return packed.join(lists, ["did", "h"]).select("did", "h", "z", "parts").mapInArrow(run, SEGMENT)


def number_lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of a column as arrays, null as an empty one."""
    for x in column:
        yield x.values.to_numpy() if x.is_valid else np.zeros(0, np.int64)


def _listed(parts: pa.Scalar) -> Iterator[tuple[int, int]]:
    """(anchor, pack) of a list, few of them as Python objects at a time."""
    anchor, pack = parts.values.flatten()
    for i in range(0, len(anchor), 1 << 14):
        yield from zip(anchor.slice(i, 1 << 14).to_pylist(), pack.slice(i, 1 << 14).to_pylist())


def _segment_batch(best: dict) -> pa.RecordBatch:
    keys, values = list(best), list(best.values())
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int64()), *(pa.array([v[0][i] for v in values], pa.int64()) for i in range(3)),
         pa.array([v[1] for v in values], pa.int64()), pa.array([k[1] for k in keys], pa.binary())],
        ["anchor", "did", "h", "pack", "copies", "seg"])


def judge(segments: DataFrame, engine: Callable) -> DataFrame:
    """Per document the window starts that stay, by the engine.

    ``engine(segs, copies, place)`` gets the distinct segments of whole anchors in the order of their first
    places, how many places each has, and the place rows; it returns (segment index, from, to) of windows
    that stay. Blocks hold whole anchors, so equal windows are always in one block.
    """
    def block(best: dict[tuple[int, bytes], list]) -> pa.RecordBatch:
        order = sorted(best.items(), key=lambda x: x[1][0])
        seg, low, high = engine([k[1] for k, _ in order], np.array([v[1] for _, v in order]),
                                np.array([v[0][2] % MAX_RUN + 1 for _, v in order]))
        did, h, pack = (np.array([v[0][i] for _, v in order], np.int64) for i in range(3))
        at = pack[seg] // MAX_RUN
        one = lambda x: pa.ListArray.from_arrays(np.arange(len(seg) + 1, dtype=np.int32), pa.array(x, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(did[seg]), pa.array(h[seg]), one(at + low), one(at + high)],
                                          ["did", "h", "starts", "ends"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, bytes], list] = {}  # copies are merged as they come, so a block holds different segments only
        size, last = 0, None
        for batch in batches:
            for anchor, did, h, pack, copies, seg in zip(*(c.to_pylist() for c in batch.columns)):
                if size > BLOCK_BYTES and anchor != last:
                    yield block(best)
                    best, size = {}, 0
                if (old := best.get((anchor, seg))) is None:
                    best[anchor, seg] = [(did, h, pack), copies]
                    size += len(seg)
                else:
                    # merged rows may begin with the same place and still know of others: rows of one document come repeatedly
                    old[1] = old[1] + copies if old[0] != (did, h, pack) else max(old[1], copies)
                    old[0] = min(old[0], (did, h, pack))
                last = anchor
        if best:
            yield block(best)
    return segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, KEPT)


def verdicts(docs: DataFrame, symbols: Callable, slicer: Callable, engine: Callable, length: int, k: int) -> DataFrame:
    """(did, h, z, parts, starts, ends) of every row: its shared segments and the window starts in them that stay."""
    if length - k + 1 > MAX_RUN:
        raise ValueError(f"windows may be at most {MAX_RUN + k - 1} symbols long")
    packed = pack_texts(docs)
    lists = shared(places(docs, symbols, length, k)).groupBy("did", "h").agg(
        F.collect_list(F.struct("anchor", "pack")).alias("parts"))
    lists = written(lists, "segment-lists")  # read twice below
    kept = judge(cut(packed, lists, slicer), engine).groupBy("did", "h").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    marks = lists.select("did", "h", F.transform("parts", lambda p: p["pack"]).alias("packs")).join(kept, ["did", "h"], "left")
    return packed.join(marks, ["did", "h"], "left").select("did", "h", "z", "packs", "starts", "ends")


def repeated_windows(n: int, packs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask over the n window starts of a document: True where the window is a repeat."""
    packs = np.unique(packs)
    at = packs // MAX_RUN
    return _covered(n, at, at + packs % MAX_RUN + 1) & ~_covered(n, starts, ends)


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask over n places: True in any [start, end). Four bytes a place: a text can be very long."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change, out=change)[:-1] > 0


def window_cover(mask: np.ndarray, n: int, length: int) -> np.ndarray:
    """Mask over n symbols: True where a marked window of ``length`` covers the symbol."""
    low = np.flatnonzero(mask & ~np.append(False, mask[:-1]))
    high = np.flatnonzero(mask & ~np.append(mask[1:], False)) + length
    return _covered(n, low, np.minimum(high, n))


ship(__name__)
