"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their groups.

Contract: A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; a document's set is its distinct ``width``-word shingles (with
fewer words the whole sequence is the one shingle, without words the set is empty and linked with nothing). Two
documents link when 100 * |intersection| >= ``percent`` * |union|. Shingles are compared by 64-bit hashes.

Method: equal sets are one node with many members. Shingles are ordered rare-first by a frequency sketch of fixed size (any
order that all documents share is right; rare-first keeps the groups small). Nodes meet on the shingles of their
prefixes, n - ceil(n * percent / 100) + 1 long. Pairs pass the length, positional and suffix filters there (a bitmap of
each set, whose bits tell whether an odd number of shingles fell there, bounds the difference), then once per pair the exact overlap.

A shingle shared by many near copies would give all their pairs. So nodes are first held against one hub per
shingle and size band, then nodes of shingles with several components against neighbours with an equal min-hash. In the end all pairs of one shingle that are still in different components are made and verified. No
link between different components is lost, and no pair inside one is needed.

Broadcast: the sketch (``SLOTS`` counters, fixed). Cases: null or empty text has no set and is its own component;
null ids never name a component (it is null if all its ids are); repeated rows are members of one node; an empty
table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import (gram_hash, lower_ascii, mix, rows_of, ship, slices, span_hash, prefix_hash, spread, utf8,
                                  word_hash, word_spans)
from shelfwise.llm.components import components
from shelfwise.llm.tables import free_name, written

SLOTS = 1 << 20  # counters of the frequency sketch
BLOCK = 1 << 12
LONGS = 16  # 64-bit numbers in a set's bitmap; bits that differ bound the difference of two sets from below
MINS = 4  # min-hashes of a node; they only choose hubs
POS = 1 << 24  # n and position of a prefix shingle in one number


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all rows of a slice, and the first index of each row."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    words = word_hash(data, starts, ends)
    n_words = np.diff(first)
    grams = gram_hash(words, width)
    count = np.maximum(n_words - width + 1, 0)
    at = spread(first[:-1], count)
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    whole = span_hash(prefix_hash(words), first[:-1][short], first[1:][short]) if len(short) else np.zeros(0, np.uint64)
    row = np.concatenate([np.repeat(np.arange(len(count)), count), short])
    value = np.concatenate([grams[at], whole]) if len(at) else whole
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return value, np.searchsorted(row, np.arange(len(count) + 1))


def node_ids(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number per set: equal sets have equal ones. Empty sets have 0."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value))])
    out = mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64))
    return np.where(np.diff(first) > 0, out, np.uint64(0)).view(np.int64)


def bitmaps(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of ``LONGS`` numbers per set: each bit is set if an odd number of the set's shingles fell on it."""
    size = 64 * LONGS
    odd = np.bincount(rows_of(first) * size + (value % np.uint64(size)).astype(np.int64), minlength=size * (len(first) - 1)) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, size), axis=1).view(np.int64)


def slot_of(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(44)).astype(np.int64)


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def members_and_sketch(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, v, n) of every row (h: hash of the text), and (block, counts) partial sketches of every task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SLOTS, np.int64)
        names = ["doc_id", "h", "v", "n", "block", "counts"]
        for batch in batches:
            data, off = utf8(batch.column(2))
            v, n = [], []
            for a, b in slices(off):
                value, first = shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], width)
                sketch += np.bincount(slot_of(value), minlength=SLOTS)
                v.append(node_ids(value, first))
                n.append(np.diff(first))
            if v:
                rows = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(v)), pa.array(np.concatenate(n).astype(np.int64)),
                                                  pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        if sketch.any():
            small = np.minimum(sketch, 255).astype(np.uint8).reshape(-1, BLOCK)  # a task's count stops at 255: order is all it is for
            k = len(small)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(k, pa.int64()) for _ in range(4)),
                                              pa.array(np.arange(k, dtype=np.int32)), pa.array([x.tobytes() for x in small], pa.binary())], names)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("h"), F.col("text").alias("text"))
    both = written(rows.mapInArrow(run, "doc_id long, h long, v long, n long, block int, counts binary"), "shingle-members")
    return both.filter("block is null").select("doc_id", "h", "v", "n"), both.filter("block is not null").select("block", "counts")


def frequencies(sketch: DataFrame) -> np.ndarray:
    """The merged sketch: ``SLOTS`` counters, whatever the corpus."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.uint8).astype(np.int64) for c in pdf["counts"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "total": [total.tobytes()]})
    # some tasks' blocks are summed first, so that no group grows with the number of tasks squared
    out = np.zeros((SLOTS // BLOCK, BLOCK), np.int64)
    for r in sketch.groupBy("block").applyInPandas(add, "block int, total binary").toLocalIterator():
        out[r.block] = np.frombuffer(r.total, np.int64)
    return out.ravel()


def nodes(docs: DataFrame, width: int) -> DataFrame:
    """(v, z, n, bits, mins): one packed text per distinct set, its size, the bitmap of its shingles, its min-hashes.

    Hash-partitioned by v and kept on the executors' disks; a lost part is computed again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, seen = zstandard.ZstdCompressor(level=1), set()
        for batch in batches:
            data, off = utf8(batch.column(0))
            for a, b in slices(off):
                value, first = shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], width)
                ids = node_ids(value, first).tolist()
                keep = []
                for i, v in enumerate(ids):
                    if v and v not in seen:
                        seen.add(v)
                        keep.append(i)
                z = [press.compress(data[off[a + i]:off[a + i + 1]].tobytes()) for i in keep]
                bitmap = pa.ListArray.from_arrays(np.arange(0, len(keep) * LONGS + 1, LONGS, dtype=np.int32),
                                                  pa.array(bitmaps(value, first)[keep].ravel(), pa.int64()))
                filled = np.flatnonzero(np.diff(first))
                lows = np.zeros((len(keep), MINS), np.uint64)
                for k in range(MINS if keep else 0):
                    low = np.minimum.reduceat(mix(value ^ mix(np.array([k + 1], np.uint64))), first[:-1][filled])
                    lows[:, k] = low[np.searchsorted(filled, keep)]
                lows = lows.ravel().view(np.int64)
                mins = pa.ListArray.from_arrays(np.arange(0, len(lows) + 1, MINS, dtype=np.int32), pa.array(lows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in keep], pa.int64()), pa.array(z, pa.binary()),
                                                  pa.array(np.diff(first)[keep].astype(np.int64)), bitmap, mins],
                                                 ["v", "z", "n", "bits", "mins"])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select(F.col("text").alias("text")).mapInArrow(run, "v long, z binary, n long, bits array<long>, mins array<long>")
    return found.repartition(n, "v").dropDuplicates(["v"]).persist(StorageLevel.DISK_ONLY)


def unpacked_sets(packed: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    unpress = zstandard.ZstdDecompressor()
    raw = [unpress.decompress(z.as_py()) for z in packed]
    return shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), width)


def prefixes(all_nodes: DataFrame, order, width: int, percent: int) -> DataFrame:
    """(token, v, place) of every prefix shingle; ``order`` is the broadcast sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = order.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                value, first = unpacked_sets(part.column(1), width)
                n = np.diff(first)
                row = rows_of(first)
                value = value[np.lexsort((value, count[slot_of(value)], row))]  # rarest first in every row
                size = n - (n * percent + 99) // 100 + 1
                at = spread(first[:-1], size)
                place = at - np.repeat(first[:-1], size)
                v = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[at].view(np.int64)), pa.array(np.repeat(v, size)), pa.array(np.repeat(n, size) * POS + place)],
                    ["token", "v", "place"])
    return all_nodes.select("v", "z").mapInArrow(run, "token long, v long, place long")


def size_band(place: Column, percent: int) -> Column:
    """Linked nodes are in the same size band or in neighbouring ones."""
    return F.floor(F.log(F.floor(place / POS)) / F.log(F.lit(100.0 / percent))).cast("int")


def meetings(tokens: DataFrame, percent: int) -> DataFrame:
    """The prefix shingles that two or more nodes have, each with the hub of its size band.

    A stream over sorted partitions. The hub is the node in which the shingle stands earliest: it has the fewest
    rare shingles of its own, so it links with more of the copies of one text than any other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_band, hub, hub_place, alone = None, None, 0, 0, None
        for batch in batches:
            out: list[tuple] = []
            for token, v, place, band in zip(*(c.to_pylist() for c in batch.columns)):
                new = token != last
                if new or band != last_band:
                    last, last_band, hub, hub_place = token, band, v, place
                if new:
                    alone = (token, v, place, v, place)
                    continue
                if alone is not None:
                    out.append(alone)
                    alone = None
                out.append((token, v, place, hub, hub_place))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["token", "v", "place", "hub", "hub_place"])
    # v is unique per token: nodes are distinct and so are the shingles of a set
    banded = tokens.withColumn("band", size_band(F.col("place"), percent))
    return banded.repartition("token").sortWithinPartitions("token", "band", F.col("place") % POS, "v").mapInArrow(
        run, "token long, v long, place long, hub long, hub_place long")


def may_link(place: Column, other: Column, percent: int) -> Column:
    """Length filter, and positional filter: what is left after the shared shingle must suffice."""
    n, m = F.floor(place / POS), F.floor(other / POS)
    need = F.ceil((n + m) * percent / (100 + percent))
    rest = F.least(n - place % POS, m - other % POS)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (rest >= need)


def bits_fit(n: Column, m: Column, bits: Column, others: Column, percent: int) -> Column:
    """Suffix filter over bitmaps: every bit that differs is a shingle that only one of the sets (of sizes n and m) has."""
    total = n + m
    apart = sum((F.bit_count(bits[k].bitwiseXOR(others[k])) for k in range(LONGS)), F.lit(0))
    return apart <= total - 2 * F.ceil(total * percent / (100 + percent))


def fitting(pairs: DataFrame, all_nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the suffix filter: bitmaps move to the pairs, so fewer texts have to."""
    def side(x: str) -> DataFrame:
        return all_nodes.select(F.col("v").alias(x), F.col("n").alias("n" + x), F.col("bits").alias("s" + x))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.filter(bits_fit(F.col("na"), F.col("nb"), F.col("sa"), F.col("sb"), percent)).select("a", "b")


def verified(pairs: DataFrame, all_nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Every pair comes once; a is the side that may repeat often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        last, x = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                value, first = unpacked_sets(part.column(3), width)
                for i, (a, b) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                    if a != last:
                        raw = unpress.decompress(part.column(2)[i].as_py())
                        x, last = shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), width)[0], a
                    y = value[first[i]:first[i + 1]]
                    if _overlap_links(x, y, percent):
                        out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
    left = all_nodes.select(F.col("v").alias("a"), F.col("z").alias("za"))
    right = all_nodes.select(F.col("v").alias("b"), F.col("z").alias("zb"))
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "za", "zb")
    return full.sortWithinPartitions("a").mapInArrow(run, "a long, b long")


def _overlap_links(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link, by their exact overlap."""
    place = np.searchsorted(x, y)
    place[place == len(x)] = 0
    both = int((x[place] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def links(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """((doc_id, h, v, n) of every row, (v, root) of the nodes that are linked to a smaller one).

    Two bounded rounds bring near copies together; then all open pairs are verified.
    """
    spark = docs.sparkSession
    members, sketch = members_and_sketch(docs, width)
    order = spark.sparkContext.broadcast(frequencies(sketch))  # SLOTS numbers
    all_nodes = nodes(docs, width)
    met = written(meetings(prefixes(all_nodes, order, width, percent), percent), "shingle-meetings")
    pairs = met.filter((F.col("v") != F.col("hub")) & may_link(F.col("place"), F.col("hub_place"), percent)).select(
        F.col("hub").alias("a"), F.col("v").alias("b")).distinct()
    pairs = fitting(pairs, all_nodes, percent)
    met = met.select("token", "v", "place")
    tried = linked = None
    for round_ in ("hubs of shingles", "neighbours by min-hash", "all that is open"):
        pairs = written(pairs, "pairs")
        found = written(verified(pairs, all_nodes, width, percent), "links")
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        tried = ordered if tried is None else tried.unionByName(ordered)
        linked = found if linked is None else linked.unionByName(found)
        root = components(linked)
        if round_ == "all that is open":
            break
        # what the pairs so far left open: nodes of one shingle in different components
        labelled = met.join(root, "v", "left").withColumn("root", F.coalesce("root", "v"))
        labelled = written(_several_components(labelled), "open-meetings")
        if round_ == "hubs of shingles":
            pairs = fitting(_hub_pairs(labelled, all_nodes), all_nodes, percent)
        else:
            pairs = _all_pairs(labelled, all_nodes, percent)
        pairs = pairs.join(tried, (F.least(pairs["a"], pairs["b"]) == tried["a"]) & (F.greatest(pairs["a"], pairs["b"]) == tried["b"]),
                           "left_anti")
    all_nodes.unpersist()
    return members, root


def _several_components(met: DataFrame) -> DataFrame:
    """The rows (token, v, place, root) whose shingle still has nodes of several components."""
    several = met.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token")
    return met.join(several, "token", "left_semi").select("token", "v", "place", "root")


def _bands(met: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows in their own and in the next size band, and in their own."""
    band = size_band(F.col("place"), percent)
    names = {"v": "v", "place": "p", "root": "r", "bits": "s"}
    side = lambda x: met.withColumn("band", band).withColumnsRenamed(
        {old: x if old == "v" else new + x for old, new in names.items()})
    wide = side("b").withColumn("moved", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", F.col("band") + F.col("moved"))
    return wide, side("a")


def _hub_pairs(met: DataFrame, all_nodes: DataFrame, near: int = 3) -> DataFrame:
    """Open nodes against those before them among the nodes with an equal min-hash, ordered by the next min-hashes.

    Similar sets share most min-hashes and so stand side by side; ``near`` pairs a node and min-hash at most.
    """
    hashes = met.select("v", "root").distinct().join(all_nodes.select("v", "mins"), "v").select("v", "root", "mins", F.posexplode("mins"))
    following = [F.element_at("mins", ((F.col("pos") + k) % MINS + 1).cast("int")) for k in range(1, MINS)]
    beside = Window.partitionBy("pos", "col").orderBy(*following, "v")
    before = F.array(*(F.lag(F.struct("v", "root"), k).over(beside) for k in range(1, near + 1)))
    pairs = hashes.select("v", "root", before.alias("before")).select("v", "root", F.explode(F.array_compact("before")).alias("x"))
    return pairs.filter(F.col("x.root") != F.col("root")).select(F.col("x.v").alias("a"), F.col("v").alias("b")).distinct()


def _first_meetings(met: DataFrame) -> DataFrame:
    """The rows with ``before``, the open shingle before theirs in the same node (the node itself at the first one).

    Nodes whose shingle before is the same one meet there already, so a shingle before which all its nodes have the same
    one makes no new pair and goes: of the shingles of a passage mostly the first is left.
    """
    before = F.coalesce(F.lag("token").over(Window.partitionBy("v").orderBy("place")), F.col("v"))  # a node's own rows: its prefix
    rows = met.withColumn("before", before)
    differ = rows.groupBy("token").agg(F.min("before").alias("low"), F.max("before").alias("high")).filter("low < high").select("token")
    return rows.join(differ, "token", "left_semi")


def _all_pairs(met: DataFrame, all_nodes: DataFrame, percent: int) -> DataFrame:
    """All pairs of one shingle in different components, each once and not once a shingle."""
    first = written(_first_meetings(met), "first-meetings").join(all_nodes.select("v", "bits"), "v")
    wide, own = _bands(first, percent)
    wide, own = wide.withColumnRenamed("before", "fb"), own.withColumnRenamed("before", "fa")
    n, m = F.floor(F.col("pa") / POS), F.floor(F.col("pb") / POS)
    return wide.join(own, ["token", "band"]).filter(
        (F.col("fa") != F.col("fb")) & ((F.col("moved") == 1) | (F.col("a") < F.col("b"))) & (F.col("ra") != F.col("rb"))
        & may_link(F.col("pa"), F.col("pb"), percent) & bits_fit(n, m, F.col("sa"), F.col("sb"), percent)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    members, root = links(docs, width, percent)
    labelled = members.join(root, "v", "left").select("doc_id", "n", F.coalesce("root", "v").alias("label"))
    full = F.col("n") > 0
    first = labelled.filter(full).groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return (labelled.filter(full).join(first, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(labelled.filter(~full).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group (then the smallest text hash), null ids last; once if repeated.

    Texts without words are in no group: all of them stay.
    """
    members, root = links(docs, width, percent)
    who, h = free_name(docs, "kept_id"), free_name(docs, "kept_hash")
    named = members.withColumn("who", F.coalesce("doc_id", F.lit(np.iinfo(np.int64).max)))
    first = (named.filter("n > 0").join(root, "v", "left").groupBy(F.coalesce("root", "v")).agg(F.min(F.struct("who", "h")).alias("x"))
             .select(F.col("x.who").alias(who), F.col("x.h").alias(h)))
    keyed = docs.withColumn(who, F.coalesce(F.col("doc_id").cast("long"), F.lit(np.iinfo(np.int64).max))).withColumn(h, text_hash())
    wordless = named.filter("n = 0").select(F.col("who").alias(who), F.col("h").alias(h)).distinct()
    kept = keyed.join(first, [who, h], "left_semi").dropDuplicates([who, h])
    return kept.unionByName(keyed.join(wordless, [who, h], "left_semi")).select(*docs.columns)


ship(__name__)
