"""Byte and word span dedup against brute force, and their odd cases."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import segments
from shelfwise.llm.substring_dedup import remove_shared_passages
from shelfwise.llm.suffix_dedup import RunLengthIndex, remove_repeats
from tests.llm import brute

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_brute_force(spark, seed):
    rows = [(i * 3 + 1, t) for i, t in enumerate(brute.texts(seed))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df).collect()}
    assert got == brute.byte_dedup(rows)
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_brute_force(spark, seed):
    rows = [(i * 3 + 1, t) for i, t in enumerate(brute.texts(seed))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_shared_passages(df).collect()}
    assert got == brute.word_dedup(rows)
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("op", [remove_repeats, remove_shared_passages])
def test_odd_tables(spark, op):
    empty = op(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    long = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long, 1), (7, long, 2), (7, long, 2), (7, "other", 3)],
                               "doc_id long, text string, n_removed long")
    rows = sorted(op(df).collect(), key=lambda r: (r.doc_id is None, r.n_removed))
    assert [r.doc_id for r in rows] == [7, 7, 7, None]
    assert rows[-1].n_removed > 0  # the null id is the last place
    assert sorted(r.kept_sha256 for r in rows[:3])  # repeated rows of one id and text share a result
    by_text = [r for r in rows if r.doc_id == 7 and r.kept_sha256 != brute.sha(b"other")]
    assert len(by_text) == 2 and by_text[0] == by_text[1]


def test_index_is_run_compressed():
    strings = [bytes(np.random.default_rng(3).integers(97, 123, 130, dtype=np.uint8))] * 50
    index = RunLengthIndex(strings, 100)
    assert len(index.run_start) < index.size / 10 and len(index.sample) == len(index.run_start)


def hot_rows(size):
    """A line shorter than a window in many texts, most with neighbours of their own, some with common ones."""
    r = np.random.default_rng(6)
    words = lambda n: " ".join("".join(map(chr, r.integers(97, 123, 6))) for _ in range(n))
    line, common = words(size), words(40)
    own = [f"{words(40)} {line} {words(40)}" for _ in range(120)]
    own += [f"{words(40)} {line} {common}" for _ in range(20)]
    own += [words(40) + "".join(f" {line} {words(12)}" for _ in range(40))]  # many of them in one text
    return [*enumerate(own), (500, own[3]), (501, own[130] + " end")]


@pytest.mark.parametrize("level", [1, 2])
@pytest.mark.parametrize("op, brute_force, length, k", [(remove_repeats, brute.byte_dedup, 100, 24), (remove_shared_passages, brute.word_dedup, 35, 8)])
def test_hot_anchors_are_split(spark, monkeypatch, op, brute_force, length, k, level):
    rows, engines = hot_rows(9 if k == 24 else 20), []
    if level == 2:  # grams of the second level that are as short, so that they are hot too
        monkeypatch.setattr(segments, "gram_sizes", lambda length, k: [k, k + 1, length])
    monkeypatch.setattr(segments, "SAMPLE", 1)
    judge = segments.judge

    def watched(found, engine):
        engines.append(found.groupBy("anchor").agg(F.count_distinct("seg").alias("n")).agg(F.max("n")).first()[0])
        return judge(found, engine)
    monkeypatch.setattr(segments, "judge", watched)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) if k == 8 else (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op(df).collect()}
    assert got == brute_force(rows)
    assert engines[0] < 64  # over 100 in one block when hot anchors are not split


@pytest.mark.parametrize("copies", [(1, 2), (2, 1), (1, 1)])
def test_merged_copies_of_repeated_rows_count(spark, copies):
    rows = [(5, 1, 1, 0, c, bytearray(b"one segment")) for c in copies]  # one first place, merged with another one or not
    engine = lambda segs, copies, runs: tuple(np.full(1, x) for x in (0, 0, 1)) if copies[0] == 1 else (np.zeros(0, np.int64),) * 3
    found = segments.judge(spark.createDataFrame(rows, segments.SEGMENT).coalesce(1), engine).collect()
    assert len(found) == (max(copies) == 1)


@pytest.mark.parametrize("op, brute_force, k", [(remove_repeats, brute.byte_dedup, 24), (remove_shared_passages, brute.word_dedup, 8)])
def test_frequent_anchors_are_dealt_by_place(spark, monkeypatch, op, brute_force, k):
    r = np.random.default_rng(8)
    words = lambda n: " ".join("".join(map(chr, r.integers(97, 123, 6))) for _ in range(n))
    passage = words(50)
    rows = [(i, f"{words(10)} {passage} {words(10)}") for i in range(60)] + [(100, words(90)), (101, ""), (102, None)]
    monkeypatch.setattr(segments, "SAMPLE", 1)
    monkeypatch.setattr(segments, "HOT", 10_000)
    seen, places = [], segments.places

    def watched(*args):
        seen.append(places(*args))
        return seen[-1]
    monkeypatch.setattr(segments, "places", watched)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) if k == 8 else (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in op(df).collect()}
    assert got == brute_force(rows)
    most = seen[0].groupBy("anchor", "known").count().groupBy("known").agg(F.max("count").alias("n"))
    most = {x.known: x.n for x in most.collect()}
    assert most[True] >= 60 and most.get(False, 0) < 60  # the passage's places do not meet in one task


@pytest.mark.parametrize("op, brute_force, k", [(remove_repeats, brute.byte_dedup, 24), (remove_shared_passages, brute.word_dedup, 8)])
def test_long_texts_in_pieces(spark, monkeypatch, op, brute_force, k):
    rows = [(i, t) for i, t in enumerate(brute.texts(3))]
    monkeypatch.setattr(segments, "PIECE", 37)  # most windows reach over a border
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) if k == 8 else (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256)
           for x in op(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert got == brute_force(rows)


@pytest.mark.parametrize("size", [100, 35])
def test_pieces_need_bounded_memory(size):
    import tracemalloc
    data = np.random.default_rng(5).integers(97, 123, 64 << 20, dtype=np.uint8)
    tracemalloc.start()
    found = sum(int(run.sum()) for _, _, run, _ in segments.segments_in(data, np.array([0, len(data)]), size, 24))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == len(data) - size + 1  # every window is in one segment
    assert peak < 100 << 20
