import hashlib

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import encode as W


def test_global_position_is_a_total_order(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = W.global_position(df, ["k"], "pos", num_partitions=7).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(5000))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_label_encode(spark):
    df = spark.createDataFrame([(30,), (10,), (30,), (20,)], "book_id long")
    got = {r.book_id: r.book_id_encoded for r in W.label_encode(df, "book_id").collect()}
    assert got == {10: 0, 20: 1, 30: 2}


def test_seeded_split_exact_and_deterministic(spark):
    df = spark.range(0, 1003).select(F.col("id").alias("u"), (F.col("id") % 7).alias("b"))
    a = W.seeded_split(df, ["u", "b"], 42)
    b = W.seeded_split(df, ["u", "b"], 42)
    assert a.filter("split = 'train'").count() == 1003 * 4 // 5
    assert sorted(r.u for r in a.filter("split = 'test'").collect()) == \
        sorted(r.u for r in b.filter("split = 'test'").collect())
    c = W.seeded_split(df, ["u", "b"], 7)
    assert sorted(r.u for r in c.filter("split = 'test'").collect()) != \
        sorted(r.u for r in a.filter("split = 'test'").collect())


@pytest.mark.parametrize("rows,kept", [(0, 8), (1, 8), (4, 8), (5, 8), (700, 8), (700, 0)])
def test_seeded_split_sorts_no_whole_table(spark, monkeypatch, rows, kept):
    def refused(df):
        raise AssertionError("all rows sorted and pinned")
    monkeypatch.setattr(W, "reliable_checkpoint", refused)
    monkeypatch.setattr(W, "KEPT", kept, raising=False)
    monkeypatch.setattr(W, "DIGITS", min(3, kept), raising=False)
    keys = [(None if u % 50 == 3 else u // 2, None if u % 50 != 3 and u % 2 else f"b{u}") for u in range(rows)]
    df = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "u long, b string, v long")
    assert df.schema.names + ["split"] == W.seeded_split(df, ["u", "b"], 5).columns
    got = {(x.u, x.b): x.split for x in W.seeded_split(df, ["u", "b"], 5).collect()}
    order = sorted(keys, key=lambda k: (hashlib.md5("|".join(["5", *(str(x) for x in k if x is not None)]).encode()).hexdigest(),
                                        (k[0] is not None, k[0] or 0), (k[1] is not None, k[1] or "")))
    cut = rows * 4 // 5
    assert got == {k: "train" if i < cut else "test" for i, k in enumerate(order)} and len(got) == rows
