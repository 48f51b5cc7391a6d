"""Exact nearest rows with pruned hot features, against brute force."""
import math
import random

import pytest

from shelfwise.operators import nearest as N


def brute(data, k, cosine=True):
    rows = {}
    for r, c, v in data:
        if v:
            rows.setdefault(r, {})[c] = v
    norm = {r: math.sqrt(sum(v * v for v in d.values())) for r, d in rows.items()}
    out = set()
    for a, x in rows.items():
        met = [(b, sum(v * y.get(c, 0) for c, v in x.items())) for b, y in rows.items() if a != b]
        keyed = [(-(math.floor(dot / (norm[a] * norm[b]) * 1e9) if cosine else dot), b, dot) for b, dot in met if dot]
        out |= {(a, b, dot, -key, i + 1) for i, (key, b, dot) in enumerate(sorted(keyed)[:k])}
    return out


def table(seed, n=90):
    """Rows with one, two or no hot features, many equal vectors, ties and zeros."""
    r, data = random.Random(seed), {}
    for u in range(n):
        for c in r.sample(range(40), r.choice([0, 1, 1, 2, 6])):
            data[u, c] = r.choice([0, 1, 2, 3, 5])
        for c, share in ((900, 0.5), (901, 0.3), (902, 0.8)):
            if r.random() < share:
                data[u, c] = r.choice([3, 4, 5])
    return [(u, c, v) for (u, c), v in data.items()]


@pytest.mark.parametrize("hot,k,cosine", [(3, 3, True), (12, 2, True), (3, 3, False)])
def test_equals_brute_force(spark, hot, k, cosine):
    data = table(hot + k)
    df = spark.createDataFrame([*data, (None, 1, 3), (1, None, 3), (2, 77, None)], "u long, b long, v int")
    got = {(x.u, x.o, x.dot, x.nano, x.rank) for x in N.nearest(df, k, "u", "b", "v", "o", cosine=cosine, hot=hot).collect()}
    assert got == brute(data, k, cosine)


def test_a_hot_feature_makes_few_pairs(spark):
    r, n, k = random.Random(9), 1500, 10
    data = [(u, c, r.randint(1, 5)) for u in range(n) for c in r.sample(range(300), 20)]
    data += [(u, 1000, r.randint(1, 5)) for u in range(0, n, 3)]  # rated by a third of the rows
    df = spark.createDataFrame(data, "r long, c long, v long")
    _, best, candidates = N.pruned_pairs(df, k, 1e9, True, 200)
    assert best.count() == n * (k + 1)
    assert candidates.count() < (n / 3) ** 2 / 4
    got = {(x.r, x.o, x.dot, x.nano, x.rank) for x in N.nearest(df, k, "r", "c", "v", "o", hot=200).collect()}
    assert got == brute(data, k)


def test_rows_with_nothing_but_the_hot_feature(spark):
    data = [(u, 1, 1 + u % 5) for u in range(600)] + [(u, 2, 3) for u in range(0, 600, 2)]
    df = spark.createDataFrame(data, "r long, c long, v long")
    classes, _, candidates = N.pruned_pairs(df, 3, 1e9, True, 100)
    assert classes.filter("r = rep").count() == 10  # equal vectors are one class, so nothing is hot
    assert candidates.count() == 0
    got = {(x.r, x.o, x.dot, x.nano, x.rank) for x in N.nearest(df, 3, "r", "c", "v", "o", hot=100).collect()}
    assert got == brute(data, 3)


@pytest.mark.parametrize("hot,per_task", [(3, 1 << 21), (3, 7), (12, 25)])
def test_dealt_champions_lose_no_pair(spark, hot, per_task):
    data = table(21)
    df = spark.createDataFrame(data, "r long, c long, v long").filter("v > 0")
    whole, dealt = (N.pruned_pairs(df, 3, 1e9, True, hot, per_task=p)[1] for p in (1 << 21, per_task))
    rows = lambda x: sorted(map(tuple, x.select("x", "y", "dot", "key").collect()))
    assert rows(dealt) == rows(whole)


@pytest.mark.parametrize("hot", [12, 200])
def test_classes_that_take_turns_lose_no_pair(spark, monkeypatch, hot):
    data, written, write = table(21), [], N.write_table
    monkeypatch.setattr(N, "PASS_PAIRS", 1)
    monkeypatch.setattr(N, "write_table", lambda df, name, *a, **k: written.append(name) or write(df, name, *a, **k))
    df = spark.createDataFrame([*data, *((u, 77, 1 + u % 4) for u in range(0, 90, 2))], "u long, b long, v int")
    got = {(x.u, x.o, x.dot, x.nano, x.rank) for x in N.nearest(df, 3, "u", "b", "v", "o", hot=hot).collect()}
    assert got == brute([*data, *((u, 77, 1 + u % 4) for u in range(0, 90, 2))], 3)
    assert written.count("nearest-first") > 1


def test_lists_leave_out_what_no_feature_needs(spark):
    """Without hot features a partner is an id, a value and a norm: 15 bytes a pair before, with the length of a hot part."""
    from tests.test_shuffles import bytes_shuffled
    r = random.Random(5)
    data = [(u, c, r.randint(1, 5)) for u in range(70_000, 70_400) for c in r.sample(range(60), 6)]
    df = spark.createDataFrame(data, "r long, c long, v long")
    lists = N._lists(df.selectExpr("cast(r as int) r", "c", "cast(v as tinyint) v", "cast(v * v as smallint) n2", "1 shares"), False, "c")
    pairs = sum(x.m ** 2 for x in df.groupBy("c").count().withColumnRenamed("count", "m").collect())
    assert max(bytes_shuffled(N._sums(lists, None, None, True, "bigint", 4, 1)[0])) < 12 * pairs
