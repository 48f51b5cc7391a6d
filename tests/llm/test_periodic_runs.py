"""Periodic runs against brute force over all periods, with their odd cases."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import periodic_runs as P
from shelfwise.llm import queries
from tests.llm.brute import WORD, sha, texts


def all_runs(w, least=6, repeats=4):
    found = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, repeats * q) and not any(all(w[x] == w[x + d] for x in range(i, i + n - d)) for d in range(1, q)):
                found.append((i, n, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {x for i, n, q in runs for x in range(i + q, i + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def planted(key, w):
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    w = planted(key, WORD.findall(text or ""))
    runs = all_runs(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{i},{n},{q}\n" for i, n, q in runs)
    return (len(runs), *top, top[1] * 1000 // top[2] if runs else None, sha(lines.encode()), sha(collapsed(w, runs).encode()))


def test_kernel_equals_brute_force():
    r = random.Random(4)
    for _ in range(400):
        n, k = r.randint(1, 70), r.choice([1, 2, 2, 3, 6])
        w = [r.randrange(k) for _ in range(n)]
        if n > 8 and r.random() < 0.5:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randint(3, 10)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        got = [tuple(x) for x in P.runs_of(np.array(w), np.array([n])).tolist()]
        assert got == all_runs(w), w


def test_tree_extensions_equal_scans():
    r = random.Random(2)
    s = [r.randrange(1, 4) for _ in range(300)] * 2 + [0]
    tree = P.SuffixTree(s)
    order = tree.tour().tolist()
    assert order == sorted(range(len(s)), key=lambda i: s[i:])
    x, y = (np.array([r.randrange(300 * a, 300 * a + 300) for _ in range(2000)]) for a in (0, 1))
    for a, b, got in zip(x.tolist(), y.tolist(), tree.common(x, y).tolist()):
        n = 0
        while s[a + n] == s[b + n] and b + n < len(s) - 1:
            n += 1
        assert n == got


def test_cut_words_are_in_no_run():
    r = random.Random(8)
    for _ in range(200):
        w = [r.randrange(3) for _ in range(r.randint(1, 80))]
        keep = P.reduce(np.array([hash((x, "salt")) for x in w]).astype(np.uint64), np.zeros(len(w), np.int64))
        assert all(keep[i:i + n].all() for i, n, _ in all_runs(w))


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(spark, tmp_path, seed):
    rows = [(i * 7 + seed, t) for i, t in enumerate(texts(seed, 60))] + [(None, "a " * 30), (3, None), (3, "x y " * 9), (3, "x y " * 9)]
    rows += [(900 + i, " ".join(f"w{random.Random(i).randrange(50 + i)}" for _ in range(120)) + f" t{i}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((k, *expected(k, t))) for k, t in rows)
    assert sum(r.n_runs > 0 for r in got) > 8


def test_odd_tables(spark):
    schema = "doc_id long, text string, periodic string, PLANTED int"
    empty, out = P.with_runs(spark.createDataFrame([], schema))
    assert empty.count() == 0 and out not in ("periodic", "text")
    long = " ".join(["lorem ipsum dolor"] * 60_000)
    df = spark.createDataFrame([(1, long, "kept", 2), (None, "", None, None), (2, None, "x", 3)], schema)
    done, out = P.with_runs(df)
    rows = {r.doc_id: r for r in done.collect()}
    assert rows[1].periodic == "kept" and rows[1][out].collapsed == "lorem ipsum dolor"
    assert [tuple(x) for x in rows[1][out].runs] == [(0, 180_000, 3)]
    assert rows[2][out].runs == [] and rows[None][out].collapsed == ""
    assert hashlib.sha256(b"").hexdigest() == done.filter("doc_id = 2").select(F.sha2(F.col(f"{out}.collapsed"), 256)).first()[0]
