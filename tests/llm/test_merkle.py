"""The manifest and its proofs against plain recursion, the multiproof's size, odd cases."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, lower=False):
    text = r[1]
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    values = (r[0], r[3], r[2], r[4], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(level):
    """All levels, and per leaf its siblings on either side, level by level."""
    sides, levels, group = [[] for _ in level], [level], [[i] for i in range(len(level))]
    while len(level) > 1:
        runs = [level[i:i + 16] for i in range(0, len(level), 16)]
        for at, members in enumerate(group):
            run, k = runs[at // 16], at % 16
            for m in members:
                sides[m].append(("".join(run[:k]), "".join(run[k + 1:])))
        group = [sum(group[i:i + 16], []) for i in range(0, len(group), 16)]
        level = [h(*run) for run in runs]
        levels.append(level)
    return level[0], sides


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = []
    for s in sources:
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        own.append((mine, *tree([leaf(r) for r in mine])))
    root, above = tree([sub for _, sub, _ in own])
    out = []
    for (mine, sub, sides), up in zip(own, above):
        for r, side in zip(mine, sides):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, tampered)
            for a, b in side + up:
                folded = h(a, folded, b)
            out.append((r[0], leaf(r), sub, root, h(*(a + b for a, b in side + up)), folded, folded == root))
    return sorted(map(repr, out))


def rows(seed, n=700):
    r = random.Random(seed)
    out = [(i * 3, r.choice(["Some Text é", "", "lower", None, "X" * r.randint(1, 400)]) and f"T{i} x", r.choice(["en", None]),
            "hot" if r.random() < 0.6 else f"s{r.randrange(30)}", r.choice([None, i])) for i in range(n)]
    return out + [(None, "null id", "en", "hot", 1), (None, None, None, None, None), (5, "A", "en", None, 2), (5, "A", "en", None, 2),
                  (5, "B", "en", None, 2), (7, "Lone", "de", "only", 4), (8, "", "de", "é", 0), (9, None, "de", "z", 0)]


@pytest.mark.parametrize("block", [1024, 37])
def test_equals_plain_recursion(spark, block):
    data = rows(block)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", queries.string.ascii_uppercase, queries.string.ascii_lowercase)
    got = merkle.audit(df, forged={"text": lowered}, where=tampered, block=block).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(data)
    assert {r.verified for r in got} == {True, False}


def test_derived_root_is_the_published_one(spark):
    placed, subroots, nodes = merkle.build(merkle.leaves(spark.createDataFrame(rows(3), SCHEMA), merkle.COLUMNS, "source", "doc_id"))
    proved = merkle.prove(placed, subroots, nodes, block=50)
    assert proved.select("derived_root", "folded_root").distinct().count() == 1
    assert proved.first().derived_root == nodes.filter("tree = -1 and n = 1").first().digest
    assert sorted(r.subroot for r in subroots.collect()) == sorted({r.subroot for r in proved.collect()})


def test_missing_nodes_are_the_least_set():
    n = 5000
    known = np.arange(700, 1900)
    got = merkle.missing(known, n)
    assert all(len(pos) <= 2 * (merkle.FANOUT - 1) for _, pos in got)
    have = {(0, int(p)) for p in known} | {(level, int(p)) for level, pos in got for p in pos}
    size, level = n, 0
    while size > 1:  # everything above follows, and no fetched node could be derived
        up = {p // 16 for lv, p in have if lv == level}
        for run in up:
            assert all((level, p) in have for p in range(run * 16, min(run * 16 + 16, size)))
        assert not {(level + 1, p) for p in up} & {(lv, int(p)) for lv, pos in got for p in pos if lv == level + 1}
        have |= {(level + 1, p) for p in up}
        size, level = -(-size // 16), level + 1
    assert merkle.missing(np.array([0]), 1) == []
    scattered = merkle.missing(np.array([3, 4999]), n)
    assert len(scattered[0][1]) == 15 + 7


def test_odd_tables(spark):
    schema = SCHEMA + ", leaf string, tree int, POS int"
    assert merkle.audit(spark.createDataFrame([], schema)).count() == 0
    one = [(1, "only", "en", "s", 4, "clash", 9, 9)]
    got = merkle.audit(spark.createDataFrame(one, schema)).collect()
    assert [tuple(r) for r in got] == [(1, leaf(one[0]), leaf(one[0]), leaf(one[0]), h(), leaf(one[0]), True)]
    same = [(2, "Copy" * 50_000, "en", "s", 4, "c", 1, 1)] * 300 + [(3, "x", "en", "s", 1, None, None, None)]
    got = merkle.audit(spark.createDataFrame(same, schema).repartition(4)).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(x.replace("False", "True") for x in brute_clean(same))


def brute_clean(data):
    """brute() without tampering."""
    out = []
    mine = sorted(data, key=lambda r: (r[0], leaf(r)))
    sub, sides = tree([leaf(r) for r in mine])
    for r, side in zip(mine, sides):
        out.append((r[0], leaf(r), sub, sub, h(*(a + b for a, b in side)), sub, True))
    return sorted(map(repr, out))
