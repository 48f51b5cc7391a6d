"""N-gram Jaccard join against brute force, chains, hot shingles and odd cases."""
import random

import numpy as np
import pytest

from shelfwise.llm import jaccard_join
from shelfwise.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def near_copies(seed):
    r = random.Random(seed)
    vocab = [f"W{i}" for i in range(500)]
    rows, chain = [], [r.choice(vocab) for _ in range(120)]
    common = [r.choice(vocab) for _ in range(40)]
    for i in range(12):  # each link of the chain is near the one before, its ends are far apart
        rows.append(" ".join(chain))
        for _ in range(2):
            chain[r.randint(0, 119)] = r.choice(vocab)
    base = [r.choice(vocab) for _ in range(100)]
    for _ in range(25):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randint(0, 99)] = r.choice(vocab)
        rows.append((" " if r.random() < .5 else "\n").join(w).upper() if r.random() < .3 else " ".join(w))
    for _ in range(25):  # unrelated texts round a common passage, some mostly made of it
        own = [r.choice(vocab) for _ in range(r.randint(0, 30))]
        rows.append(" ".join(own[:5] + common + own[5:]))
    rows += [" ".join(common[:n]) for n in (39, 40, 36, 5, 4, 3, 1)] + [" ".join(common[:4]).lower(), "", None, " \n"]
    rows += [rows[0], rows[0], "a b c d e " * 30, "a b c d e " * 31, "b c d e a " * 30]
    ids = list(range(3, 3 + len(rows)))
    r.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == brute.jaccard_groups(rows)


def test_odd_tables(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "one two three four five six seven"
    rows = [(None, text, 1), (5, text, 1), (5, text, 1), (None, "alone", 2), (9, None, 3), (None, None, 3)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id long")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, 3, 5), (5, 3, 5), (5, 3, 5), (None, 1, None), (9, 0, 9), (None, 0, None)]))


def test_components_of_a_long_chain(spark):
    r = random.Random(3)
    names = r.sample(range(10**6), 200)
    edges = list(zip(names[:149], names[1:150])) + list(zip(names[150:199], names[151:]))
    got = {x.v: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (names[:150], names[150:]):
        assert all(got.get(v, v) == min(part) for v in part)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlap():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        keep = rng.random(len(x)) < rng.choice([0.7, 0.85, 0.95, 1])
        y = np.unique(np.concatenate([x[keep], rng.integers(0, 1 << 60, int(rng.integers(0, 8))).astype(np.uint64)]))
        if not len(y):
            continue
        both = len(np.intersect1d(x, y))
        assert jaccard_join._overlap_links(x, y, 80) == (100 * both >= 80 * (len(x) + len(y) - both))


def test_only_shingles_with_differing_ones_before_are_joined(spark):
    # nodes 1-3 share the passage 10, 11, 12; node 3 comes to 12 over 20, so 11 alone has nothing new
    rows = [(10, 1, 0), (11, 1, 1), (12, 1, 2), (10, 2, 0), (11, 2, 1), (12, 2, 2), (20, 3, 0), (12, 3, 1), (20, 4, 0)]
    met = spark.createDataFrame([(t, v, jaccard_join.POS * 9 + p, v) for t, v, p in rows], "token long, v long, place long, root long")
    left = {(r.token, r.v, r.before) for r in jaccard_join._first_meetings(met).collect()}
    assert left == {(10, 1, 1), (10, 2, 2), (12, 1, 11), (12, 2, 11), (12, 3, 20), (20, 3, 3), (20, 4, 4)}
