import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import similarity as S


def brute(entries):
    by_row = {}
    for r, c, v in entries:
        by_row.setdefault(r, {})[c] = v
    out = {}
    for row in by_row.values():
        for a, b in itertools.combinations(sorted(row), 2):
            d, n = out.get((a, b), (0.0, 0))
            out[(a, b)] = (d + row[a] * row[b], n + 1)
    return out


@pytest.mark.parametrize("sub_block", [512, 7, 1])
def test_cooccurrence_matches_brute_force_with_hot_row(spark, sub_block):
    rnd = random.Random(7)
    entries = set()
    for r in range(40):
        for c in rnd.sample(range(30), rnd.randint(1, 6)):
            entries.add((r, c))
    # one hot row holding about a third of all entries
    for c in range(30):
        entries.add((999, c))
    data = [(r, c, float(rnd.randint(1, 5))) for r, c in sorted(entries)]
    df = spark.createDataFrame(data, "r long, c long, v double")
    got = {(x.i, x.j): (x.dot, x.n_common) for x in
           S.cooccurrence(df, "r", "c", "v", sub_block=sub_block).collect()}
    assert got == brute(data)


def test_cosine_hand_example(spark):
    # 4 users x 5 books; books 1 and 2 co-rated by users a, b
    rows = [("a", 1, 4), ("a", 2, 2), ("b", 1, 3), ("b", 2, 1), ("b", 3, 5), ("c", 3, 2), ("c", 4, 4),
            ("d", 5, 1)]
    df = spark.createDataFrame(rows, "user_id string, book_id long, rating int")
    nb = {(r.book_id, r.other_id): r.sim for r in S.item_neighbors(df, k=10).collect()}
    # sim(1,2) = (4*2 + 3*1) / (sqrt(16+9) * sqrt(4+1))
    assert nb[(1, 2)] == pytest.approx(11 / (5 * math.sqrt(5)))
    assert nb[(2, 1)] == nb[(1, 2)]
    # sim(3,4) = 2*4 / (sqrt(25+4) * 4)
    assert nb[(3, 4)] == pytest.approx(8 / (math.sqrt(29) * 4))
    assert (5, 1) not in nb and all(a != b for a, b in nb)  # book 5 has no co-rated partner; no self pairs
    assert all(0 < s <= 1 + 1e-9 for s in nb.values())


def test_topk_ties_broken_by_id(spark):
    rows = [("u", 1, 1), ("u", 2, 1), ("u", 3, 1), ("u", 4, 1)]
    df = spark.createDataFrame(rows, "user_id string, book_id long, rating int")
    got = S.item_neighbors(df, k=2).filter("book_id = 1").orderBy("rank").select("other_id").collect()
    assert [r.other_id for r in got] == [2, 3]


def test_dense_cosine(spark):
    from shelfwise.functions.exprs import dense_cosine
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 2.0])], "x array<double>, y array<double>")
    got = [r.c for r in df.select(dense_cosine("x", "y").alias("c")).collect()]
    assert got[0] == pytest.approx(1 / math.sqrt(2)) and got[1] == 0.0


@pytest.mark.parametrize("sub_block", [512, 5, 2])
@pytest.mark.parametrize("k", [1, 3])
def test_neighbors_match_brute_force_with_hot_row_and_column(spark, sub_block, k):
    rnd = random.Random(11)
    ents = set()
    for r in range(60):
        for c in rnd.sample(range(25), rnd.randint(1, 5)):
            ents.add((r, c))
    for c in range(0, 25, 2):
        ents.add((500, c))  # hot row
    for r in range(0, 60, 2):
        ents.add((r, 3))  # hot column
    data = [(r, c, rnd.randint(1, 3)) for r, c in sorted(ents)]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    got = sorted((x.book_id, x.other_id, x.rank) for x in
                 S.item_neighbors(df, k=k, sub_block=sub_block).collect())
    # brute force: exact integer dot / norms, rank by floor(sim*1e9) desc then id
    co = brute([(r, c, float(v)) for r, c, v in data])
    n2 = {}
    for r, c, v in data:
        n2[c] = n2.get(c, 0) + v * v
    cand = {}
    for (a, b), (d, n) in co.items():
        s = d / (math.sqrt(n2[a]) * math.sqrt(n2[b]))
        nano = math.floor(s * 1e9)
        cand.setdefault(a, []).append((-nano, b))
        cand.setdefault(b, []).append((-nano, a))
    want = sorted((a, b, i + 1) for a, lst in cand.items() for i, (_, b) in enumerate(sorted(lst)[:k]))
    assert got == want


def test_zero_norm_item_hides_no_neighbour(spark):
    rows = [(1, 1, 0), (1, 2, 4), (1, 3, 5), (2, 2, 3), (2, 3, 2), (None, 2, 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "user_id int, book_id int, rating int")
    got = sorted((r.book_id, r.other_id) for r in S.item_neighbors(df, k=1).collect())
    assert got == [(2, 3), (3, 2)]  # book 1 has no cosine


def test_neighbor_plan_is_native_and_splits_hot_rows(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("user_id"), F.col("id").alias("book_id"), F.lit(1).alias("rating"))
    plan = S.item_neighbors(df, k=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    e = df.select(F.col("user_id").alias("r"), F.col("book_id").alias("c"))
    most = S._dealt(e, 100).groupBy("r", "b").count().agg(F.max("count")).first()[0]
    assert most < 200  # a row of 1,667 entries meets in pieces of about 100


def test_wide_sums_do_not_overflow(spark):
    # 20,000 raters, values in millionths: their squares' sum is above a long at 370,000 five-star raters; scaled here
    df = spark.range(20_000).select(F.col("id").alias("u"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("t"),
                                    F.lit(500_000_000).cast("long").alias("v"))
    got = S.cosine_pairs(df, "u", "t", "v", "l", "r", wide=True).collect()
    assert sorted((x.l, x.r) for x in got) == [("a", "b"), ("b", "a")]
    assert all(int(x.dot) == 20_000 * 500_000_000 ** 2 and x.sim == pytest.approx(1.0) for x in got)


def test_metadata_fallback_gives_one_row_per_key(spark):
    from shelfwise.sources.readers import metadata_with_fallback
    primary = spark.createDataFrame([(1, "b", "y"), (1, "a", "x"), (1, "a", "z")], "book_id int, title string, authors string")
    fallback = spark.createDataFrame([(1, "f", "f"), (2, "g", "g"), (2, "g", "h")], "book_id int, title string, authors string")
    ids = spark.createDataFrame([(1,), (2,), (2,)], "book_id int")
    rows = lambda mode, p: sorted(tuple(r) for r in metadata_with_fallback(p, fallback, ids, mode=mode).collect())
    assert rows("per_key", primary) == [(1, "a", "x"), (2, "g", "g")]
    assert rows("all_or_nothing", primary) == [(1, "a", "x")]
    assert rows("all_or_nothing", primary.limit(0)) == [(1, "f", "f"), (2, "g", "g")]


@pytest.mark.parametrize("sub_block", [512, 3])
def test_neighbors_of_some_items_equal_those_of_all(spark, sub_block):
    rnd = random.Random(4)
    data = [(r, c, rnd.randint(1, 5)) for r in range(30) for c in rnd.sample(range(20), rnd.randint(1, 7))] + [(99, c, 2) for c in range(20)]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    only = df.filter("book_id % 6 = 1").select("book_id")
    rows = lambda x: sorted(map(tuple, x.select("book_id", "other_id", "dot", "nano", "n_common", "rank").collect()))
    want = rows(S.item_neighbors(df, k=4).filter("book_id % 6 = 1"))
    assert rows(S.item_neighbors(df, k=4, sub_block=sub_block, only=only)) == want


@pytest.mark.parametrize("per_task", [1 << 21, 40, 3])
def test_dealt_columns_keep_every_neighbour(spark, per_task):
    rnd = random.Random(5)
    data = [(r, c, rnd.randint(0, 300)) for r in range(40) for c in {0, 70_000, *rnd.sample(range(1, 25), rnd.randint(1, 6))}]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    co = brute(data)
    n2 = {}
    for r, c, v in data:
        n2[c] = n2.get(c, 0) + v * v
    want = {(a, b): d for (a, b), d in co.items() if n2[a] and n2[b]}
    got = {(x.book_id, x.other_id): (x.dot, x.n_common) for x in S.cosine_pairs(df, "user_id", "book_id", "rating", "book_id", "other_id", per_task=per_task).collect()}
    assert got == {p: v for (a, b), v in want.items() for p in ((a, b), (b, a))}


def test_pairs_are_not_shuffled(spark):
    # 100 rows of 60 columns: 354,000 pairs in both directions, from 6,000 entries; only entries, blocks and the k best may be shuffled
    df = spark.range(6000).select((F.col("id") % 100).alias("user_id"), F.expr("id div 100 + 60 * (id % 100)").alias("book_id"), F.lit(1).alias("rating"))
    plan = S.item_neighbors(df, k=2)
    assert plan.count() == 12_000

    def written(node):
        inner = node.executedPlan() if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else node.plan() if "QueryStage" in node.getClass().getSimpleName() else None
        if inner is not None:
            return written(inner)
        own = [node.metrics().apply("shuffleRecordsWritten").value()] if "ShuffleExchange" in node.getClass().getSimpleName() else []
        kids = node.children()
        return own + [x for i in range(kids.size()) for x in written(kids.apply(i))]

    df = plan
    df._jdf.queryExecution().executedPlan()
    df.collect()
    counts = written(df._jdf.queryExecution().executedPlan())
    assert counts and max(counts) <= 12_000
