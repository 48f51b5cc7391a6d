"""What is computed once and what crosses a shuffle."""
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import inner_product as IP
from shelfwise.operators import recommend as R
from shelfwise.operators import similarity as S
from shelfwise.operators import text as TX
from shelfwise.plans import q_eval, q_io
from tests.conftest import SF


def records_shuffled(df):
    """The records each exchange of ``df`` wrote, after it ran."""
    df.collect()

    def written(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return written(node.executedPlan())
        if "QueryStage" in name:
            return written(node.plan())
        own = [node.metrics().apply("shuffleRecordsWritten").value()] if "ShuffleExchange" in name else []
        return own + [x for i in range(node.children().size()) for x in written(node.children().apply(i))]
    return written(df._jdf.queryExecution().executedPlan())


def test_profiles_shuffle_ratings_not_features(spark):
    r = random.Random(2)
    data = [(u, b, r.randint(1, 5)) for u in range(50) for b in r.sample(range(40), 10)]
    feats = [(b, f"f{f}", float(f)) for b in range(39) for f in r.sample(range(12), 6)]
    inter = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    features = spark.createDataFrame(feats, "book_id long, feature string, value double")
    df = R.user_profiles(inter, features)
    assert max(records_shuffled(df)) <= len(data)  # 3,000 features of ratings before
    total, num = {}, {}
    for u, b, x in data:
        total[u] = total.get(u, 0) + x
        for c, f, v in feats:
            if b == c:
                num[u, f] = num.get((u, f), 0) + x * v
    assert {(x.user_id, x.feature): x.weight for x in df.collect()} == {k: pytest.approx(v / total[k[0]]) for k, v in num.items()}


def test_latest_version_finds_the_neighbours_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch
    nb = spark.range(30).select((F.col("id") % 3).alias("book_id"), F.col("id").alias("other_id"), F.lit(5).cast("long").alias("nano"),
                                (F.col("id") % 20 + 1).cast("int").alias("rank"))
    monkeypatch.setattr(q_io.S, "item_neighbors", lambda *a, **k: nb.mapInArrow(rows, nb.schema))
    got = q_io.s09_k10_latest_version(spark, SF).collect()
    assert made.value == 30
    assert sorted(x.other_id for x in got) == sorted(i for i in range(30) if i % 20 < 10) and {x.version for x in got} == {2}


@pytest.mark.parametrize("blocks,width", [(1 << 15, 8), (1 << 15, 1), (4, 100), (0, 0)])
def test_a_slice_holds_a_bounded_number_of_weights(blocks, width):
    rows = IP.slice_rows(blocks, blocks * width)
    assert rows >= 1 and (rows == 1 or rows * max(blocks, blocks * width) <= IP.CELLS)


def bytes_shuffled(df):
    """The bytes each exchange of ``df`` took, before they are compressed, after it ran."""
    df.collect()

    def written(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return written(node.executedPlan())
        if "QueryStage" in name:
            return written(node.plan())
        own = [node.metrics().apply("dataSize").value()] if "ShuffleExchange" in name else []
        return own + [x for i in range(node.children().size()) for x in written(node.children().apply(i))]
    return written(df._jdf.queryExecution().executedPlan())


def test_a_partner_is_one_small_number(spark):
    r = random.Random(3)
    data = [(u, b, r.randint(1, 5)) for u in range(300) for b in r.sample(range(1 << 21), 60)]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    assert max(bytes_shuffled(S.item_neighbors(df, k=3))) < 6 * 300 * 60 * 59  # 8.1 bytes a pair as three arrays


@pytest.mark.parametrize("wide", [False, True])
def test_few_columns_are_summed_before_the_shuffle(spark, wide):
    r = random.Random(4)
    data = [(u, f"title {b}", r.randint(-3, 5) * 1000) for u in range(1500) for b in r.sample(range(20), 15)]
    df = spark.createDataFrame(data, "user_id long, title string, rating long")
    sims = S.cosine_pairs(df, "user_id", "title", "rating", "title", "other", wide=wide)
    assert max(bytes_shuffled(sims)) < 100 * len(data)  # entries, not pairs
    rows = {}
    for u, t, v in data:
        rows.setdefault(u, {})[t] = v
    want = {}
    for row in rows.values():
        for a in row:
            for b in row:
                if a != b:
                    d, n = want.get((a, b), (0, 0))
                    want[a, b] = (d + row[a] * row[b], n + 1)
    assert {(x.title, x.other): (int(x.dot), x.n_common) for x in sims.collect()} == want


@pytest.mark.parametrize("sub_block,per_task", [(512, 1 << 21), (3, 40)])
def test_large_and_negative_ids_and_values_stay_exact(spark, sub_block, per_task):
    r = random.Random(6)
    ids = [-(1 << 40), -5, 0, 7, 1 << 33, (1 << 40) + 1, *range(100, 130)]
    data = [(u, b, r.randint(-9, 9)) for u in range(25) for b in {ids[u % 6], *r.sample(ids, 8)}]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    want = {}
    for u, a, x in data:
        for w, b, y in data:
            if u == w and a != b:
                d, n = want.get((a, b), (0, 0))
                want[a, b] = (d + x * y, n + 1)
    got = S.cosine_pairs(df, "user_id", "book_id", "rating", "book_id", "other", sub_block=sub_block, per_task=per_task).collect()
    assert {(x.book_id, x.other): (x.dot, x.n_common) for x in got} == want


def test_tfidf_leaves_the_counts_with_their_document(spark):
    r = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join(f"word{r.randint(0, 60)}" for _ in range(50))) for i in range(120)] + [(None, "word1 word2")], "doc_id long, text string")
    w, _ = TX.tfidf(docs, "doc_id", "text", 2, 0.9)
    rows = w.collect()
    assert len(rows) > 3000 and all(x.doc_id is not None for x in rows)
    assert max(records_shuffled(w), default=0) < 1000  # every count crossed three shuffles before
    sums = {}
    for x in rows:
        sums[x.doc_id] = sums.get(x.doc_id, 0.0) + x.weight ** 2
    assert len(sums) == 120 and all(s == pytest.approx(1.0) for s in sums.values())


def test_overlap_draws_its_sample_once(spark, monkeypatch):
    made, draw = spark.sparkContext.accumulator(0), q_eval.sample_keys

    def rows(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def counted(*a, **k):
        users = draw(*a, **k)
        return users.mapInArrow(rows, users.schema)
    monkeypatch.setattr(q_eval, "sample_keys", counted)
    assert q_eval.e03_overlap(spark, SF).count() == 10
    assert made.value == 5


@pytest.mark.parametrize("sub_block,per_task", [(512, 1 << 21), (7, 40)])
def test_neighbours_made_in_passes_equal_those_made_at_once(spark, sub_block, per_task):
    rnd = random.Random(12)
    data = [(r, c, rnd.randint(0, 5)) for r in range(60) for c in {3, *rnd.sample(range(40), rnd.randint(1, 9))}] + [(99, c, 2) for c in range(40)]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    only = df.filter("book_id % 6 = 3").select("book_id")
    rows = lambda x: sorted(map(tuple, x.select("book_id", "other_id", "dot", "sim", "nano", "n_common", "rank").collect()))
    for some in (None, only):
        many = S.item_neighbors(df, k=4, sub_block=sub_block, per_task=per_task, only=some, pass_pairs=1)
        assert many.columns == S.item_neighbors(df, k=4, only=some).columns
        assert rows(many) == rows(S.item_neighbors(df, k=4, only=some))


def test_passes_bound_what_the_disk_holds(spark):
    # 100 rows of 60 columns: 354,000 pairs of 1 partner number; no exchange of a pass may hold more than its share of the entries
    data = [(u, b + 60 * u, 1 + (u + b) % 5) for u in range(100) for b in range(60)]
    df = spark.createDataFrame(data, "user_id long, book_id long, rating int")
    parts, _ = S._directed(*S._asked(df, "user_id", "book_id", "rating", None), 512, False, 1 << 21, 1)
    assert len(parts) == 15  # four pairs an entry
    sent = [max(bytes_shuffled(p)) for p in parts]
    assert sum(sent) < 6 * 354_000 + 100 * 6000 and max(sent) < sum(sent) / 8


def test_a_written_table_leaves_no_shuffle_files(spark):
    from shelfwise.sources.sinks import write_bucketed, write_table
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: sum(b.isShuffle() for b in (lambda s: [s.apply(i) for i in range(s.size())])(blocks.getAllBlocks()))
    df = spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count()
    before = files()
    assert write_table(df, "freed").count() == 97 and write_bucketed(df, "freed", "k", 3).filter("k >= 0").select("k").distinct().count() == 97
    df.write.format("noop").mode("overwrite").save()
    assert files() > before  # elsewhere they stay for the next reader
    kept = files()
    write_table(df, "freed")
    assert files() == kept
