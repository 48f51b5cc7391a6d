import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dedup as D
from shelfwise.operators import profile as A
from shelfwise.plans.pipelines import append_ingest


def test_bayesian_average(spark):
    rows = [("a", 5)] * 10 + [("b", 1)] * 10 + [("c", 5)]
    df = spark.createDataFrame(rows, "title string, rating int")
    got = {r.title: r.bayesian_avg for r in A.bayesian_ranking(df, "title", "rating").collect()}
    m = (50 + 10 + 5) / 21
    assert got == {"a": pytest.approx((10 * 5 + 10 * m) / 20), "b": pytest.approx((10 * 1 + 10 * m) / 20)}


def test_describe_quartiles_linear(spark):
    vals = [1, 2, 2, 3, 7, 11, 40]
    df = spark.createDataFrame([(v,) for v in vals], "c long")
    r = A.describe(df, "c").first()
    assert r.q25 == pytest.approx(np.percentile(vals, 25)) and r.q75 == pytest.approx(np.percentile(vals, 75))
    assert r.std == pytest.approx(np.std(vals, ddof=1))


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a long, b string")
    got = {r.column_name: (r.n_null, r.pct_null) for r in A.null_profile(df).collect()}
    assert got == {"a": (1, pytest.approx(100 / 3)), "b": (2, pytest.approx(200 / 3))}


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("t", "a", 3, "x"), ("t", "a", 1, "y"), ("u", "b", 2, "z")],
                               "title string, authors string, seq int, v string")
    first = {r.title: r.v for r in D.keep_first(df, ["title", "authors"], ["seq"], ["v"]).collect()}
    last = {r.title: r.v for r in D.keep_last(df, ["title", "authors"], ["seq"], ["v"]).collect()}
    assert first == {"t": "y", "u": "z"} and last == {"t": "x", "u": "z"}


def test_append_ingest_clashing_ids(spark):
    ex_b = spark.createDataFrame([(1, "A", "x"), (2, "B", "y")], "book_id long, title string, authors string")
    in_b = spark.createDataFrame([(1, "A", "x"), (2, "C", "z")], "book_id long, title string, authors string")
    ex_r = spark.createDataFrame([(9, 1, 3, 0), (9, 2, 4, 1)], "user_id long, book_id long, rating int, _pos int")
    in_r = spark.createDataFrame([(9, 1, 5, 0), (9, 2, 2, 1), (9, 2, 1, 2)],
                                 "user_id long, book_id long, rating int, _pos int")
    books, ratings = append_ingest(ex_b, ex_r, in_b, in_r)
    # incoming ids shifted by max existing id (2): (1,A,x) duplicates existing and is dropped, C becomes 4
    assert sorted((r.book_id, r.title) for r in books.collect()) == [(1, "A"), (2, "B"), (4, "C")]
    assert {r.language_code for r in books.collect()} == {"eng"}
    # incoming rating for book 3 (dropped book) removed; last of the repeated (9, 4) pair kept
    assert sorted((r.book_id, r.rating) for r in ratings.collect()) == [(1, 3), (2, 4), (4, 1)]


def test_item_lists_are_long_rows(spark):
    df = spark.createDataFrame([(1, 3 * i) for i in range(200)] + [(2, 5)], "u long, b long")
    out = sorted(tuple(r) for r in A.item_lists(df, "u", "b").collect())
    assert out == [(1, 3 * i, i) for i in range(200)] + [(2, 5, 0)]


def test_pivot_reports_unlisted_values(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "a", 4), (1, "z", 9), (2, None, 1)], "u long, c string, v long")
    got = {r.u: (r.a, r.b, r.n_unlisted) for r in A.pivot_mean(df, "u", "c", "v", ["a", "b"]).collect()}
    assert got == {1: (3.0, 0.0, 1), 2: (0.0, 0.0, 1)}
    assert {(r.u, r.c): r["mean"] for r in A.mean_by(df, "u", "c", "v").collect()} == {(1, "a"): 3, (1, "z"): 9, (2, None): 1}


def test_describe_of_many_and_of_no_values(spark):
    many = A.describe(spark.range(1001).select((F.col("id") * 3).alias("c")), "c").first()
    assert (many.q25, many.q50, many.q75) == (750.0, 1500.0, 2250.0)
    none = A.describe(spark.range(3).select(F.lit(None).cast("long").alias("c")), "c").first()
    assert none["count"] == 0 and none.q50 is None


def test_isin_takes_long_lists(spark):
    from shelfwise.operators.cleaning import isin_filter
    df = spark.range(5000)
    assert isin_filter(df, "id", list(range(0, 8000, 2))).count() == 2500 and isin_filter(df, "id", []).count() == 0
