from pyspark.sql import functions as F

from shelfwise.operators import evaluate as E
from shelfwise.operators import serve as SV


def test_request_validation_cases(spark):
    # cases carried over from the reference's endpoint checks
    reqs = [(1, "user", "99999", None, None), (2, "user", "-1", None, None), (3, "user", "0", None, None),
            (4, "user", "abc", None, None), (5, "user", "125", "100", None), (6, "user", "125", "-1", None),
            (7, "user", "125", "0", None), (8, "user", "125", "1", None), (9, "user", "125", None, None),
            (10, "user", "125", "20", "3"), (11, "book", "99999", None, None), (12, "book", "352", "20", None),
            (13, "user", "abc", "100", None)]
    df = spark.createDataFrame(reqs, "request_id long, kind string, id_text string, num_text string, n_text string")
    got = {r.request_id: (r.status, r["count"]) for r in SV.validate_requests(df).collect()}
    assert got[1][0] == 404 and got[2][0] == 404 and got[3][0] == 404 and got[11][0] == 404
    assert got[4][0] == 422 and got[5][0] == 422 and got[6][0] == 422 and got[7][0] == 422
    assert got[13][0] == 422  # 422 is decided before 404
    assert got[8] == (200, 1) and got[9] == (200, 5) and got[10] == (200, 3) and got[12] == (200, 20)


def test_answer_respects_count(spark):
    valid = spark.createDataFrame([(1, "user", 5, 2, 200), (2, "user", 6, 5, 200), (3, "user", 5, 5, 404)],
                                  "request_id long, kind string, target_id long, count int, status int")
    recs = spark.createDataFrame([(5, b, r, "t", "a") for r, b in enumerate([7, 8, 9], 1)],
                                 "user_id long, book_id long, rank int, title string, authors string")
    sim = spark.createDataFrame([], "book_id long, other_id long, rank int, title string, authors string")
    out = SV.answer(valid, recs, sim).collect()
    assert sorted((r.request_id, r.book_id) for r in out) == [(1, 7), (1, 8)]


def test_precision_recall(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 12, 1)], "user_id long, book_id long, rank int")
    test = spark.createDataFrame([(1, 11), (1, 13), (2, 14), (3, 15)], "user_id long, book_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    r = {x.k: x for x in E.precision_recall(recs, test, users, [1, 2]).collect()}
    assert abs(r[2].precision - (1 / 2) / 3) < 1e-12 and abs(r[2].recall - (1 / 2) / 3) < 1e-12
    assert r[1].precision == 0.0


def test_list_overlap_skips_empty(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 11, 1)], "user_id long, book_id long, rank int")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    got = {(r.user_id_a, r.user_id_b): r.jaccard for r in E.list_overlap(recs, users, n=5).collect()}
    assert got[(1, 2)] == 0.5 and got[(1, 3)] is None and got[(2, 3)] is None


def test_respond_answers_every_request(spark):
    valid = spark.createDataFrame([(1, "user", 5, 2, 200), (2, "user", 6, 5, 200), (3, "book", 0, 5, 404), (4, "user", None, 5, 422)],
                                  "request_id long, kind string, target_id long, count int, status int")
    items = spark.createDataFrame([(1, 8, "t", "a", 2), (1, 7, "t", "a", 1)],
                                  "request_id long, book_id long, title string, authors string, rank int")
    for empty in (200, 404):
        got = {r.request_id: r for r in SV.respond(valid, items, empty_status=empty).collect()}
        assert {k: (r.status, r.n_items) for k, r in got.items()} == {1: (200, 2), 2: (empty, 0), 3: (404, 0), 4: (422, 0)}
        assert [x.book_id for x in got[1].recommendations] == [7, 8] and got[3].recommendations == []


def test_user_item_entries_sum_duplicates(spark):
    from shelfwise.operators.recommend import user_item_entries
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 4), (1, 3, None), (None, 2, 5), (1, None, 5)], "user_id long, book_id long, rating int")
    assert sorted(map(tuple, user_item_entries(df).collect())) == [(1, 2, 7), (1, 3, 0)]
    assert user_item_entries(df.limit(0)).collect() == []


def test_one_pass_minmax(spark):
    from shelfwise.operators.features import minmax
    df = spark.createDataFrame([(1, 0, 5), (2, 10, 5), (3, None, 5)], "book_id long, size int, price int")
    out = minmax(df, ["size", "price"])
    assert sorted(map(tuple, out.collect())) == [(1, "price", 0.0), (1, "size", 0.0), (2, "price", 0.0), (2, "size", 1.0),
                                                 (3, "price", 0.0), (3, "size", 0.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1 + 2  # one scan, one subquery
