from pyspark.sql import functions as F

from shelfwise.operators import cleaning as C


def test_clean_ratings(spark):
    raw = spark.createDataFrame([("1", "10", "4"), ("x1", "10", "3"), (None, "11", "2"), (" 2 ", "12", " 5 "),
                                 ("3", "13", "9"), ("4", "14", "0"), ("5", "15", "")],
                                "user_id string, book_id string, rating string")
    got = sorted((r.user_id, r.book_id, r.rating) for r in C.clean_ratings(raw).collect())
    assert got == [(1, 10, 4.0), (2, 12, 5.0)]


def test_clean_books_order_and_fills(spark):
    raw = spark.createDataFrame([
        ("7.9", "T", "A", None, None, None, "3.5"),
        ("x1", "T2", "B", "i", "fr", "O", "4"),
        ("8", None, "C", None, None, None, "1"),
        ("9", "Unknown Title", "Unknown", None, None, None, "n/a"),
    ], "book_id string, title string, authors string, isbn string, language_code string, original_title string, "
       "average_rating string")
    out = C.clean_books(raw)
    rows = {r.book_id: r for r in out.collect()}
    assert set(rows) == {7, 9}
    assert rows[7].isbn == "" and rows[7].language_code == "eng" and rows[7].original_title == "T"
    assert rows[9].average_rating == 0.0
    assert [r.book_id for r in C.drop_placeholders(out).collect()] == [7]


def test_reconcile_aliases(spark):
    df = spark.createDataFrame([(1, "t", "a")], "book_id long, book_title string, author string")
    assert C.reconcile_aliases(df).columns == ["book_id", "title", "authors"]


def test_rekey_uses_max_of_existing(spark):
    ex = spark.createDataFrame([(1,), (5,)], "book_id long")
    inc = spark.createDataFrame([(1, "n")], "book_id long, t string")
    assert C.rekey(inc, ex, ["book_id"]).first().book_id == 6
