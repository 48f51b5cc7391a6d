"""Queries for cleaning, projections and filters."""
from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import cleaning as C
from shelfwise.plans import views as V
from shelfwise.plans.registry import DIRTY_BOOKS_SQL, DIRTY_RATINGS_SQL, INTER_SQL, query, td

B_COLS = "book_id, title, authors, average_rating, ratings_count, isbn, language_code, original_title, image_url"


@query("p01_coerce", f"""WITH {DIRTY_BOOKS_SQL}
SELECT {td('book_id')} AS book_id, {td('average_rating')} AS average_rating, {td('ratings_count')} AS ratings_count,
       title FROM dirty_books""")
def p01_coerce(spark, d):
    return C.coerce_numeric(V.dirty_books(spark, d), ["book_id", "average_rating", "ratings_count"]).select(
        "book_id", "average_rating", "ratings_count", "title")


@query("p02_drop_critical", f"""WITH {DIRTY_BOOKS_SQL}
SELECT {B_COLS} FROM dirty_books WHERE title IS NOT NULL AND authors IS NOT NULL""")
def p02_drop_critical(spark, d):
    return C.drop_missing(V.dirty_books(spark, d), C.CRITICAL)


@query("p03_drop_null_key", f"""WITH {DIRTY_BOOKS_SQL}
SELECT {td('book_id')} AS book_id, title FROM dirty_books WHERE {td('book_id')} IS NOT NULL""")
def p03_drop_null_key(spark, d):
    df = C.coerce_numeric(V.dirty_books(spark, d).select("book_id", "title"), ["book_id"])
    return C.drop_missing(df, ["book_id"])


@query("p04_fill", f"""WITH {DIRTY_BOOKS_SQL}
SELECT coalesce(isbn, '') AS isbn, coalesce(language_code, 'eng') AS language_code,
       coalesce(image_url, '') AS image_url, coalesce({td('average_rating')}, 0) AS average_rating,
       coalesce({td('ratings_count')}, 0) AS ratings_count, title FROM dirty_books""")
def p04_fill(spark, d):
    df = C.coerce_numeric(V.dirty_books(spark, d), ["average_rating", "ratings_count"])
    return C.fill_defaults(df, C.BOOK_FILL, ["average_rating", "ratings_count"]).select(
        "isbn", "language_code", "image_url", "average_rating", "ratings_count", "title")


@query("p05_fill_from", f"""WITH {DIRTY_BOOKS_SQL}
SELECT book_id, title, coalesce(original_title, title) AS original_title FROM dirty_books""")
def p05_fill_from(spark, d):
    return C.fill_from(V.dirty_books(spark, d).select("book_id", "title", "original_title"), "original_title", "title")


@query("p06_cast", f"""WITH {DIRTY_BOOKS_SQL}
SELECT CAST(trunc({td('average_rating')}) AS BIGINT) AS average_rating, CAST({td('book_id')} AS BIGINT) AS book_id
FROM dirty_books""")
def p06_cast(spark, d):
    df = C.coerce_numeric(V.dirty_books(spark, d).select("book_id", "average_rating"), ["book_id", "average_rating"])
    return C.cast_integer(df, ["book_id", "average_rating"])


@query("p07_drop_any", f"""WITH {DIRTY_RATINGS_SQL}
SELECT * FROM (SELECT {td('book_id')} AS book_id, {td('user_id')} AS user_id, {td('rating')} AS rating
               FROM dirty_ratings) t
WHERE book_id IS NOT NULL AND user_id IS NOT NULL AND rating IS NOT NULL""")
def p07_drop_any(spark, d):
    return C.drop_any_null(C.coerce_numeric(V.dirty_ratings(spark, d), ["book_id", "user_id", "rating"]))


@query("p08_range", f"""WITH {DIRTY_RATINGS_SQL}
SELECT * FROM (SELECT book_id, user_id, {td('rating')} AS rating FROM dirty_ratings) t
WHERE rating BETWEEN 1 AND 5""")
def p08_range(spark, d):
    return C.in_range(C.coerce_numeric(V.dirty_ratings(spark, d), ["rating"]), "rating", 1, 5)


CLEAN_BOOKS_SQL = f"""clean_books AS (
  SELECT CAST(trunc(book_id) AS BIGINT) AS book_id, title, authors, coalesce(average_rating, 0) AS average_rating,
         CAST(trunc(coalesce(ratings_count, 0)) AS BIGINT) AS ratings_count, coalesce(isbn, '') AS isbn,
         coalesce(language_code, 'eng') AS language_code, coalesce(original_title, title) AS original_title,
         coalesce(image_url, '') AS image_url
  FROM (SELECT {td('book_id')} AS book_id, title, authors, {td('average_rating')} AS average_rating,
               {td('ratings_count')} AS ratings_count, isbn, language_code, original_title, image_url
        FROM dirty_books WHERE title IS NOT NULL AND authors IS NOT NULL) t
  WHERE book_id IS NOT NULL)"""


@query("p09_clean_books", f"""WITH {DIRTY_BOOKS_SQL}, {CLEAN_BOOKS_SQL}
SELECT * FROM clean_books""")
def p09_clean_books(spark, d):
    return C.clean_books(V.dirty_books(spark, d))


@query("p10_clean_ratings", f"""WITH {DIRTY_RATINGS_SQL}
SELECT CAST(trunc(book_id) AS BIGINT) AS book_id, CAST(trunc(user_id) AS BIGINT) AS user_id, rating
FROM (SELECT {td('book_id')} AS book_id, {td('user_id')} AS user_id, {td('rating')} AS rating FROM dirty_ratings) t
WHERE book_id IS NOT NULL AND user_id IS NOT NULL AND rating IS NOT NULL AND rating BETWEEN 1 AND 5""")
def p10_clean_ratings(spark, d):
    return C.clean_ratings(V.dirty_ratings(spark, d))


@query("p11_constant", f"""WITH {DIRTY_BOOKS_SQL}
SELECT book_id, title, 'eng' AS language_code FROM dirty_books""")
def p11_constant(spark, d):
    return C.overwrite_constant(V.dirty_books(spark, d).select("book_id", "title", "language_code"),
                                "language_code", "eng")


@query("p12_aliases", """SELECT p_partkey AS book_id, p_name AS title, p_brand AS authors FROM part""")
def p12_aliases(spark, d):
    raw = V.table(spark, d, "part").select(F.col("p_partkey").alias("book_id"), F.col("p_name").alias("book_title"),
                                           F.col("p_brand").alias("author"))
    return C.reconcile_aliases(raw).select("book_id", "title", "authors")


@query("p13_p16_placeholder", f"""WITH {DIRTY_BOOKS_SQL}
SELECT {B_COLS} FROM dirty_books
WHERE title IS NOT NULL AND authors IS NOT NULL AND NOT (contains(title, 'Unknown') AND authors = 'Unknown')""")
def p13_p16_placeholder(spark, d):
    from shelfwise.schemas import require_columns
    return C.drop_placeholders(require_columns(V.dirty_books(spark, d), "title", "authors"))


@query("p14_implicit", """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS book_id,
       CAST(SUM(1.0) AS DOUBLE) AS rating, CAST(COUNT(*) AS BIGINT) AS n_events
FROM events GROUP BY 1, 2""")
def p14_implicit(spark, d):
    ev = V.table(spark, d, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("book_id"))
    ev = C.implicit_feedback(ev)
    return ev.groupBy("user_id", "book_id").agg(F.sum("rating").cast("double").alias("rating"),
                                                F.count(F.lit(1)).alias("n_events"))


P15_IDS = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597]


@query("p15_isin", f"""WITH {INTER_SQL}
SELECT user_id, book_id, rating FROM interactions WHERE book_id IN ({', '.join(map(str, P15_IDS))})""")
def p15_isin(spark, d):
    return C.isin_filter(V.interactions(spark, d, keep=False), "book_id", P15_IDS)


@query("p17_rekey", """SELECT p_partkey + (SELECT max(p_partkey) FROM part WHERE p_size <= 25) AS book_id,
       p_name AS title FROM part WHERE p_size > 25""")
def p17_rekey(spark, d):
    p = V.table(spark, d, "part").select(F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"),
                                         "p_size")
    existing = p.filter(F.col("p_size") <= 25)
    incoming = p.filter(F.col("p_size") > 25).drop("p_size")
    return C.rekey(incoming, existing, ["book_id"])


@query("p18_user_top_rated", f"""WITH {INTER_SQL}
SELECT user_id, book_id, rating, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, book_id) AS INTEGER) AS rank
  FROM (SELECT DISTINCT user_id, book_id, rating FROM interactions WHERE rating >= 2) a) t WHERE rank <= 10""")
def p18_user_top_rated(spark, d):
    return C.user_top_rated(V.interactions(spark, d))


@query("p22_projection", """SELECT p_partkey AS book_id, p_name AS title FROM part""")
def p22_projection(spark, d):
    return V.books(spark, d).select("book_id", "title")
