"""Queries for joins, dedup/set operations and profiling."""
from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import cleaning as C
from shelfwise.operators import dedup as D
from shelfwise.operators import joins as J
from shelfwise.operators import profile as A
from shelfwise.operators import similarity as S
from shelfwise.operators.ranking import top_k_per_group, top_n
from shelfwise.plans import pipelines as P
from shelfwise.plans import views as V
from shelfwise.plans.q_clean import CLEAN_BOOKS_SQL
from shelfwise.plans.registry import (BOOKS_SQL, DIRTY_BOOKS_SQL, DIRTY_RATINGS_SQL, INTER_SQL, IR_SQL, cosine_sql,
                                      query, td)
from shelfwise.session import scratch_path
from shelfwise.streaming.buckets import BucketedBooks

CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def rated_books(spark, d):
    return V.interactions(spark, d).join(V.books(spark, d), "book_id")


# ---- joins -----------------------------------------------------------------------------------
@query("j01_merge", f"""WITH {INTER_SQL}, {BOOKS_SQL}
SELECT i.book_id, i.user_id, i.rating, b.title, b.authors, b.category, b.size, b.price
FROM interactions i JOIN books b ON i.book_id = b.book_id""")
def j01_merge(spark, d):
    return J.merge_ratings_books(V.interactions(spark, d), V.books(spark, d))


@query("j02_semi", f"""WITH {INTER_SQL}, {DIRTY_BOOKS_SQL}, {CLEAN_BOOKS_SQL}
SELECT user_id, book_id, rating FROM interactions i
WHERE EXISTS (SELECT 1 FROM clean_books c WHERE c.book_id = i.book_id)""")
def j02_semi(spark, d):
    return J.referential_filter(V.interactions(spark, d), C.clean_books(V.dirty_books(spark, d)))


@query("j03_orphans", f"""WITH {INTER_SQL}, {DIRTY_BOOKS_SQL}, {CLEAN_BOOKS_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS n_orphans FROM (SELECT DISTINCT book_id FROM interactions) i
WHERE NOT EXISTS (SELECT 1 FROM clean_books c WHERE c.book_id = i.book_id)""")
def j03_orphans(spark, d):
    return J.orphans(V.interactions(spark, d), C.clean_books(V.dirty_books(spark, d)))


@query("j03_orphan_sample", f"""WITH {INTER_SQL}, {DIRTY_BOOKS_SQL}, {CLEAN_BOOKS_SQL}
SELECT book_id FROM (SELECT DISTINCT book_id FROM interactions) i
WHERE NOT EXISTS (SELECT 1 FROM clean_books c WHERE c.book_id = i.book_id) ORDER BY book_id LIMIT 5""")
def j03_orphan_sample(spark, d):
    return J.orphan_sample(V.interactions(spark, d), C.clean_books(V.dirty_books(spark, d)))


@query("j04_tags", """SELECT bt.goodreads_book_id, bt.tag_id, bt.count, t.tag_name
FROM (SELECT l_partkey AS goodreads_book_id, l_suppkey AS tag_id, CAST(COUNT(*) AS BIGINT) AS count
      FROM lineitem GROUP BY 1, 2) bt JOIN (SELECT s_suppkey AS tag_id, s_name AS tag_name FROM supplier) t
ON bt.tag_id = t.tag_id""")
def j04_tags(spark, d):
    return J.tag_names(V.book_tags(spark, d), V.tags(spark, d))


@query("j05_left_named", """SELECT n.n_nationkey, n.n_name, r.r_regionkey, r.r_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def j05_left_named(spark, d):
    n = V.table(spark, d, "nation")
    r = V.table(spark, d, "region")
    return J.left_join_named(n, r, "n_regionkey", "r_regionkey").select("n_nationkey", "n_name", "r_regionkey",
                                                                        "r_name")


@query("j06_stats_join", f"""WITH {INTER_SQL}
SELECT book_id, round(avg(rating), 6) AS mean_rating, CAST(COUNT(rating) AS BIGINT) AS n_ratings
FROM interactions GROUP BY 1""")
def j06_stats_join(spark, d):
    return A.mean_count(V.interactions(spark, d), "book_id", "rating").withColumn(
        "mean_rating", F.round("mean_rating", 6))


@query("j10_activity_filter", f"""WITH {INTER_SQL},
kept AS (SELECT * FROM interactions WHERE book_id IN
         (SELECT book_id FROM interactions GROUP BY 1 HAVING COUNT(*) >= 2))
SELECT user_id, book_id, rating FROM kept WHERE user_id IN
  (SELECT user_id FROM kept GROUP BY 1 HAVING COUNT(*) >= 10)""")
def j10_activity_filter(spark, d):
    return J.activity_filter(V.interactions(spark, d))


# ---- dedup and set operations ------------------------------------------------------------------
@query("d01_keep_first", """SELECT title, authors, book_id, category FROM (
  SELECT p_name AS title, p_brand AS authors, p_partkey AS book_id, p_type AS category,
         row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS rn FROM part) t WHERE rn = 1""")
def d01_keep_first(spark, d):
    return D.keep_first(V.books(spark, d), ["title", "authors"], ["book_id"], ["book_id", "category"])


@query("d02_keep_last", f"""WITH {INTER_SQL} SELECT user_id, book_id, rating FROM interactions""")
def d02_keep_last(spark, d):
    return V.interactions(spark, d, keep=False)


@query("d03_one_per_book", """SELECT goodreads_book_id, tag_id, count FROM (
  SELECT *, row_number() OVER (PARTITION BY goodreads_book_id ORDER BY tag_id) AS rn FROM
  (SELECT l_partkey AS goodreads_book_id, l_suppkey AS tag_id, CAST(COUNT(*) AS BIGINT) AS count
   FROM lineitem GROUP BY 1, 2) bt) t WHERE rn = 1""")
def d03_one_per_book(spark, d):
    return D.keep_first(V.book_tags(spark, d), ["goodreads_book_id"], ["tag_id"], ["tag_id", "count"])


@query("d04_distinct", """SELECT DISTINCT p_brand AS authors FROM part""")
def d04_distinct(spark, d):
    return D.distinct_values(V.books(spark, d), "authors")


@query("d05_distinct_rows", f"""WITH {IR_SQL} SELECT DISTINCT user_id, book_id, rating FROM ir""")
def d05_distinct_rows(spark, d):
    return D.distinct_rows(V.interactions_raw(spark, d).select("user_id", "book_id", "rating"))


@query("u01_union", """SELECT p_partkey AS book_id, p_name AS title, p_brand AS authors, NULL AS category, 0 AS src
FROM part WHERE p_size <= 25
UNION ALL SELECT p_partkey, p_name, NULL, p_type, 1 FROM part WHERE p_size > 25""")
def u01_union(spark, d):
    b = V.books(spark, d)
    ex = b.filter(F.col("size") <= 25).select("book_id", "title", "authors")
    inc = b.filter(F.col("size") > 25).select("book_id", "title", "category")
    return D.append_union(ex, inc, "book_id").select("book_id", "title", "authors", "category",
                                                     F.col("_seq.src").alias("src"))


def _ingest_inputs(spark, d):
    b = V.books(spark, d).select("book_id", "title", "authors", "size")
    ir = V.interactions_raw(spark, d).join(b.select("book_id", "size"), "book_id").withColumn(
        "_pos", F.struct(*[F.col(c) for c in V.SEQ_COLS]))
    ex_b = b.filter(F.col("size") <= 25).drop("size")
    in_b = b.filter(F.col("size") > 25).drop("size")
    ex_r = ir.filter(F.col("size") <= 25).select("user_id", "book_id", "rating", "_pos")
    in_r = ir.filter(F.col("size") > 25).select("user_id", "book_id", "rating", "_pos")
    return ex_b, ex_r, in_b, in_r


INGEST_SQL = f"""{IR_SQL},
mx AS (SELECT max(p_partkey) AS m FROM part WHERE p_size <= 25),
ub AS (SELECT p_partkey AS book_id, p_name AS title, p_brand AS authors, 0 AS src FROM part WHERE p_size <= 25
       UNION ALL SELECT p_partkey + (SELECT m FROM mx), p_name, p_brand, 1 FROM part WHERE p_size > 25),
nb AS (SELECT book_id, title, authors, 'eng' AS language_code FROM (
         SELECT *, row_number() OVER (PARTITION BY title, authors ORDER BY src, book_id) AS rn FROM ub) t
       WHERE rn = 1),
ur AS (SELECT ir.user_id, ir.book_id, ir.rating, 0 AS src, ir.l_orderkey, ir.l_linenumber, ir.l_quantity,
              ir.l_extendedprice FROM ir JOIN part p ON ir.book_id = p.p_partkey WHERE p.p_size <= 25
       UNION ALL
       SELECT ir.user_id, ir.book_id + (SELECT m FROM mx), ir.rating, 1, ir.l_orderkey, ir.l_linenumber,
              ir.l_quantity, ir.l_extendedprice FROM ir JOIN part p ON ir.book_id = p.p_partkey WHERE p.p_size > 25),
nr AS (SELECT user_id, book_id, rating FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, book_id ORDER BY src DESC, l_orderkey DESC,
                l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) AS rn
         FROM ur WHERE book_id IN (SELECT book_id FROM nb)) t WHERE rn = 1)"""


@query("u02_append_ingest_books", f"""WITH {INGEST_SQL} SELECT * FROM nb""")
def u02_append_ingest_books(spark, d):
    books, _ = P.append_ingest(*_ingest_inputs(spark, d))
    return books.select("book_id", "title", "authors", "language_code")


@query("u02_append_ingest_ratings", f"""WITH {INGEST_SQL} SELECT * FROM nr""")
def u02_append_ingest_ratings(spark, d):
    _, ratings = P.append_ingest(*_ingest_inputs(spark, d))
    return ratings.select("user_id", "book_id", "rating")


def _bucketed(spark, d):
    """The stored books and ratings as the first load, the others as an append that rewrites the buckets it touches."""
    ex_b, ex_r, in_b, in_r = _ingest_inputs(spark, d)
    tables = BucketedBooks(spark, scratch_path(spark, "bucketed_books"), 16)
    tables.append(ex_b, ex_r, -1)
    tables.append(in_b, in_r, 0)
    return tables


@query("u02_bucketed_books", f"""WITH {INGEST_SQL} SELECT * FROM nb""")
def u02_bucketed_books(spark, d):
    return _bucketed(spark, d).read("books")


@query("u02_bucketed_ratings", f"""WITH {INGEST_SQL} SELECT * FROM nr""")
def u02_bucketed_ratings(spark, d):
    return _bucketed(spark, d).read("ratings")


@query("u03_difference", f"""WITH {INTER_SQL}
SELECT book_id FROM interactions EXCEPT SELECT p_partkey FROM part WHERE p_size <= 25""")
def u03_difference(spark, d):
    small = V.books(spark, d).filter(F.col("size") <= 25).select("book_id")
    return D.key_difference(V.interactions(spark, d, keep=False).select("book_id"), small, "book_id")


@query("u04_u05_overlap", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'book_id', 'user_id', 'user_id', 'other_user_id')},
co AS (SELECT a.user_id, b.user_id AS other_user_id, CAST(COUNT(*) AS BIGINT) AS n_common
       FROM interactions a JOIN interactions b ON a.book_id = b.book_id AND a.user_id <> b.user_id GROUP BY 1, 2),
cnt AS (SELECT user_id, CAST(COUNT(*) AS BIGINT) AS n FROM interactions GROUP BY 1),
top1 AS (SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY user_id ORDER BY nano DESC, other_user_id) AS rn
                        FROM sims s) t WHERE rn = 1)
SELECT t.user_id, t.other_user_id, co.n_common AS n_common,
       round(co.n_common / (ca.n + cb.n - co.n_common), 6) AS jaccard
FROM top1 t JOIN co ON t.user_id = co.user_id AND t.other_user_id = co.other_user_id
JOIN cnt ca ON t.user_id = ca.user_id JOIN cnt cb ON t.other_user_id = cb.user_id""")
def u04_u05_overlap(spark, d):
    inter = V.written_interactions(spark, d)
    nb = S.user_neighbors(inter, k=1)
    cnt = inter.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cb = cnt.select(F.col("user_id").alias("other_user_id"), F.col("n").alias("nb"))
    read = inter.select("user_id", "book_id")
    common = (nb.select("user_id", "other_user_id").join(read, "user_id")
              .join(read.withColumnRenamed("user_id", "other_user_id"), ["other_user_id", "book_id"])
              .groupBy("user_id", "other_user_id").agg(F.count(F.lit(1)).alias("n_common")))
    return (common.join(cnt, "user_id").join(cb, "other_user_id")
            .select("user_id", "other_user_id", "n_common",
                    F.round(F.col("n_common") / (F.col("n") + F.col("nb") - F.col("n_common")), 6).alias("jaccard")))


# ---- profiling ---------------------------------------------------------------------------------
@query("a01_counts", f"""WITH {INTER_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS n_user_id,
       CAST(COUNT(DISTINCT book_id) AS BIGINT) AS n_book_id FROM interactions""")
def a01_counts(spark, d):
    return A.counts(V.interactions(spark, d, keep=False), ["user_id", "book_id"])


@query("a02_max_ids", f"""WITH {INTER_SQL}
SELECT max(user_id) AS max_user_id, max(book_id) AS max_book_id FROM interactions""")
def a02_max_ids(spark, d):
    return A.max_ids(V.interactions(spark, d, keep=False), ["user_id", "book_id"])


@query("a03_user_lists", f"""WITH {INTER_SQL}
SELECT user_id, book_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY book_id) - 1 AS BIGINT) AS position
FROM interactions""")
def a03_user_lists(spark, d):
    return A.item_lists(V.interactions(spark, d, keep=False), "user_id", "book_id")


@query("a04_value_counts", """SELECT l_suppkey AS tag_id, CAST(COUNT(*) AS BIGINT) AS count
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) t GROUP BY 1""")
def a04_value_counts(spark, d):
    return A.value_counts(V.book_tags(spark, d), "tag_id")


@query("a05_mean_count", f"""WITH {INTER_SQL}, {BOOKS_SQL}
SELECT b.title, round(avg(i.rating), 6) AS mean_rating, CAST(COUNT(i.rating) AS BIGINT) AS n_ratings
FROM interactions i JOIN books b ON i.book_id = b.book_id GROUP BY 1""")
def a05_mean_count(spark, d):
    return A.mean_count(rated_books(spark, d), "title", "rating").withColumn("mean_rating", F.round("mean_rating", 6))


@query("a06_global", f"""WITH {INTER_SQL}
SELECT round(avg(rating), 6) AS mean, min(rating) AS min, max(rating) AS max FROM interactions""")
def a06_global(spark, d):
    return A.global_stats(V.interactions(spark, d, keep=False), "rating").withColumn("mean", F.round("mean", 6))


BAYES_SQL = f"""{INTER_SQL}, {BOOKS_SQL},
m AS (SELECT avg(rating) AS gm FROM interactions),
st AS (SELECT b.title, avg(i.rating) AS mean_rating, COUNT(i.rating) AS n_ratings
       FROM interactions i JOIN books b ON i.book_id = b.book_id GROUP BY 1),
bay AS (SELECT title, mean_rating, CAST(n_ratings AS BIGINT) AS n_ratings,
               (n_ratings * mean_rating + 10 * (SELECT gm FROM m)) / (n_ratings + 10) AS bayesian_avg
        FROM st WHERE n_ratings >= 10)"""


@query("a07_bayesian", f"""WITH {BAYES_SQL}
SELECT title, round(mean_rating, 6) AS mean_rating, n_ratings, round(bayesian_avg, 6) AS bayesian_avg FROM bay""")
def a07_bayesian(spark, d):
    out = A.bayesian_ranking(rated_books(spark, d), "title", "rating")
    return out.select("title", F.round("mean_rating", 6).alias("mean_rating"), "n_ratings",
                      F.round("bayesian_avg", 6).alias("bayesian_avg"))


@query("a08_w02_top_bayesian", f"""WITH {BAYES_SQL}
SELECT title, round(bayesian_avg, 6) AS bayesian_avg FROM bay ORDER BY bayesian_avg DESC, title LIMIT 10""")
def a08_w02_top_bayesian(spark, d):
    out = A.bayesian_ranking(rated_books(spark, d), "title", "rating")
    return top_n(out, [F.col("bayesian_avg").desc(), F.col("title")], 10).select(
        "title", F.round("bayesian_avg", 6).alias("bayesian_avg"))


@query("a09_describe", """SELECT CAST(COUNT(count) AS BIGINT) AS count, round(avg(count), 6) AS mean,
  round(stddev_samp(count), 6) AS std, CAST(min(count) AS DOUBLE) AS min,
  CAST(quantile_cont(count, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont(count, 0.5) AS DOUBLE) AS q50,
  CAST(quantile_cont(count, 0.75) AS DOUBLE) AS q75, CAST(max(count) AS DOUBLE) AS max
FROM (SELECT l_partkey, l_suppkey, COUNT(*) AS count FROM lineitem GROUP BY 1, 2) t""")
def a09_describe(spark, d):
    out = A.describe(V.book_tags(spark, d), "count")
    return out.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


NULL_COLS = ["book_id", "title", "authors", "average_rating", "ratings_count", "isbn", "language_code",
             "original_title", "image_url"]


@query("a10_null_profile", f"""WITH {DIRTY_BOOKS_SQL}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows, round(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 6) "
    f"AS pct_null FROM dirty_books" for c in NULL_COLS))
def a10_null_profile(spark, d):
    return A.null_profile(V.dirty_books(spark, d).select(*NULL_COLS))


@query("a11_duplicates", f"""WITH {IR_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT DISTINCT user_id, book_id
 FROM ir) t) AS n_distinct,
 CAST(COUNT(*) AS BIGINT) - (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT DISTINCT user_id, book_id FROM ir) t)
 AS n_duplicates FROM ir""")
def a11_duplicates(spark, d):
    return A.duplicate_keys(V.interactions_raw(spark, d), ["user_id", "book_id"])


@query("a12_string_stats", f"""WITH {DIRTY_BOOKS_SQL}
SELECT min(length(title)) AS min_len, max(length(title)) AS max_len, round(avg(length(title)), 6) AS avg_len,
       CAST(SUM(CASE WHEN trim(title) = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank,
       CAST(SUM(CASE WHEN title IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM dirty_books""")
def a12_string_stats(spark, d):
    return A.string_stats(V.dirty_books(spark, d), "title")


@query("a13_pivot", f"""WITH {INTER_SQL}, {BOOKS_SQL}
SELECT i.user_id, """ + ", ".join(
    f"round(coalesce(avg(CASE WHEN b.category = '{c}' THEN i.rating END), 0), 6) AS {c}" for c in CATEGORIES) + f""",
  CAST(SUM(CASE WHEN b.category IN ({', '.join(f"'{c}'" for c in CATEGORIES)}) THEN 0 ELSE 1 END) AS BIGINT) AS n_unlisted
FROM interactions i JOIN books b ON i.book_id = b.book_id GROUP BY 1""")
def a13_pivot(spark, d):
    out = A.pivot_mean(rated_books(spark, d), "user_id", "category", "rating", CATEGORIES)
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in CATEGORIES], "n_unlisted")


@query("a14_norms", f"""WITH {INTER_SQL}
SELECT user_id, CAST(SUM(rating) AS BIGINT) AS rating_sum, CAST(SUM(rating * rating) AS BIGINT) AS norm2
FROM interactions GROUP BY 1""")
def a14_norms(spark, d):
    return A.rating_sums(V.interactions(spark, d, keep=False), "user_id")


@query("a16_audit", f"""WITH {DIRTY_RATINGS_SQL},
c AS (SELECT * FROM (SELECT {td('book_id')} AS b, {td('user_id')} AS u, {td('rating')} AS r FROM dirty_ratings) t
      WHERE b IS NOT NULL AND u IS NOT NULL AND r IS NOT NULL AND r BETWEEN 1 AND 5)
SELECT 'clean_ratings' AS stage, (SELECT CAST(COUNT(*) AS BIGINT) FROM dirty_ratings) AS rows_in,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM c) AS rows_out,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM dirty_ratings) - (SELECT CAST(COUNT(*) AS BIGINT) FROM c) AS rows_removed""")
def a16_audit(spark, d):
    raw = V.dirty_ratings(spark, d)
    return A.audit(raw, C.clean_ratings(raw), "clean_ratings")


@query("a18_distribution", f"""WITH {INTER_SQL}
SELECT rating, CAST(COUNT(*) AS BIGINT) AS count FROM interactions GROUP BY 1 ORDER BY 1""")
def a18_distribution(spark, d):
    return A.distribution(V.interactions(spark, d, keep=False), "rating")
