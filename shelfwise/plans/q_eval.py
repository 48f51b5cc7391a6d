"""Queries for encoding, split, sampling, recommenders, evaluation and serving."""
from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.exprs import dense_cosine
from shelfwise.operators import encode as W
from shelfwise.operators import evaluate as E
from shelfwise.operators import factorize as FA
from shelfwise.operators import joins as J
from shelfwise.operators import recommend as R
from shelfwise.operators import serve as SV
from shelfwise.operators import similarity as S
from shelfwise.operators.ranking import sample_keys, top_k_per_group
from shelfwise.plans import views as V
from shelfwise.plans.q_text import AUTH_SQL
from shelfwise.plans.registry import (BOOKS_SQL, INTER_SQL, IR_SQL, SPLIT_SQL, VALID_SQL, cosine_sql, query, recs_sql,
                                      topk_sql)
from shelfwise.sources.sinks import write_table

SEED = 42
SAMPLE_USERS = 50
KS = [5, 10]
SCORE_K = 19
SERVE_K = 20


# ---- encoding / split / sampling -----------------------------------------------------------------
@query("w01_label_encode", f"""WITH {INTER_SQL}
SELECT book_id, CAST(row_number() OVER (ORDER BY book_id) - 1 AS BIGINT) AS book_id_encoded
FROM (SELECT DISTINCT book_id FROM interactions) t""")
def w01_label_encode(spark, d):
    return W.label_encode(V.interactions(spark, d), "book_id")


@query("j07_encode", f"""WITH {INTER_SQL},
m AS (SELECT book_id, row_number() OVER (ORDER BY book_id) - 1 AS code FROM (SELECT DISTINCT book_id FROM interactions) t)
SELECT i.user_id, CAST(coalesce(m.code, i.book_id) AS BIGINT) AS book_id, i.rating
FROM interactions i LEFT JOIN m ON i.book_id = m.book_id""")
def j07_encode(spark, d):
    inter = V.interactions(spark, d)
    return J.encode_ids(inter, W.label_encode(inter, "book_id"), "book_id", "book_id_encoded")


@query("j08_decode", f"""WITH {INTER_SQL}
SELECT user_id, book_id, rating FROM interactions""")
def j08_decode(spark, d):
    inter = V.interactions(spark, d)
    m = W.label_encode(inter, "book_id")
    enc = J.encode_ids(inter, m, "book_id", "book_id_encoded")
    return J.decode_ids(enc, m, "book_id", "book_id_encoded").select("user_id", "book_id", "rating")


@query("w08_split", f"""WITH {SPLIT_SQL}
SELECT user_id, book_id, rating, split FROM sp""")
def w08_split(spark, d):
    return V.split_interactions(spark, d, SEED)


@query("w09_sample", f"""WITH {SPLIT_SQL}
SELECT user_id FROM (SELECT DISTINCT user_id FROM test) t
ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR))), user_id LIMIT {SAMPLE_USERS}""")
def w09_sample(spark, d):
    test = V.split_interactions(spark, d, SEED).filter(F.col("split") == "test")
    return sample_keys(test, "user_id", SAMPLE_USERS, SEED)


# ---- recommenders --------------------------------------------------------------------------------
@query("r01_user_item", f"""WITH {IR_SQL}
SELECT user_id, book_id, CAST(SUM(rating) AS BIGINT) AS rating FROM ir GROUP BY 1, 2""")
def r01_user_item(spark, d):
    return R.user_item_entries(V.interactions_raw(spark, d))


@query("r04_similar_books", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 5, 'nb')}
SELECT book_id, other_id, nano, rank FROM nb""")
def r04_similar_books(spark, d):
    return S.item_neighbors(V.written_interactions(spark, d), k=5).select("book_id", "other_id", "nano", "rank")


@query("r06_popularity_fallback", """WITH imp AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS book_id, COUNT(*) AS rating
  FROM events GROUP BY 1, 2),
pop AS (SELECT book_id, CAST(SUM(rating) AS BIGINT) AS popularity FROM imp GROUP BY 1
        ORDER BY popularity DESC, book_id LIMIT 5),
ranked AS (SELECT book_id, popularity, CAST(row_number() OVER (ORDER BY popularity DESC, book_id) AS INTEGER) AS rank
           FROM pop),
cold AS (SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM imp))
SELECT cold.user_id, ranked.book_id, ranked.popularity, ranked.rank FROM cold, ranked""")
def r06_popularity_fallback(spark, d):
    users = V.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return R.popularity_fallback(users, V.implicit_interactions(spark, d), 5)


@query("r07_vector_cosine", """WITH e AS (SELECT vec_id, embedding FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS other_id, a.embedding AS x, b.embedding AS y
      FROM e a JOIN e b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, other_id, round(CASE WHEN sqrt(list_sum(list_transform(x, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) = 0
  OR sqrt(list_sum(list_transform(y, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) = 0 THEN 0.0
  ELSE list_sum(list_transform(list_zip(x, y), lambda t: CAST(t[1] AS DOUBLE) * CAST(t[2] AS DOUBLE)))
     / (sqrt(list_sum(list_transform(x, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))))
        * sqrt(list_sum(list_transform(y, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))))) END, 6) AS cosine
FROM p""")
def r07_vector_cosine(spark, d):
    e = V.table(spark, d, "embeddings").select("vec_id", "embedding")
    a = e.select("vec_id", F.col("embedding").alias("x"))
    b = e.select(F.col("vec_id").alias("other_id"), F.col("embedding").alias("y"))
    p = a.join(b, F.col("other_id") == F.col("vec_id") + 1)
    return p.select("vec_id", "other_id", F.round(dense_cosine("x", "y"), 6).alias("cosine"))


@query("r08_user_neighbors", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'book_id', 'user_id', 'user_id', 'other_user_id')},
{topk_sql('sims', 'user_id', 'nano DESC, other_user_id', 10, 'nb')}
SELECT user_id, other_user_id, dot, nano, rank FROM nb""")
def r08_user_neighbors(spark, d):
    return S.user_neighbors(V.written_interactions(spark, d), k=10).select("user_id", "other_user_id", "dot", "nano", "rank")


TITLE_SQL = f"""{INTER_SQL}, {BOOKS_SQL},
tr AS (SELECT i.user_id, b.title, CAST(floor(AVG(i.rating) * 1000000) AS BIGINT) AS rating
       FROM interactions i JOIN books b ON i.book_id = b.book_id GROUP BY 1, 2)"""


def title_ratings(spark, d):
    """Ratings keyed by title (Q15): mean per (user, title) on collisions, as exact micro-units."""
    rb = V.interactions(spark, d).join(V.books(spark, d).select("book_id", "title"), "book_id")
    return rb.groupBy("user_id", "title").agg(F.floor(F.avg("rating") * 1_000_000).cast("long").alias("rating"))


@query("r09_title_similarity", f"""WITH {TITLE_SQL},
{cosine_sql('tr', 'user_id', 'title', 'title', 'other_title')}
SELECT title, other_title, round(sim, 9) AS sim, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY title ORDER BY nano DESC, other_title) AS INTEGER) AS rank
  FROM sims) t WHERE rank <= 10""")
def r09_title_similarity(spark, d):
    sims = S.cosine_pairs(title_ratings(spark, d), "user_id", "title", "rating", "title", "other_title", wide=True)
    top = top_k_per_group(sims, ["title"], [F.col("nano").desc(), F.col("other_title")], 10)
    return top.select("title", "other_title", F.round("sim", 9).alias("sim"), "rank")


@query("r10_predict_user", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'book_id', 'user_id', 'user_id', 'other_user_id')},
{topk_sql('sims', 'user_id', 'nano DESC, other_user_id', 3, 'nb')},
den AS (SELECT user_id, SUM(abs(sim)) AS den FROM nb GROUP BY 1),
num AS (SELECT n.user_id, r.book_id, SUM(n.sim * r.rating) AS num FROM nb n
        JOIN interactions r ON r.user_id = n.other_user_id
        WHERE NOT EXISTS (SELECT 1 FROM interactions x WHERE x.user_id = n.user_id AND x.book_id = r.book_id)
        GROUP BY 1, 2),
pred AS (SELECT num.user_id, num.book_id, round(num.num / den.den, 6) AS pred FROM num JOIN den USING (user_id)
         WHERE den.den <> 0)
SELECT user_id, book_id, pred, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, book_id) AS INTEGER) AS rank
  FROM pred WHERE pred > 0) t WHERE rank <= 10""")
def r10_predict_user(spark, d):
    inter = V.written_interactions(spark, d)
    return R.predict_user_based(inter, S.user_neighbors(inter, k=3), n=10).select("user_id", "book_id", "pred", "rank")


@query("r11_predict_item", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 3, 'nb')},
den AS (SELECT book_id, SUM(abs(sim)) AS den FROM nb GROUP BY 1),
num AS (SELECT r.user_id, n.book_id, SUM(n.sim * r.rating) AS num FROM nb n
        JOIN interactions r ON r.book_id = n.other_id
        WHERE NOT EXISTS (SELECT 1 FROM interactions x WHERE x.user_id = r.user_id AND x.book_id = n.book_id)
        GROUP BY 1, 2),
pred AS (SELECT num.user_id, num.book_id, round(num.num / den.den, 6) AS pred FROM num JOIN den USING (book_id)
         WHERE den.den <> 0)
SELECT user_id, book_id, pred, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, book_id) AS INTEGER) AS rank
  FROM pred WHERE pred > 0) t WHERE rank <= 10""")
def r11_predict_item(spark, d):
    inter = V.written_interactions(spark, d)
    return R.predict_item_based(inter, S.item_neighbors(inter, k=3), n=10).select("user_id", "book_id", "pred", "rank")


@query("r13_recs_with_metadata", f"""WITH {INTER_SQL}, {BOOKS_SQL},
{recs_sql('interactions', SCORE_K, 5, 'recs')}
SELECT r.user_id, r.book_id, b.title, b.authors, r.rank - 1 AS rank FROM recs r JOIN books b ON r.book_id = b.book_id""")
def r13_recs_with_metadata(spark, d):
    inter = V.written_interactions(spark, d)
    top = R.recommend_for_users(inter, S.item_neighbors(inter, k=SCORE_K), n=5, zero_based_rank=True)
    return R.attach_metadata(top, V.books(spark, d)).select("user_id", "book_id", "title", "authors", "rank")


@query("r14_similar_with_metadata", f"""WITH {INTER_SQL}, {BOOKS_SQL},
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 5, 'nb')}
SELECT n.book_id, n.other_id, b.title, b.authors, n.rank - 1 AS rank FROM nb n JOIN books b ON n.other_id = b.book_id""")
def r14_similar_with_metadata(spark, d):
    nb = S.item_neighbors(V.written_interactions(spark, d), k=5).withColumn("rank", (F.col("rank") - 1).cast("int"))
    meta = V.books(spark, d).select(F.col("book_id").alias("other_id"), "title", "authors")
    return nb.join(meta, "other_id").select("book_id", "other_id", "title", "authors", "rank")


def _answers(spark, d):
    """(validated requests, their items); only the requested users and books are scored."""
    valid = SV.validate_requests(V.requests(spark, d))
    ok = valid.filter(F.col("status") == 200)
    asked = lambda kind, name: ok.filter(F.col("kind") == kind).select(F.col("target_id").alias(name))
    inter, books = V.written_interactions(spark, d), V.books(spark, d)
    # the neighbour table is written once (K10) and serves both: scoring uses its first SCORE_K ranks
    nb = write_table(S.item_neighbors(inter, k=SERVE_K), "item_neighbors", spark)
    recs = R.recommend_for_users(inter.join(asked("user", "user_id"), "user_id", "left_semi"),
                                 nb.filter(F.col("rank") <= SCORE_K), n=SERVE_K)
    similar = nb.join(asked("book", "book_id"), "book_id", "left_semi").join(
        books.select(F.col("book_id").alias("other_id"), "title", "authors"), "other_id")
    return valid, SV.answer(valid, R.attach_metadata(recs, books), similar)


SERVE_SQL = f"""{INTER_SQL}, {BOOKS_SQL}, {VALID_SQL},
{recs_sql('interactions', SCORE_K, SERVE_K, 'recs')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', SERVE_K, 'simb')},
items AS (
  SELECT v.request_id, v.kind, v.target_id, r.book_id, b.title, b.authors, r.rank
  FROM valid v JOIN recs r ON v.kind = 'user' AND v.status = 200 AND r.user_id = v.target_id AND r.rank <= v.count
  JOIN books b ON b.book_id = r.book_id
  UNION ALL
  SELECT v.request_id, v.kind, v.target_id, s.other_id, b.title, b.authors, s.rank
  FROM valid v JOIN simb s ON v.kind = 'book' AND v.status = 200 AND s.book_id = v.target_id AND s.rank <= v.count
  JOIN books b ON b.book_id = s.other_id)"""


@query("p19_validate_requests", f"""WITH {VALID_SQL} SELECT * FROM valid""")
def p19_validate_requests(spark, d):
    return SV.validate_requests(V.requests(spark, d))


@query("r16_batch_serving", f"""WITH {SERVE_SQL}
SELECT request_id, kind, target_id, book_id, title, authors, rank FROM items""")
def r16_batch_serving(spark, d):
    return _answers(spark, d)[1]


@query("p20_response", f"""WITH {SERVE_SQL}
SELECT request_id, book_id, coalesce(title, 'Book ' || CAST(book_id AS VARCHAR)) AS title,
       coalesce(authors, 'Unknown Author') AS authors, rank FROM items""")
def p20_response(spark, d):
    return SV.project_response(_answers(spark, d)[1])


@query("p20_nested", f"""WITH {SERVE_SQL},
bodies AS (SELECT request_id, CAST(COUNT(*) AS INTEGER) AS n, CAST(to_json(list({{
    'rank': rank, 'book_id': book_id, 'title': coalesce(title, 'Book ' || CAST(book_id AS VARCHAR)),
    'authors': coalesce(authors, 'Unknown Author')}} ORDER BY rank)) AS VARCHAR) AS body FROM items GROUP BY 1)
SELECT v.request_id, v.kind, v.target_id,
       CAST(CASE WHEN v.status = 200 AND b.n IS NULL THEN 404 ELSE v.status END AS INTEGER) AS status,
       coalesce(b.n, 0) AS n_items, coalesce(b.body, '[]') AS body
FROM valid v LEFT JOIN bodies b USING (request_id)""")
def p20_nested(spark, d):
    valid, items = _answers(spark, d)
    named = SV.project_response(items)
    return SV.respond(valid, named, empty_status=404).withColumn("body", F.to_json("recommendations")).drop("recommendations")


# ---- evaluation ----------------------------------------------------------------------------------
def _eval_parts(spark, d):
    sp = V.split_interactions(spark, d, SEED)
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "test").drop("split")
    users = write_table(sample_keys(test, "user_id", SAMPLE_USERS, SEED), "sampled-users")
    own = write_table(train.join(users, "user_id", "left_semi"), "sampled-ratings")  # only these items' neighbours are scored
    recs = R.recommend_for_users(own, S.item_neighbors(train, k=SCORE_K, only=own), n=max(KS))
    # exclusions must use the full train rows of the sampled users: the semi-join keeps all of them
    return train, test, users, recs


EVAL_SQL = f"""{SPLIT_SQL},
su AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM test) t
       ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR))), user_id LIMIT {SAMPLE_USERS}),
{recs_sql('train', SCORE_K, max(KS), 'recs', users='su')},
ks AS (SELECT unnest([{', '.join(map(str, KS))}]) AS k),
hits AS (SELECT r.user_id, ks.k, COUNT(*) AS hits FROM recs r JOIN test t ON r.user_id = t.user_id
         AND r.book_id = t.book_id JOIN ks ON r.rank <= ks.k GROUP BY 1, 2),
nt AS (SELECT user_id, COUNT(*) AS n_test FROM test GROUP BY 1),
pu AS (SELECT su.user_id, ks.k, coalesce(h.hits, 0) AS hits, nt.n_test FROM su CROSS JOIN ks
       LEFT JOIN hits h ON h.user_id = su.user_id AND h.k = ks.k LEFT JOIN nt ON nt.user_id = su.user_id),
pr AS (SELECT k, avg(hits / k) AS precision,
              avg(CASE WHEN n_test > 0 THEN hits / n_test ELSE 0 END) AS recall, COUNT(*) AS n_users
       FROM pu GROUP BY k)"""


@query("e01_precision_recall", f"""WITH {EVAL_SQL}
SELECT k, round(precision, 6) AS precision, round(recall, 6) AS recall, CAST(n_users AS BIGINT) AS n_users FROM pr""")
def e01_precision_recall(spark, d):
    train, test, users, recs = _eval_parts(spark, d)
    pr = E.precision_recall(recs, test, users, KS)
    return pr.select("k", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"),
                     "n_users")


@query("e02_train_eval", f"""WITH {EVAL_SQL}
SELECT 'item_knn' AS model,
  round(max(CASE WHEN k = 5 THEN precision END), 6) AS precision_at_5,
  round(max(CASE WHEN k = 5 THEN recall END), 6) AS recall_at_5,
  round(max(CASE WHEN k = 10 THEN precision END), 6) AS precision_at_10,
  round(max(CASE WHEN k = 10 THEN recall END), 6) AS recall_at_10 FROM pr""")
def e02_train_eval(spark, d):
    from shelfwise.sources.sinks import evaluation_table
    train, test, users, recs = _eval_parts(spark, d)
    pr = E.precision_recall(recs, test, users, KS)
    wide = evaluation_table(pr, "item_knn", KS)
    return write_table(wide, "evaluation_results", spark)


OVERLAP_SQL = f"""{INTER_SQL},
su AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM interactions) t
       ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR))), user_id LIMIT 5),
{recs_sql('interactions', SCORE_K, 5, 'recs', users='su')},
pairs AS (SELECT a.user_id AS ua, b.user_id AS ub FROM su a JOIN su b ON a.user_id < b.user_id),
cnt AS (SELECT user_id, COUNT(*) AS n FROM recs GROUP BY 1),
inter AS (SELECT p.ua, p.ub, COUNT(*) AS n_common FROM pairs p JOIN recs ra ON ra.user_id = p.ua
          JOIN recs rb ON rb.user_id = p.ub AND ra.book_id = rb.book_id GROUP BY 1, 2),
jac AS (SELECT p.ua, p.ub, CAST(coalesce(i.n_common, 0) AS INTEGER) AS n_common,
          CASE WHEN coalesce(ca.n, 0) = 0 OR coalesce(cb.n, 0) = 0 THEN NULL
               ELSE coalesce(i.n_common, 0) / (ca.n + cb.n - coalesce(i.n_common, 0)) END AS jaccard
        FROM pairs p LEFT JOIN inter i ON i.ua = p.ua AND i.ub = p.ub
        LEFT JOIN cnt ca ON ca.user_id = p.ua LEFT JOIN cnt cb ON cb.user_id = p.ub)"""


def _overlap(spark, d):
    inter = V.interactions(spark, d)
    # sample, ratings and lists of five users are read many times
    users = write_table(sample_keys(inter, "user_id", 5, SEED), "sampled-users")
    own = write_table(inter.join(users, "user_id", "left_semi"), "sampled-ratings")
    recs = write_table(R.recommend_for_users(own, S.item_neighbors(inter, k=SCORE_K, only=own), n=5), "sampled-recommendations")
    return E.list_overlap(recs, users, n=5), recs, users


@query("e03_overlap", f"""WITH {OVERLAP_SQL}
SELECT ua AS user_id_a, ub AS user_id_b, n_common, round(jaccard, 6) AS jaccard FROM jac""")
def e03_overlap(spark, d):
    ov, _, _ = _overlap(spark, d)
    return ov.withColumn("jaccard", F.round("jaccard", 6))


SIM_SAMPLE_SQL = f"""{INTER_SQL},
sb AS (SELECT book_id FROM (SELECT DISTINCT book_id FROM interactions) t
       ORDER BY md5(concat_ws('|', '42', CAST(book_id AS VARCHAR))), book_id LIMIT 5),
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id', 'bs')},
{topk_sql('bs', 'book_id', 'nano DESC, other_id', 5, 'bnb')},
bc AS (SELECT sb.book_id, CAST(COUNT(bnb.other_id) AS BIGINT) AS n_items FROM sb
       LEFT JOIN bnb ON bnb.book_id = sb.book_id GROUP BY 1)"""


def _similar_counts(spark, d):
    inter = V.interactions(spark, d)
    books = write_table(sample_keys(inter, "book_id", 5, SEED), "sampled-books")
    return E.counts_per_key(books, S.item_neighbors(inter, k=5, only=books), "book_id")


@query("e04_similar_counts", f"""WITH {SIM_SAMPLE_SQL} SELECT book_id, n_items FROM bc""")
def e04_similar_counts(spark, d):
    return _similar_counts(spark, d)


@query("e05_cold_start", f"""WITH {INTER_SQL},
{recs_sql('interactions', SCORE_K, 5, 'recs')}
SELECT (SELECT max(user_id) FROM interactions) + 100 AS user_id,
       CAST((SELECT COUNT(*) FROM recs WHERE user_id = (SELECT max(user_id) FROM interactions) + 100) AS BIGINT)
       AS n_items""")
def e05_cold_start(spark, d):
    inter = V.interactions(spark, d)
    probe = spark.range(1).select((inter.select(F.max("user_id")).scalar() + 100).alias("user_id"))
    own = write_table(inter.join(probe, "user_id", "left_semi"), "probed-ratings")
    recs = R.recommend_for_users(own, S.item_neighbors(inter, k=SCORE_K, only=own), n=5)
    return E.counts_per_key(probe, recs, "user_id")


@query("e06_summary", f"""WITH {OVERLAP_SQL},
sb AS (SELECT book_id FROM (SELECT DISTINCT book_id FROM interactions) t
       ORDER BY md5(concat_ws('|', '42', CAST(book_id AS VARCHAR))), book_id LIMIT 5),
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 5, 'bnb')},
bc AS (SELECT sb.book_id, COUNT(bnb.other_id) AS n_items FROM sb LEFT JOIN bnb ON bnb.book_id = sb.book_id GROUP BY 1)
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM su) AS n_users,
       round((SELECT avg(coalesce(c.n, 0)) FROM su LEFT JOIN cnt c ON c.user_id = su.user_id), 6) AS avg_items_per_user,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM pairs) AS n_pairs,
       round((SELECT avg(jaccard) FROM jac), 6) AS mean_jaccard,
       round((SELECT avg(n_items) FROM bc), 6) AS avg_similar_book_count,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM recs WHERE user_id = (SELECT max(user_id) FROM interactions) + 100)
         AS cold_start_count""")
def e06_summary(spark, d):
    inter = V.written_interactions(spark, d)
    users = sample_keys(inter, "user_id", 5, SEED)
    cold = spark.range(1).select((inter.select(F.max("user_id")).scalar() + 100).alias("user_id"))
    # neighbours and the sampled lists are written once; all figures read those
    nb = write_table(S.item_neighbors(inter, k=SCORE_K), "item_neighbors", spark)
    asked = inter.join(users.unionByName(cold), "user_id", "left_semi")
    recs = write_table(R.recommend_for_users(asked, nb, n=5), "sampled_recommendations", spark)
    ov = E.list_overlap(recs, users, n=5)
    per_user = E.counts_per_key(users, recs, "user_id")
    per_book = E.counts_per_key(sample_keys(inter, "book_id", 5, SEED), nb.filter(F.col("rank") <= 5), "book_id")
    return spark.range(1).select(
        per_book.select(F.round(F.avg("n_items"), 6)).scalar().alias("avg_similar_book_count"),
        E.counts_per_key(cold, recs, "user_id").select(F.sum("n_items")).scalar().alias("cold_start_count"),
        users.select(F.count(F.lit(1))).scalar().alias("n_users"),
        per_user.select(F.round(F.avg("n_items"), 6)).scalar().alias("avg_items_per_user"),
        ov.select(F.count(F.lit(1))).scalar().alias("n_pairs"),
        ov.select(F.round(F.avg("jaccard"), 6)).scalar().alias("mean_jaccard"))


@query("x03_coverage", f"""WITH {INTER_SQL},
{recs_sql('interactions', SCORE_K, 10, 'recs')}
SELECT (SELECT CAST(COUNT(DISTINCT book_id) AS BIGINT) FROM recs) AS n_recommended,
       (SELECT CAST(COUNT(DISTINCT p_partkey) AS BIGINT) FROM part) AS n_items,
       round((SELECT COUNT(DISTINCT book_id) FROM recs) / (SELECT COUNT(DISTINCT p_partkey) FROM part), 6) AS coverage""")
def x03_coverage(spark, d):
    inter = V.written_interactions(spark, d)
    recs = R.recommend_for_users(inter, S.item_neighbors(inter, k=SCORE_K), n=10)
    return E.coverage(recs, V.books(spark, d)).withColumn("coverage", F.round("coverage", 6))


# ---- content-based, hybrid and factor models ------------------------------------------------------
DENSE = ("price", "size")
LIST = 50  # items of each list that a hybrid mixes

CONTENT_SQL = f"""{INTER_SQL}, {AUTH_SQL},
fv AS (SELECT book_id, feature, CAST(floor(value * 10000 + 0.5) AS BIGINT) AS v FROM feats),
fn AS (SELECT book_id, sqrt(CAST(SUM(v * v) AS DOUBLE)) AS norm FROM fv GROUP BY 1 HAVING SUM(v * v) > 0),
fc AS (SELECT fv.book_id, fv.feature, CAST(floor(fv.v * CAST(10000 AS DOUBLE) / fn.norm + 0.5) AS BIGINT) AS c
       FROM fv JOIN fn ON fv.book_id = fn.book_id),
ut AS (SELECT user_id, CAST(SUM(rating) AS BIGINT) AS total FROM interactions GROUP BY 1),
uw AS (SELECT n.user_id, n.feature, n.num * 1000 // ut.total AS w FROM (
         SELECT i.user_id, f.feature, CAST(SUM(i.rating * f.v) AS BIGINT) AS num
         FROM interactions i JOIN fv f ON i.book_id = f.book_id GROUP BY 1, 2) n JOIN ut ON n.user_id = ut.user_id),
ul AS (SELECT user_id, sqrt(CAST(SUM(w * w) AS DOUBLE)) AS length FROM uw GROUP BY 1),
cs AS (SELECT uw.user_id, fc.book_id, CAST(SUM(uw.w * fc.c) AS BIGINT) AS score FROM uw JOIN fc ON uw.feature = fc.feature
       WHERE NOT EXISTS (SELECT 1 FROM interactions r WHERE r.user_id = uw.user_id AND r.book_id = fc.book_id) GROUP BY 1, 2)"""


def content_scores(spark, d, n, inter):
    from shelfwise.plans.q_text import book_features
    features = write_table(book_features(spark, d), "book_features", spark)  # read for profiles, norms and books
    return R.content_recommendations(inter, features, n, DENSE)


@query("x01_content_recs", f"""WITH {CONTENT_SQL}, {topk_sql('cs', 'user_id', 'score DESC, book_id', 10, 'best')}
SELECT best.user_id, best.book_id, best.score, round(best.score / (ul.length * 10000), 6) AS sim, best.rank
FROM best JOIN ul ON best.user_id = ul.user_id""")
def x01_content_recs(spark, d):
    return content_scores(spark, d, 10, V.written_interactions(spark, d))


@query("x02_hybrid", f"""WITH {CONTENT_SQL}, {topk_sql('cs', 'user_id', 'score DESC, book_id', LIST, 'content')},
ir2 AS (SELECT user_id, book_id, rating FROM interactions WHERE rating >= 4),
{recs_sql('ir2', SCORE_K, LIST, 'recs')},
l AS (SELECT user_id, book_id, score_nano * 1000000 // max(score_nano) OVER (PARTITION BY user_id) AS part FROM recs),
r AS (SELECT user_id, book_id, score * 1000000 // max(score) OVER (PARTITION BY user_id) AS part FROM content),
mixed AS (SELECT user_id, book_id, coalesce(l.part, 0) AS left_part, coalesce(r.part, 0) AS right_part,
                 coalesce(l.part, 0) + coalesce(r.part, 0) AS score FROM l FULL OUTER JOIN r USING (user_id, book_id)),
{topk_sql('mixed', 'user_id', 'score DESC, book_id', 10, 'best')}
SELECT user_id, book_id, left_part, right_part, score, rank FROM best""")
def x02_hybrid(spark, d):
    """Collaborative lists from liked books (4 and 5 stars), content lists from all ratings: each side knows users of its own."""
    inter = V.written_interactions(spark, d)
    liked = inter.filter(F.col("rating") >= 4)
    # each side is written before the other starts, so their shuffle files are never on the disk together
    collaborative = write_table(R.recommend_for_users(liked, S.item_neighbors(liked, k=SCORE_K), n=LIST).select(
        "user_id", "book_id", F.col("score_nano").alias("score")), "collaborative", spark)
    content = write_table(content_scores(spark, d, LIST, inter).select("user_id", "book_id", "score"), "content", spark)
    return R.hybrid(collaborative, content, 10)


@query("x04_als")
def x04_als(spark, d):
    """Rows only: the factors are floating point sums, whose order no other engine repeats."""
    inter = V.written_interactions(spark, d)
    users, items, _ = FA.als(inter)
    return FA.recommend(users, items, inter, 10)


@query("x04_als_loss")
def x04_als_loss(spark, d):
    """Rows only: the loss after each round."""
    return FA.als(V.written_interactions(spark, d))[2].withColumn("loss", F.round("loss", 3))
