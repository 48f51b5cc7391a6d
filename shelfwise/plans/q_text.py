"""Queries for text and hand-made features."""
from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import features as FT
from shelfwise.operators import recommend as R
from shelfwise.operators import text as TX
from shelfwise.operators.nearest import nearest
from shelfwise.plans import views as V
from shelfwise.plans.registry import BOOKS_SQL, INTER_SQL, query

STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in TX.STOP_WORDS)
PAT = r"[\p{L}\p{N}_]{2,}"
MIN_DF, MAX_DF = 5, 0.8


def docs(spark, d):
    return V.table(spark, d, "documents").select("doc_id", "text")


def book_docs(spark, d):
    b = V.books(spark, d).withColumn("original_title", F.col("title"))
    return TX.concat_text(b, ("title", "authors", "original_title"))


def tfidf_sql(src: str, id_col: str) -> str:
    return f"""toks AS (SELECT {id_col}, unnest(regexp_extract_all(lower(text), '{PAT}')) AS term FROM {src}),
tf AS (SELECT {id_col}, term, COUNT(*) AS tf FROM toks WHERE term NOT IN ({STOP_SQL}) GROUP BY 1, 2),
nd AS (SELECT COUNT(*) AS n FROM {src}),
dfc AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1),
voc AS (SELECT term, CAST(df AS BIGINT) AS df, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS index
        FROM dfc WHERE df >= {MIN_DF} AND df <= {MAX_DF} * (SELECT n FROM nd)),
w AS (SELECT tf.{id_col}, tf.term, tf.tf * (ln((1 + (SELECT n FROM nd)) / (1 + voc.df)) + 1) AS w
      FROM tf JOIN voc ON tf.term = voc.term),
nrm AS (SELECT {id_col}, sqrt(SUM(w * w)) AS norm FROM w GROUP BY 1),
tfidf AS (SELECT w.{id_col}, w.term, w.w / CASE WHEN nrm.norm = 0 THEN 1 ELSE nrm.norm END AS weight
          FROM w JOIN nrm ON w.{id_col} = nrm.{id_col})"""


BOOK_TEXT_SQL = f"""{BOOKS_SQL},
bt AS (SELECT book_id, concat_ws(' ', coalesce(title, ''), coalesce(authors, ''), coalesce(title, '')) AS text
       FROM books)"""


@query("t01_t02_tokens", f"""WITH {BOOK_TEXT_SQL}
SELECT book_id, text, array_to_string(regexp_extract_all(lower(text), '{PAT}'), ' ') AS tokens FROM bt""")
def t01_t02_tokens(spark, d):
    from shelfwise.functions.exprs import tokens
    b = book_docs(spark, d)
    return b.select("book_id", "text", F.array_join(tokens("text"), " ").alias("tokens"))


@query("t03_stopwords", f"""WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{PAT}')) AS term
FROM documents)
SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n_tokens FROM toks WHERE term NOT IN ({STOP_SQL}) GROUP BY 1""")
def t03_stopwords(spark, d):
    return TX.doc_tokens(docs(spark, d), "doc_id", "text").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"))


@query("t04_vocab", f"""WITH {tfidf_sql('documents', 'doc_id')}
SELECT term, df, index FROM voc""")
def t04_vocab(spark, d):
    _, vocab = TX.tfidf(docs(spark, d), "doc_id", "text", MIN_DF, MAX_DF)
    return vocab.select("term", "df", "index")


@query("t05_tfidf", f"""WITH {tfidf_sql('documents', 'doc_id')}
SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf""")
def t05_tfidf(spark, d):
    w, _ = TX.tfidf(docs(spark, d), "doc_id", "text", MIN_DF, MAX_DF)
    return w.withColumn("weight", F.round("weight", 6))


@query("t06_book_tfidf", f"""WITH {BOOK_TEXT_SQL}, {tfidf_sql('bt', 'book_id')}
SELECT book_id, term, round(weight, 6) AS weight FROM tfidf""")
def t06_book_tfidf(spark, d):
    w, _ = TX.tfidf(book_docs(spark, d), "book_id", "text", MIN_DF, MAX_DF)
    return w.withColumn("weight", F.round("weight", 6))


@query("w05_top_tokens", f"""WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{PAT}')) AS term
FROM documents)
SELECT term, CAST(COUNT(*) AS BIGINT) AS count FROM toks WHERE term NOT IN ({STOP_SQL})
GROUP BY 1 ORDER BY count DESC, term LIMIT 100""")
def w05_top_tokens(spark, d):
    return TX.top_tokens(docs(spark, d), "doc_id", "text", 100)


@query("r02_content_similarity", f"""WITH {BOOK_TEXT_SQL}, {tfidf_sql('bt', 'book_id')},
units AS (SELECT book_id, term, CAST(round(weight * 10000) AS BIGINT) AS w FROM tfidf),
pairs AS (SELECT a.book_id, b.book_id AS other_id, CAST(SUM(a.w * b.w) AS BIGINT) AS dot
          FROM units a JOIN units b ON a.term = b.term AND a.book_id <> b.book_id GROUP BY 1, 2)
SELECT book_id, other_id, dot / 100000000.0 AS sim, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY book_id ORDER BY dot DESC, other_id) AS INTEGER) AS rank
  FROM pairs) t WHERE rank <= 10""")
def r02_content_similarity(spark, d):
    w, _ = TX.tfidf(book_docs(spark, d), "book_id", "text", MIN_DF, MAX_DF)
    # weights in ten-thousandths: sums are exact in any order and, for unit vectors, at most about 1e8
    units = w.withColumn("w", F.round(F.col("weight") * 10_000).cast("long"))
    top = nearest(units, 10, "book_id", "term", "w", "other_id", cosine=False)
    return top.select("book_id", "other_id", (F.col("dot") / F.lit(100_000_000.0)).alias("sim"), "rank")


AUTH_SQL = f"""{BOOKS_SQL},
ba AS (SELECT book_id, coalesce(authors, 'Unknown') AS a FROM books),
tk AS (SELECT unnest(regexp_split_to_array(trim(a), '\\s+')) AS token FROM ba),
top AS (SELECT token FROM tk WHERE token <> '' GROUP BY 1 ORDER BY COUNT(*) DESC, token LIMIT 100),
af AS (SELECT ba.book_id, 'author_' || top.token AS feature, 1.0 AS value FROM ba JOIN top ON contains(ba.a, top.token)),
cat AS (SELECT book_id, coalesce(category, 'unknown') AS c FROM books),
ctop AS (SELECT c FROM cat GROUP BY 1 ORDER BY COUNT(*) DESC, c LIMIT 20),
cf AS (SELECT cat.book_id, 'category_' || cat.c AS feature, 1.0 AS value FROM cat JOIN ctop ON cat.c = ctop.c),
mm AS (SELECT book_id, 'size' AS feature, coalesce(CASE WHEN (SELECT max(size) FROM books) > (SELECT min(size) FROM books)
         THEN (size - (SELECT min(size) FROM books)) / ((SELECT max(size) FROM books) - (SELECT min(size) FROM books))
         ELSE 0.0 END, 0.0) AS value FROM books
       UNION ALL
       SELECT book_id, 'price', coalesce(CASE WHEN (SELECT max(price) FROM books) > (SELECT min(price) FROM books)
         THEN (price - (SELECT min(price) FROM books)) / ((SELECT max(price) FROM books) - (SELECT min(price) FROM books))
         ELSE 0.0 END, 0.0) FROM books),
feats AS (SELECT * FROM af UNION ALL SELECT * FROM cf UNION ALL SELECT * FROM mm)"""


@query("t07_author_flags", f"""WITH {AUTH_SQL} SELECT * FROM af""")
def t07_author_flags(spark, d):
    return FT.author_flags(V.books(spark, d))


@query("t08_onehot", f"""WITH {AUTH_SQL} SELECT * FROM cf""")
def t08_onehot(spark, d):
    return FT.category_onehot(V.books(spark, d))


@query("t09_minmax", f"""WITH {AUTH_SQL} SELECT book_id, feature, round(value, 6) AS value FROM mm""")
def t09_minmax(spark, d):
    return FT.minmax(V.books(spark, d), ["size", "price"]).withColumn("value", F.round("value", 6))


def book_features(spark, d):
    b = V.books(spark, d)
    return FT.assemble(b, [FT.author_flags(b), FT.category_onehot(b), FT.minmax(b, ["size", "price"])])


@query("t10_features", f"""WITH {AUTH_SQL} SELECT book_id, feature, round(value, 6) AS value FROM feats""")
def t10_features(spark, d):
    return book_features(spark, d).withColumn("value", F.round("value", 6))


HIST_IN_SQL = """h AS (SELECT p_partkey AS book_id, 1 + (p_retailprice % 400) / 100 AS average_rating,
                     CAST(p_size * 37 AS BIGINT) AS ratings_count FROM part)"""


def _shares_sql(i: int) -> str:
    cases = " ".join(f"WHEN average_rating >= {lo} THEN {sh[i]}" for lo, sh in FT.RATING_BANDS)
    return f"CAST(floor(ratings_count * CASE {cases} ELSE {FT.RATING_BAND_LOWEST[i]} END) AS BIGINT)"


@query("t11_histogram", f"""WITH {HIST_IN_SQL}
SELECT book_id, round(average_rating, 6) AS average_rating, ratings_count,
  {_shares_sql(0)} AS ratings_1, {_shares_sql(1)} AS ratings_2, {_shares_sql(2)} AS ratings_3,
  {_shares_sql(3)} AS ratings_4,
  {_shares_sql(4)} + greatest(ratings_count - {_shares_sql(0)} - {_shares_sql(1)} - {_shares_sql(2)}
     - {_shares_sql(3)} - {_shares_sql(4)}, 0) AS ratings_5 FROM h""")
def t11_histogram(spark, d):
    p = V.table(spark, d, "part").select(
        F.col("p_partkey").alias("book_id"), (1 + (F.col("p_retailprice") % 400) / 100).alias("average_rating"),
        (F.col("p_size") * 37).cast("long").alias("ratings_count"))
    return FT.rating_histogram(p).withColumn("average_rating", F.round("average_rating", 6))


@query("t12_templates", """SELECT p_partkey AS book_id,
  'https://example.com/bookcovers/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
  'https://example.com/bookcovers/small/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS small_image_url,
  'This is a fictional description for the book ''' || p_name || ''' by ' || p_brand || '.' AS description,
  CAST(floor(p_size * 37 * 0.1) AS BIGINT) AS work_text_reviews_count FROM part""")
def t12_templates(spark, d):
    b = V.books(spark, d).withColumn("ratings_count", F.col("size") * 37)
    return FT.templated_fields(b)


@query("t13_split", """SELECT p_partkey AS book_id, CAST(g.pos - 1 AS INTEGER) AS pos, g.value
FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS value,
                           generate_subscripts(string_split(p_name, ' '), 1) AS pos) g""")
def t13_split(spark, d):
    return TX.split_list(V.books(spark, d), "book_id", "title", " ")


@query("r12_user_profile", f"""WITH {INTER_SQL}, {AUTH_SQL},
tot AS (SELECT user_id, SUM(rating) AS rsum FROM interactions GROUP BY 1),
num AS (SELECT i.user_id, f.feature, SUM(i.rating * f.value) AS num FROM interactions i
        JOIN feats f ON i.book_id = f.book_id GROUP BY 1, 2)
SELECT num.user_id, num.feature, round(CASE WHEN tot.rsum = 0 THEN 0.0 ELSE num.num / tot.rsum END, 6) AS weight
FROM num JOIN tot ON num.user_id = tot.user_id""")
def r12_user_profile(spark, d):
    prof = R.user_profiles(V.interactions(spark, d), book_features(spark, d))
    return prof.withColumn("weight", F.round("weight", 6))


@query("a15_k06_feature_summary", f"""WITH {INTER_SQL}, {BOOK_TEXT_SQL}, {tfidf_sql('bt', 'book_id')}
SELECT (SELECT CAST(COUNT(DISTINCT user_id) AS BIGINT) FROM interactions) AS num_users,
       (SELECT CAST(COUNT(DISTINCT book_id) AS BIGINT) FROM interactions) AS num_books,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM voc) AS num_features,
       (SELECT CAST(COUNT(DISTINCT book_id) AS BIGINT) FROM tfidf) AS num_documents,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM interactions) AS nnz,
       round((SELECT COUNT(*) FROM interactions) / ((SELECT COUNT(DISTINCT user_id) FROM interactions)
             * (SELECT COUNT(DISTINCT book_id) FROM interactions)), 9) AS density,
       CAST({MIN_DF} AS BIGINT) AS min_df, CAST({MAX_DF} AS DOUBLE) AS max_df""")
def a15_k06_feature_summary(spark, d):
    from shelfwise.sources.sinks import write_table
    w, vocab = TX.tfidf(book_docs(spark, d), "book_id", "text", MIN_DF, MAX_DF)
    summ = FT.feature_summary(V.interactions(spark, d), w, vocab, MIN_DF, MAX_DF)
    return write_table(summ, "features_summary", spark)
