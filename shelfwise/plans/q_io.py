"""Queries for sources and sinks (S01-S09, K01-K10): each writes under the shared folder and
returns what is read back."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import encode as W
from shelfwise.operators import evaluate as E
from shelfwise.operators import features as FT
from shelfwise.operators import recommend as R
from shelfwise.operators import similarity as S
from shelfwise.operators import text as TX
from shelfwise.operators.ranking import sample_keys
from shelfwise.operators.refit import NeighbourModel
from shelfwise.plans import views as V
from shelfwise.plans.q_text import MAX_DF, MIN_DF, book_docs, tfidf_sql, BOOK_TEXT_SQL
from shelfwise.plans.q_clean import CLEAN_BOOKS_SQL
from shelfwise.plans.registry import (BOOKS_SQL, DIRTY_BOOKS_SQL, INTER_SQL, SPLIT_SQL, cosine_sql, query,
                                      recs_sql, topk_sql)
from shelfwise.schemas import BOOKS, PAYLOAD, RATINGS
from shelfwise.session import scratch_path
from shelfwise.sources import readers as RD
from shelfwise.sources.sinks import write_bucketed, write_table

BOOK_DIM = T.StructType([
    T.StructField("book_id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("authors", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("size", T.IntegerType()), T.StructField("price", T.DoubleType()),
])


@query("s01_scan_books", f"""WITH {BOOKS_SQL} SELECT * FROM books""")
def s01_scan_books(spark, d):
    path = scratch_path(spark, "books_csv")
    V.books(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return RD.read_table(spark, path, BOOK_DIM, "csv")


def book_lines(spark, d):
    """CSV lines of the 25-column books table; every 37th is cut short and every 41st is no record at all."""
    b = V.table(spark, d, "part").select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("authors"), F.col("p_type").alias("genres"),
        (1 + (F.col("p_retailprice") % 400) / 100).alias("average_rating"), (F.col("p_size") * 37).cast("long").alias("ratings_count"))
    rows = FT.rating_histogram(b).join(FT.templated_fields(b), "book_id")
    k = F.col("book_id")
    rows = rows.select(
        *(k.alias(c) for c in ("id", "book_id", "best_book_id", "work_id")), F.lit(1).cast("long").alias("books_count"),
        F.lpad(k.cast("string"), 10, "0").alias("isbn"), F.concat(F.lit("978"), F.lpad(k.cast("string"), 10, "0")).alias("isbn13"), "authors",
        F.lit(None).cast("double").alias("original_publication_year"), F.col("title").alias("original_title"), "title",
        F.lit("eng").alias("language_code"), "average_rating", "ratings_count", F.col("ratings_count").alias("work_ratings_count"),
        "work_text_reviews_count", *(f"ratings_{i}" for i in range(1, 6)), "image_url", "small_image_url", "genres", "description")
    line = F.to_csv(F.struct(*BOOKS.fieldNames()))
    return rows.select(F.when(k % 37 == 0, F.concat_ws(",", k, k, F.lit("oops"))).when(
        k % 41 == 0, F.concat(F.lit("x"), k)).otherwise(line).alias("value"))


@query("s01_books_quarantine", """SELECT p_partkey AS book_id, '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isbn13, p_name AS title,
  p_brand AS authors, round(1 + (p_retailprice % 400) / 100, 6) AS average_rating, CAST(p_size * 37 AS BIGINT) AS ratings_count,
  'This is a fictional description for the book ''' || p_name || ''' by ' || p_brand || '.' AS description, NULL AS line
FROM part WHERE p_partkey % 37 <> 0 AND p_partkey % 41 <> 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN p_partkey % 37 = 0
  THEN p_partkey || ',' || p_partkey || ',oops' ELSE 'x' || p_partkey END FROM part WHERE p_partkey % 37 = 0 OR p_partkey % 41 = 0""")
def s01_books_quarantine(spark, d):
    """The 25-column scan; refused lines land in a quarantine table."""
    path = scratch_path(spark, "books_lines")
    book_lines(spark, d).write.text(path)
    good, bad = RD.read_lines(spark, path, BOOKS, header=False)
    good = good.select("book_id", "isbn13", "title", "authors", F.round("average_rating", 6).alias("average_rating"), "ratings_count", "description")
    return good.unionByName(bad.select("line"), allowMissingColumns=True)


@query("s02_scan_ratings", f"""WITH {INTER_SQL} SELECT book_id, user_id, rating FROM interactions""")
def s02_scan_ratings(spark, d):
    path = scratch_path(spark, "ratings_csv")
    V.interactions(spark, d).select("book_id", "user_id", "rating").write.option("header", True).csv(path)
    return RD.read_table(spark, path, RATINGS, "csv")


@query("s03_scan_split", f"""WITH {SPLIT_SQL} SELECT user_id, book_id, rating FROM train""")
def s03_scan_split(spark, d):
    t = write_table(V.split_interactions(spark, d), "processed", spark, partition_by=["split"])
    return t.filter(F.col("split") == "train").select("user_id", "book_id", "rating")


@query("s04_metadata_fallback", f"""WITH {SPLIT_SQL}, {BOOKS_SQL}
SELECT b.book_id, CASE WHEN b.book_id IN (SELECT book_id FROM train) THEN b.title ELSE upper(b.title) END AS title, b.authors
FROM books b WHERE b.book_id IN (SELECT book_id FROM test)""")
def s04_metadata_fallback(spark, d):
    sp = V.split_interactions(spark, d)
    train_ids = sp.filter(F.col("split") == "train").select("book_id").distinct()
    books = V.books(spark, d)
    primary = books.join(train_ids, "book_id", "left_semi").select(
        "book_id", F.col("title").alias("book_title"), F.col("authors").alias("author"))
    ids = sp.filter(F.col("split") == "test").select("book_id")
    return RD.metadata_with_fallback(primary, books.withColumn("title", F.upper("title")), ids, mode="per_key")


@query("s04_all_or_nothing", f"""WITH {SPLIT_SQL}, {BOOKS_SQL}
SELECT b.book_id, upper(b.title) AS title, b.authors FROM books b WHERE b.book_id IN (SELECT book_id FROM test)""")
def s04_all_or_nothing(spark, d):
    sp = V.split_interactions(spark, d)
    books = V.books(spark, d)
    ids = sp.filter(F.col("split") == "test").select("book_id")
    primary = books.select("book_id", "title").withColumnRenamed("title", "book_title")  # no authors column
    return RD.metadata_with_fallback(primary, books.withColumn("title", F.upper("title")), ids, mode="all_or_nothing")


@query("s05_scan_five", """SELECT 'books' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM part
UNION ALL SELECT 'ratings', COUNT(*) FROM lineitem
UNION ALL SELECT 'tags', COUNT(*) FROM supplier
UNION ALL SELECT 'book_tags', COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) t
UNION ALL SELECT 'to_read', COUNT(*) FROM events""")
def s05_scan_five(spark, d):
    tabs = {"books": V.table(spark, d, "part"), "ratings": V.table(spark, d, "lineitem"),
            "tags": V.table(spark, d, "supplier"), "book_tags": V.book_tags(spark, d),
            "to_read": V.table(spark, d, "events")}
    out = None
    for name, t in tabs.items():
        one = t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def payloads(spark, d):
    """API-like pages of 100 books; every 7th page (page % 7 == 3) is an error payload."""
    p = V.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                                         (F.col("p_partkey") / 100).cast("long").alias("page"))
    pages = p.groupBy("page").agg(F.collect_list(F.struct("id", "title")).alias("books"))
    ok = F.to_json(F.struct(F.struct(F.col("books").alias("books")).alias("data")))
    err = F.to_json(F.struct(F.array(F.struct(F.lit("rate limited").alias("message"))).alias("errors")))
    return pages.select("page", F.when(F.col("page") % 7 == 3, err).otherwise(ok).alias("payload"))


@query("s06_json_payloads", """SELECT p_partkey AS id, p_name AS title FROM part WHERE (p_partkey // 100) % 7 <> 3""")
def s06_json_payloads(spark, d):
    return RD.ingest_payloads(payloads(spark, d))


@query("s06_json_limit", """SELECT p_partkey AS id, p_name AS title FROM part WHERE (p_partkey // 100) % 7 <> 3
ORDER BY p_partkey LIMIT 1000""")
def s06_json_limit(spark, d):
    return RD.ingest_payloads(payloads(spark, d), limit=1000)


@query("s06_event_props", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def s06_event_props(spark, d):
    ev = V.table(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"))


@query("s07_load_features", f"""WITH {INTER_SQL}, {BOOKS_SQL}
SELECT i.user_id, i.book_id, i.rating, b.title FROM interactions i JOIN books b ON i.book_id = b.book_id""")
def s07_load_features(spark, d):
    base = scratch_path(spark, "features")
    V.interactions(spark, d).write.parquet(f"{base}/interactions")
    V.books(spark, d).write.parquet(f"{base}/books")
    got = RD.read_features(spark, base)
    inter, books = got
    return inter.join(books.select("book_id", "title"), "book_id").select("user_id", "book_id", "rating", "title")


@query("s08_k04_mappings", f"""WITH {INTER_SQL}
SELECT CAST(row_number() OVER (ORDER BY book_id) - 1 AS BIGINT) AS book_id_encoded, book_id
FROM (SELECT DISTINCT book_id FROM interactions) t""")
def s08_k04_mappings(spark, d):
    m = W.label_encode(V.interactions(spark, d), "book_id")
    path = scratch_path(spark, "book_id_mapping")
    m.write.parquet(path)
    return RD.read_mapping(spark, path)


@query("s09_k10_latest_version", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 10, 'nb')}
SELECT book_id, other_id, nano, rank, 2 AS version FROM nb""")
def s09_k10_latest_version(spark, d):
    inter = V.written_interactions(spark, d)
    path = scratch_path(spark, "model_neighbors")
    nb = S.item_neighbors(inter, k=20).select("book_id", "other_id", "nano", "rank")
    nb.withColumn("version", F.lit(1)).write.partitionBy("version").parquet(path)
    # the second version is taken from the first as written: the neighbours are found once
    first = spark.read.schema(nb.schema).parquet(f"{path}/version=1")
    first.filter(F.col("rank") <= 10).withColumn("version", F.lit(2)).write.mode("append").partitionBy("version").parquet(path)
    return RD.latest_version(spark, path)


@query("k05_vocabulary", f"""WITH {BOOK_TEXT_SQL}, {tfidf_sql('bt', 'book_id')}
SELECT term, index FROM voc""")
def k05_vocabulary(spark, d):
    _, vocab = TX.tfidf(book_docs(spark, d), "book_id", "text", MIN_DF, MAX_DF)
    return write_table(vocab.select("term", "index").orderBy("index"), "tfidf_vocabulary", spark)


def _digest_sql(cols: str) -> str:
    """Rows and content of a stage: the sum of the first 48 bits of every row's md5."""
    return f"COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(CAST('0x' || substr(md5(concat_ws('|', {cols})), 1, 12) AS BIGINT)) AS VARCHAR) AS content"


_MERGED_COLS = "i.user_id, i.book_id, i.rating, b.title, b.authors, b.category, b.size, CAST(round(b.price * 100) AS BIGINT)"


@query("k01_k02_stage_tables", f"""WITH {SPLIT_SQL}, {BOOKS_SQL}
SELECT 'raw_books' AS stage, CAST({_digest_sql("book_id, title, authors, category, size, CAST(round(price * 100) AS BIGINT)")} FROM books
UNION ALL SELECT 'raw_ratings', CAST({_digest_sql("user_id, book_id, rating")} FROM ir
UNION ALL SELECT 'merged', CAST({_digest_sql(_MERGED_COLS)} FROM interactions i JOIN books b ON i.book_id = b.book_id
UNION ALL SELECT 'train', CAST({_digest_sql("user_id, book_id, rating")} FROM train
UNION ALL SELECT 'test', CAST({_digest_sql("user_id, book_id, rating")} FROM test""")
def k01_k02_stage_tables(spark, d):
    """Raw books/ratings as CSV, processed stages as Parquet; rows and content read back."""
    sp = V.split_interactions(spark, d)
    rating, book = ["user_id", "book_id", "rating"], ["book_id", "title", "authors", "category", "size", "cents"]
    stages = {
        "raw_books": (book, write_table(V.books(spark, d), "raw_books", spark, fmt="csv")),
        "raw_ratings": (rating, write_table(V.interactions_raw(spark, d).select(*rating), "raw_ratings", spark, fmt="csv")),
        "merged": (rating + book[1:], write_table(V.interactions(spark, d).join(V.books(spark, d), "book_id"), "merged", spark)),
        "train": (rating, write_table(sp.filter(F.col("split") == "train"), "train", spark)),
        "test": (rating, write_table(sp.filter(F.col("split") == "test"), "test", spark)),
    }
    out = None
    for name, (cols, t) in stages.items():
        if "cents" in cols:
            t = t.withColumn("cents", F.round(F.col("price") * 100).cast("long"))
        row = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols])), 1, 12), 16, 10).cast("long")
        # the 48 bits as two halves, whose sums fit a long for 2^39 rows
        halves = t.select(F.shiftright(row, 24).alias("high"), row.bitwiseAND(F.lit((1 << 24) - 1)).alias("low")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("high").cast("decimal(20,0)").alias("high"), F.sum("low").cast("decimal(20,0)").alias("low"))
        content = F.col("high") * F.lit(1 << 24).cast("decimal(8,0)") + F.col("low")
        one = halves.select(F.lit(name).alias("stage"), "n_rows", content.cast("string").alias("content"))
        out = one if out is None else out.unionByName(one)
    return out


@query("k03_matrices", f"""WITH {INTER_SQL}, {BOOK_TEXT_SQL}, {tfidf_sql('bt', 'book_id')},
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 20, 'nb')}
SELECT 'user_item' AS matrix, user_id AS row_id, CAST(book_id AS VARCHAR) AS col_id, CAST(rating AS DOUBLE) AS value FROM interactions
UNION ALL SELECT 'tfidf', book_id, term, round(weight, 6) FROM tfidf
UNION ALL SELECT 'similarity', book_id, CAST(other_id AS VARCHAR), nano / 1000000000.0 FROM nb""")
def k03_matrices(spark, d):
    """User x item, book x term and book x book (the nearest 20) in coordinate form, written clustered by row, read back."""
    inter = V.written_interactions(spark, d)
    weights, _ = TX.tfidf(book_docs(spark, d), "book_id", "text", MIN_DF, MAX_DF)
    cell = lambda df, row, col, value: df.select(
        F.col(row).cast("long").alias("row_id"), F.col(col).cast("string").alias("col_id"), value.cast("double").alias("value"))
    made = {"user_item": cell(inter, "user_id", "book_id", F.col("rating")),
            "tfidf": cell(weights, "book_id", "term", F.round("weight", 6)),
            "similarity": cell(S.item_neighbors(inter, k=20), "book_id", "other_id", F.col("nano") / F.lit(1_000_000_000.0))}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = None
    for name, m in made.items():
        back = write_table(m.repartition(n, "row_id").sortWithinPartitions("row_id", "col_id"), name, spark)
        back = back.select(F.lit(name).alias("matrix"), "row_id", "col_id", "value")
        out = back if out is None else out.unionByName(back)
    return out


@query("k03_bucketed_scores", f"""WITH {INTER_SQL}, {recs_sql('interactions', 19, 10, 'recs')}
SELECT user_id, book_id, score_nano, rank FROM recs""")
def k03_bucketed_scores(spark, d):
    """Ratings and neighbours as tables bucketed by book, scored (R05) without an exchange below their join."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inter = write_bucketed(V.interactions(spark, d, keep=False), "interactions_by_book", "book_id", n)
    nb = write_bucketed(S.item_neighbors(inter, k=19).select("book_id", "other_id", "nano"), "neighbors_by_book", "book_id", n)
    return R.recommend_for_users(inter, nb, n=10).select("user_id", "book_id", "score_nano", "rank")


@query("k10_delta_refit", f"""WITH {INTER_SQL},
{cosine_sql('interactions', 'user_id', 'book_id', 'book_id', 'other_id')},
{topk_sql('sims', 'book_id', 'nano DESC, other_id', 20, 'nb')}
SELECT book_id, other_id, dot, nano, rank FROM nb""")
def k10_delta_refit(spark, d):
    """The neighbour model built on the first orders and refitted after three appends, the last of the ratings in order."""
    raw = V.interactions_raw(spark, d)
    share = F.col("l_orderkey") / raw.select(F.max("l_orderkey")).scalar()  # D02 orders by the order key first
    model = NeighbourModel(spark, scratch_path(spark, "neighbour_model"))
    bounds = (float("-inf"), 0.7, 0.8, 0.9, float("inf"))
    for version, (low, high) in enumerate(zip(bounds, bounds[1:])):
        model.append(raw.filter((share > low) & (share <= high)), version, V.SEQ_COLS)
    return model.neighbors(20).select("book_id", "other_id", "dot", "nano", "rank")


@query("k08_request_results", f"""WITH {INTER_SQL}, {recs_sql('interactions', 19, 5, 'recs')}
SELECT user_id, book_id, score_nano, score_nano / 1000000000.0 AS score, rank, 'r1' AS run FROM recs""")
def k08_request_results(spark, d):
    """One results table partitioned by run instead of a file per request."""
    inter = V.written_interactions(spark, d)
    recs = R.recommend_for_users(inter, S.item_neighbors(inter, k=19), n=5)
    t = write_table(recs.withColumn("run", F.lit("r1")), "request_results", spark, partition_by=["run"])
    return t.filter(F.col("run") == "r1").select("user_id", "book_id", "score_nano", "score", "rank", "run")


@query("k09_test_report", f"""WITH {INTER_SQL},
su AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM interactions) t
       ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR))), user_id LIMIT 5),
{recs_sql('interactions', 19, 5, 'recs', users='su')},
pu AS (SELECT user_id, list({{'rank': rank, 'book_id': book_id}} ORDER BY rank) AS items, COUNT(*) AS n FROM recs GROUP BY 1),
pairs AS (SELECT a.user_id AS ua, b.user_id AS ub FROM su a JOIN su b ON a.user_id < b.user_id),
common AS (SELECT p.ua, p.ub, COUNT(*) AS c FROM pairs p JOIN recs ra ON ra.user_id = p.ua
           JOIN recs rb ON rb.user_id = p.ub AND ra.book_id = rb.book_id GROUP BY 1, 2),
jac AS (SELECT coalesce(c, 0) / (x.n + y.n - coalesce(c, 0)) AS j FROM pairs p JOIN pu x ON x.user_id = p.ua JOIN pu y ON y.user_id = p.ub
        LEFT JOIN common ON common.ua = p.ua AND common.ub = p.ub)
SELECT CAST(to_json({{'user_results': (SELECT list({{'user_id': user_id, 'items': items}} ORDER BY user_id) FROM pu),
                     'summary': {{'mean_jaccard_millionths': (SELECT CAST(floor(avg(j) * 1000000 + 0.5) AS BIGINT) FROM jac),
                                  'n_users': (SELECT COUNT(*) FROM pu)}}}}) AS VARCHAR) AS report""")
def k09_test_report(spark, d):
    """Nested JSON report (sampled users' lists + summary) written, read back and shown in canonical form."""
    inter = V.written_interactions(spark, d)
    users = sample_keys(inter, "user_id", 5, 42)
    recs = R.recommend_for_users(inter.join(users, "user_id", "left_semi"), S.item_neighbors(inter, k=19), n=5)
    per_user = recs.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "book_id"))).alias("items"))
    ov = E.list_overlap(recs, users, n=5)
    report = spark.range(1).select(
        per_user.select(F.array_sort(F.collect_list(F.struct("user_id", "items")))).scalar().alias("user_results"),  # five users
        F.struct(ov.select(F.floor(F.avg("jaccard") * 1_000_000 + 0.5)).scalar().alias("mean_jaccard_millionths"),
                 per_user.select(F.count(F.lit(1))).scalar().alias("n_users")).alias("summary"))
    path = scratch_path(spark, "test_report")
    report.write.json(path)
    return spark.read.schema(report.schema).json(path).select(F.to_json(F.struct("user_results", "summary")).alias("report"))


@query("r15_metadata", f"""WITH {INTER_SQL}, {BOOKS_SQL}, {DIRTY_BOOKS_SQL}, {CLEAN_BOOKS_SQL},
prim AS (SELECT book_id, title, authors FROM (
           SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY title, authors) AS rn FROM clean_books
           WHERE NOT (contains(title, 'Unknown') AND authors = 'Unknown')) t WHERE rn = 1),
ids AS (SELECT DISTINCT book_id FROM interactions),
p AS (SELECT prim.* FROM prim WHERE book_id IN (SELECT book_id FROM ids))
SELECT book_id, title, authors FROM p
UNION ALL
SELECT b.book_id, b.title, b.authors FROM books b
WHERE b.book_id IN (SELECT book_id FROM ids) AND b.book_id NOT IN (SELECT book_id FROM p)""")
def r15_metadata(spark, d):
    """Metadata for every rated book from the cleaned table (placeholders dropped, one row per
    id), the raw book dimension filling the ids the cleaned table lacks (S04 per_key, P15, D03, P16)."""
    from shelfwise.operators import cleaning as C
    from shelfwise.operators.dedup import keep_first
    prim = C.drop_placeholders(C.clean_books(V.dirty_books(spark, d)))
    prim = keep_first(prim.select("book_id", "title", "authors"), ["book_id"], ["title", "authors"])
    ids = V.interactions(spark, d).select("book_id")
    return RD.metadata_with_fallback(prim, V.books(spark, d), ids, mode="per_key")
