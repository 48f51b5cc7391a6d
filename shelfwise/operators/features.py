"""Hand-made book features as long rows (book_id, feature, value)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference generator: rating shares per average-rating band (1..5 stars),
# band lower bounds, and the URL / description templates.
RATING_BANDS = [
    (4.5, [0.01, 0.04, 0.10, 0.25, 0.60]),
    (4.0, [0.02, 0.08, 0.15, 0.35, 0.40]),
    (3.5, [0.05, 0.10, 0.25, 0.40, 0.20]),
    (3.0, [0.10, 0.15, 0.40, 0.25, 0.10]),
]
RATING_BAND_LOWEST = [0.30, 0.25, 0.20, 0.15, 0.10]
IMAGE_URL = "https://example.com/bookcovers/{id}.jpg"
SMALL_IMAGE_URL = "https://example.com/bookcovers/small/{id}.jpg"
DESCRIPTION = "This is a fictional description for the book '{title}' by {authors}."
REVIEW_SHARE = 0.1


def author_flags(books: DataFrame, n: int = 100, id_col: str = "book_id", authors: str = "authors",
                 mode: str = "substring") -> DataFrame:
    """Flags for the n most frequent whitespace tokens of authors (NULL -> 'Unknown').

    ``substring`` (Q13, the reference) tests containment; ``token`` matches whole tokens with an
    equi-join. The token list is at most ``n`` entries and reaches rows as one scalar value.
    """
    a = books.select(id_col, F.coalesce(F.col(authors), F.lit("Unknown")).alias("_a"))
    toks = a.select(F.explode(F.split(F.trim("_a"), r"\s+")).alias("token")).filter(F.col("token") != "")
    top = toks.groupBy("token").agg(F.count(F.lit(1)).alias("c")).orderBy(F.col("c").desc(), "token").limit(n)
    if mode == "token":
        mine = a.select(id_col, F.explode(F.array_distinct(F.split(F.trim("_a"), r"\s+"))).alias("token"))
        hit = mine.join(F.broadcast(top.select("token")), "token")
    else:
        lst = top.agg(F.collect_list("token")).scalar()
        withlst = a.select(id_col, "_a", lst.alias("_toks"))
        hit = withlst.select(id_col, F.explode(F.filter("_toks", lambda t: F.col("_a").contains(t))).alias("token"))
    return hit.select(id_col, F.concat(F.lit("author_"), F.col("token")).alias("feature"), F.lit(1.0).alias("value"))


def category_onehot(books: DataFrame, col: str = "category", n: int = 20, id_col: str = "book_id") -> DataFrame:
    """One-hot of the n most frequent categories (NULL -> 'unknown'); others get no row."""
    c = books.select(id_col, F.coalesce(F.col(col), F.lit("unknown")).alias("_c"))
    top = c.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "_c").limit(n)
    return c.join(F.broadcast(top.select("_c")), "_c").select(
        id_col, F.concat(F.lit(f"{col}_"), F.col("_c")).alias("feature"), F.lit(1.0).alias("value"))


def minmax(books: DataFrame, cols: Sequence[str], id_col: str = "book_id") -> DataFrame:
    """(x - min) / (max - min); constant column -> 0; NULL -> 0. All bounds are one scalar subquery, all columns one pass."""
    bounds = books.agg(F.array(*(F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"))
                                 for c in cols)).alias("bounds")).scalar()

    def scaled(i: int, c: str):
        lo, hi = F.col("_bounds")[i]["lo"], F.col("_bounds")[i]["hi"]
        v = F.when(hi > lo, (F.col(c).cast("double") - lo) / (hi - lo)).otherwise(F.lit(0.0))
        return F.struct(F.lit(c).alias("feature"), F.coalesce(v, F.lit(0.0)).alias("value"))
    cells = books.withColumn("_bounds", bounds).select(id_col, F.explode(F.array(*(scaled(i, c) for i, c in enumerate(cols)))).alias("x"))
    return cells.select(id_col, "x.feature", "x.value")


def assemble(books: DataFrame, blocks: Sequence[DataFrame], id_col: str = "book_id") -> DataFrame:
    """Union of feature blocks; a book without any feature gets ('placeholder', 1.0)."""
    feats = blocks[0]
    for b in blocks[1:]:
        feats = feats.unionByName(b)
    missing = books.select(id_col).distinct().join(feats.select(id_col), id_col, "left_anti")
    return feats.unionByName(missing.select(id_col, F.lit("placeholder").alias("feature"),
                                            F.lit(1.0).alias("value")))


def rating_histogram(df: DataFrame, avg_col: str = "average_rating", count_col: str = "ratings_count") -> DataFrame:
    """Split a rating count into five star counts by average-rating band; the remainder goes to 5 stars."""
    def band_share(i):
        e = F.lit(RATING_BAND_LOWEST[i])
        for lo, shares in reversed(RATING_BANDS):
            e = F.when(F.col(avg_col) >= lo, F.lit(shares[i])).otherwise(e)
        return e
    cnt = F.col(count_col)
    floors = [F.floor(cnt * band_share(i)).cast("long") for i in range(5)]
    out = df
    for i in range(4):
        out = out.withColumn(f"ratings_{i + 1}", floors[i])
    rest = cnt - sum(floors[:4]) - floors[4]
    return out.withColumn("ratings_5", floors[4] + F.greatest(rest, F.lit(0)).cast("long"))


def templated_fields(df: DataFrame, id_col: str = "book_id", title: str = "title", authors: str = "authors",
                     count_col: str = "ratings_count") -> DataFrame:
    """URLs, description and the 10 % review count."""
    idc = F.col(id_col).cast("string")
    return df.select(
        id_col,
        F.concat(F.lit(IMAGE_URL.split("{id}")[0]), idc, F.lit(IMAGE_URL.split("{id}")[1])).alias("image_url"),
        F.concat(F.lit(SMALL_IMAGE_URL.split("{id}")[0]), idc, F.lit(SMALL_IMAGE_URL.split("{id}")[1]))
        .alias("small_image_url"),
        F.concat(F.lit("This is a fictional description for the book '"), F.col(title), F.lit("' by "),
                 F.col(authors), F.lit(".")).alias("description"),
        F.floor(F.col(count_col) * F.lit(REVIEW_SHARE)).cast("long").alias("work_text_reviews_count"))


def feature_summary(interactions: DataFrame, tfidf: DataFrame, vocab: DataFrame, min_df: int, max_df: float,
                    user_col: str = "user_id", item_col: str = "book_id") -> DataFrame:
    """Matrix shapes and counts in one row (density is our addition)."""
    nu = interactions.select(F.countDistinct(user_col)).scalar()
    nb = interactions.select(F.countDistinct(item_col)).scalar()
    nnz = interactions.select(F.count(F.lit(1))).scalar()
    nt = vocab.select(F.count(F.lit(1))).scalar()
    nd = tfidf.select(F.countDistinct(tfidf.columns[0])).scalar()
    return interactions.sparkSession.range(1).select(
        nu.alias("num_users"), nb.alias("num_books"), nt.alias("num_features"), nd.alias("num_documents"),
        nnz.alias("nnz"), F.round(nnz / (nu * nb), 9).alias("density"),
        F.lit(min_df).cast("long").alias("min_df"), F.lit(max_df).cast("double").alias("max_df"))
