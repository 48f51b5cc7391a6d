"""Projections, filters and cleaning (P01-P18). All native column expressions."""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.exprs import try_double
from shelfwise.operators.ranking import top_k_per_group

BOOK_NUMERIC = ["book_id", "id", "best_book_id", "work_id", "books_count", "average_rating", "ratings_count",
                "work_ratings_count", "work_text_reviews_count", "ratings_1", "ratings_2", "ratings_3",
                "ratings_4", "ratings_5"]
BOOK_INTEGER = [c for c in BOOK_NUMERIC if c != "average_rating"]
CRITICAL = ["title", "authors"]
# Fixed defaults of the book cleaner.
BOOK_FILL = {"isbn": "", "language_code": "eng", "image_url": "", "small_image_url": ""}
ALIASES = {"author": "authors", "book_title": "title"}


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text to double, bad values to NULL, in one projection."""
    cols = set(cols)
    return df.select(*[try_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL."""
    return df.na.drop(how="any", subset=[c for c in cols if c in df.columns])


def fill_defaults(df: DataFrame, text_fill: Mapping[str, str] | None = None,
                  numeric_cols: Iterable[str] = ()) -> DataFrame:
    """Constant defaults for text columns, 0 for numeric columns."""
    text_fill = {k: v for k, v in (text_fill or BOOK_FILL).items() if k in df.columns}
    out = df.na.fill(text_fill) if text_fill else df
    nums = [c for c in numeric_cols if c in df.columns]
    return out.na.fill(0, subset=nums) if nums else out


def fill_from(df: DataFrame, target: str, source: str) -> DataFrame:
    """Fill a column from another one."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))


def cast_integer(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Truncating cast to long."""
    cols = set(cols)
    return df.select(*[F.col(c).cast("long").alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_any_null(df: DataFrame) -> DataFrame:
    """P07."""
    return df.na.drop(how="any")


def in_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range."""
    return df.filter(F.col(col).between(lo, hi))


def clean_books(df: DataFrame) -> DataFrame:
    """Drop null title/authors -> coerce numerics -> drop null key -> fill -> integer ids."""
    out = drop_missing(df, CRITICAL)
    out = coerce_numeric(out, [c for c in BOOK_NUMERIC if c in out.columns])
    out = drop_missing(out, ["book_id"])
    if "original_title" in out.columns:
        out = fill_from(out, "original_title", "title")
    out = fill_defaults(out, BOOK_FILL, [c for c in BOOK_NUMERIC if c in out.columns])
    return cast_integer(out, [c for c in BOOK_INTEGER if c in out.columns])


def clean_ratings(df: DataFrame, lo: int = 1, hi: int = 5) -> DataFrame:
    """P10: coerce -> drop any null -> rating in [lo, hi] -> integer ids (rating stays double)."""
    out = coerce_numeric(df, ["user_id", "book_id", "rating"])
    out = in_range(drop_any_null(out), "rating", lo, hi)
    return cast_integer(out, ["user_id", "book_id"])


def overwrite_constant(df: DataFrame, col: str, value) -> DataFrame:
    """P11."""
    return df.withColumn(col, F.lit(value))


def reconcile_aliases(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Rename alias columns when the canonical name is absent (schema-only decision)."""
    for alias, canonical in (aliases or ALIASES).items():
        if canonical not in df.columns and alias in df.columns:
            df = df.withColumnRenamed(alias, canonical)
    return df


def implicit_feedback(df: DataFrame, rating_col: str = "rating") -> DataFrame:
    """Without a rating column every interaction counts 1.0."""
    return df if rating_col in df.columns else df.withColumn(rating_col, F.lit(1.0))


def isin_filter(df: DataFrame, col: str, ids) -> DataFrame:
    """Membership filter as a semi-join, for an id DataFrame (first column) or a list of any length.

    Spark broadcasts the ids when they are small at run time and shuffles otherwise.
    """
    if not isinstance(ids, DataFrame):
        kind = T.StructType([T.StructField(col, df.schema[col].dataType)])
        ids = df.sparkSession.createDataFrame([(x,) for x in ids], kind)
    return df.join(ids.select(F.col(ids.columns[0]).alias(col)).distinct(), col, "left_semi")


def drop_placeholders(df: DataFrame, title: str = "title", authors: str = "authors",
                      marker: str = "Unknown") -> DataFrame:
    """Drop null title/authors and rows whose title contains and authors equal the marker."""
    out = drop_missing(df, [title, authors])
    return out.filter(~(F.col(title).contains(marker) & (F.col(authors) == marker)))


def rekey(incoming: DataFrame, offset_from: DataFrame, id_cols: Sequence[str], key: str = "book_id") -> DataFrame:
    """Shift every id column of ``incoming`` by the current maximum id of ``offset_from``.

    The maximum is a scalar subquery (no cross join, no driver round trip).
    """
    mx = F.coalesce(offset_from.select(F.max(key)).scalar(), F.lit(0))
    return incoming.select(*[(F.col(c) + mx).alias(c) if c in id_cols else F.col(c) for c in incoming.columns])


def user_top_rated(interactions: DataFrame, min_rating=2, n: int = 10, user_col: str = "user_id",
                   item_col: str = "book_id", rating_col: str = "rating") -> DataFrame:
    """Every user's own top-n distinct items with rating >= min_rating (rating desc, id asc)."""
    liked = interactions.filter(F.col(rating_col) >= min_rating).select(user_col, item_col, rating_col).distinct()
    return top_k_per_group(liked, [user_col], [F.col(rating_col).desc(), F.col(item_col)], n)
