"""Fixed schemas for every table the library reads or writes (never inferred)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BOOKS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("book_id", T.LongType()),
    T.StructField("best_book_id", T.LongType()),
    T.StructField("work_id", T.LongType()),
    T.StructField("books_count", T.LongType()),
    T.StructField("isbn", T.StringType()),
    T.StructField("isbn13", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("original_publication_year", T.DoubleType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("language_code", T.StringType()),
    T.StructField("average_rating", T.DoubleType()),
    T.StructField("ratings_count", T.LongType()),
    T.StructField("work_ratings_count", T.LongType()),
    T.StructField("work_text_reviews_count", T.LongType()),
    T.StructField("ratings_1", T.LongType()),
    T.StructField("ratings_2", T.LongType()),
    T.StructField("ratings_3", T.LongType()),
    T.StructField("ratings_4", T.LongType()),
    T.StructField("ratings_5", T.LongType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("small_image_url", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("description", T.StringType()),
])

# Raw text schema: every column is read as a string and coerced explicitly.
BOOKS_RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in BOOKS.fields])

RATINGS = T.StructType([
    T.StructField("book_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("rating", T.IntegerType()),
])
RATINGS_RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in RATINGS.fields])

MERGED_COLUMNS = ["book_id", "user_id", "rating"] + [f.name for f in BOOKS.fields if f.name != "book_id"]

ID_MAPPING = T.StructType([
    T.StructField("book_id", T.LongType()),
    T.StructField("book_id_encoded", T.LongType()),
])

VOCABULARY = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("index", T.LongType()),
])

TAGS = T.StructType([T.StructField("tag_id", T.LongType()), T.StructField("tag_name", T.StringType())])
BOOK_TAGS = T.StructType([
    T.StructField("goodreads_book_id", T.LongType()),
    T.StructField("tag_id", T.LongType()),
    T.StructField("count", T.LongType()),
])

# Nested API payload.
PAYLOAD = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("books", T.ArrayType(T.StructType([
            T.StructField("id", T.LongType()),
            T.StructField("title", T.StringType()),
        ]))),
    ])),
    T.StructField("errors", T.ArrayType(T.StructType([T.StructField("message", T.StringType())]))),
])

# API response item (P20).
RESPONSE_ITEM = T.StructType([
    T.StructField("book_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("rank", T.IntegerType()),
])


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Required-column gate, checked on the driver against the schema only."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}; have {df.columns}")
    return df
