"""Joins (J01-J10). Strategy is left to Catalyst/AQE: a side is broadcast only when its runtime
size is under the broadcast threshold; otherwise sort-merge with AQE skew splitting."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schemas import MERGED_COLUMNS


def merge_ratings_books(ratings: DataFrame, books: DataFrame, key: str = "book_id") -> DataFrame:
    """Ratings x books on the key; rating columns first, then book columns."""
    out = ratings.join(books, key, "inner")
    ordered = [c for c in MERGED_COLUMNS if c in out.columns]
    return out.select(*ordered, *[c for c in out.columns if c not in ordered])


def referential_filter(ratings: DataFrame, books: DataFrame, key: str = "book_id") -> DataFrame:
    """Keep ratings whose book exists."""
    return ratings.join(books.select(key), key, "left_semi")


def orphans(ratings: DataFrame, books: DataFrame, key: str = "book_id") -> DataFrame:
    """Number of distinct ids present in ratings but missing from books (one row)."""
    miss = ratings.select(key).distinct().join(books.select(key), key, "left_anti")
    return miss.agg(F.count(F.lit(1)).alias("n_orphans"))


def orphan_sample(ratings: DataFrame, books: DataFrame, key: str = "book_id", sample: int = 5) -> DataFrame:
    """The ``sample`` smallest orphan ids (an ordered limit, never a collected list)."""
    miss = ratings.select(key).distinct().join(books.select(key), key, "left_anti")
    return miss.orderBy(key).limit(sample)


def tag_names(book_tags: DataFrame, tags: DataFrame) -> DataFrame:
    """book_tags x tags."""
    return book_tags.join(tags, "tag_id", "inner")


def left_join_named(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on differently named keys."""
    return left.join(right, left[left_key] == right[right_key], "left")


def activity_filter(interactions: DataFrame, min_item: int = 2, min_user: int = 10, user_col: str = "user_id",
                    item_col: str = "book_id") -> DataFrame:
    """Keep items with >= min_item ratings, then users with >= min_user remaining ratings.

    Counts are aggregates joined back (map-side combined), not windows, so a hot key never
    lands whole in one task.
    """
    ic = interactions.groupBy(item_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_item)
    kept = interactions.join(ic.select(item_col), item_col, "left_semi")
    uc = kept.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_user)
    return kept.join(uc.select(user_col), user_col, "left_semi")


def encode_ids(df: DataFrame, mapping: DataFrame, col: str, code_col: str) -> DataFrame:
    """Replace ids by their codes; unmapped ids are left unchanged."""
    m = mapping.select(F.col(col).alias("_k"), F.col(code_col).alias("_code"))
    return df.join(m, df[col] == m["_k"], "left").withColumn(col, F.coalesce("_code", F.col(col))).drop("_k", "_code")


def decode_ids(df: DataFrame, mapping: DataFrame, col: str, code_col: str) -> DataFrame:
    """Codes back to ids with a same-value default."""
    m = mapping.select(F.col(code_col).alias("_k"), F.col(col).alias("_orig"))
    return df.join(m, df[col] == m["_k"], "left").withColumn(col, F.coalesce("_orig", F.col(col))).drop("_k", "_orig")


def unordered_pairs(keys: DataFrame, key: str) -> DataFrame:
    """Pairs (a < b) of a sampled key set whose size is a parameter.

    Keys are numbered 0..s-1 (a window over the s sampled keys only); every key lists the higher
    numbers and pairs are an equi-join on the number, so no nested-loop join is planned.
    """
    idx = keys.select(key).distinct().withColumn("_i", F.row_number().over(Window.orderBy(key)) - 1)
    s = idx.select(F.count(F.lit(1))).scalar()
    a = idx.select(F.col(key).alias(f"{key}_a"), F.explode(F.sequence(F.col("_i") + 1, F.greatest(
        F.col("_i") + 1, s - 1))).alias("_j"), (F.col("_i") + 1 <= s - 1).alias("_has"))
    a = a.filter("_has").drop("_has")
    b = idx.select(F.col(key).alias(f"{key}_b"), F.col("_i").alias("_j"))
    return a.join(b, "_j").drop("_j")


def with_group_count(df: DataFrame, part: str, name: str) -> DataFrame:
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(part)))
