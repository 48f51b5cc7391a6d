"""Logical tables of the recommender, defined over the driver's test tables.

Every view is lazy and reads only the columns it needs, so Parquet pruning and pushdown apply.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.exprs import rating_from_quantity
from shelfwise.sources.sinks import write_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, book_id, rating) per line item, plus the columns that order duplicates."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                 "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("book_id"),
        rating_from_quantity("l_quantity").alias("rating"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


SEQ_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def interactions(spark: SparkSession, sf_dir: str, keep: bool = True) -> DataFrame:
    """D02 over ``interactions_raw``: the last row per (user, book) in sequence order wins.

    ``keep`` persists it (memory, then disk) for plans that read it several times; single-pass plans leave it lazy,
    so their filters and columns reach the scan. A lost executor computes its blocks again from lineage.
    """
    from shelfwise.operators.dedup import keep_last
    last = keep_last(interactions_raw(spark, sf_dir), ["user_id", "book_id"], SEQ_COLS, ["rating"])
    return last.persist(StorageLevel.MEMORY_AND_DISK) if keep else last


def written_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``interactions`` as a written table, for jobs on large tables that read it often: the shuffle files of the join and of D02 are gone
    before the job starts, while a persisted table keeps them to its end."""
    return write_table(interactions(spark, sf_dir, keep=False), "interactions", spark)


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book dimension from ``part``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("authors"),
        F.col("p_type").alias("category"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("tag_id"),
                                                   F.col("s_name").alias("tag_name"))


def book_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("goodreads_book_id"), F.col("l_suppkey").alias("tag_id")).agg(
        F.count(F.lit(1)).alias("count"))


def dirty_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-text books with deterministic defects (the driver tables have none)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.when(k % 23 == 0, F.lit("x1")).when(k % 29 == 0, F.lit(None)).otherwise(k.cast("string")).alias("book_id"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 31 == 0, F.lit("Unknown Title")).otherwise(
            F.col("p_name")).alias("title"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 31 == 0, F.lit("Unknown")).otherwise(F.col("p_brand")).alias("authors"),
        F.when(k % 11 == 0, F.lit("n/a")).when(k % 7 == 0, F.lit(None)).otherwise(
            F.col("p_retailprice").cast("string")).alias("average_rating"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("p_size").cast("string")).alias("ratings_count"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("978"), F.lpad(k.cast("string"), 10, "0"))).alias("isbn"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.lit("eng")).alias("language_code"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("original_title"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("http://img/"), k.cast("string"))).alias("image_url"),
    )


def dirty_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-text ratings with bad numbers, nulls and out-of-range values."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rating = rating_from_quantity("l_quantity")
    return j.select(
        F.when(k % 41 == 0, F.lit("abc")).otherwise(F.col("l_partkey").cast("string")).alias("book_id"),
        F.when(k % 37 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(k % 19 == 0, F.lit("9")).when(k % 43 == 0, F.lit("0")).when(k % 47 == 0, F.lit(" 4 "))
        .otherwise(rating.cast("string")).alias("rating"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request table from customer keys, with bad ids and counts mixed in by modulus."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("request_id"),
        F.when(k % 2 == 0, F.lit("user")).otherwise(F.lit("book")).alias("kind"),
        F.when(k % 11 == 0, F.lit("abc")).when(k % 13 == 0, F.lit("-1")).when(k % 17 == 0, F.lit("99999"))
        .when(k % 19 == 0, F.lit("0")).otherwise((k % 600).cast("string")).alias("id_text"),
        F.when(k % 7 == 0, F.lit("100")).when(k % 9 == 0, F.lit("0")).when(k % 8 == 0, F.lit("-1"))
        .when(k % 5 == 0, F.lit(None).cast("string")).otherwise((k % 20 + 1).cast("string")).alias("num_text"),
        F.when(k % 10 == 3, F.lit("3")).when(k % 23 == 0, F.lit("x")).otherwise(F.lit(None).cast("string"))
        .alias("n_text"))


def implicit_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implicit feedback from events: item = props.k, rating = number of events (P14 + R01)."""
    ev = table(spark, sf_dir, "events").select("user_id", F.get_json_object("props", "$.k").cast("long").alias("book_id"))
    from shelfwise.operators.recommend import user_item_entries
    return user_item_entries(ev.withColumn("rating", F.lit(1))).withColumn("rating", F.col("rating").cast("int"))


def split_interactions(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    from shelfwise.operators.encode import seeded_split
    return seeded_split(interactions(spark, sf_dir), ["user_id", "book_id"], seed)
