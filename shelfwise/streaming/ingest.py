"""Incremental append ingestion with Structured Streaming.

The reference's append mode is a batch merge (U02). ``append_ingest`` is a pure
DataFrame -> DataFrame function, so a stream of incoming book/rating files drives it per micro-batch through
``foreachBatch``; each batch writes both merged tables at a new version.

A batch is published by one row of the ledger (epoch, version), written last. A crash before that row leaves the old
version current, and the batch run again overwrites the unpublished files; an epoch found in the ledger is skipped.
Readers take ``published``. Every batch rewrites the merged tables, as the reference's merge does.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans.pipelines import append_ingest


LEDGER = "epoch long, version long"


def current_version(spark: SparkSession, ledger: str) -> int:
    return spark.read.schema(LEDGER).parquet(ledger).agg(F.max("version")).first()[0]


def published(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The rows of the versioned table ``path`` at the ledger's newest version; unpublished files are not read."""
    return spark.read.parquet(path).filter(F.col("version") == current_version(spark, ledger)).drop("version")


def merge_batch(batch: DataFrame, epoch: int, books_path: str, ratings_path: str, ledger: str, ratings_for_batch) -> None:
    """Merge one micro-batch into the published version and publish the result; safe to run again at any point."""
    spark = batch.sparkSession
    if not spark.read.schema(LEDGER).parquet(ledger).filter(F.col("epoch") == epoch).isEmpty() or batch.isEmpty():
        return
    version = current_version(spark, ledger) + 1
    old_ratings = published(spark, ratings_path, ledger).withColumn("_pos", F.lit(0).cast("long"))
    books, ratings = append_ingest(published(spark, books_path, ledger), old_ratings, batch, ratings_for_batch(batch))
    books.write.mode("overwrite").parquet(f"{books_path}/version={version}")
    ratings.write.mode("overwrite").parquet(f"{ratings_path}/version={version}")
    spark.createDataFrame([(epoch, version)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)


def start_book_ingest(spark: SparkSession, incoming_dir: str, books_path: str, ratings_path: str,
                      ratings_for_batch, schema: T.StructType, checkpoint: str, ledger: str, trigger_once: bool = True):
    """Stream incoming book files (``schema``, Parquet) into the versioned merged tables.

    ``ratings_for_batch(batch_df) -> DataFrame`` supplies the incoming ratings of a batch as
    (user_id, book_id, rating, _pos long), ``_pos`` ordering repeated pairs within the batch. A new ledger starts at
    the newest version that the books table has.
    """
    first = spark.read.parquet(books_path).agg(F.lit(-1).cast("long").alias("epoch"), F.max("version").cast("long").alias("version"))
    first.write.mode("ignore").parquet(ledger)
    stream = spark.readStream.schema(schema).parquet(incoming_dir)
    w = stream.writeStream.foreachBatch(
        lambda batch, epoch: merge_batch(batch, epoch, books_path, ratings_path, ledger, ratings_for_batch))
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()
