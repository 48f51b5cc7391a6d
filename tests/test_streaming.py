import tempfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shelfwise.streaming.ingest import current_version, merge_batch, published, start_book_ingest

SCHEMA = "book_id long, title string, authors string"


def _ratings(batch):
    return batch.select(F.lit(9).cast("long").alias("user_id"), "book_id", F.lit(5).alias("rating"),
                        F.lit(0).cast("long").alias("_pos"))


@pytest.fixture
def tables(spark):
    base = tempfile.mkdtemp(prefix="shelfwise-stream-")
    spark.createDataFrame([(1, "A", "x", "eng", 1), (2, "B", "y", "eng", 1)],
                          SCHEMA + ", language_code string, version int").write.partitionBy("version").parquet(f"{base}/books")
    spark.createDataFrame([(9, 1, 3, 1)], "user_id long, book_id long, rating int, version int") \
        .write.partitionBy("version").parquet(f"{base}/ratings")
    spark.createDataFrame([(1, "C", "z"), (2, "A", "x")], SCHEMA).write.parquet(f"{base}/incoming")
    return base


def _content(spark, base):
    ledger = f"{base}/ledger"
    return (sorted((r.book_id, r.title) for r in published(spark, f"{base}/books", ledger).collect()),
            sorted((r.book_id, r.rating) for r in published(spark, f"{base}/ratings", ledger).collect()))


# incoming ids shifted by max existing id (2); (A, x) already exists and is dropped
MERGED = ([(1, "A"), (2, "B"), (3, "C")], [(1, 3), (3, 5)])


def test_stream_append_ingest(spark, tables):
    q = start_book_ingest(spark, f"{tables}/incoming", f"{tables}/books", f"{tables}/ratings", _ratings,
                          spark.createDataFrame([], SCHEMA).schema, f"{tables}/ckpt", f"{tables}/ledger")
    q.awaitTermination(120)
    assert _content(spark, tables) == MERGED


def _merge(spark, base, epoch=0):
    merge_batch(spark.read.parquet(f"{base}/incoming"), epoch, f"{base}/books", f"{base}/ratings", f"{base}/ledger", _ratings)


def test_batch_run_again_changes_nothing(spark, tables):
    spark.createDataFrame([(-1, 1)], "epoch long, version long").write.parquet(f"{tables}/ledger")
    _merge(spark, tables)
    _merge(spark, tables)
    assert _content(spark, tables) == MERGED and current_version(spark, f"{tables}/ledger") == 2


def test_crash_between_the_two_writes(spark, tables, monkeypatch):
    spark.createDataFrame([(-1, 1)], "epoch long, version long").write.parquet(f"{tables}/ledger")
    write = DataFrameWriter.parquet

    def crash(self, path, *args, **kw):
        if "/ratings/" in path:
            raise OSError("lost")
        return write(self, path, *args, **kw)
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", crash)
        with pytest.raises(OSError):
            _merge(spark, tables)
    assert _content(spark, tables) == ([(1, "A"), (2, "B")], [(1, 3)])  # the old version is still the current one
    _merge(spark, tables)
    assert _content(spark, tables) == MERGED
