"""Sinks (K01-K10): Parquet tables under a shared folder, read back lazily."""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import scratch_path


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the executions inside are removed when each ends; a caller that runs one of them again makes them again."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def write_table(df: DataFrame, name: str, spark: SparkSession | None = None, path: str | None = None,
                partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Write ``df`` (K01-K08) and return the table read back from storage; the shuffle files that the write made are removed."""
    spark = spark or df.sparkSession
    path = path or scratch_path(spark, name)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(spark):
        w.save(path)
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).schema(df.schema)
    return r.load(path)


def write_bucketed(df: DataFrame, name: str, by: str, buckets: int, dealt: bool = False) -> DataFrame:
    """``df`` as a table bucketed and sorted by one column, under the shared folder, and read through the catalogue.

    Joins and groupings on ``by`` with tables of as many buckets need no exchange on this side. The rows are dealt by the key
    first, so every bucket is one file; ``dealt``: the caller dealt them by it over as many partitions.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    with freed_shuffles(spark):
        (df if dealt else df.repartition(buckets, by)).write.bucketBy(buckets, by).sortBy(by).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def evaluation_table(pr: DataFrame, model: str, ks: Sequence[int]) -> DataFrame:
    """Long (k, precision, recall) -> one row per model, one column per metric."""
    long = pr.select(F.lit(model).alias("model"), F.explode(F.array(
        *[F.struct(F.concat(F.lit(m + "_at_"), F.col("k").cast("string")).alias("metric"),
                   F.col(m).alias("value")) for m in ("precision", "recall")])).alias("m"))
    names = [f"{m}_at_{k}" for k in ks for m in ("precision", "recall")]
    wide = long.select("model", "m.metric", "m.value").groupBy("model").pivot("metric", names).agg(F.first("value"))
    return wide.select("model", *[F.round(c, 6).alias(c) for c in names])
