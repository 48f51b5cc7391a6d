"""Global positions, label encoding and the exact seeded split.

For positions a total order over all rows is computed without a single-partition window:
range-partition + sort within partitions, a reliable checkpoint that pins the partitions,
per-partition row counts (one row per partition, broadcast), then
``position = offset(partition) + row index inside the partition``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.exprs import seeded_hash
from shelfwise.session import reliable_checkpoint
from shelfwise.sources.sinks import write_table

_LOW33 = (1 << 33) - 1
DIGITS = 3  # digits of a hash that the rows of a split are counted by
KEPT = 8  # digits of it that are kept with them


def global_position(df: DataFrame, order_cols: Sequence[str], name: str = "pos",
                    num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row under ``order_cols`` (which must form a total order)."""
    spark = df.sparkSession
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = reliable_checkpoint(df.repartitionByRange(p, *order_cols).sortWithinPartitions(*order_cols))
    mid = F.monotonically_increasing_id()
    tagged = (ranged.withColumn("_mid", mid)
              .withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOW33))))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the running sum is over at most ``p`` rows
    offsets = sizes.withColumn("_off", F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).select("_pid", "_off")
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_mid", "_pid", "_local", "_off"))


def running_sum(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` over all rows up to this one in ``key`` order (unique keys), without a single-partition window.

    As for positions: range partitions pinned by a checkpoint, one offset per partition, a window inside each.
    """
    p = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = reliable_checkpoint(df.repartitionByRange(p, key)).withColumn("_pid", F.spark_partition_id())
    sizes = ranged.groupBy("_pid").agg(F.sum(amount).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)  # one row per partition
    offsets = sizes.select("_pid", (F.sum("_n").over(before) - F.col("_n")).alias("_off"))
    inside = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.withColumn(name, F.sum(amount).over(inside)).join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col(name) + F.col("_off")).drop("_pid", "_off"))


def label_encode(df: DataFrame, col: str, code_col: str | None = None) -> DataFrame:
    """Mapping ``(col, code)`` with codes 0..n-1 in ascending ``col`` order."""
    code_col = code_col or f"{col}_encoded"
    return global_position(df.select(col).distinct(), [col], code_col)


def seeded_split(df: DataFrame, key_cols: Sequence[str], seed: int = 42, test_num: int = 1,
                 test_den: int = 5) -> DataFrame:
    """Exact split; rows ordered by md5(seed|keys) and the first floor(n * (den-num) / den)
    rows are train. Adds ``split`` ('train'/'test'). Keys must be unique.

    The rows are written once with the first digits of their hash and not sorted: they are counted by ``DIGITS`` digits, 4,096 numbers at
    most, and only the few rows of the digits that the cut falls in are put in order to find the first test row. The others are compared with it.
    """
    full = seeded_hash(seed, *key_cols)
    h = write_table(df.withColumn("_h", F.substring(full, 1, KEPT)), "split-hashes")
    counts = sorted(h.groupBy(F.substring("_h", 1, DIGITS).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(c.n for c in counts)
    cut = left = n * (test_den - test_num) // test_den
    label = F.lit("train")
    if cut < n:
        for prefix, size in counts:
            if left < size:
                break
            left -= size
        some = h.filter(F.col("_h").startswith(prefix)).withColumn("_h", full)
        first = some.select("_h", *key_cols).orderBy("_h", *key_cols).offset(left).limit(1).first()
        row = F.struct(*(F.lit(first[c]).cast(df.schema[c].dataType).alias(c) for c in key_cols))
        near = (full < first["_h"]) | ((full == first["_h"]) & (F.struct(*key_cols) < row))  # few rows get here
        begins = first["_h"][:KEPT]
        before = F.when(F.col("_h") < begins, True).when(F.col("_h") > begins, False).otherwise(near)
        label = F.when(before, F.lit("train")).otherwise(F.lit("test"))
    return h.withColumn("split", label).drop("_h")
