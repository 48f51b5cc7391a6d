"""Top-k, ordered limits and seeded sampling."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.exprs import as_col, seeded_hash


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, k: int,
                    rank_col: str = "rank", zero_based: bool = False) -> DataFrame:
    """The k first rows of every group under a total order.

    ``row_number() <= k`` sits directly above the window so the planner inserts a
    partial ``WindowGroupLimit`` before the shuffle: no group is ever sorted whole.
    """
    w = Window.partitionBy(*group_cols).orderBy(*[as_col(c) for c in order_cols])
    out = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
    if zero_based:
        out = out.withColumn(rank_col, (F.col(rank_col) - 1).cast("int"))
    return out


def top_n(df: DataFrame, order_cols: Sequence, n: int) -> DataFrame:
    """Global top-n (TakeOrderedAndProject: per-partition top-n, then merge)."""
    return df.orderBy(*[as_col(c) for c in order_cols]).limit(n)


def sample_keys(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N distinct keys without replacement (all of them when fewer), seeded and engine-independent."""
    keys = df.select(key).distinct()
    return keys.withColumn("_h", seeded_hash(seed, key)).orderBy("_h", key).limit(n).drop("_h")


def with_order_key(df: DataFrame, seed: int, cols: Sequence[str], name: str = "order_key") -> DataFrame:
    return df.withColumn(name, seeded_hash(seed, *cols))


def desc(c) -> Column:
    return as_col(c).desc()
