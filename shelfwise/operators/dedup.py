"""Deduplication and set operations.

Keep-first / keep-last are aggregates (``min``/``max`` of a struct whose leading fields are the
sequence columns), not windows: the aggregate combines map-side, so a key holding a third of
all rows never sorts in one task, and the chosen row is deterministic.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], carry: Sequence[str] | None,
          last: bool) -> DataFrame:
    carry = [c for c in (carry if carry is not None else df.columns) if c not in keys]
    fields = list(order_cols) + [c for c in carry if c not in order_cols]
    packed = F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)])
    agg = (F.max if last else F.min)(packed).alias("_best")
    out = df.groupBy(*keys).agg(agg)
    sel = [F.col(k) for k in keys] + [F.col(f"_best._f{fields.index(c)}").alias(c) for c in carry]
    return out.select(*sel)


def keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
               carry: Sequence[str] | None = None) -> DataFrame:
    """The first row per key in ``order_cols`` order."""
    return _keep(df, keys, order_cols, carry, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
              carry: Sequence[str] | None = None) -> DataFrame:
    """The last row per key in ``order_cols`` order."""
    return _keep(df, keys, order_cols, carry, last=True)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """D04."""
    return df.select(*cols).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """D05."""
    return df.distinct()


def append_union(existing: DataFrame, incoming: DataFrame, order_col: str, seq_col: str = "_seq") -> DataFrame:
    """Existing rows first, then incoming; ``seq_col`` = (source, order_col) records that order."""
    a = existing.withColumn(seq_col, F.struct(F.lit(0).alias("src"), F.col(order_col).alias("pos")))
    b = incoming.withColumn(seq_col, F.struct(F.lit(1).alias("src"), F.col(order_col).alias("pos")))
    return a.unionByName(b, allowMissingColumns=True)


def key_difference(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Distinct keys of ``left`` absent from ``right``."""
    right_key = right_key or left_key
    r = right.select(F.col(right_key).alias(left_key)).distinct()
    return left.select(left_key).distinct().join(r, left_key, "left_anti")


def overlap(a, b):
    """U04/U05 on two array columns: intersection size and Jaccard (NULL when either list is empty)."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    jac = F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(None).cast("double")).otherwise(inter / union)
    return inter, jac
