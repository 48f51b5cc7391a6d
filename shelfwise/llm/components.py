"""Connected components of an edge table by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger (large star) or smaller neighbours and itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        out = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        out = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, root) for every node of ``edges`` (a, b) but the roots; root is the smallest node of the component.

    A hub with many neighbours is a hot join key against one row per key; Spark splits it at run time.
    """
    edges = written(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        edges = written(_star(_star(edges, True), False), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
