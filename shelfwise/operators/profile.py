"""Aggregations and profiling (A01-A18). Everything is a partial+final aggregate;
global constants reach row expressions as scalar subqueries, never as cross joins."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.exprs import bayesian_average
from shelfwise.operators.encode import global_position, running_sum

PRIOR_WEIGHT = 10  # C of the Bayesian average
MIN_SUPPORT = 10


def counts(df: DataFrame, distinct_cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Row count and distinct counts (exact, or HyperLogLog++ when ``exact`` is False)."""
    fn = (lambda c: F.countDistinct(c)) if exact else (lambda c: F.approx_count_distinct(c))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[fn(c).alias(f"n_{c}") for c in distinct_cols])


def max_ids(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A02."""
    return df.agg(*[F.max(c).alias(f"max_{c}") for c in cols])


def item_lists(df: DataFrame, key: str, item: str) -> DataFrame:
    """Items per key as long rows (key, item, position from 0 in item order).

    One row per item, whatever a key holds: the position is the global one less that of the key's first row, so a
    key with a third of the rows is spread over range partitions. (key, item) must be unique.
    """
    placed = global_position(df.select(key, item), [key, item], "_at")
    first = placed.groupBy(key).agg(F.min("_at").alias("_first"))
    return placed.join(first, key).select(key, item, (F.col("_at") - F.col("_first")).alias("position"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """A04/A18."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def mean_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and count per key in one aggregate (the reference joins two aggregates)."""
    return df.groupBy(key).agg(F.avg(value).alias("mean_rating"), F.count(value).alias("n_ratings"))


def global_stats(df: DataFrame, value: str) -> DataFrame:
    """A06."""
    return df.agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def bayesian_ranking(df: DataFrame, key: str, value: str, prior_weight: int = PRIOR_WEIGHT,
                     min_support: int = MIN_SUPPORT) -> DataFrame:
    """Bayesian average per key with the global mean as prior; keys below support dropped."""
    m = df.select(F.avg(value)).scalar()
    stats = mean_count(df, key, value)
    return (stats.withColumn("bayesian_avg", bayesian_average("mean_rating", "n_ratings", prior_weight, m))
            .filter(F.col("n_ratings") >= min_support))


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max; exact at every size.

    The quartiles come from the histogram of values, which Spark aggregates map-side: a global position of each
    distinct value by range partition, then the running count of rows up to it. No task holds all values.
    An empty column has count 0 and nulls.
    """
    c = F.col(col)
    stats = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                   F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
    hist = df.select(c.cast("double").alias("x")).filter("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    upto = running_sum(hist, "x", "n", "upto")  # rows (upto - n) .. (upto - 1), counted from 0, have the value x
    last = (df.select(F.count(c)).scalar() - 1).cast("double")
    pick, names = [], ("q25", "q50", "q75")
    for q, name in zip((0.25, 0.5, 0.75), names):
        at = last * F.lit(q)
        for side, k in (("low", F.floor(at)), ("high", F.ceil(at))):
            here = (F.col("upto") > k) & (F.col("upto") - F.col("n") <= k)
            pick.append(F.max(F.when(here, F.col("x"))).alias(f"{name}_{side}"))
    ends = upto.agg(*pick)
    share = [last * F.lit(q) - F.floor(last * F.lit(q)) for q in (0.25, 0.5, 0.75)]
    quart = ends.select(F.struct(*[(F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * w).alias(n)
                                   for n, w in zip(names, share)])).scalar()
    return stats.withColumn("_q", quart).select("count", "mean", "std", "min", *[F.col("_q")[n].alias(n) for n in names], "max")


def null_profile(df: DataFrame) -> DataFrame:
    """A10: per column, nulls, rows and percentage of cells; one pass then unpivot."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.sum(F.col(c).isNull().cast("long")).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column_name, n_null)")
    return long.select("column_name", F.col("n_null").cast("long").alias("n_null"),
                       F.col("_rows").alias("n_rows"),
                       F.round(F.col("n_null") * 100.0 / F.col("_rows"), 6).alias("pct_null"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key."""
    d = df.select(*keys).distinct()
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", d.select(F.count(F.lit(1))).scalar().alias("n_distinct")).withColumn(
        "n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def string_stats(df: DataFrame, col: str) -> DataFrame:
    """Length statistics and blank count."""
    ln = F.length(col)
    return df.agg(F.min(ln).alias("min_len"), F.max(ln).alias("max_len"), F.round(F.avg(ln), 6).alias("avg_len"),
                  F.sum((F.trim(col) == "").cast("long")).alias("n_blank"),
                  F.sum(F.col(col).isNull().cast("long")).alias("n_null"))


def mean_by(df: DataFrame, index: str, columns: str, value: str) -> DataFrame:
    """A13, long form: mean(value) per index and column value, for every value there is."""
    return df.groupBy(index, columns).agg(F.avg(value).alias("mean"))


def pivot_mean(df: DataFrame, index: str, columns: str, value: str, values: Sequence, fill: float = 0.0) -> DataFrame:
    """A13, wide form: index x ``values`` of mean(value), missing -> fill.

    ``n_unlisted`` counts an index's rows whose column value is not in ``values``: none vanishes unseen.
    """
    values = list(values)
    listed = F.col(columns).isin(values) if values else F.lit(False)
    cells = [F.coalesce(F.avg(F.when(F.col(columns) == v, F.col(value))), F.lit(fill)).alias(str(v)) for v in values]
    return df.groupBy(index).agg(*cells, F.sum((~F.coalesce(listed, F.lit(False))).cast("long")).alias("n_unlisted"))


def rating_sums(df: DataFrame, key: str, value: str = "rating") -> DataFrame:
    """Sum and squared norm per key."""
    v = F.col(value)
    return df.groupBy(key).agg(F.sum(v).cast("long").alias("rating_sum"), F.sum(v * v).cast("long").alias("norm2"))


def audit(before: DataFrame, after: DataFrame, stage: str) -> DataFrame:
    """Rows in, out and removed by a stage (two scalar aggregates)."""
    rin = before.select(F.count(F.lit(1))).scalar()
    rout = after.select(F.count(F.lit(1))).scalar()
    return after.sparkSession.range(1).select(F.lit(stage).alias("stage"), rin.alias("rows_in"),
                                              rout.alias("rows_out"), (rin - rout).alias("rows_removed"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts sorted by value."""
    return value_counts(df, col).orderBy(col)
