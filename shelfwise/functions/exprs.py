"""Column expressions shared by the operators. All are native Spark expressions (codegen'd)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "NANO", "WORD_PATTERN", "as_col", "try_double", "seeded_hash", "nano", "tokens",
    "bayesian_average", "dense_cosine", "safe_divide", "rating_from_quantity", "smallest_type",
]

# Fixed values that must equal the reference behaviour.
NANO = 1_000_000_000  # similarities are ranked and summed as floor(sim * 1e9) integers
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"  # word tokens of two or more characters


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c) -> Column:
    """Text to number, bad values become NULL; NaN is normalised to NULL."""
    v = F.trim(as_col(c).cast("string")).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def seeded_hash(seed, *cols) -> Column:
    """Engine-independent pseudo-random order key: md5('seed|k1|k2...')."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_col(c).cast("string") for c in cols]))


def nano(sim) -> Column:
    """Integer similarity used for exact sums and total orders."""
    return F.floor(as_col(sim) * F.lit(NANO)).cast("long")


def tokens(text) -> Column:
    """Lower-case word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(WORD_PATTERN), 0)


def safe_divide(num, den) -> Column:
    """Q16: a zero denominator gives NULL instead of NaN."""
    return F.try_divide(as_col(num), as_col(den))


def bayesian_average(mean, count, prior_weight, prior_mean) -> Column:
    """(n * r + C * m) / (n + C)."""
    n = as_col(count)
    return (n * as_col(mean) + F.lit(prior_weight) * as_col(prior_mean)) / (n + F.lit(prior_weight))


def dense_cosine(x, y) -> Column:
    """Cosine of two equal-length numeric arrays; 0 when either norm is 0."""
    x, y = as_col(x), as_col(y)
    dot = F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)
    nx = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    ny = F.sqrt(F.aggregate(y, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return F.when((nx == 0) | (ny == 0), F.lit(0.0)).otherwise(dot / (nx * ny))


def rating_from_quantity(q) -> Column:
    """Test-data rating 1..5 from a quantity 1..50."""
    return (F.floor((as_col(q) - 1) / 10) + 1).cast("int")


def smallest_type(kind: T.DataType, low, high) -> str:
    """The smallest type for integers between ``low`` and ``high``; other kinds stay."""
    if not isinstance(kind, T.IntegralType) or low is None or high is None:
        return kind.simpleString()
    return next(t for t, bits in (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)) if -(1 << bits) <= low and high < 1 << bits)
