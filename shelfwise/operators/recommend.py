"""Recommenders over neighbour and feature tables.

Every operator scores all users at once: a per-user loop of the reference becomes one join plus
one aggregation. Scores are exact integers ``sum(nano * rating)`` so ranking is engine-independent.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.exprs import NANO, safe_divide, smallest_type
from shelfwise.operators.inner_product import block_of, dot, quantile_cells, top_inner_products
from shelfwise.operators.ranking import top_k_per_group
from shelfwise.sources.sinks import write_bucketed, write_table

RATINGS_PER_TASK = 1 << 16  # ratings whose candidates one task sums
PASS_CELLS = 1 << 28  # candidates of the ratings of one pass, in the mean


def _scoring_tasks(interactions: DataFrame, ratings: int | None = None) -> int:
    """The number of tasks follows the ratings; a rating brings a list of some twenty rows at most."""
    n = interactions.select(F.count(F.lit(1))).first()[0] if ratings is None else ratings
    return max(n // RATINGS_PER_TASK + 1, int(interactions.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def in_passes(passes: int, user_col: str, name: str, made: Callable[[Callable[[DataFrame], DataFrame]], DataFrame]) -> DataFrame:
    """``made(own)`` for every share of the users, one after the other, each written before the next starts and its shuffle files removed;
    ``own`` keeps a share's rows. For results whose rows depend on the rows of their user and on whole other tables."""
    if passes <= 1:
        return made(lambda df: df)
    share = F.pmod(F.xxhash64(F.lit("pass"), user_col), F.lit(passes))
    return reduce(DataFrame.unionByName, [write_table(made(lambda df: df.filter(share == n)), name) for n in range(passes)])


def _passes(cells: float, ratings: int) -> int:
    return math.ceil(cells / max(PASS_CELLS, 4 * ratings))


def user_item_entries(ratings: DataFrame, user_col: str = "user_id", item_col: str = "book_id",
                      rating_col: str = "rating") -> DataFrame:
    """The sparse user x item matrix as (user, item, rating) entries, duplicates summed.

    The sum is a long for integer ratings; rows without a user or an item are no entry, null ratings add nothing.
    """
    kept = ratings.filter(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
    return kept.groupBy(user_col, item_col).agg(F.coalesce(F.sum(rating_col), F.lit(0)).alias(rating_col))


def score_candidates(interactions: DataFrame, neighbors: DataFrame, user_col: str = "user_id",
                     item_col: str = "book_id", rating_col: str = "rating",
                     other_col: str = "other_id") -> DataFrame:
    """R05 core: score(u, c) = sum over rated b with c in N(b) of nano(b, c) * rating(u, b),
    for items c the user has not rated.

    A rating goes to its user's task once, with the neighbour list of its item as two arrays and the item itself in
    front, which marks the item as rated: candidates are made, summed and ranked there, and no candidate is shuffled.
    """
    return _scored(interactions, _neighbor_lists(neighbors, item_col, other_col), user_col, item_col, rating_col, _scoring_tasks(interactions))


def _neighbor_lists(neighbors: DataFrame, item_col: str, other_col: str) -> DataFrame:
    lists = neighbors.filter(F.col(other_col).isNotNull()).groupBy(item_col).agg(F.collect_list(F.struct(other_col, "nano")).alias("_l"))
    return lists.select(item_col, F.col(f"_l.{other_col}").alias("_js"), F.col("_l.nano").alias("_ns"))


def _scored(interactions: DataFrame, lists: DataFrame, user_col: str, item_col: str, rating_col: str, tasks: int) -> DataFrame:
    kind = interactions.schema[item_col].dataType
    met = interactions.select(user_col, item_col, rating_col).join(lists, item_col, "left").select(
        user_col, F.col(item_col).cast(lists.schema["_js"].dataType.elementType).alias(item_col), rating_col,
        F.coalesce("_js", F.array().cast(lists.schema["_js"].dataType)).alias("_js"), F.coalesce("_ns", F.array().cast(lists.schema["_ns"].dataType)).alias("_ns"))
    rows = met.select(user_col, rating_col, "_ns", F.concat(F.array(item_col), "_js").alias("_js"))
    rows = rows.repartition(tasks, user_col).select(user_col, rating_col, "_ns", F.posexplode("_js").alias("_p", item_col))
    contrib = F.when(F.col("_p") > 0, F.get("_ns", F.col("_p") - 1).cast("long") * F.col(rating_col)).otherwise(F.lit(0).cast("long"))
    agg = rows.groupBy(user_col, item_col).agg(F.sum(contrib).alias("score_nano"), F.min("_p").alias("_p"))
    return agg.filter(F.col("_p") > 0).select(user_col, F.col(item_col).cast(kind).alias(item_col), "score_nano")


def recommend_for_users(interactions: DataFrame, neighbors: DataFrame, n: int = 10, user_col: str = "user_id",
                        item_col: str = "book_id", rating_col: str = "rating", other_col: str = "other_id",
                        zero_based_rank: bool = False) -> DataFrame:
    """Top-n unrated items per user. Columns: user, item, score_nano, score, rank.

    Above ``PASS_CELLS`` candidates the neighbour lists are written once, by item, go on with the smallest integer types, and users are scored
    in passes (``in_passes``), so the disk holds the lists and the candidates of one pass.
    """
    lists, passes = _neighbor_lists(neighbors, item_col, other_col), 1
    ratings = interactions.select(F.count(F.lit(1))).first()[0]
    if ratings > PASS_CELLS // 32:
        lists = write_bucketed(lists, "neighbor_lists", item_col, int(interactions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        # a few numbers that choose types and passes, never the result
        f = lists.agg(F.avg(F.size("_js")).alias("size"), *(m(k(c)).alias(f"{n}{c}") for c in ("_js", "_ns") for n, m, k in (
            ("low", F.min, F.array_min), ("high", F.max, F.array_max)))).first()
        ids = interactions.agg(F.min(item_col).alias("low"), F.max(item_col).alias("high")).first()
        passes = _passes(ratings * ((f.size or 0.0) + 1), ratings)
        ends = [x for x in (f.low_js, f.high_js, ids.low, ids.high) if x is not None]
        js = smallest_type(interactions.schema[item_col].dataType, min(ends, default=None), max(ends, default=None))
        ns = smallest_type(lists.schema["_ns"].dataType.elementType, f.low_ns, f.high_ns)
        lists = lists.select(item_col, F.col("_js").cast(f"array<{js}>").alias("_js"), F.col("_ns").cast(f"array<{ns}>").alias("_ns"))

    def top(own: Callable[[DataFrame], DataFrame]) -> DataFrame:
        scored = _scored(own(interactions), lists, user_col, item_col, rating_col, _scoring_tasks(interactions, ratings // max(passes, 1)))
        return top_k_per_group(scored, [user_col], [F.col("score_nano").desc(), F.col(item_col)], n, zero_based=zero_based_rank)
    return in_passes(passes, user_col, "recommended", top).withColumn("score", F.col("score_nano") / F.lit(float(NANO)))


def popular_items(interactions: DataFrame, n: int, item_col: str = "book_id", rating_col: str = "rating") -> DataFrame:
    """Items by summed rating (Q8: popularity is the sum, not the count), id breaks ties."""
    pop = interactions.groupBy(item_col).agg(F.sum(rating_col).cast("long").alias("popularity"))
    return pop.orderBy(F.col("popularity").desc(), F.col(item_col)).limit(n)


def popularity_fallback(users: DataFrame, interactions: DataFrame, n: int, user_col: str = "user_id",
                        item_col: str = "book_id", rating_col: str = "rating") -> DataFrame:
    """Users without any interaction get the n most popular items.

    The top-n list (at most ``n`` rows, a parameter) reaches every row as one scalar-subquery array
    and is exploded per user: no cross join and no driver round trip.
    """
    top = popular_items(interactions, n, item_col, rating_col)
    ranked = top.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("popularity")).alias("_neg"), F.col(item_col).alias(item_col),
        F.col("popularity").alias("popularity")))).alias("lst")).scalar()
    cold = users.select(user_col).distinct().join(interactions.select(user_col).distinct(), user_col, "left_anti")
    with_list = cold.select(user_col, ranked.alias("_lst"))
    return with_list.select(user_col, F.posexplode("_lst").alias("pos", "p")).select(
        user_col, F.col(f"p.{item_col}").alias(item_col), F.col("p.popularity").alias("popularity"),
        (F.col("pos") + 1).cast("int").alias("rank"))


def predict_user_based(interactions: DataFrame, user_nbrs: DataFrame, n: int = 10, user_col: str = "user_id",
                       item_col: str = "book_id", rating_col: str = "rating",
                       other_col: str = "other_user_id") -> DataFrame:
    """pred(u, i) = sum_v sim(u, v) r(v, i) / sum_v |sim(u, v)| over the k nearest users v.

    A neighbour that did not rate i adds 0 to the numerator and stays in the denominator.
    Only items rated by at least one neighbour can be non-zero; zero predictions are omitted.
    """
    r = interactions.select(F.col(user_col).alias(other_col), item_col, rating_col)
    user_nbrs, passes = _predicted_in(interactions, user_nbrs, user_col)

    def top(own: Callable[[DataFrame], DataFrame]) -> DataFrame:
        nbrs = own(user_nbrs)
        den = nbrs.groupBy(user_col).agg(F.sum(F.abs("sim")).alias("den"))
        num = (nbrs.select(user_col, other_col, "sim").join(r, other_col)
               .select(user_col, item_col, (F.col("sim") * F.col(rating_col)).alias("x"), F.lit(0).alias("rated")))
        rated = own(interactions).select(user_col, item_col, F.lit(0.0).alias("x"), F.lit(1).alias("rated"))
        agg = num.unionByName(rated).groupBy(user_col, item_col).agg(F.sum("x").alias("num"), F.max("rated").alias("rated"))
        pred = (agg.filter(F.col("rated") == 0).join(den, user_col)
                .withColumn("pred", F.round(safe_divide("num", "den"), 6)).select(user_col, item_col, "pred"))
        return top_k_per_group(pred.filter(F.col("pred") > 0), [user_col], [F.col("pred").desc(), F.col(item_col)], n)
    return in_passes(passes, user_col, "predicted", top)


def _predicted_in(interactions: DataFrame, nbrs: DataFrame, key: str) -> tuple[DataFrame, int]:
    """The neighbours, written if their predictions are made in passes, and the number of passes."""
    ratings = interactions.select(F.count(F.lit(1))).first()[0]
    if ratings <= PASS_CELLS // 32:
        return nbrs, 1
    nbrs = write_table(nbrs, "neighbors")
    f = nbrs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys")).first()
    return nbrs, _passes(ratings * (f.n / max(f.keys, 1) + 1) * 4, ratings)  # a prediction is some four times the bytes of a list's cell


def predict_item_based(interactions: DataFrame, item_nbrs: DataFrame, n: int = 10, user_col: str = "user_id",
                       item_col: str = "book_id", rating_col: str = "rating",
                       other_col: str = "other_id") -> DataFrame:
    """pred(u, i) = sum_{j in N_k(i)} sim(i, j) r(u, j) / sum_{j in N_k(i)} |sim(i, j)| for unread i.

    Computed from neighbours x ratings on the neighbour: only items with a rated neighbour are
    non-zero; zero predictions are omitted.
    """
    item_nbrs, passes = _predicted_in(interactions, item_nbrs, item_col)
    den = item_nbrs.groupBy(item_col).agg(F.sum(F.abs("sim")).alias("den"))

    def top(own: Callable[[DataFrame], DataFrame]) -> DataFrame:
        r = own(interactions).select(user_col, F.col(item_col).alias(other_col), rating_col)
        num = (item_nbrs.select(item_col, other_col, "sim").join(r, other_col)
               .select(user_col, item_col, (F.col("sim") * F.col(rating_col)).alias("x"), F.lit(0).alias("rated")))
        rated = own(interactions).select(user_col, item_col, F.lit(0.0).alias("x"), F.lit(1).alias("rated"))
        agg = num.unionByName(rated).groupBy(user_col, item_col).agg(F.sum("x").alias("num"), F.max("rated").alias("rated"))
        pred = (agg.filter(F.col("rated") == 0).join(den, item_col)
                .withColumn("pred", F.round(safe_divide("num", "den"), 6)).select(user_col, item_col, "pred"))
        return top_k_per_group(pred.filter(F.col("pred") > 0), [user_col], [F.col("pred").desc(), F.col(item_col)], n)
    return in_passes(passes, user_col, "predicted", top)


def user_profiles(interactions: DataFrame, features: DataFrame, user_col: str = "user_id",
                  item_col: str = "book_id", rating_col: str = "rating", feature_col: str = "feature",
                  value_col: str = "value") -> DataFrame:
    """profile(u, f) = sum_b r(u, b) w(b, f) / sum_b r(u, b) over all rated books b."""
    tasks = _scoring_tasks(interactions)
    tot = interactions.select(user_col, rating_col).repartition(tasks, user_col).groupBy(user_col).agg(F.sum(rating_col).alias("rsum"))
    # a rating goes to its user's task once, with its book's features as two arrays
    lists = features.groupBy(item_col).agg(F.collect_list(F.struct(feature_col, value_col)).alias("_l")).select(
        item_col, F.col(f"_l.{feature_col}").alias("_fs"), F.col(f"_l.{value_col}").alias("_vs"))
    rows = interactions.select(user_col, item_col, rating_col).join(lists, item_col).select(user_col, rating_col, "_fs", "_vs").repartition(
        tasks, user_col).select(user_col, rating_col, "_vs", F.posexplode("_fs").alias("_p", feature_col))
    num = rows.groupBy(user_col, feature_col).agg(F.sum(F.col(rating_col) * F.get("_vs", F.col("_p"))).alias("num"))
    return num.join(tot, user_col).select(user_col, feature_col,
                                          F.when(F.col("rsum") == 0, F.lit(0.0)).otherwise(
                                              F.col("num") / F.col("rsum")).alias("weight"))


def attach_metadata(ranked: DataFrame, books: DataFrame, item_col: str = "book_id",
                    cols=("title", "authors")) -> DataFrame:
    """Ranked ids joined to metadata; rank order is carried by the rank column."""
    return ranked.join(books.select(item_col, *cols), item_col, "inner")


UNIT = 10_000  # feature values and cosine shares as integers
FINE = 1_000  # parts of a unit in profile weights
SIGNATURES = 512  # slots of sparse features among the blocks of books
GRID = (0.3, 0.55, 0.75, 0.86, 0.92, 0.96, 0.985)  # quantiles that cut a dense feature; high values decide, so they are cut finer


def _names(features: DataFrame, feature_col: str) -> list[str]:
    """The feature names in order; their number follows the operators' parameters (top authors, categories, numeric columns)."""
    return [r[0] for r in features.select(feature_col).distinct().orderBy(feature_col).collect()]


def _dense(cells: DataFrame, key: str, names: list[str], value: str) -> DataFrame:
    """(key, vector): the long rows of a key as one array over all ``names``, missing ones 0."""
    found = cells.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("feature", value))).alias("m"))
    every = F.array(*(F.lit(x) for x in names))
    return found.select(key, F.transform(every, lambda x: F.coalesce(F.try_element_at("m", x), F.lit(0).cast("long"))).alias("vector"))


def content_recommendations(interactions: DataFrame, features: DataFrame, n: int = 10, dense: Sequence[str] = (),
                            user_col: str = "user_id", item_col: str = "book_id", rating_col: str = "rating") -> DataFrame:
    """The n unrated books whose features are most like those of the books a user rated: user, item, score, sim, rank.

    The profile (R12) is the rating-weighted mean of the rated books' features; a book's score is its cosine with it. Everything is
    integer, so any engine gets the same order: values in ``UNIT``ths, profile weights in ``UNIT * FINE``ths, book shares
    value / norm in ``UNIT``ths. The best books are found by bounds (``inner_product``): books of one block have the same sparse
    features and are near in the ``dense`` ones (numeric features in 0..1, which every book may have). ``features`` is
    (item, feature, value), unique, not negative. Users without a rated book with features have no profile and no row; books that share
    nothing with a profile score 0 and fill its list; a profile of zeros has no ``sim``.
    """
    v = features.select(item_col, "feature", F.floor(F.col("value") * UNIT + 0.5).cast("long").alias("v"))
    norms = v.groupBy(item_col).agg(F.sqrt(F.sum(F.col("v") * F.col("v")).cast("double")).alias("norm")).filter("norm > 0")
    shares = v.join(norms, item_col).select(item_col, "feature", F.floor(
        F.try_divide(F.col("v") * float(UNIT), F.col("norm")) + 0.5).cast("long").alias("c"))
    names = _names(features, "feature")
    books = _dense(shares, item_col, names, "c")
    at = {x: i for i, x in enumerate(names)}
    flags = F.transform("vector", lambda x, i: (x > 0) & ~i.isin([at[d] for d in dense if d in at]) if dense else x > 0)
    grid = quantile_cells(books, {at[d]: GRID for d in dense if d in at})
    books = books.withColumn("flags", F.transform(flags, lambda x: x.cast("int")))
    # the most frequent sparse feature sets have a slot each, all others share the last one
    slots = books.groupBy("flags").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "flags").limit(SIGNATURES - 1)
    slots = slots.agg(F.array_sort(F.collect_list("flags")).alias("known")).scalar()
    slot = F.array_position(F.col("known"), F.col("flags"))
    books = books.withColumn("known", slots).withColumn("block", block_of((F.when(slot > 0, slot - 1).otherwise(SIGNATURES - 1), SIGNATURES), *grid))
    books = books.select(item_col, "vector", "block")
    rated = interactions.select(user_col, item_col, F.col(rating_col).cast("long").alias("r")).dropna()
    sums = rated.groupBy(user_col).agg(F.sum("r").alias("total"), F.count(F.lit(1)).alias("spare"))
    weights = (rated.join(v, item_col).groupBy(user_col, "feature").agg(F.sum(F.col("r") * F.col("v")).alias("num"))
               .join(sums, user_col).filter("total > 0")
               .select(user_col, "feature", F.expr(f"num * {FINE} div nullif(total, 0)").alias("w")))
    who = write_table(_dense(weights, user_col, names, "w").join(sums.select(user_col, "spare"), user_col), "profiles")  # read for lists and lengths
    length = who.select(user_col, F.sqrt(dot(F.col("vector"), F.col("vector"), "long").cast("double")).alias("length"))
    top = top_inner_products(who, books, rated, n, user_col, item_col)
    sim = F.try_divide(F.col("score"), F.col("length") * float(UNIT))
    return top.join(length, user_col).select(user_col, item_col, "score", F.round(sim, 6).alias("sim"), "rank")


def hybrid(left: DataFrame, right: DataFrame, n: int = 10, weights: tuple[int, int] = (1, 1), user_col: str = "user_id",
           item_col: str = "book_id", score_col: str = "score") -> DataFrame:
    """Two score tables (user, item, positive integer score) in one: user, item, left_part, right_part, score, rank.

    Each side's scores become millionths of the user's best on that side; an item or a user that one side does not know has 0
    there. The weighted sum ranks, ties go to the smaller item.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        best = df.groupBy(user_col).agg(F.max(score_col).alias("best")).filter("best > 0")
        return df.join(best, user_col).select(user_col, item_col, F.expr(f"{score_col} * 1000000L div nullif(best, 0)").alias(name))
    both = side(left, "left_part").join(side(right, "right_part"), [user_col, item_col], "full_outer").na.fill(0, ["left_part", "right_part"])
    both = both.withColumn("score", F.col("left_part") * weights[0] + F.col("right_part") * weights[1])
    return top_k_per_group(both, [user_col], [F.col("score").desc(), F.col(item_col)], n)
