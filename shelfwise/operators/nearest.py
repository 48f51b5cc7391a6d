"""Exact top-k neighbours of sparse vectors, with bounds that spare most pairs of a hot feature.

``cooccurrence`` makes every pair of rows that share a feature; a feature in a third of the rows makes d * d / 2 of them. Here:

1. Rows with equal vectors are one class. Neighbours are found between classes and expanded at the end: the k + 1 smallest
   members of the best k + 1 classes hold the k best neighbours of every member.
2. Features of at most ``hot`` classes make all their pairs. A hotter feature pairs its classes only with its champions: those
   with the largest share value / norm, k + 2 of them and, near the cut, k + 2 of every (value, norm).
3. The (k + 1)-th best of these sums is a lower bound ``least`` for each class. A pair of two classes with hot features may gain up to
   the product of their hot parts' lengths; it is summed in full if that lets it reach ``least``.
4. What a class could share with nobody but non-champions of its hot features is at most the sum of share * cut. Where that is
   below ``least`` the class is closed. An open one meets the classes of its hot features whose hot part is long enough, found
   by cells of that length, so the join makes only pairs that the bound allows.

Everything is an equi-join or an aggregation. Pairs are made in the task of their first class and are
not shuffled (``_sums``). Above ``PASS_PAIRS`` pairs, or four an entry, the lists of the features are written once and classes take turns: a pass sends the
lists to its share of the classes, writes what it finds and removes its shuffle files. Ranks compare integers,
floor(similarity * scale), then the other id; bounds keep a margin of one unit and more, so no tie is lost.

Values must be whole and not negative; (row, feature) pairs unique. Null rows, features and values and zeros are left out; a row of
zeros has no neighbour. Two 64-bit hashes of the entries, their number and squared norm stand for a vector's identity.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.exprs import NANO, smallest_type
from shelfwise.operators.ranking import top_k_per_group
from shelfwise.sources.sinks import write_table

HOT = 512  # classes of a feature up to which all its pairs are made
CELLS = 64  # cells of the hot part's length, as a share of the longest
PER_TASK = 1 << 21  # pairs summed in one task, in the mean; a champion with more is dealt over several
MOST_TASKS = 20_000
PASS_PAIRS = 1 << 29  # pairs of one pass, in the mean
BAND = 1e-6  # shares within this part below the cut count as near it


def _classes(entries: DataFrame, cosine: bool) -> DataFrame:
    """(r, rep, size, norm): the class of every row, named by its smallest row."""
    x = entries.groupBy("r").agg(F.bit_xor(F.xxhash64("c", "v")).alias("a"), F.bit_xor(F.xxhash64(F.lit(7), "c", "v")).alias("b"),
                                 F.count(F.lit(1)).alias("m"), F.sum(F.col("v") * F.col("v")).alias("n2"))
    key = ["a", "b", "m", "n2"]
    named = x.groupBy(*key).agg(F.min("r").alias("rep"), F.count(F.lit(1)).alias("size"))
    return x.join(named, key).select("r", "rep", "size", "n2", (F.sqrt(F.col("n2").cast("double")) if cosine else F.lit(1.0)).alias("norm"))


def _lists(df: DataFrame, is_hot: bool, *on: str) -> DataFrame:
    """The classes of a feature as arrays; without hot features their parts' lengths are all 0 and left out."""
    m = df.groupBy(*on).agg(F.collect_list(F.struct("r", "v", "n2", *(["h"] if is_hot else []), "shares")).alias("m"))
    return m.select(*on, *(F.col(f"m.{a}").alias(b) for a, b in (("r", "ys"), ("v", "vs"), ("n2", "ns"), ("shares", "ss"), *([("h", "hs")] if is_hot else []))))


def _sums(rare: DataFrame, hot: DataFrame | None, champions: DataFrame | None, cosine: bool, kind: str, tasks: int, passes: int) -> list[DataFrame]:
    """(x, y, nx, ny, dot, rare, spread) both ways, a table for each pass: the sums over rare features and champions, and what hot features may add.

    ``rare`` has the lists of the rare features. They travel once for each class x that they hold to the task of x; the pairs are made and summed there.
    A champion meets every class of its hot feature: those are dealt over ``shares`` tasks by y. ``hot`` is None where no feature is.
    """
    names = ["ys", "vs", "ns", *(["hs"] if hot is not None else [])]
    own = rare.select(*rare.columns, F.posexplode("ys").alias("k", "x"))
    rows = own.select("x", *(F.get(a, F.col("k")).alias(b) for a, b in (("vs", "vx"), ("ns", "nx"), *([("hs", "hx")] if hot is not None else []), ("ss", "shares"))),
                      *names, F.lit(True).alias("is_rare"))
    mine = lambda df, n, x: df if passes == 1 else df.filter(F.pmod(F.xxhash64(F.lit("pass"), F.col(x)), F.lit(passes)) == n)
    if hot is not None:
        pieces = hot.filter("not champion").withColumn("piece", F.pmod(F.xxhash64("r"), F.ceil(F.col("d") / HOT)).cast("int"))
        of_champions, of_pieces = _lists(champions, True, "c"), _lists(pieces, True, "c", "piece")

    def met(df: DataFrame, others: DataFrame) -> DataFrame:
        return df.join(others, "c").select(F.col("r").alias("x"), F.col("v").alias("vx"), F.col("n2").alias("nx"), F.col("h").alias("hx"), "shares",
                                           *names, F.lit(False).alias("is_rare"))

    def one(n: int) -> DataFrame:
        met_rows = mine(rows, n, "x")
        if hot is not None:
            turn = mine(hot, n, "r")
            met_rows = met_rows.unionByName(met(turn, of_champions)).unionByName(met(turn.filter("champion"), of_pieces))
        return _summed(met_rows, names, cosine, kind, tasks)
    return [one(n) for n in range(passes)]


def _summed(rows: DataFrame, names: list[str], cosine: bool, kind: str, tasks: int) -> DataFrame:
    """The sums of ``_sums`` over the rows (x, its value and norm, the lists it meets)."""
    h = "hs" in names
    lengths = ["hx"] if h else []
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    at = F.filter(F.sequence(F.lit(0), F.size("ys") - 1), lambda k: F.pmod(F.xxhash64(F.get("ys", k)), F.col("shares")) == F.col("part"))
    mine = lambda name: F.when(F.col("shares") == 1, F.col(name)).otherwise(F.transform("at", lambda k: F.get(name, k))).alias(name)
    rows = rows.withColumn("at", F.when(F.col("shares") > 1, at)).select("x", "vx", "nx", *lengths, "part", "is_rare", *map(mine, names))
    rows = rows.repartition(tasks, "x", "part").select("x", "vx", "nx", *lengths, "part", "is_rare", *names[1:], F.posexplode("ys").alias("p", "y"))
    of = lambda name: F.get(name, F.col("p"))
    product = F.col("vx").cast("long") * F.col("vy").cast("long")
    s = rows.filter("x <> y").select("x", "part", "y", "nx", *lengths, "vx", "is_rare", of("vs").alias("vy"), of("ns").alias("ny"), *([of("hs").alias("hy")] if h else [])).groupBy(
        "x", "part", "y", "nx", "ny", *(["hx", "hy"] if h else [])).agg(F.sum(product).alias("dot"), F.sum(F.when(F.col("is_rare"), product).otherwise(0)).alias("rare"))
    root = lambda x: (F.sqrt(F.col(x).cast("double")) if cosine else F.lit(1.0)).alias(x)
    return s.select(F.col("x").cast(kind).alias("x"), F.col("y").cast(kind).alias("y"), root("nx"), root("ny"), "dot", "rare", (F.col("hx") * F.col("hy") if h else F.lit(0.0)).alias("spread"))


def pruned_pairs(entries: DataFrame, k: int, scale: float, cosine: bool, hot: int, per_task: int = PER_TASK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, nearest, candidates): classes of the rows, the best k + 1 classes (x, y, dot, key) of each, the pairs summed in full."""
    classes = write_table(_classes(entries, cosine), "nearest-classes")
    e = entries.join(classes.filter("r = rep").select("r", "norm", "n2"), "r")
    degree = e.groupBy("c").agg(F.count(F.lit(1)).alias("d")).filter(F.col("d") > hot).select("c", "d", F.lit(True).alias("is_hot"))
    e = e.join(degree, "c", "left").withColumn("share", F.col("v") / F.col("norm"))
    parts = e.filter("is_hot").groupBy("r").agg(F.sqrt(F.sum(F.col("share") * F.col("share"))).alias("h"))
    e = write_table(e.join(parts, "r", "left").withColumn("h", F.coalesce("h", F.lit(0.0))), "nearest-entries")
    # a few numbers that choose types and the number of tasks, never the result
    f = e.agg(F.min("r").alias("first"), F.max("r").alias("last"), F.max("v").alias("v"), F.max("n2").alias("n2"), F.count(F.lit(1)).alias("n"), F.max("h").alias("h")).first()
    pairs = e.groupBy("c").agg(F.count(F.lit(1)).alias("m")).agg(F.sum(F.col("m").cast("double") * F.least("m", F.lit(hot)))).first()[0] or 0.0
    is_hot = bool(f.h)
    passes = max(1, math.ceil(pairs / max(PASS_PAIRS, 4 * f.n)))
    tasks = min(max(int(pairs / passes / PER_TASK) + 1, int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))), MOST_TASKS)
    kind, long = e.schema["r"].dataType, T.LongType()
    types = {"r": smallest_type(kind, f["first"], f["last"]), "v": smallest_type(long, 0, f.v), "n2": smallest_type(long, 0, f.n2)}
    rare, warm = e.filter("is_hot is null"), e.filter("is_hot")

    cut = top_k_per_group(warm.select("c", "r", "share"), ["c"], [F.col("share").desc(), F.col("r")], k + 2).groupBy("c").agg(F.min("share").alias("cut"))
    near = warm.join(cut, "c").filter(F.col("share") >= F.col("cut") * (1 - BAND))
    champions = write_table(top_k_per_group(near, ["c", "v", "norm"], [F.col("r")], k + 2).drop("rank"), "nearest-champions")
    warm = warm.join(champions.select("c", "r", F.lit(True).alias("champion")), ["c", "r"], "left").withColumn(
        "champion", F.coalesce("champion", F.lit(False))).join(champions.groupBy("c").agg(F.first("cut").alias("cut")), "c")
    warm = write_table(warm, "nearest-hot")

    key = lambda dot: F.floor(F.col(dot).cast("double") / (F.col("nx") * F.col("ny")) * F.lit(scale)).cast("long")
    loads = champions.groupBy("r").agg(F.ceil(F.sum("d") / per_task).cast("int").alias("shares")).filter("shares > 1")
    # the length of a hot part as a bound in single precision: never too short, and 0 only where it is
    length = {"h": (F.col("h") * (1 + 1e-6)).cast("float")}
    small = lambda df: df.join(loads, "r", "left").withColumn("shares", F.coalesce("shares", F.lit(1))).withColumns(
        {x: F.col(x).cast(t) for x, t in types.items()} | length)

    def met(rare: DataFrame) -> list[DataFrame]:
        lists = _lists(small(rare), is_hot, "c")
        if passes > 1:  # read in every pass
            lists = write_table(lists, "nearest-lists")
        return _sums(lists, *((small(warm), small(champions)) if is_hot else (None, None)), cosine, kind.simpleString(), tasks, passes)

    best = lambda sums: top_k_per_group(sums.withColumn("key", key("dot")), ["x"], [F.col("key").desc(), F.col("y")], k + 1)
    top = reduce(DataFrame.unionByName, [write_table(best(sums), "nearest-first") for sums in met(rare)])  # one after the other
    least = top.groupBy("x").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).select(
        "x", F.when(F.col("n") > k, F.col("least")).otherwise(-1).alias("least"))
    if passes > 1:
        least = write_table(least, "nearest-least")
    exact = top.filter("spread = 0").select("x", "y", "dot", "key")

    above = lambda value: F.ceil(value * F.lit(scale) * (1 + 1e-12)).cast("long") + 1  # noqa: E731  a key that no rounding passes
    reach = above(F.col("rare").cast("double") / (F.col("nx") * F.col("ny")) + F.col("spread"))
    found = [part.filter("spread > 0").join(least, "x").filter(reach >= F.col("least")).select("x", "y") for part in met(rare.filter("h > 0"))] if is_hot else []
    if passes > 1:
        found = [write_table(x, "nearest-summed") for x in found]
    if not is_hot:  # every pair is summed in full
        return classes, exact, exact.select("x", "y").limit(0)
    summed = reduce(DataFrame.unionByName, found)

    longest = warm.select(F.max("h")).scalar()
    own = warm.groupBy("r", "h", "norm").agg(
        F.sum(F.col("share") * F.col("cut")).alias("bound"), F.max(F.col("share") * F.col("cut") * (1 - BAND)).alias("alone"),
        F.count(F.lit(1)).alias("m"))
    own = own.join(least.withColumnRenamed("x", "r"), "r", "left").withColumn("least", F.coalesce("least", F.lit(-1)))
    own = own.withColumn("longest", longest)
    stays = (above(F.col("bound")) >= F.col("least")) & (above(F.col("h") * F.col("longest")) >= F.col("least")) & (
        (F.col("m") > 1) | (above(F.col("alone")) >= F.col("least")))
    cell = lambda h: F.least(F.floor(h / F.col("longest") * CELLS), F.lit(CELLS - 1)).cast("int")
    # y's hot part must have at least this length; one cell of margin
    short = F.greatest(F.floor((F.col("least") - 2) / F.lit(scale) / F.col("h") / F.col("longest") * CELLS) - 1, F.lit(0)).cast("int")
    asks = own.filter(stays & (short < CELLS)).select("r", "least", "h", F.explode(F.sequence(short, F.lit(CELLS - 1))).alias("cell"))
    asks = asks.join(warm.select("r", "c"), "r").select(F.col("r").alias("x"), "c", "cell", "least", F.col("h").alias("hx"))
    there = warm.withColumn("longest", longest).select("c", cell(F.col("h")).alias("cell"), F.col("r").alias("y"), F.col("h").alias("hy"))
    rest = asks.join(there, ["c", "cell"]).filter((F.col("x") != F.col("y")) & (above(F.col("hx") * F.col("hy")) >= F.col("least"))).select("x", "y")

    candidates = write_table(summed.unionByName(rest).distinct(), "nearest-candidates")
    left = e.select(F.col("r").alias("x"), "c", F.col("v").alias("v1"), F.col("norm").alias("nx"))
    right = e.select(F.col("r").alias("y"), "c", F.col("v").alias("v2"), F.col("norm").alias("ny"))
    full = candidates.join(left, "x").join(right, ["y", "c"]).groupBy("x", "y", "nx", "ny").agg(F.sum(F.col("v1") * F.col("v2")).alias("dot"))
    found = exact.unionByName(full.select("x", "y", "dot", key("dot").alias("key")))
    return classes, top_k_per_group(found, ["x"], [F.col("key").desc(), F.col("y")], k + 1).drop("rank"), candidates


def nearest(entries: DataFrame, k: int, row: str, feature: str, value: str, other: str, cosine: bool = True, hot: int = HOT) -> DataFrame:
    """The k most similar rows of every row: row, other, dot, sim, nano, rank (1-based), by nano desc, then other.

    ``cosine``: sim = dot / (norm * norm) and nano = floor(sim * 1e9); else both are the inner product itself.
    """
    scale = float(NANO) if cosine else 1.0
    e = entries.select(F.col(row).alias("r"), F.col(feature).alias("c"), F.col(value).cast("long").alias("v")).dropna().filter("v > 0")
    classes, best, _ = pruned_pairs(e, k, scale, cosine, hot)
    reps = classes.filter("r = rep").select("rep", "size", "norm")
    squares = e.join(reps.filter("size > 1").select(F.col("rep").alias("r"), "norm"), "r").groupBy("r", "norm").agg(
        F.sum(F.col("v") * F.col("v")).alias("dot"))
    own = squares.select(F.col("r").alias("x"), F.col("r").alias("y"), "dot", F.floor(
        F.col("dot").cast("double") / (F.col("norm") * F.col("norm")) * F.lit(scale)).cast("long").alias("key"))
    members = top_k_per_group(classes.select("rep", "r"), ["rep"], [F.col("r")], k + 1).select(F.col("rep").alias("y"), F.col("r").alias("other"))
    lists = top_k_per_group(best.unionByName(own).join(members, "y"), ["x"], [F.col("key").desc(), F.col("other")], k + 1)
    lists = lists.join(reps.select(F.col("rep").alias("y"), F.col("norm").alias("ny")), "y")
    met = classes.select("r", F.col("rep").alias("x"), F.col("norm").alias("nx")).join(lists, "x").filter(F.col("r") != F.col("other"))
    w = Window.partitionBy("r").orderBy("rank")  # at most k + 1 rows
    met = met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    sim = F.col("dot").cast("double") / (F.col("nx") * F.col("ny"))
    return met.select(F.col("r").alias(row), F.col("other").alias(other), "dot", sim.alias("sim"), F.col("key").alias("nano"), "rank")
