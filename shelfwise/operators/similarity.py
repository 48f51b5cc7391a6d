"""All-pairs similarity (J12, R03, R07, R09; R02 and R08 are in ``nearest``): a sparse Gram product as a degree-split equi-join.

The product G[i, j] = sum_r v[r, i] * v[r, j] joins the entries with themselves on the row. A row with more than
``sub_block`` entries is dealt into ``ceil(degree / sub_block)`` sub-blocks by column hash and joined sub-block pair by
sub-block pair, on the key (row, lo, hi). So:

* no join key holds more than about ``sub_block`` entries a side, however hot the row; a row of d entries is copied
  d / sub_block times, and the pairs it makes are spread over that many keys squared;
* the pairs are summed by ``groupBy(i, j)`` with map-side combine; a column that is in a third of all rows
  is many (i, j) keys, never one group;
* the work follows the real pairs (the sum of squared degrees), not the number of columns squared, and there is one plan
  at every size and for every parameter: no driver action, no Python, no size switch.

A row of d columns has d * (d - 1) / 2 real pairs; they are all made and none is dropped.

The cosines (``cosine_pairs``) make each pair in both directions and never write pairs to a shuffle: a sub-block of a row travels
once for each of its columns to the task of the column, whole numbers as one number a partner (id, value and squared norm, five bytes for
ratings), else as arrays. There the pairs are made, summed and ranked, so only the k best of a column and a task go on. A column of more than
``PER_TASK`` pairs goes to several tasks, each with its share of the partners. The number of tasks follows the number of pairs. Where the
columns are so few that the same pairs come again and again (64 titles), pairs are summed before the shuffle instead.

Neighbour lists of many pairs are made in passes (``item_neighbors``): the rows' lists are written once, and a pass sends them to its share of the columns
only. Its k best are written and its shuffle files removed before the next one starts, so the disk holds the entries and the pairs of one pass,
``PASS_PAIRS`` or four an entry. Every pair is made in exactly one pass; a column that is dealt over tasks may be in several, and its lists are merged.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.exprs import nano, smallest_type
from shelfwise.operators.nearest import MOST_TASKS, PER_TASK, nearest
from shelfwise.operators.ranking import top_k_per_group
from shelfwise.sources.sinks import write_table

SUB_BLOCK = 512  # entries of one row that meet under one join key
PASS_PAIRS = 1 << 29  # pairs of one pass, in the mean: some 2.6 GB in the shuffle before they are compressed
_LOW = (1 << 32) - 1


def _dealt(entries: DataFrame, sub_block: int) -> DataFrame:
    """The entries with their sub-block ``b`` and the number of sub-blocks ``nb`` of their row (0 and 1 for most)."""
    # only rows above the bound are counted out: at most n / sub_block of them
    heavy = entries.groupBy("r").agg(F.count(F.lit(1)).alias("degree")).filter(F.col("degree") > sub_block).select(
        "r", F.ceil(F.col("degree") / F.lit(sub_block)).cast("int").alias("nb"))
    counted = entries.join(heavy, "r", "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    return counted.withColumn("b", F.pmod(F.xxhash64("c"), F.col("nb")).cast("int"))


def _pairs(entries: DataFrame, sub_block: int) -> DataFrame:
    """(i, j, x, y, ni, nj) per row and column pair i < j; ``entries`` is (r, c, v, norm)."""
    dealt = _dealt(entries, sub_block)
    left = dealt.withColumn("hi", F.explode(F.sequence(F.col("b"), F.col("nb") - 1))).select(
        "r", F.col("b").alias("lo"), "hi", F.col("c").alias("c1"), F.col("v").alias("v1"), F.col("norm").alias("n1"))
    right = dealt.withColumn("lo", F.explode(F.sequence(F.lit(0), F.col("b")))).select(
        "r", "lo", F.col("b").alias("hi"), F.col("c").alias("c2"), F.col("v").alias("v2"), F.col("norm").alias("n2"))
    met = left.join(right, ["r", "lo", "hi"]).filter((F.col("lo") < F.col("hi")) | (F.col("c1") < F.col("c2")))
    first = F.col("c1") < F.col("c2")
    return met.select(F.least("c1", "c2").alias("i"), F.greatest("c1", "c2").alias("j"), F.col("v1").alias("x"), F.col("v2").alias("y"),
                      F.when(first, F.col("n1")).otherwise(F.col("n2")).alias("ni"),
                      F.when(first, F.col("n2")).otherwise(F.col("n1")).alias("nj"))


def _product(entries: DataFrame, wide: bool) -> Column:
    """x * y for the sum: exact (long, or decimal where sums of longs could overflow) for integers, else double."""
    if wide:
        return (F.col("x").cast("decimal(18,0)") * F.col("y").cast("decimal(18,0)")).cast("decimal(28,0)")
    kind = "long" if isinstance(entries.schema["v"].dataType, T.IntegralType) else "double"
    return F.col("x").cast(kind) * F.col("y").cast(kind)


def _packed(first: int, last: int, low: int, high: int, most: int) -> dict | None:
    """How an id, a value and a squared norm share one whole number, or None if they need more than 63 bits."""
    ids, values, norms = (max(int(x).bit_length(), least) for x, least in ((last - first, 1), (high - low, 1), (most, 0)))
    return {"first": first, "low": low, "norms": norms, "values": values, "bits": ids + values + norms} if ids + values + norms <= 63 else None


def _directed(entries: DataFrame, only: DataFrame | None, sub_block: int, wide: bool, per_task: int, pass_pairs: int | None = None) -> tuple[list[DataFrame], bool]:
    """(i, j, ni, nj, dot, n_common, dealt) of every ordered column pair, dealt by i, in one table or, with ``pass_pairs``, one for each pass, and
    whether ``ni`` and ``nj`` are squared norms; ``entries`` is (r, c, v) and the norms are made here. ``dealt`` columns may be in several passes."""
    whole = isinstance(entries.schema["v"].dataType, T.IntegralType)
    kind = entries.schema["c"].dataType
    total = "decimal(38,0)" if wide else None
    entries = write_table(entries, "similarity-entries")  # read for norms, degrees and pairs
    own = entries.select("c", "v", F.col("v").alias("x"), F.col("v").alias("y"))
    norms = write_table(own.groupBy("c").agg(F.sum(_product(entries, wide)).alias("n2"), F.count(F.lit(1)).alias("m"), F.min("v").alias("low"), F.max(
        "v").alias("high")).filter("n2 > 0"), "similarity-norms")
    # a few numbers that choose types and the number of tasks, never the result
    f = norms.agg(F.max("n2").alias("n2"), F.min("low").alias("low"), F.max("high").alias("high"), F.count(F.lit(1)).alias("columns"),
                  F.min("c").alias("first"), F.max("c").alias("last")).first()
    asked = None
    if only is not None:  # only rows with a column asked for make pairs
        asked = write_table(only.join(norms.select("c", "m"), "c"), "similarity-asked").select("c", "m")
        entries = entries.join(entries.join(asked, "c", "left_semi").select("r").distinct(), "r", "left_semi")
    g = entries.groupBy("r").agg(F.count(F.lit(1)).alias("d")).agg(
        F.sum("d").alias("n"), F.sum(F.col("d").cast("double") * F.col("d")).alias("pairs"), F.max("d").alias("most")).first()
    every = g.pairs or 0.0
    mean = every / (g.n or 1)  # partners that an entry meets
    if only is not None:
        every = (asked.agg(F.sum("m")).first()[0] or 0) * mean
    # no sum of products passes the largest squared norm
    exact = whole and (f.n2 is None or int(f.n2) < 1 << 63)
    # few columns make the same pairs over and over: those are summed before the shuffle
    few = exact and only is None and f.columns ** 2 <= per_task and f.columns ** 2 * _partitions(entries) * 4 <= every
    code = None
    if few:
        norms = write_table(norms.withColumn("code", F.row_number().over(Window.orderBy("c")).cast("long")), "similarity-codes")  # few rows
        code = _packed(0, f.columns, f.low, f.high, 0)
    elif exact and f.columns and isinstance(kind, T.IntegralType):
        code = _packed(f["first"], f["last"], f.low, f.high, int(f.n2))
    norm = F.col("n2").cast("long") if exact else F.sqrt(F.col("n2").cast("double"))
    shares = F.lit(1) if few else F.ceil(F.col("m") * mean / per_task).cast("int")
    e = entries.join(norms.select("c", "m", norm.alias("n2"), *(["code"] if few else [])), "c").withColumn("shares", shares)
    if asked is not None:
        e = e.join(asked.select("c", F.lit(True).alias("asked")), "c", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    if code is not None:
        at = F.lit(0) if few else F.col("n2")
        e = e.withColumn("p", F.shiftleft(((F.col("code") if few else F.col("c")).cast("long") - code["first"]), code["values"] + code["norms"])
                         .bitwiseOR(F.shiftleft(F.col("v").cast("long") - code["low"], code["norms"])).bitwiseOR(at.cast("long")))
    fields = [*(["c", "v", "n2"] if code is None else ["p"]), "shares", *([] if asked is None else ["asked"])]
    if code is None:
        lists = {"js": F.col("own.c"), "ys": F.col("own.v"), "ns": F.col("own.n2")}
    else:  # a number's low 32 bits and, apart, those above
        lists = {"js": F.transform("own.p", lambda p: (p.bitwiseAND(F.lit(_LOW)) - F.lit(1 << 31)).cast("int"))}
        if code["bits"] > 32:
            lists["ys"] = F.transform("own.p", lambda p: F.shiftright(p, 32).cast(smallest_type(T.LongType(), 0, 1 << (code["bits"] - 32))))
    names = list(lists)
    passes = 1 if few or pass_pairs is None else max(1, math.ceil(every / max(pass_pairs, 4 * (g.n or 0))))
    lists |= {"ss": F.col("own.shares")} | ({} if asked is None else {"asked": F.col("own.asked")})
    rows = _rows(e.select("r", "c", *(x for x in fields if x != "c")), fields, lists, sub_block, g.most or 0)
    if passes > 1:  # read in every pass
        rows = [write_table(x, "similarity-rows") for x in rows]

    def partner(k: Column, of: str = "") -> Column:
        """The number of the k-th partner."""
        low = F.get(f"{of}js", k).cast("long") + F.lit(1 << 31)
        return low if len(names) == 1 else F.shiftleft(F.get(f"{of}ys", k).cast("long"), 32).bitwiseOR(low)

    def own(of: str) -> dict[str, Column]:
        """The entry at ``k`` of its row's lists."""
        get = lambda c: F.get(f"{of}{c}", F.col("k"))
        return ({"i": get("js"), "x": get("ys"), "ni": get("ns")} if code is None else {"p": partner(F.col("k"), of)}) | {"shares": get("ss")}

    met = _met_rows(rows, names, own, asked is not None)
    mine = ["i", "x", "ni"] if code is None else ["p"]
    apart = F.lit(-1) if code is None else F.lit(~(((1 << code["values"]) - 1) << code["norms"]))  # a number without its value
    first = F.col("i") if code is None else F.col("p").bitwiseAND(apart)
    # the partners of a dealt column's share; a column that is not dealt has the share -1
    key = (lambda k: F.get("js", k)) if code is None else (lambda k: partner(k).bitwiseAND(apart))
    at = F.filter(F.sequence(F.lit(0), F.size("js") - 1), lambda k: F.pmod(F.xxhash64(key(k)), F.col("shares")) == F.col("share"))
    part = lambda name: F.when(F.col("shares") == 1, F.col(name)).otherwise(F.transform("at", lambda k: F.get(name, k))).alias(name)
    share = F.explode(F.when(F.col("shares") > 1, F.sequence(F.lit(0), F.col("shares") - 1)).otherwise(F.array(F.lit(-1))))
    tasks = min(max(int(every / passes / per_task) + 1, _partitions(entries)), MOST_TASKS)

    def one(n: int) -> DataFrame:
        """The pairs of a pass."""
        if few:
            return _summed(met.withColumn("share", F.lit(-1)))
        m = met.withColumn("share", share)
        if passes > 1:
            m = m.filter(F.pmod(F.xxhash64(F.lit("pass"), first, "share"), F.lit(passes)) == n)
        m = m.withColumn("at", F.when(F.col("shares") > 1, at)).select(*mine, "share", *map(part, names))
        return _summed(m.repartition(tasks, first, "share"))

    def _summed(met: DataFrame) -> DataFrame:
        if code is None:
            pairs = met.select("i", "x", "ni", "share", *names[1:], F.posexplode("js").alias("k", "j")).select(
                "i", "share", "j", "ni", "x", F.get("ys", F.col("k")).alias("y"), F.get("ns", F.col("k")).alias("nj"))
            group = ["i", "share", "j", "ni", "nj"]
        else:
            value = lambda p: (F.shiftright(p, code["norms"]).bitwiseAND(F.lit((1 << code["values"]) - 1)) + F.lit(code["low"]))
            pairs = met.select("p", "share", *names[1:], F.posexplode("js").alias("k", "q"))
            low = F.col("q").cast("long") + F.lit(1 << 31)
            pairs = pairs.select("p", "share", (low if len(names) == 1 else F.shiftleft(F.get("ys", F.col("k")).cast("long"), 32).bitwiseOR(low)).alias("q"))
            pairs = pairs.select(F.col("p").bitwiseAND(apart).alias("i"), "share", F.col("q").bitwiseAND(apart).alias("j"), value(F.col("p")).alias("x"), value(F.col("q")).alias("y"))
            group = ["i", "share", "j"]
        s = pairs.filter("i <> j").groupBy(*group).agg(F.sum(_product(entries, wide and not exact)).alias("dot"), F.count(F.lit(1)).alias("n_common"))
        if few:
            to = lambda c, n: F.broadcast(norms.select(F.col("code").alias(f"{c}_code"), F.col("c").alias(c), F.col("n2").cast("long").alias(n)))  # noqa: E731  few rows
            s = s.select(*(F.shiftright(c, code["values"]).alias(f"{c}_code") for c in ("i", "j")), "share", "dot", "n_common").join(to("i", "ni"), "i_code").join(to("j", "nj"), "j_code")
        elif code is not None:
            of = lambda c: (F.shiftright(c, code["values"] + code["norms"]) + F.lit(code["first"])).alias(c)
            n2 = lambda c: F.col(c).bitwiseAND(F.lit((1 << code["norms"]) - 1))
            s = s.select(of("i"), of("j"), n2("i").alias("ni"), n2("j").alias("nj"), "share", "dot", "n_common")
        dot = F.col("dot") if total is None else F.col("dot").cast(total)
        return s.select(F.col("i").cast(kind).alias("i"), F.col("j").cast(kind).alias("j"), "ni", "nj", dot.alias("dot"), "n_common", (F.col("share") >= 0).alias("dealt"))
    return [one(n) for n in range(passes)], exact


def _rows(e: DataFrame, fields: list[str], lists: dict[str, Column], sub_block: int, most: int) -> list[DataFrame]:
    """The entries of each row as ``lists`` over ``own``, ordered; of rows above ``sub_block``, if there are any, apart, by sub-block."""
    def blocks(df: DataFrame, *on: str) -> DataFrame:
        own = df.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("own"), F.max("nb").alias("nb"))
        return own.select(*on, "nb", *(x.alias(n) for n, x in lists.items()))
    if most <= sub_block:  # no row is dealt
        return [blocks(e.withColumn("nb", F.lit(1)), "r")]
    dealt = _dealt(e, sub_block)
    return [blocks(dealt.filter("nb = 1"), "r"), blocks(dealt.filter("nb > 1"), "r", "b")]


def _met_rows(rows: list[DataFrame], names: list[str], own, some: bool) -> DataFrame:
    """Each entry (``own``) with the lists ``names`` of its row, a sub-block at a time; ``some``: only entries with ``asked``."""
    def each(df: DataFrame, of: str) -> DataFrame:
        e = df.select("*", F.posexplode(f"{of}js").alias("k", "_j"))
        e = e.filter(F.get(f"{of}asked", F.col("k"))) if some else e
        return e.select(*(x.alias(n) for n, x in own(of).items()), *names)
    light, *heavy = rows
    met = each(light, "")
    for df in heavy:
        every = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
        left = df.select("r", F.col("b").alias("lo"), every.alias("hi"), *(F.col(c).alias(f"o_{c}") for c in df.columns if c not in ("r", "b", "nb")))
        met = met.unionByName(each(left.join(df.select("r", every.alias("lo"), F.col("b").alias("hi"), *names), ["r", "lo", "hi"]), "o_"))
    return met


def _met(e: DataFrame, fields: list[str], sub_block: int, most: int, some: bool) -> DataFrame:
    """(o, other): each entry with the entries of its row, a sub-block at a time; ``some``: only entries with ``asked``."""
    mine = F.filter("own", lambda x: x["asked"]) if some else F.col("own")
    blocks = lambda df, *on: df.groupBy(*on).agg(F.collect_list(F.struct(*fields)).alias("own"), F.max("nb").alias("nb"))
    if most <= sub_block:  # no row is dealt
        return blocks(e.withColumn("nb", F.lit(1)), "r").select(F.explode(mine).alias("o"), F.col("own").alias("other"))
    dealt = _dealt(e, sub_block)
    light = blocks(dealt.filter("nb = 1"), "r").select(F.explode(mine).alias("o"), F.col("own").alias("other"))
    heavy = blocks(dealt.filter("nb > 1"), "r", "b")
    left = heavy.select("r", F.col("b").alias("lo"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("hi"), mine.alias("own"))
    right = heavy.select("r", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("lo"), F.col("b").alias("hi"), F.col("own").alias("other"))
    return light.unionByName(left.join(right, ["r", "lo", "hi"]).select(F.explode("own").alias("o"), "other"))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cooccurrence(entries: DataFrame, row: str, col: str, value: str, *, sub_block: int = SUB_BLOCK) -> DataFrame:
    """Sparse Gram product over a long table ``(row, col, value)`` with unique (row, col).

    Returns ``(i, j, dot, n_common)`` for every column pair i < j sharing at least one row. Integer values give
    an exact long ``dot``, others a double. Null rows and columns have no pairs.
    """
    e = entries.select(F.col(row).alias("r"), F.col(col).alias("c"), F.col(value).alias("v"), F.lit(1.0).alias("norm"))
    e = e.filter("r is not null and c is not null")
    return _pairs(e, sub_block).groupBy("i", "j").agg(F.sum(_product(e, False)).alias("dot"), F.count(F.lit(1)).alias("n_common"))


def cosine_pairs(entries: DataFrame, row: str, col: str, value: str, out_left: str, out_right: str, *,
                 sub_block: int = SUB_BLOCK, wide: bool = False, only: DataFrame | None = None, per_task: int = PER_TASK) -> DataFrame:
    """Cosine for every co-occurring pair, in both directions; with ``only`` (a table of columns) for those on the left alone.

    Columns: ``out_left, out_right, dot, sim, n_common, nano``. Integer inputs keep ``dot`` and squared norms
    exact, so ``sim = dot / (sqrt(n2_i) * sqrt(n2_j))`` is bit-identical in any engine; ``wide`` sums them as
    decimals, for values whose squares could overflow a long. A column of zeros has no cosine and no partner.
    """
    (pairs,), exact = _directed(*_asked(entries, row, col, value, only), sub_block, wide, per_task)
    return _cosines(pairs, exact, out_left, out_right).drop("dealt")


def _asked(entries: DataFrame, row: str, col: str, value: str, only: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    e = entries.select(F.col(row).alias("r"), F.col(col).alias("c"), F.col(value).alias("v")).filter("r is not null and c is not null")
    return e, None if only is None else only.select(F.col(col).alias("c")).distinct()


def _sim(exact: bool) -> Column:
    root = lambda x: F.sqrt(F.col(x).cast("double")) if exact else F.col(x)
    return F.col("dot").cast("double") / (root("ni") * root("nj"))


def _cosines(pairs: DataFrame, exact: bool, out_left: str, out_right: str) -> DataFrame:
    """(out_left, out_right, dot, sim, n_common, nano, other columns) of pairs with their norms, ``exact``: squared ones."""
    s = pairs.withColumn("sim", _sim(exact))
    rest = [c for c in pairs.columns if c not in ("i", "j", "ni", "nj", "dot", "n_common")]
    return s.select(F.col("i").alias(out_left), F.col("j").alias(out_right), "dot", "sim", "n_common", nano("sim").alias("nano"), *rest)


def mirror(pairs: DataFrame, out_left: str, out_right: str, carry) -> DataFrame:
    """(i, j, ...) with i < j -> both orientations in one pass (no second copy of the subplan)."""
    both = F.explode(F.array(F.struct(F.col("i").alias("l"), F.col("j").alias("r")),
                             F.struct(F.col("j").alias("l"), F.col("i").alias("r")))).alias("_o")
    return pairs.select(both, *carry).select(F.col("_o.l").alias(out_left), F.col("_o.r").alias(out_right), *carry)


def item_neighbors(interactions: DataFrame, k: int = 20, user_col: str = "user_id", item_col: str = "book_id",
                   rating_col: str = "rating", other_col: str = "other_id", *, sub_block: int = SUB_BLOCK, only: DataFrame | None = None,
                   per_task: int = PER_TASK, pass_pairs: int | None = None) -> DataFrame:
    """The k most similar co-rated items of every item (self excluded by id).

    Columns: item_col, other_col, dot, sim, nano, rank (1-based). Ties: nano desc, other id asc. ``only``: a table of the items
    whose neighbours are asked for; pairs without one of them are not made. ``pass_pairs``: pairs above which they are made in passes.
    """
    parts, exact = _directed(*_asked(interactions, user_col, item_col, rating_col, only), sub_block, False, per_task, pass_pairs or PASS_PAIRS)
    if len(parts) == 1:
        sims = _cosines(parts[0], exact, item_col, other_col).drop("dealt")
        return top_k_per_group(sims, [item_col], [F.col("nano").desc(), F.col(other_col)], k)
    top = lambda df: top_k_per_group(df.withColumn("nano", nano(_sim(exact))), ["i"], [F.col("nano").desc(), F.col("j")], k).drop("nano")
    best = [write_table(top(pairs), "similarity-best") for pairs in parts]  # one after the other
    best = reduce(DataFrame.unionByName, best)
    best = best.filter("not dealt").unionByName(top(best.filter("dealt").drop("rank")))
    return _cosines(best, exact, item_col, other_col).drop("dealt")


def user_neighbors(interactions: DataFrame, k: int, user_col: str = "user_id", item_col: str = "book_id",
                   rating_col: str = "rating", other_col: str = "other_user_id", **kw) -> DataFrame:
    """The k nearest users of every user by cosine (``nearest``): a book that many rated pairs them only as far as bounds ask.

    Columns: user_col, other_col, dot, sim, nano, rank (1-based). Ties: nano desc, other id asc. Whole, not negative ratings.
    """
    return nearest(interactions, k, user_col, item_col, rating_col, other_col, **kw)
