"""Mixing sources to target weights: pivotal dependent rounding of copy counts.

Size is the number of words of a text. Sources share the total size by weight; a target stops at ``cap`` times its
source's size and the excess is shared again by weight among the others until none is above. Every document of a
source gets the copy rate target / size. Its whole part is taken at once; the fractions are rounded by pivotal
sampling: two fractional documents exchange mass at random (a martingale that keeps the sum of probability times
size) until one of them is 0 or 1. Documents are dealt to cells by a hash of id, size and the number among equal rows; each cell leaves at most one fractional
document, and these are combined cell by cell in a tree until one per source is left, which a seeded coin decides. So a source's taken words differ from its target by less than one document.

Randomness is seeded by source, cell and level and rows are ordered by (hash of id, id, size), so reruns agree.

Cases: null text has size 0 and takes 0 words; the null source is a source of its own, last in order; rows may
repeat; a source or table without words has target 0; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship
from shelfwise.llm.tables import written
from shelfwise.operators.encode import global_position

CELL_ROWS = 2048
FAN_IN = 64
EDGE = 1e-9  # a probability this near to 0 or 1 is taken for it


def source_targets(sized: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, sid, weight, source_size, n_docs, target) of every source."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ordered = global_position(totals.withColumn("nulls", F.col("source").isNull().cast("int")), ["nulls", "source"], "sid")
    cycle = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    table = written(ordered.drop("nulls").withColumn("weight", cycle), "mix-sources")
    level, capped = _water_level(table, cap)
    limit = cap * F.col("source_size")
    return table.withColumn("target", F.least(F.lit(level) * F.col("weight"), limit))


def _water_level(table: DataFrame, cap: float) -> tuple[float, int]:
    """Size per unit of weight at which the targets sum up to the total; one small aggregate a round."""
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0, 0
    level, before = total / weight, -1
    while True:
        full = F.lit(level) * F.col("weight") >= cap * F.col("source_size")
        n, held, open_weight = table.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, cap * F.col("source_size"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if n == before or not open_weight:
            return level, n
        level, before = (total - held) / open_weight, n


def _pivot(size: np.ndarray, p: np.ndarray, coins: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounded probabilities; the index of the one that stays fractional, or -1."""
    p = p.tolist()
    size = size.tolist()
    held = -1
    for j, coin in enumerate(coins.tolist()):
        if not EDGE < p[j] < 1 - EDGE:
            p[j] = round(p[j])
            continue
        if held < 0:
            held = j
            continue
        up = min((1 - p[held]) * size[held], p[j] * size[j])  # mass that can move from j to the held one
        down = min(p[held] * size[held], (1 - p[j]) * size[j])
        moved = up if coin * (up + down) < down else -down
        p[held] += moved / size[held]
        p[j] -= moved / size[j]
        open_held, open_j = (EDGE < p[i] < 1 - EDGE for i in (held, j))
        if not open_held:
            p[held] = round(p[held])
        if not open_j:
            p[j] = round(p[j])
        held = held if open_held else j if open_j else -1
    return np.array(p, float), held


ROW = "doc_id long, size long, sid long, cell long, whole long, p double, open boolean"


def _round_cells(rows: DataFrame, seed: int, level: int) -> DataFrame:
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "doc_id", "size", "whole"], na_position="last", kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, level, int(pdf["sid"].iloc[0]), int(pdf["cell"].iloc[0])])
        p, held = _pivot(pdf["size"].to_numpy(), pdf["p"].to_numpy(), rng.random(len(pdf)))
        pdf["p"], pdf["open"] = p, False
        if held >= 0:
            pdf.loc[held, "open"] = True
        return pdf[["doc_id", "size", "sid", "cell", "whole", "p", "open"]]
    keyed = rows.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "size"))
    return written(keyed.groupBy("sid", "cell").applyInPandas(one, ROW), f"mix-level{level}")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number among equal rows, so that a cell's hash deals those too: equal rows (of a null id, say) are counted with
    map-side combine and written out again in two steps of about ``CELL_ROWS`` each."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    step = F.lit(CELL_ROWS)
    chunks = counted.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step.cast("long"))))
    return chunks.withColumn("number", F.explode(F.sequence("low", F.least(F.col("low") + step, F.col("n")) - 1))).drop("n", "low")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, seed: int = 11) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row of ``docs``.

    ``weights`` go round the sources in code point order, null last.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))
    sized = written(sized, "mix-sizes")
    targets = written(source_targets(sized, weights, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0)
    cells = F.ceil(F.col("n_docs") / CELL_ROWS)
    rows = (sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
            .select("doc_id", "size", "sid", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("p"), cells.alias("cells")))
    worded = F.col("size") > 0
    done = rows.filter(~worded).select("doc_id", "size", "sid", F.lit(0).cast("long").alias("copies"))
    level, most = 0, int(targets.agg(F.max(cells)).first()[0] or 1)
    rows = _numbered(rows.filter(worded)).withColumn(
        "cell", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size", "number"), F.col("cells"))).drop("cells", "number")
    while True:
        rounded = _round_cells(rows, seed, level)
        copies = F.col("whole") + F.round("p").cast("long")
        done = done.unionByName(rounded.filter(~F.col("open")).select("doc_id", "size", "sid", copies.alias("copies")))
        rows = rounded.filter("open").withColumn("cell", F.floor(F.col("cell") / FAN_IN).cast("long")).drop("open")
        level += 1
        if most <= 1:
            break
        most = -(-most // FAN_IN)
    coin = F.pmod(F.xxhash64(F.lit(seed + 2), "sid"), F.lit(1 << 30)) / float(1 << 30)
    last = rows.select("doc_id", "size", "sid", (F.col("whole") + (coin < F.col("p")).cast("long")).alias("copies"))
    return (done.unionByName(last).join(targets.select("sid", "source", "source_size", "target"), "sid")
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


ship(__name__)
