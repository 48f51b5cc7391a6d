"""Merkle manifest of a dataset, with octopus multiproofs per block of leaves.

Every row is a leaf (``leaf_digest``). The leaves of a group ascend by id and form a tree whose nodes hash up to ``FANOUT``
children; the groups' subroots, in group order, form a top tree whose only node left is the root of the manifest.

Method. ``build`` writes the nodes level by level, each a ``groupBy(tree, run)`` of at most 16 children, so a level is a
sixteenth of the one below and no group is larger than a run. ``prove`` deals the leaves to blocks of neighbours. For each
block it computes the minimal set of node coordinates that its leaves do not give by themselves (the octopus: level by level the
run mates of what is known; all parents are known then), fetches them by one equi-join with the nodes, derives the shared
interiors once, and expands every leaf's own proof inside the block. A block holds at most ``BLOCK`` leaves and 15 nodes a
side and level, whatever the size of its group.

A hot group is many runs and many blocks. Leaf places come from range partitions pinned by a checkpoint
(``encode.global_position``); the driver sees the size of the largest tree and the root, nothing else.

Cases: a null value is ``-`` in the leaf; null groups are the first tree, null ids stand first in their tree; rows that share an
id are ordered by their leaf digest, and equal rows are leaves of their own, side by side; empty and very long texts are hashed
whole; an empty table has no tree, no root and an empty result; extra columns are not part of the leaf and are left out.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship
from shelfwise.llm.tables import written
from shelfwise.operators.encode import global_position

FANOUT = 16
BLOCK = 1024  # leaves that share one multiproof
TOP = -1  # the tree of the subroots; other trees are named by the place of their first leaf
DIGEST = 64  # characters of a digest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROVED = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, derived_root string"
COORDINATE = "tree long, block long, of long, level int, pos long"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """H of the values: ``-`` for null, else UTF-8 bytes, a colon and the value."""
    parts = []
    for c in columns:
        c = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)))
    return F.sha2(F.concat(*parts), 256)


def leaves(df: DataFrame, columns: Sequence[str], group: str, order: str, forged: dict[str, Column] | None = None,
           where: Column | None = None) -> DataFrame:
    """(grp, ord, leaf, forged): the leaf of every row, and the one it would have with ``forged`` columns ``where`` that holds."""
    leaf = leaf_digest([F.col(c) for c in columns])
    other = leaf_digest([(forged or {}).get(c, F.col(c)) for c in columns])
    return df.select(F.col(group).alias("grp"), F.col(order).alias("ord"), leaf.alias("leaf"),
                     (F.when(where, other) if where is not None else F.lit(None).cast("string")).alias("forged"))


def _levels(bottom: DataFrame, name: str) -> list[DataFrame]:
    """The nodes (tree, level, pos, n, digest) of all levels; ``bottom`` is (tree, pos, n, digest), n the level's size in its tree."""
    out = [bottom.withColumn("level", F.lit(0))]
    largest = bottom.agg(F.max("n").alias("n")).first().n or 0
    while largest > 1:
        up = out[-1].filter(F.col("n") > 1).groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("up"), "n").agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("run"))
        up = up.select("tree", F.col("up").alias("pos"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n"),
                       F.sha2(F.array_join(F.col("run.digest"), ""), 256).alias("digest"), F.lit(len(out)).alias("level"))
        out.append(written(up.repartitionByRange(F.col("tree"), F.col("pos")), f"{name}-{len(out)}"))  # small files have neighbours
        largest = -(-largest // FANOUT)
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select("tree", "level", "pos", "n", "digest")
    for p in parts[1:]:
        out = out.unionByName(p.select("tree", "level", "pos", "n", "digest"))
    return out


def build(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From ``leaves``: the placed leaves, the trees (tree, n, seat, subroot) and the nodes of all trees and of the top tree.

    ``rows`` is written first, so texts are hashed once. Equal rows get a number each, which deals them to several partitions.
    """
    rows = written(rows, "merkle-leaves").withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    placed = global_position(rows, ["grp", "ord", "leaf", "salt"], "at").drop("salt")
    groups = written(placed.groupBy("grp").agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    groups = written(global_position(groups, ["tree"], "seat"), "merkle-trees")
    placed = written(placed.join(groups.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(
        "tree", (F.col("at") - F.col("tree")).alias("pos"), "n", "seat", F.col("ord").alias("doc_id"), "leaf", "forged"), "merkle-placed")
    own = _union(_levels(placed.select("tree", "pos", "n", F.col("leaf").alias("digest")), "merkle-nodes"))
    subroots = written(own.filter("n = 1").join(groups.select("tree", "seat", "grp"), "tree").select(
        "tree", "seat", "grp", F.col("digest").alias("subroot")), "merkle-subroots")
    size = groups.select(F.count(F.lit(1)).alias("n")).scalar()
    top = _levels(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("seat").alias("pos"), size.alias("n"),
                                  F.col("subroot").alias("digest")), "merkle-top")
    return placed, subroots, own.unionByName(_union(top))


def missing(known: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Per level the places that leaves at ``known`` (sorted) of a tree of n leaves need and cannot derive: the least set."""
    out, level = [], 0
    while n > 1:
        runs = np.unique(known // FANOUT)
        mates = (runs[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        out.append((level, np.setdiff1d(mates[mates < n], known, assume_unique=True)))
        known, n, level = runs, -(-n // FANOUT), level + 1
    return out


def _climb(known: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> tuple[list[dict[int, str]], str]:
    """The joined digests of every run above ``known``, per level, and the digest of the tree; interiors are hashed once."""
    levels, level = [], 0
    while n > 1:
        runs = {}
        for run in sorted({p // FANOUT for p in known}):
            mates = range(run * FANOUT, min(run * FANOUT + FANOUT, n))
            runs[run] = "".join(known[p] if p in known else fetched[level, p] for p in mates)
        levels.append(runs)
        known = {run: _h(joined) for run, joined in runs.items()}
        n, level = -(-n // FANOUT), level + 1
    return levels, known[0]


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expand(block: pa.Table) -> pa.Table:
    """Every leaf's result, from a block's leaves and fetched nodes."""
    rows = block.to_pylist()
    mine = sorted((r for r in rows if r["of"] is None), key=lambda r: r["pos"])
    own, top = ({(r["level"], r["pos"]): r["digest"] for r in rows if r["of"] is not None and (r["of"] == TOP) == up}
                for up in (False, True))
    n, seat, trees = mine[0]["n"], mine[0]["seat"], mine[0]["trees"]
    levels, subroot = _climb({r["pos"]: r["digest"] for r in mine}, n, own)
    above, root = _climb({seat: subroot}, trees, top)

    def path(pos: int, tree: list[dict[int, str]]) -> list[tuple[str, str]]:
        """What stands left and right of the node in its run, level by level."""
        out = []
        for runs in tree:
            joined, at = runs[pos // FANOUT], pos % FANOUT * DIGEST
            out.append((joined[:at], joined[at + DIGEST:]))
            pos //= FANOUT
        return out
    shared = path(seat, above)
    out = {name: [] for name in ("doc_id", "leaf", "subroot", "proof_sha256", "folded_root", "derived_root")}
    for r in mine:
        sides = path(r["pos"], levels) + shared
        folded = r["forged"] or r["digest"]
        for left, right in sides:
            folded = _h(left + folded + right)
        for name, value in zip(out, (r["doc_id"], r["digest"], subroot, _h("".join(a + b for a, b in sides)), folded, root)):
            out[name].append(value)
    return pa.table([pa.array(v, pa.int64() if k == "doc_id" else pa.string()) for k, v in out.items()], names=list(out))


def requests(blocks: DataFrame) -> DataFrame:
    """The coordinates that each block (tree, block, low, high, n, seat, trees) lacks, of its own tree and of the top tree."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for of, known, n in ((r["tree"], np.arange(r["low"], r["high"] + 1), r["n"]), (TOP, np.array([r["seat"]]), r["trees"])):
                    for level, pos in missing(known, n):
                        k = len(pos)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(k, r["tree"])), pa.array(np.full(k, r["block"])), pa.array(np.full(k, of)),
                             pa.array(np.full(k, level, np.int32)), pa.array(pos, pa.int64())], ["tree", "block", "of", "level", "pos"])
    return blocks.mapInArrow(run, COORDINATE)


def prove(placed: DataFrame, subroots: DataFrame, nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, proof_sha256, folded_root (from ``forged`` where set) and derived_root of every leaf."""
    trees = subroots.select(F.count(F.lit(1))).scalar()
    mine = placed.withColumn("block", F.floor(F.col("pos") / block)).withColumn("trees", trees)
    blocks = mine.groupBy("tree", "block", "n", "seat", "trees").agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    there = nodes.select(F.col("tree").alias("of"), "level", "pos", "digest")
    fetched = requests(blocks).join(there, ["of", "level", "pos"])
    cols = ["tree", "block", "of", "level", "pos", "digest", "n", "seat", "trees", "doc_id", "forged"]
    leaf_rows = mine.withColumn("of", F.lit(None).cast("long")).withColumn("level", F.lit(0)).withColumn("digest", F.col("leaf"))
    both = leaf_rows.select(*cols).unionByName(fetched, allowMissingColumns=True).select(*cols)
    return both.groupBy("tree", "block").applyInArrow(expand, PROVED)


def audit(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "source", order: str = "doc_id",
          forged: dict[str, Column] | None = None, where: Column | None = None, block: int = BLOCK) -> DataFrame:
    """The manifest of ``docs`` and every row's proof: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``verified`` tells if the leaf, or its ``forged`` version, folds to the root with the siblings of the manifest.
    """
    placed, subroots, nodes = build(leaves(docs, columns, group, order, forged, where))
    root = nodes.filter(f"tree = {TOP} and n = 1").select("digest").scalar()
    proved = prove(placed, subroots, nodes, block)
    return proved.withColumn("root", root).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                  (F.col("folded_root") == F.col("root")).alias("verified"))


LEVELS = 5  # of the SQL twin: trees of up to 16^5 leaves
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf_sql(columns: Sequence[str]) -> str:
    part = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
    return "sha256(" + " || ".join(part.format(c) for c in columns) + ")"


def _tree_sql(name: str, key: str) -> str:
    """CTEs ``name``1.. of the levels above ``name``0 (key, pos, n, h), and ``name``_s of left and right siblings per level."""
    out = []
    for i in range(LEVELS):
        low = f"{name}{i}"
        out.append(f"""{name}{i + 1} AS (SELECT {key}, pos // {FANOUT} AS pos, (n + {FANOUT - 1}) // {FANOUT} AS n,
    CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
  FROM {low} GROUP BY {key}, pos // {FANOUT}, n),
{name}_s{i} AS (SELECT a.{key}, a.pos, any_value(a.n) AS n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {low} a JOIN {low} b ON a.{key} = b.{key} AND a.pos // {FANOUT} = b.pos // {FANOUT} GROUP BY 1, 2)""")
    return ",\n".join(out)


def _oracle() -> str:
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: "
           "CAST(ascii(x) AS BIGINT))), lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: " + step + ")))")
    climb, proofs, f = [], [], "p.forged"
    for name, key, at in (("t", "seat", "pos"), ("u", "k", "seat")):
        for i in range(LEVELS):
            s = f"{name}{i}s"
            climb.append(f"JOIN {name}_s{i} {s} ON {s}.{key} = {'p.seat' if name == 't' else '0'} AND {s}.pos = p.{at} // {FANOUT ** i}")
            proofs.append(f"{s}.l || {s}.r")
    fold, last = [], "p.forged"
    for k, s in enumerate([f"{n}{i}s" for n in "tu" for i in range(LEVELS)]):
        fold.append(f"f{k} AS (SELECT * , CASE WHEN n{k} = 1 THEN {last} ELSE sha256(l{k} || {last} || r{k}) END AS f{k}_ FROM "
                    f"{'sides' if not k else f'f{k - 1}'})")
        last = f"f{k}_"
    fold[0] = fold[0].replace("p.forged", "forged")
    names = [f"{n}{i}s" for n in "tu" for i in range(LEVELS)]
    sides = ", ".join(f"{s}.n AS n{k}, {s}.l AS l{k}, {s}.r AS r{k}" for k, s in enumerate(names))
    return f"""WITH d AS (SELECT doc_id, source, {_leaf_sql(COLUMNS)} AS leaf, CASE WHEN {crc} % 5 = 0
    THEN {_leaf_sql([_LOWERED if c == 'text' else c for c in COLUMNS])} END AS changed FROM documents),
p AS (SELECT doc_id, leaf, coalesce(changed, leaf) AS forged, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS seat,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY source) AS n FROM d),
t0 AS (SELECT seat, pos, n, leaf AS h FROM p),
{_tree_sql('t', 'seat')},
u0 AS (SELECT 0 AS k, seat AS pos, (SELECT COUNT(*) FROM t{LEVELS}) AS n, h FROM t{LEVELS}),
{_tree_sql('u', 'k')},
sides AS (SELECT p.doc_id, p.leaf, p.forged, t{LEVELS}.h AS subroot, sha256({' || '.join(proofs)}) AS proof_sha256, {sides}
  FROM p JOIN t{LEVELS} ON t{LEVELS}.seat = p.seat {' '.join(climb)}),
{(',' + chr(10)).join(fold)}
SELECT doc_id, leaf, subroot, (SELECT h FROM u{LEVELS}) AS root, proof_sha256, {last} AS folded_root,
  {last} = (SELECT h FROM u{LEVELS}) AS verified FROM f{len(fold) - 1}"""


ORACLE = _oracle()

ship(__name__)
