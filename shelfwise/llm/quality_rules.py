"""Quality rules: a learned decision list over text statistics, run as ordered Spark conditions.

Statistics (all whole texts, words are ``[^\\x20\\x09-\\x0D]+``): n_words, word_chars (code points in words),
n_symbols (``#*$%&|<>``), n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in
8-word windows found twice or more in the text), n_echoes (words equal to the word before).

Method: sequential covering. Labelled rows are split into a growing and a pruning part. A rule starts empty and
gets the threshold condition with the best information gain until it covers no good growing row; conditions are
then dropped from its end while that helps on the pruning rows. Rules are added until the next one would be less
precise than ``precision`` there. The list becomes one ``when(...).when(...)`` expression, first match first.

Training is driver-side numpy over at most ``max_labels`` labelled rows (a documented bound, chosen by hash of
the id); statistics and verdicts cover all rows.

Cases: null or empty text has no words (base rule fails); labels with a null id, null quality or no document are
ignored, an id labelled twice counts with its lowest quality; with no bad or no good label the list is empty and
only the base rule rejects; null ids, repeated rows and extra columns pass through.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import (cover, gram_hash, mix, prefix_hash, rows_of, ship, slices, span_hash, spread, utf8,
                                  word_spans, byte_symbols)
from shelfwise.llm.tables import append_column, free_name

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echoes")
WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
STATS = "struct<" + ", ".join(f"{c}: long" for c in COUNTS) + ">"


def counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The statistics of every row of a slice, as one array each in the order of ``COUNTS``."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)
    row = rows_of(first)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = np.bincount(row, lead[ends] - lead[starts], n).astype(np.int64)
    symbols = np.diff(np.concatenate([[0], np.cumsum(_SYMBOL[data])])[offsets])
    prefix = prefix_hash(byte_symbols(data))
    words = span_hash(prefix, starts, ends)
    # lines: cut at row borders and line feeds
    feeds = np.flatnonzero(data == 10)
    low = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    high = np.sort(np.concatenate([feeds, offsets[1:]]), kind="stable")
    line_row = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, "right") - 1])
    line_row.sort()
    worded = np.searchsorted(starts, low) < np.searchsorted(starts, high)
    low, high, line_row = low[worded], high[worded], line_row[worded]
    twice = _again(span_hash(prefix, low, high), line_row)
    dup_lines = np.bincount(line_row[twice], minlength=n)
    # windows found twice or more in their row
    grams = gram_hash(words, WINDOW)
    at = spread(first[:-1], np.maximum(n_words - WINDOW + 1, 0))
    again = _several(grams[at], row[at]) if len(at) else np.zeros(0, bool)
    inside = cover(len(words), at[again], at[again] + WINDOW)
    repeats = np.bincount(row[inside], minlength=n)
    echo = np.zeros(len(words), bool)
    echo[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    return [n_words, chars, symbols, dup_lines, repeats, np.bincount(row[echo], minlength=n)]


def _key(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix(values ^ mix(row.astype(np.uint64) + np.uint64(1)))


def _again(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True where the row has the value at an earlier place."""
    key = _key(values, row)
    out = np.ones(len(key), bool)
    out[np.unique(key, return_index=True)[1]] = False
    return out


def _several(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True where the row has the value at two places or more."""
    key = _key(values, row)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def with_statistics(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column of ``COUNTS``; narrow, whole texts."""
    def kernel(text):
        data, off = utf8(text)
        parts = [counts(data[off[a]:off[b]], off[a:b + 1] - off[a]) for a, b in slices(off)]
        columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(COUNTS))]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COUNTS))
    return append_column(docs, name, STATS, ["text"], kernel)


def base_failed(stats: str) -> Column:
    s = F.col(stats)
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


#: feature -> (counted, per): integers, thousandths, so that Spark and numpy agree exactly
FEATURES = {
    "symbols": ("n_symbols", "n_words"), "repeats": ("n_repeat_words", "n_words"), "echoes": ("n_echoes", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_words"), "word_length": ("word_chars", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= limit, else feature <= limit
    limit: int

    def column(self, stats: str) -> Column:
        top, per = FEATURES[self.feature]
        value = F.expr(f"(1000 * `{stats}`.{top}) div greatest(`{stats}`.{per}, 1)")
        return value >= self.limit if self.above else value <= self.limit

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] >= self.limit if self.above else values[self.feature] <= self.limit


def feature_values(table: np.ndarray) -> dict[str, np.ndarray]:
    by = {c: table[:, i] for i, c in enumerate(COUNTS)}
    return {f: 1000 * by[top] // np.maximum(by[per], 1) for f, (top, per) in FEATURES.items()}


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    live = np.ones(len(bad), bool)
    while (live & ~bad).any() and len(rule) < 4:
        p, n = int((live & bad).sum()), int((live & ~bad).sum())
        best, gain = None, 1e-9
        for feature, value in values.items():
            for limit in np.unique(np.quantile(value[live & bad], np.linspace(0, 1, 33), method="nearest")):
                for above in (True, False):
                    c = Condition(feature, above, int(limit))
                    hit = live & c.holds(values)
                    q, m = int((hit & bad).sum()), int((hit & ~bad).sum())
                    g = q * (np.log2(q / (q + m)) - np.log2(p / (p + n))) if q else 0
                    if g > gain:
                        best, gain = c, g
        if best is None:
            break
        rule.append(best)
        live &= best.holds(values)
    return rule


def covers(rule: list[Condition], values: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(np.logical_and, [c.holds(values) for c in rule], np.ones(n, bool))


def learn(table: np.ndarray, bad: np.ndarray, precision: float = 0.95, least: int = 5, seed: int = 7) -> list[list[Condition]]:
    """Ordered rejecting rules from labelled statistics (columns as ``COUNTS``); what no rule matches is kept."""
    rules: list[list[Condition]] = []
    prune = np.random.default_rng(seed).random(len(bad)) < 1 / 3
    left = np.ones(len(bad), bool)
    values = feature_values(table)
    while (left & bad & ~prune).any() and (left & ~bad).any() and len(rules) < 16:
        part = lambda m: {f: v[m] for f, v in values.items()}
        grow, check = left & ~prune, left & prune
        rule = _grow(part(grow), bad[grow])
        seen, truth = part(check), bad[check]

        def worth(r):
            hit = covers(r, seen, len(truth))
            return (int((hit & truth).sum()) - int((hit & ~truth).sum())) / max(int(hit.sum()), 1)
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covers(rule, seen, len(truth))
        good, all_hit = int((hit & truth).sum()), int(hit.sum())
        taken = left & covers(rule, values, len(bad))
        if not rule or int((taken & bad).sum()) < least or (all_hit and good < precision * all_hit) or not all_hit:
            break
        rules.append(rule)
        left &= ~taken
    return rules


def decision(rules: list[list[Condition]], stats: str) -> Column:
    """The number of the first rule that rejects (from 0), null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        out = F.when(reduce(lambda a, b: a & b, [c.column(stats) for c in rule]), F.lit(i)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> list[list[Condition]]:
    """Decision list from at most ``max_labels`` labelled documents, the ones whose hashed id is smallest."""
    known = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
             .dropna().groupBy("label_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labels))
    # broadcast: at most max_labels rows of two numbers
    rows = (docs.select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").alias("text"))
            .join(F.broadcast(known), "label_id"))
    rows = with_statistics(rows, "stats").filter(~base_failed("stats")).select("label_id", "quality", "stats.*")
    rows = rows.groupBy("label_id", "quality").agg(*(F.max(c).alias(c) for c in COUNTS)).toPandas().sort_values("label_id")
    table = rows[list(COUNTS)].to_numpy(np.int64).reshape(-1, len(COUNTS))
    return learn(table, rows["quality"].to_numpy() == 0)


def judge(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): the counts, base_failed, rule and kept."""
    rules = fit(docs, labels, max_labels)
    stats, out = free_name(docs, "quality_stats"), free_name(docs, "quality")
    rule = F.when(~base_failed(stats), decision(rules, stats))
    judged = with_statistics(docs, stats).withColumn(out, F.struct(
        *(F.col(stats)[c].alias(c) for c in COUNTS), base_failed(stats).alias("base_failed"), rule.alias("rule"),
        (~base_failed(stats) & rule.isNull()).alias("kept")))
    return judged.drop(stats), out


def kept_documents(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    judged, out = judge(docs, labels, max_labels)
    return judged.filter(F.col(out)["kept"]).select(*docs.columns)


ship(__name__)
