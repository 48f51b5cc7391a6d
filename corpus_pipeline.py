"""Corpus pipeline: quality rules, line dedup, near-duplicate join, benchmark decontamination, source mixing.

Each stage takes (spark, docs, sf_dir), works on all rows of the stage before and, but for the last, returns the
columns of documents. Between stages the rows are written as Parquet in the shared folder and read again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_rules
from shelfwise.llm.tables import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality_rules.kept_documents(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that spread over many sources; those that hold nothing else stay for the next stage."""
    return line_dedup.deduplicated(docs, max_share=None)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    return jaccard_join.one_of_each_group(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copy counts that bring every source near its target share of words."""
    return mixing.mix(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing to target weights", mix)]

#: the learned rules, the near-duplicate groups and the seeded rounding have no SQL form; tests/llm holds them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{i}")
    return docs
