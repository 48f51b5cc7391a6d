"""Registered queries of the training-data operators, over the whole tables."""
from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, line_dedup, merkle, mixing, periodic_runs, quality_rules, secrets, url_filter
from shelfwise.llm.html_extract import extract
from shelfwise.llm.jaccard_join import near_duplicates
from shelfwise.llm.substring_dedup import remove_shared_passages
from shelfwise.llm.suffix_dedup import remove_repeats
from shelfwise.llm.tables import read
from shelfwise.llm.token_counts import load_vocabulary, with_token_counts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"  # public tokenizer file, a parameter of the operator

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_array_dedup(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents"), length=100).drop("spans")


@query
def op9_token_counts(spark, sf_dir):
    counted, out = with_token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), load_vocabulary(VOCABULARY), whole=True)
    return counted.select("doc_id", f"{out}.*")


@query
def op10_substring_dedup(spark, sf_dir):
    return remove_shared_passages(read(spark, sf_dir, "documents"), length=35).drop("spans")


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), width=5, percent=80)


@query
def op3_quality_rules(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    judged, out = quality_rules.judge(docs.select("doc_id", "text"), labels)
    q = F.col(out)
    return judged.select("doc_id", *(q[c].alias(c) for c in (*quality_rules.COUNTS, "base_failed", "rule", "kept")))


@query
def op4_line_dedup(spark, sf_dir):
    done, out = line_dedup.remove_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return done.select("doc_id", f"{out}.*", F.md5("text").alias("kept_md5"))


ORACLE["op4_line_dedup"] = line_dedup.ORACLE


@query
def op5_html_extraction(spark, sf_dir):
    return extract(read(spark, sf_dir, "pages"))


@query
def op6_decontamination(spark, sf_dir):
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op7_url_filter(spark, sf_dir):
    judged, out = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), url_filter.RULES)
    return judged.select("page_id", f"{out}.*")


ORACLE["op7_url_filter"] = url_filter.ORACLE


@query
def op8_source_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark, sf_dir):
    docs, text = periodic_runs.with_planted_periods(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found, out = periodic_runs.with_runs(docs.select("doc_id", text), text)
    runs, top = F.col(f"{out}.runs"), F.col("top")
    found = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), periodic_runs.longest(runs).alias("top"),
                         F.sha2(periodic_runs.run_lines(runs), 256).alias("runs_sha256"),
                         F.sha2(F.col(f"{out}.collapsed"), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", (-top["back"]).alias("start"), top["length"].alias("length"), (-top["p"]).alias("period"),
                        F.floor(1000 * top["length"] / -top["p"]).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query
def op12_secret_scan(spark, sf_dir):
    found, out = secrets.with_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [kind for kind, *_ in secrets.BASE]
    count = [F.size(secrets.of_kind(F.col(out), k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *count, F.sha2(secrets.joined(secrets.of_kind(F.col(out), *kinds)), 256).alias("base_sha256"),
                        secrets.joined(F.col(out)).alias("spans"))


@query
def op13_merkle_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return merkle.audit(docs.select(*merkle.COLUMNS), forged={"text": lowered}, where=tampered)


ORACLE["op13_merkle_manifest"] = merkle.ORACLE
