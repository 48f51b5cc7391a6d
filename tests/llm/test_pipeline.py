"""The pipeline: its stages chained, against the same decisions made by brute force, and without rows."""
from collections import defaultdict

import pytest

import corpus_pipeline
from shelfwise.llm import quality_rules
from tests.conftest import SF
from tests.llm import brute


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = corpus_pipeline.quality(spark, docs, SF)
    judged, out = quality_rules.judge(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert step.columns == docs.columns and step.count() == judged.filter(f"{out}.kept").count()
    step = corpus_pipeline.lines(spark, step, SF)
    before = [(r.doc_id, r.text) for r in step.collect()]
    one = corpus_pipeline.near_duplicates(spark, step, SF)
    assert one.columns == docs.columns
    groups = brute.jaccard_groups(before)
    kept = {r.doc_id: r.text for r in one.collect()}
    assert set(kept) == {d for d, (n, c) in groups.items() if d == c}
    clean = corpus_pipeline.decontamination(spark, one, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = brute.contamination(list(kept.items()), items[:5])
    left = {r.doc_id for r in clean.collect()}
    assert clean.columns == docs.columns and left <= {d for d in kept if not bad[d][4]}
    mixed = corpus_pipeline.mix(spark, clean, SF).collect()
    assert {r.doc_id for r in mixed} == left
    assert all(r.taken <= 3 * r.size for r in mixed)


def test_one_of_each_group_with_nulls_and_repeats(spark):
    text = "one two three four five six seven"
    rows = [(None, text, "a"), (5, text, "a"), (5, text, "b"), (None, "alone words", "c"), (None, "alone words", "c"), (9, None, "d"), (9, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id string")
    got = sorted(map(str, ((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())))
    assert got == sorted(map(str, [(5, text), (None, "alone words"), (9, None), (9, None)]))


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def line_dedup(rows, min_sites=8):
    """rows: (doc_id, text, source)."""
    sites = defaultdict(set)
    core = lambda line: line.strip(" \t\n\x0b\x0c\r")
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if source is not None:
                sites[core(line)].add(source)
    gone = lambda line: core(line) and len(sites[core(line)]) >= min_sites
    out = []
    for d, text, source in rows:
        worded = [x for x in (text or "").split("\n") if core(x)]
        if any(map(gone, worded)) and not all(map(gone, worded)):
            text = "\n".join(x for x in text.split("\n") if not gone(x))
        out.append((d, text, source))
    return out


def contaminated(text, items, width=10):
    words = brute.BENCH_WORD.findall(brute.lower(text))
    return any(tuple(words[i:i + n]) in found for n, found in items.items() for i in range(len(words) - n + 1))


def targets(size, weights=(1, 2, 3), cap=3.0):
    """Shares of the total by weight, none over ``cap`` times the source's size; what is over goes to the others."""
    weight = {s: weights[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    full = set()
    while True:
        rest = [s for s in size if s not in full]
        level = (sum(size.values()) - sum(cap * size[s] for s in full)) / max(sum(weight[s] for s in rest), 1)
        more = {s for s in rest if level * weight[s] >= cap * size[s]}
        if not more:
            return {s: cap * size[s] if s in full else level * weight[s] for s in size}
        full |= more


def test_run_equals_a_brute_force_chain(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.fit(docs, labels)

    def keeps(text):
        count = dict(zip(quality_rules.COUNTS, brute.quality_counts(text)))
        value = {f: 1000 * count[a] // max(count[b], 1) for f, (a, b) in quality_rules.FEATURES.items()}
        rejected = any(all(value[c.feature] >= c.limit if c.above else value[c.feature] <= c.limit for c in rule) for rule in rules)
        return count["n_words"] >= 20 and 100 * count["n_repeat_words"] <= 30 * count["n_words"] and not rejected
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect() if keeps(r.text)]
    rows = line_dedup(rows)
    groups = brute.jaccard_groups([r[:2] for r in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    items = defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = brute.BENCH_WORD.findall(brute.lower(r.text))
        n = min(len(words), 10)
        if n:
            items[n] |= {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
    rows = [r for r in rows if not contaminated(r[1], items)]
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(brute.WORD.findall(text or ""))
    mixed = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.source, r["size"]) for r in mixed) == sorted((d, s, len(brute.WORD.findall(t or ""))) for d, t, s in rows)
    want, taken, largest = targets(size), defaultdict(int), defaultdict(int)
    for r in mixed:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] + 1e-3 for s in size)
