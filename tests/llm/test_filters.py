"""Quality rules, line dedup, decontamination, URL rules and mixing against brute force and their odd cases."""
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import decontaminate, line_dedup, mixing, quality_rules, url_filter
from tests.llm import brute

SCHEMA = "doc_id long, text string"


# ---- quality rules
def quality_texts():
    extra = ["same line here\nsame line here\n\n\nsame line here \n", "go go go go " * 9, "a *b* c | d <e>\n" * 3, "é#ñ $$ %%",
             "\n".join(["x y z"] * 30), "one two three four five six seven eight " * 2]
    return [(i, t) for i, t in enumerate(brute.texts(3, 30) + extra)]


def test_quality_counts_equal_brute_force(spark):
    rows = quality_texts()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r.q) for r in quality_rules.with_statistics(df, "q").collect()}
    assert got == {d: brute.quality_counts(t) for d, t in rows}


def labelled(spark, n=900, seed=4):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(r.randint(40, 80))]
        bad = r.random() < 0.3
        if bad:
            words = [w + r.choice(["***", "|", "&&"]) for w in words] if r.random() < 0.6 else [w for w in words for _ in range(5)]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_decision_list_generalises(spark):
    docs, labels = labelled(spark)
    train = labels.filter("doc_id < 600")
    judged, out = quality_rules.judge(docs, train)
    judged = judged.select("doc_id", F.col(out)["kept"].alias("kept"))
    held = judged.join(labels, "doc_id").filter("doc_id >= 600").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.97
    assert "CASE WHEN" in judged._jdf.queryExecution().optimizedPlan().toString()


def test_quality_odd_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "w " * 30, "c"), (2, "w " * 30, "c")],
                                 "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(None, 0), (9, None), (2, 1), (2, 0)], "doc_id long, quality int")
    judged, out = quality_rules.judge(docs, labels)
    assert out == "_quality" and judged.count() == 4
    assert quality_rules.kept_documents(docs.limit(0), labels.limit(0)).columns == docs.columns
    plain, out = quality_rules.judge(spark.createDataFrame([(1, " ".join(map(str, range(40))))], SCHEMA), labels.limit(0))
    assert plain.select(f"{out}.kept").first().kept


# ---- line dedup
def test_lines(spark):
    boiler, rows = "All rights reserved.", []
    for s in range(12):
        rows.append((s, f"own {s} first\n {boiler} \n\nown {s} last", f"s{s}"))
        rows.append((100 + s, f"own {s} first" if s < 3 else boiler, f"s{s}"))
        rows.append((200 + s, "a copied text\nof two lines", f"s{s}"))
        rows.append((300 + s, "on few sites\nown text %d" % s, f"s{s % 7}"))
    rows += [(900, None, "x"), (901, "", None), (902, boiler + "\nnull site", None), (902, boiler + "\nnull site", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("line_dedup", F.lit(1))
    done, out = line_dedup.remove_boilerplate(docs)
    got = defaultdict(list)
    for r in done.collect():
        got[r.doc_id].append((r.text, r[out].n_removed))
    for s in range(12):
        assert got[s] == [(f"own {s} first\n\nown {s} last", 1)]
        assert got[200 + s] == [("a copied text\nof two lines", 0)]  # a copy, not a page with boilerplate
        assert got[300 + s][0][1] == 0  # seven sites only
    assert got[105] == [(boiler, 0)] and got[900] == [(None, 0)] and got[901] == [("", 0)]
    assert got[902] == [("null site", 1)] * 2
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0


def test_short_pages_lose_their_boilerplate(spark):
    rows = [(s, f"Header line\nonly text of page {s}\nFooter line", f"s{s}") for s in range(9)]
    rows += [(100 + s, "Header line\n\nFooter line", f"s{s}") for s in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {**{s: f"only text of page {s}" for s in range(9)}, **{100 + s: "Header line\n\nFooter line" for s in range(9)}}


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(i * 100 + j, f"line {i}", f"site{j}") for i in range(60, 140, 8) for j in range(i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bad = {r.line for r in line_dedup.boilerplate(docs, min_sites=100, band=0.3, lg_k=6).collect()}
    assert len(bad) == sum(i >= 100 for i in range(60, 140, 8))


# ---- decontamination
@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_windows_equal_brute_force(spark, block_bytes):
    r = random.Random(5)
    vocab = ["Ab", "b", "cé", "dd1", "É", "ff", "ggg", "h2h", "the", "of"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(n))) for i, n in enumerate([14, 12, 10, 9, 3, 1, 25, 12])]
    items += [(20, items[0][1]), (None, "null id words"), (21, None), (22, " .. "), (7, items[7][1])]
    items[5] = (5, "Zebra")
    docs = []
    for i in range(60):
        words = [r.choice(vocab) for _ in range(r.randint(0, 50))]
        if r.random() < 0.7:
            at = r.randint(0, len(words))
            words[at:at] = (r.choice(items)[1] or "").split()[r.choice([0, 0, 1]):]
        docs.append((i, r.choice([" ", ", ", "\n", "--"]).join(w.upper() if r.random() < .2 and w.isascii() else w for w in words)))
    docs += [(100, None), (101, ""), (102, "zebra"), (103, "zebras"), (104, "null, id: WORDS"), (105, items[0][1] * 2)]
    got = decontaminate.report(spark.createDataFrame(docs, SCHEMA).repartition(3),
                               spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    got = {x.doc_id: tuple(x)[1:] for x in got.collect()}
    assert got == brute.contamination(docs, items)


def test_search_in_long_texts_with_shifts():
    r = random.Random(6)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 9))) for _ in range(400)]
    items = [" ".join(r.choice(vocab) for _ in range(30)) for _ in range(20)]
    words = [r.choice(vocab) for _ in range(20000)]
    for _ in range(40):
        at = r.randint(0, len(words))
        words[at:at] = r.choice(items).split()[3:15]
    text = " ".join(words)
    data = np.frombuffer(text.encode(), np.uint8)
    n, mask, _, pairs = decontaminate.Matcher(items, 10).search(data, np.array([0, len(data)]))
    want = brute.contamination([(1, text)], list(enumerate(items)))[1]
    assert (int(n[0]), int(mask.sum()), len(pairs)) == want[:3]


def test_without_items(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {tuple(x)[1:4] for x in decontaminate.report(docs, none).collect()} == {(2, 0, 0), (0, 0, 0)}
    assert decontaminate.clean_documents(docs.withColumn("benchmark_hits", F.lit(1)), none).count() == 2
    assert decontaminate.report(docs.limit(0), none).count() == 0


# ---- URL rules
URLS = ["http://a.com/x", "https://WWW.Example.com/en/1?q", "http://example.com/en", "http://example.com/en/", "x://m.example.com/en/a#b",
        "http://net/es/1", "http://q.net/fr/", "http://q.net/", "http://com", "http://com/", "http://xcom/", "nothing", None, "://", "a://b://c.com/",
        "http://u@example.com:80/en/", "http://example.com?x=/en/", "http://.com/", "http://É.com/é", "http://x.example.com./en/", "\n://a.com/\nb"]


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        import re
        rest = url.split("://", 1)[1]
        host = brute.lower(re.split(r"[/?#]", rest)[0])
        path = re.split(r"[?#]", rest[len(re.split(r"[/?#]", rest)[0]):])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("max_bits", [1 << 23, 0])
def test_url_rules(spark, max_bits):
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    judged, out = url_filter.judge(pages, url_filter.RULES, max_bits=max_bits)
    got = {r.page_id: tuple(r[out]) for r in judged.collect()}
    assert got == {i: brute_url(u, url_filter.RULES) for i, u in enumerate(URLS)}
    if max_bits:
        plan = judged._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Join" not in plan
    assert url_filter.judge(pages.limit(0), url_filter.RULES, max_bits=max_bits)[0].count() == 0
    assert url_filter.judge(pages, [])[0].select(f"{out}.verdict").distinct().collect()[0].verdict == "allow"


def test_cascade_is_exact_with_false_positives(spark):
    r = random.Random(1)
    hosts = [f"h{r.randint(0, 10**6)}.org" for _ in range(3000)]
    rules = [("block" if i % 2 else "allow", h, "/") for i, h in enumerate(dict.fromkeys(hosts[:600]))]
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id long, url string")
    listed = spark.createDataFrame([(h + p,) for _, h, p in rules], "key string")
    universe = spark.createDataFrame([(h + "/",) for h in dict.fromkeys(hosts)], "key string")
    cascade = url_filter.Cascade(listed, universe)
    assert len(cascade.levels) >= 2
    assert {x.key for x in universe.filter(cascade.lists(F.col("key"))).collect()} == {h + p for _, h, p in rules}
    judged, out = url_filter.judge(pages, rules)
    assert all(tuple(x[out]) == brute_url(x.url, rules) for x in judged.collect())


# ---- mixing
def test_every_level_is_held_against_the_bound(spark, monkeypatch):
    counts, level = [], url_filter.Level
    monkeypatch.setattr(url_filter, "Level", lambda keys, count, number: counts.append(count) or level(keys, count, number))
    pages = spark.range(20000).select(F.concat(F.lit("https://h"), "id", F.lit(".org/")).alias("url"))
    rules = [("block", f"h{i}.org", "/") for i in range(5)]
    judged, out = url_filter.judge(pages, rules, max_bits=64)  # five keys fit, their false positives do not
    assert judged.filter(F.col(out)["verdict"] == "block").count() == 5 and judged.count() == 20000
    assert all(url_filter.BITS_PER_KEY * n <= 64 for n in counts)
    wide, out = url_filter.judge(pages, rules)
    assert max(counts) > 5 and wide.exceptAll(judged).count() == 0


def test_mixing(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 60), r.choice("aaaaab") + str(i % 5)) for i in range(6000)]
    rows += [(7000 + i, "x y", "tiny") for i in range(3)] + [(8000, "n u l l", None), (8001, None, None), (None, "a b", "a0"), (None, "a b", "a0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda x: (str(x.doc_id), x.size, x.taken)
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    by = defaultdict(list)
    for x in got:
        assert x.taken <= 3 * x.size and x.taken % max(x.size, 1) == 0
        by[x.source].append(x)
    total = sum(x.size for x in got)
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    sizes = {s: sum(x.size for x in by[s]) for s in names}
    target, full = {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        if not (more := {s for s in names if s not in full and target[s] >= 3 * sizes[s]}):
            break
        full |= more
    for s in names:
        assert by[s][0].target == pytest.approx(target[s]) and by[s][0].source_size == sizes[s]
        assert abs(sum(x.taken for x in by[s]) - target[s]) <= max(x.size for x in by[s])


def test_mixing_empty(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")).count() == 2


def test_pivot_keeps_the_mass():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 500).astype(float)
    p, held = mixing._pivot(size, np.full(500, 0.37), rng.random(500))
    fractional = (p > 0) & (p < 1)
    assert fractional.sum() <= 1 and abs((p * size).sum() - 0.37 * size.sum()) < 1e-6
    mean = np.mean([mixing._pivot(size[:20], np.full(20, 0.37), rng.random(20))[0].mean() for _ in range(3000)])
    assert abs(mean - 0.37) < 0.02


def test_equal_rows_go_to_several_cells(spark):
    n = 3 * mixing.CELL_ROWS
    rows = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("a").alias("source"))
    rows = rows.unionByName(spark.createDataFrame([(1, " ".join(["w"] * 4000), "b")], rows.schema))
    got = mixing.mix(rows).collect()
    assert len(got) == n + 1
    taken = {s: sum(r.taken for r in got if r.source == s) for s in "ab"}
    target = {r.source: r.target for r in got}
    assert abs(taken["a"] - target["a"]) <= 3 and abs(taken["b"] - target["b"]) <= 4000
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(rows.repartition(5)).collect()))
    rows = spark.createDataFrame([(None, 7, 0, 1, 0.5, 3)] * n + [(4, 7, 0, 1, 0.5, 3)], "doc_id long, size long, sid long, whole long, p double, cells long")
    numbered = mixing._numbered(rows).collect()
    assert sorted(r.number for r in numbered if r.doc_id is None) == list(range(n)) and len(numbered) == n + 1


def test_passes_over_a_large_benchmark(spark):
    r = random.Random(9)
    items = [(i, " ".join(f"w{r.randint(0, 40)}" for _ in range(12))) for i in range(40)]
    docs = [(i, " ".join([*(f"w{r.randint(0, 40)}" for _ in range(9)), items[i % 40][1] if i % 3 else ""])) for i in range(60)]
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    found, out = decontaminate.find_windows(*frames, block_bytes=200, at_once=2)
    got = {x.doc_id: (x[out].n_words, sorted(x[out]["items"])) for x in found.collect()}
    whole, name = decontaminate.find_windows(*frames)
    assert got == {x.doc_id: (x[name].n_words, sorted(x[name]["items"])) for x in whole.collect()}
    assert any(items for _, items in got.values())
