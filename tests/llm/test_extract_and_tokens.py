"""HTML extraction (held-out accuracy, odd markup) and token counts (against the tokenizer library and brute force)."""
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import html_extract, token_counts
from shelfwise.llm.html_blocks import blocks
from shelfwise.llm.queries import VOCABULARY
from tests.conftest import SF
from tests.llm import brute


@pytest.fixture(scope="module")
def field():
    return html_extract.trained_field()


def test_held_out_blocks(field):
    right = total = 0
    for html, main in html_extract.labelled_pages(150, seed=99):
        page = blocks(html)
        want = html_extract.labels_of(page, main)
        got = field.decode(html_extract.block_features(page))
        right += sum(a == b for a, b in zip(want, got))
        total += len(want)
    assert right / total > 0.97


def test_articles_of_the_table(spark, field):
    rows = html_extract.extract(spark.read.parquet(f"{SF}/pages.parquet"), field).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    good = 0
    for r in rows:
        article = source[r.page_id].split("<article>")[1].split("</article>")[0]
        good += r.text == " ".join(b.text for b in blocks(article)) and r.n_chars == len(r.text)
    assert good >= 0.98 * len(rows) and len(rows) == len(source)


def test_viterbi_and_marginals_equal_enumeration(field):
    rng = np.random.default_rng(3)
    small = html_extract.Field(rng.normal(size=(2, html_extract.WEIGHTS)), rng.normal(size=(2, 2)))
    features = [[int(x) for x in rng.integers(0, html_extract.WEIGHTS, 3)] for _ in range(6)]
    s = small.scores(features)
    paths = {p: sum(s[i, l] for i, l in enumerate(p)) + sum(small.pairs[a, b] for a, b in zip(p, p[1:]))
             for p in np.ndindex(*(2,) * 6)}
    assert tuple(small.decode(features)) == max(paths, key=paths.get)
    single, both, z = small.marginals(features)
    assert z == pytest.approx(np.logaddexp.reduce(list(paths.values())))
    assert single[2, 1] == pytest.approx(sum(np.exp(v - z) for p, v in paths.items() if p[2]))
    assert both.sum() == pytest.approx(5)


def test_blocks_of_odd_markup():
    text = lambda h: [b.text for b in blocks(h)]
    assert text("a <b>b</b>c<br>d<p>e&amp;f &#x41; &nbsp; g<p>h<script>x<p></script><!-- c --><style>s</style>") == ["a bc d", "e&f A g", "h"]
    assert text(None) == text("") == text("<div></div>") == []
    assert text("<ul><li>1<li>2</ul></div></p>t <unclosed <p>u") and text("<" * 50) and text("&#xD800;x") is not None
    assert len(text("<div>" * 3000 + "deep" + "</div>" * 10)) == 1


def test_no_markup_fails(field):
    r = random.Random(7)
    bits = ["<", "<!", "<![", "]", "]]>", ">", "<!--", "--", "/", "<svg", "<p>", "</p>", "<script", "</script", "<select>", "<a href='", '"', "=", "&", "&#",
            "x;", " ", "foo", "CDATA[", "<?", "<textarea>", "</", "\n", "é", "<div class=", "<noscript>", "<template>", "</svg>", "\x00"]
    for _ in range(10_000):
        blocks("".join(r.choice(bits) for _ in range(r.randint(1, 14))))
    assert html_extract.page_text("<article><p>Some words of it.<![foo[ x ]]><p>More of it.<![ x></article>", field) is not None


def test_unclosed_silent_elements_hide_nothing():
    text = lambda h: [b.text for b in blocks(h)]
    for tag in ("svg", "math", "noscript", "select", "textarea", "iframe", "object", "canvas", "template", "video", "datalist"):
        assert text(f"<{tag}><p>kept</p> tail") == ["kept", "tail"], tag
        assert text(f"a<{tag}>gone</{tag}>b") == ["a", "b"], tag
    assert text("<svg><p>kept</p><svg><path/></svg><p>too") == ["kept", "too"]
    assert text("<select><option>gone<p>kept</p><select><option>gone</select>end") == ["kept", "end"]
    assert text("<SVG><foreignObject><p>gone</p></foreignObject></SVG>kept") == ["kept"]
    assert text("kept<script>gone <p>gone") == ["kept"]


def test_deep_nesting_is_linear(field):
    begin = time.process_time()
    assert len(blocks("<div class='a b'>x" * 40_000)) == 40_000
    html_extract.page_text("<div>x" * 40_000 + "</b>" * 40_000 + "<b>" * 40_000, field)
    assert time.process_time() - begin < 12


def test_extract_odd_rows(spark, field):
    long = "word " * 200_000
    rows = [(1, "u", None), (None, None, ""), (2, "u", f"<article><p>{long}.</p></article>"), (2, "u", f"<article><p>{long}.</p></article>")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")), field).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, len(long) + 1, len(long) + 1]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"), field).count() == 0


# ---- token counts
def library(vocabulary):
    from tokenizers import Tokenizer, models
    pieces = [("<unk>", 0.0)] + vocabulary + [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    return Tokenizer(models.Unigram(pieces, 0, True))


def test_counts_equal_the_library(spark):
    vocabulary = token_counts.load_vocabulary(VOCABULARY)
    tokenizer, counter = library(vocabulary), token_counts.Counter(vocabulary)
    texts = [t or "" for t in brute.texts(8, 12)] + ["naïve ☃☃ 你好世界 x☃y", "don't stop", "aaaaaaaaaaaaaaaaaaaaaaa"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()]
    words = {w for t in texts for w in brute.WORD.findall(t)}
    assert len(words) > 1000
    wrong = [w for w in words if counter.count(w)[1] != len(tokenizer.encode(token_counts.MARK + w, add_special_tokens=False).ids)]
    assert not wrong


def test_ties_equal_enumeration():
    import itertools
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁a", -2.0), ("bab", -3.0)]
    counter = token_counts.Counter(pieces)
    from tokenizers import Tokenizer, models
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0)] + pieces + [(f"<0x{b:02X}>", 0.0) for b in range(256)], 0, True))
    for n in range(1, 9):
        for w in map("".join, itertools.product("abé" if n < 5 else "ab", repeat=n)):
            assert counter.count(w)[1] == len(tokenizer.encode("▁" + w, add_special_tokens=False).ids), w


def test_count_rows(spark):
    vocabulary = [("▁", -1.0), ("a", -1.0), ("▁a", -1.5)]
    rows = [(1, None), (2, ""), (3, "a  a\na"), (3, "a  a\na"), (None, "z é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_counts", F.lit(1))
    counted, out = token_counts.with_token_counts(docs, vocabulary)
    got = sorted((str(r.doc_id), *r[out]) for r in counted.collect())
    assert out == "_token_counts"
    assert got == sorted([("1", 0, 0, 0.0), ("2", 0, 0, 0.0), ("3", 3, 3, -4.5), ("3", 3, 3, -4.5), ("None", 2, 5, -25.0)])
    assert token_counts.with_token_counts(docs.limit(0), [])[0].count() == 0
    assert re.fullmatch(r"\W", token_counts.MARK)


def test_whole_texts_equal_the_library(spark):
    from shelfwise.llm import queries
    vocabulary = token_counts.load_vocabulary(VOCABULARY)
    tokenizer = library(vocabulary)
    want = lambda t: len(tokenizer.encode(token_counts.MARK + t.replace(" ", token_counts.MARK), add_special_tokens=False).ids) if t else 0
    texts = ["a\nb", "a\n\nb", "a\tb", "a  b", " a", "a ", "\na", "  ", "\n", "a\r\n\tb", "▁a▁ ▁b\n▁", "x" + " " * 40 + "y", "naïve ☃\u3000☃ 你好\n你", "a.\x0b\x0cB", "", None]
    texts += brute.texts(8, 12)
    rows = list(enumerate(texts))
    counted, out = token_counts.with_token_counts(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary, whole=True)
    got = {r.doc_id: r[out].n_tokens for r in counted.collect()}
    assert got == {d: want(t or "") for d, t in rows}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in queries.op9_token_counts(spark, SF).collect()}
    assert got == {r.doc_id: want(r.text or "") for r in docs}


def test_pieces_that_cross_blanks_and_line_feeds():
    import itertools
    pieces = [("▁", -1.0), ("a", -1.0), ("a▁", -1.5), ("▁a", -1.25), ("\na", -2.0), ("a▁a", -2.5), ("b", -1.0)]
    counter = token_counts.Counter(pieces)
    from tokenizers import Tokenizer, models
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0)] + pieces + [(f"<0x{b:02X}>", 0.0) for b in range(256)], 0, True))
    texts = ["".join(t) for n in range(7) for t in itertools.product("a \nb" if n < 6 else "a ", repeat=n)]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(t) for t in raw]))
    got = counter.rows(data, off, whole=True)[1].tolist()
    assert got == [len(tokenizer.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0 for t in texts]


def test_runs_of_unknown_characters_are_one_piece_without_byte_fallback():
    import itertools
    pieces = [("▁", -1.0), ("a", -1.0), ("▁a", -1.25), ("b", -1.0), ("ab", -1.5)]
    counter = token_counts.Counter(pieces, byte_fallback=False)
    from tokenizers import Tokenizer, models
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0)] + pieces, 0, False))
    texts = ["".join(t) for n in range(6) for t in itertools.product("ab漢字 ", repeat=n)] + ["a漢字漢b", "漢" * 50]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(t) for t in raw]))
    got = counter.rows(data, off, whole=True)[1].tolist()
    assert got == [len(tokenizer.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0 for t in texts]
    assert counter.count("a漢字漢b")[1] == 3
