import math

import pytest

from shelfwise.operators import text as TX


def test_tfidf_smoothed_idf_and_l2(spark):
    docs = spark.createDataFrame([(1, "red apple red"), (2, "green apple"), (3, "the blue sky")], "id long, text string")
    w, vocab = TX.tfidf(docs, "id", "text", min_df=1, max_df=1.0)
    got = {(r.id, r.term): r.weight for r in w.collect()}
    n = 3
    idf = {t: math.log((1 + n) / (1 + df)) + 1 for t, df in
           {"red": 1, "apple": 2, "green": 1, "blue": 1, "sky": 1}.items()}
    d1 = {"red": 2 * idf["red"], "apple": idf["apple"]}
    norm = math.sqrt(sum(v * v for v in d1.values()))
    assert got[(1, "red")] == pytest.approx(d1["red"] / norm)
    assert got[(1, "apple")] == pytest.approx(d1["apple"] / norm)
    assert (3, "the") not in got  # stop word
    assert [r.term for r in vocab.orderBy("index").collect()] == ["apple", "blue", "green", "red", "sky"]


def test_vocabulary_bounds(spark):
    docs = spark.createDataFrame([(i, "common rare%d" % (i % 2)) for i in range(10)], "id long, text string")
    _, vocab = TX.tfidf(docs, "id", "text", min_df=5, max_df=0.8)
    # 'common' is in 10/10 docs (> 0.8 * 10); rare0 / rare1 in 5 docs each
    assert sorted(r.term for r in vocab.collect()) == ["rare0", "rare1"]


def test_tokens_two_chars_unicode(spark):
    from shelfwise.functions.exprs import tokens
    df = spark.createDataFrame([("Élan a b2 été x_y",)], "t string")
    assert df.select(tokens("t").alias("k")).first().k == ["élan", "b2", "été", "x_y"]


def test_default_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert TX.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
