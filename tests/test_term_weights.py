"""Term weights against plain counts; the tokens are made once, whatever reads them."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newslake.functions import text as t
from newslake.operators import features

DOCS = [(1, "en", "b a b"), (2, "en", "a c"), (3, "fr", "a"), (4, "fr", ""), (5, "en", "c c c")]


@pytest.fixture
def counted_tokens(spark):
    """Documents whose tokens come from a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def split(text):
        calls.add(1)
        return text.split()

    docs = spark.createDataFrame(DOCS, "doc_id long, lang string, text string")
    return docs.select("doc_id", "lang", F.udf(split, "array<string>")("text").alias("tokens")), calls


def idfs():
    df = Counter(w for _, _, text in DOCS for w in set(text.split()))
    return {w: (n, math.log((len(DOCS) + 1) / (n + 1))) for w, n in df.items()}


def test_tf_idf_makes_tokens_once(counted_tokens):
    docs, calls = counted_tokens
    got = {(r.doc_id, r.term): (r.tf, r.df, r.tf_idf) for r in features.tf_idf(docs).collect()}
    known = idfs()
    assert got.keys() == {(i, w) for i, _, text in DOCS for w in text.split()}
    for i, _, text in DOCS:
        for w, tf in Counter(text.split()).items():
            assert got[i, w] == (tf, known[w][0], pytest.approx(tf * known[w][1]))
    assert calls.value == len(DOCS)


@pytest.mark.parametrize("unicode", [False, True])
def test_feature_tokens(spark, unicode):
    texts = ["Ab cd9-X é ÉK the ÀB1_c", "", None, "\U00010400\U00010400 ZZİz 0A", "A" * 5 + "\n" + "zZ"]
    rows = spark.createDataFrame([(n, x) for n, x in enumerate(texts)], "n int, text string")
    wide = F.split(F.lower("text"), r"[^\p{L}\p{Nd}]+" if unicode else r"[^0-9A-Za-z]+")
    plain = t.remove_stop_words(F.filter(wide, lambda w: F.length(w) >= 2))
    assert rows.filter(~t.feature_tokens("text", unicode).eqNullSafe(plain)).count() == 0


def test_feature_tokens_split_without_capitals(spark):
    """With them a split takes about twenty times as long, and the text is in lower case anyway."""
    plan = spark.createDataFrame([("a",)], "text string").select(t.feature_tokens("text"))
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "A-Z" not in plan


def test_top_terms_make_tokens_once(counted_tokens):
    docs, calls = counted_tokens
    got = {(r.lang, r.term): (r.tf, r.df, r.score) for r in features.top_terms_by_group(docs, "lang", k=9).collect()}
    known, tf = idfs(), defaultdict(int)
    for _, lang, text in DOCS:
        for w in text.split():
            tf[lang, w] += 1
    assert got == {(g, w): (n, known[w][0], round(n * known[w][1], 6)) for (g, w), n in tf.items()}
    assert calls.value == len(DOCS)
