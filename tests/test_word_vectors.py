"""Word vectors: texts are split once, and the parts of the training follow from the corpus."""

import pytest
from pyspark.sql import functions as F

from newslake.catalog import vectors as queries
from newslake.operators import vectors


def test_texts_are_split_once(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    def split(text):
        calls.add(1)
        return text.split()

    texts = [f"alpha beta gamma delta alpha beta n{n % 3}" for n in range(40)]
    docs = spark.createDataFrame([(n, x) for n, x in enumerate(texts)], "doc_id long, text string")
    made = docs.select("doc_id", F.udf(split, "array<string>")("text").alias("tokens"))
    monkeypatch.setattr(queries, "texts", lambda *_: docs)
    monkeypatch.setattr(queries.corpus, "training_corpus", lambda *_: made)
    found = queries.word2vec_neighbours(spark, "").collect()
    assert {r.query_id for r in found} == {"alpha", "beta", "gamma", "delta", "n0"}
    assert calls.value == len(texts)


@pytest.mark.parametrize("docs, parts", [(0, 8), (3, 8), (80, 8), (81, 9), (200, 20)])
def test_parts_follow_from_the_corpus(spark, docs, parts):
    rows = spark.range(docs).select(F.array_repeat(F.lit("w"), 10).alias("tokens"))
    assert vectors.training_parts(rows, part_tokens=100) == parts
