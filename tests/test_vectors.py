"""Neighbours, projections, embeddings and sampling against numpy."""

import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newslake.catalog.fixtures import table
from newslake.operators import corpus, sequences, vectors


# Workers cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class HashedTokenEncoder:
    """A stand-in for a language model: every token has a fixed pseudo-random vector.

    ``pooling`` is 'mean' over all tokens or 'cls', the first token alone; vectors
    have length 1.
    """

    def __init__(self, dims: int = 32, pooling: str = "mean", max_tokens: int | None = None):
        self.dims, self.pooling, self.max_tokens = dims, pooling, max_tokens
        self.known: dict[str, np.ndarray] = {}

    def _token(self, token: str) -> np.ndarray:
        if token not in self.known:
            from zlib import crc32

            self.known[token] = np.random.default_rng(crc32(token.encode())).standard_normal(self.dims)
        return self.known[token]

    def _text(self, text: str) -> np.ndarray:
        tokens = ["[CLS]", *text.lower().split()[: self.max_tokens]]
        if self.pooling == "cls":
            # The leading mark sees the text through its first word.
            pooled = sum(self._token(t) for t in tokens[:2])
        else:
            pooled = np.mean([self._token(t) for t in tokens], axis=0)
        return pooled / max(float(np.linalg.norm(pooled)), 1e-12)

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.array([self._text(t) for t in texts]).reshape(len(texts), self.dims)


def load(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    local = rows.orderBy("id").collect()
    matrix = np.array([r.vector for r in local], dtype="float64")
    return rows, np.array([r.id for r in local]), matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


@pytest.mark.parametrize("block", [4096, 60])
def test_nearest_for_all_rows(spark, sf, block):
    rows, ids, unit = load(spark, sf)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -2)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :3]
    expected = {int(ids[n]): [int(ids[j]) for j in best[n]] for n in range(len(ids))}
    got = {}
    for r in vectors.nearest(rows, rows, 3, query_block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == expected


def test_nearest_edges(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [-1.0, 0.0])], "id long, vector array<double>")
    got = vectors.nearest(rows, rows.filter("id = 1"), 10).orderBy("rank").collect()
    assert [(r.id, r.similarity) for r in got] == [(3, 1.0), (2, 0.0), (4, -1.0)]
    assert vectors.nearest(rows, rows.filter("id = 9"), 2).count() == 0
    named = spark.createDataFrame([("a", [1.0, 0.0])], "id string, vector array<double>")
    assert [r.id for r in vectors.nearest(rows, named, 2).orderBy("rank").collect()] == [1, 3]


def test_no_cartesian_product(spark, sf):
    rows, _, _ = load(spark, sf)
    plan = vectors.nearest(rows, rows, 3, query_block=60)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_projection(spark, sf):
    rows, _, _ = load(spark, sf)
    got = np.array([r.projection for r in vectors.project(rows).orderBy("id").collect()])
    raw = np.array([r.vector for r in rows.orderBy("id").collect()], dtype="float64")
    centred = raw - raw.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ axes[:2].T), atol=1e-5)


def test_document_vectors(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a", "zz"]), (2, ["zz"]), (3, [])], "doc_id long, tokens array<string>")
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, vector array<double>")
    got = {r.doc_id: r.vector for r in vectors.document_vectors(docs, words, 2).collect()}
    assert np.allclose(got[1], [2 / 3, 1.0]) and got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]
    unit = {r.doc_id: r.vector for r in vectors.document_vectors(docs, words, 2, normalize=True).collect()}
    assert np.isclose(np.linalg.norm(unit[1]), 1) and unit[2] == [0.0, 0.0]


def test_document_vectors_of_rare_words_and_what_is_shuffled(spark):
    rng = np.random.default_rng(1)
    rows = [(d, [f"w{min(rng.geometric(0.2), 30)}" for _ in range(rng.integers(0, 40))]) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    table_of = {f"w{n}": rng.normal(size=3).tolist() for n in range(1, 25)}
    words = spark.createDataFrame(list(table_of.items()), "word string, vector array<double>")
    expected = [np.mean([table_of[w] for w in ws if w in table_of] or [[0.0] * 3], axis=0) for _, ws in rows]
    for frequent in (100, 4):
        found = vectors.document_vectors(docs, words, 3, frequent=frequent)
        assert np.allclose([r.vector for r in found.orderBy("doc_id").collect()], expected)
    # Words meet their vectors where the documents lie; sums are no objects that are sorted and spilled.
    plan = vectors.document_vectors(docs, words, 3)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "hashpartitioning(word" not in plan


def test_embedding(spark):
    docs = spark.createDataFrame([(n, f"word{n} common text") for n in range(50)] + [(50, None)], "doc_id long, text string")
    for pooling in ("mean", "cls"):
        got = vectors.embed(docs, "text", lambda p=pooling: HashedTokenEncoder(8, p), batch_size=7).collect()
        encoder = HashedTokenEncoder(8, pooling)
        expected = encoder([r.text or "" for r in docs.orderBy("doc_id").collect()])
        assert np.allclose([r.vector for r in sorted(got, key=lambda r: r.doc_id)], expected)
        assert np.allclose(np.linalg.norm(expected, axis=1), 1)


def test_samples_repeat(spark):
    rows = spark.range(500).withColumnRenamed("id", "k")
    one = [r.k for r in vectors.sample_rows(rows, 20, "k").collect()]
    assert one == [r.k for r in vectors.sample_rows(rows.repartition(7), 20, "k").collect()] and len(set(one)) == 20
    assert one != [r.k for r in vectors.sample_rows(rows, 20, "k", seed=1).collect()]
    pairs = [tuple(r) for r in vectors.sample_pairs(rows, 30, "k").collect()]
    assert len(set(pairs)) == 30 and all(a < b for a, b in pairs)
    assert pairs == [tuple(r) for r in vectors.sample_pairs(rows.repartition(5), 30, "k").collect()]


def test_word_vectors(spark):
    docs = spark.createDataFrame([(["sun", "moon", "star"] * 5,), (["bread", "milk", "egg"] * 5,)] * 30, "tokens array<string>")
    model = vectors.train_word_vectors(docs, dims=8, epochs=3, min_count=1, partitions=1)
    words = vectors.word_vectors(model)
    anchors = spark.createDataFrame([("sun",), ("absent",)], "word string")
    got = vectors.similar_words(words, anchors, 2).orderBy("rank").collect()
    assert {r.query_id for r in got} == {"sun"} and {r.word for r in got} == {"moon", "star"}
    pair = spark.createDataFrame([("sun", "moon")], "a string, b string")
    assert np.isclose(vectors.word_similarity(words, pair).first().similarity, got[0].similarity) or got[0].word == "star"


def test_compare_models_with_texts(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])], "id long, vector array<double>")
    other = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0])], "id long, vector array<double>")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    texts = spark.createDataFrame([(n, f"text {n}") for n in (1, 2, 3)], "id long, text string")
    got = vectors.compare_models(pairs, rows, other, texts).collect()
    assert [(r.a, r.b, r.sim_a, r.sim_b, r.delta) for r in got] == [(1, 3, 0.0, 1.0, -1.0), (1, 2, 0.7071, 1.0, -0.2929)]
    assert got[0].snippet_b == "text 3..."


def test_sequences(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["zz"]), (3, [])], "k long, tokens array<string>")
    vocabulary = sequences.build_vocabulary(corpus.token_counts(docs.filter("k = 1")))
    assert {r.word: r.id for r in vocabulary.collect()} == {"<PAD>": 0, "UNK": 1, "a": 2, "b": 3}
    encoded = sequences.encode(docs, vocabulary, ["k"])
    assert {r.k: r.ids for r in encoded.collect()} == {1: [2, 3, 2], 2: [1], 3: []}
    padded = sequences.pad_in_batches(encoded, 2, F.lit(0), ["k"], ["ids"])
    assert {r.k: (r.batch_no, r.ids) for r in padded.collect()} == {1: (0, [2, 3, 2]), 2: (0, [1, 0, 0]), 3: (1, [])}
    frame = spark.createDataFrame([([2, 3, 0, 0], [2, 4, 0, 0])], "p array<int>, l array<int>")
    assert tuple(sequences.tag_accuracy(frame, "p", "l", 0).first()) == (3, 2, 1.5)
    assert tuple(sequences.masked_tag_accuracy(frame, "p", "l", 0).first()) == (1, 2, 0.5)


def test_distinct_in_order_and_fallback(spark):
    from newslake.operators.filters import in_vocabulary

    one = spark.createDataFrame([(0, "x"), (1, "y")], "pos int, word string")
    two = spark.createDataFrame([(0, "y"), (1, "z"), (2, "x")], "pos int, word string")
    assert [r.word for r in corpus.distinct_in_order([one, two]).orderBy("pos").collect()] == ["x", "y", "z"]
    counts = spark.createDataFrame([(w, n) for n, w in enumerate("abcdefg")], "word string, n long")
    assert sorted(r.word for r in in_vocabulary(one, counts).collect()) == list("cdefg")


def test_histogram_of_equal_values(spark):
    frame = spark.createDataFrame([(5,), (5,), (None,)], "v int")
    assert [(r.bin, r.n) for r in corpus.histogram(frame, "v").collect()] == [(1, 2)]


def test_approximate_vocabulary(spark, sf):
    from newslake.catalog import QUERIES

    exact, rough = QUERIES["vocab_ttr"](spark, sf).first(), QUERIES["vocab_ttr_approximate"](spark, sf).first()
    assert rough.total_tokens == exact.total_tokens
    assert rough.within_three_errors
