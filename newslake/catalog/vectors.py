"""Queries over vectors: similarity, neighbours, means, projections."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from newslake.catalog.base import query
from newslake.catalog.corpora import WORDS_SQL, counts, tokenized
from newslake.catalog.fixtures import table, texts
from newslake.functions.vectors import l2_normalize, masked_mean
from newslake.operators import corpus, vectors
from newslake.session import set_down

VECTORS_SQL = "vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vector, label FROM embeddings)"


def all_vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


def next_pairs(spark, sf):
    """Every vector with the one that follows it."""
    rows = table(spark, sf, "embeddings").select("vec_id")
    return rows.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))


@query(
    "cosine_pairs",
    f"""WITH {VECTORS_SQL}
    SELECT x.id AS a, y.id AS b, round(list_cosine_similarity(x.vector, y.vector), 6) AS similarity
    FROM vectors x JOIN vectors y ON y.id = x.id + 1""",
)
def cosine_pairs(spark, sf):
    scored = vectors.pair_similarity(next_pairs(spark, sf), all_vectors(spark, sf))
    return scored.withColumn("similarity", F.round("similarity", 6))


@query(
    "knn",
    f"""WITH {VECTORS_SQL}, s AS (
      SELECT o.id AS query_id, v.id, round(list_cosine_similarity(o.vector, v.vector), 6) AS similarity,
             row_number() OVER (ORDER BY list_cosine_similarity(o.vector, v.vector) DESC, v.id) AS rank
      FROM vectors v, (SELECT * FROM vectors WHERE id = 0) o WHERE v.id <> o.id)
    SELECT query_id, id, similarity, rank FROM s WHERE rank <= 5""",
)
def knn(spark, sf):
    """The nearest five rows of a reference row among all rows."""
    rows = all_vectors(spark, sf)
    found = vectors.nearest(rows, rows.filter(F.col("id") == 0), 5)
    return found.select("query_id", "id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


CENTROIDS_SQL = """parts AS (
  SELECT label, i, avg(vector[i]) AS x FROM vectors, unnest(range(1, 65)) AS r(i) GROUP BY label, i
), centroids AS (
  SELECT label, list(x ORDER BY i) AS vector FROM parts GROUP BY label
)"""


@query(
    "knn_centroids",
    f"""WITH {VECTORS_SQL}, {CENTROIDS_SQL}, s AS (
      SELECT CAST(o.label AS BIGINT) AS query_id, v.id,
             round(list_cosine_similarity(o.vector, v.vector), 6) AS similarity,
             row_number() OVER (PARTITION BY o.label
                                ORDER BY list_cosine_similarity(o.vector, v.vector) DESC, v.id) AS rank
      FROM vectors v, centroids o)
    SELECT query_id, id, similarity, rank FROM s WHERE rank <= 5""",
)
def knn_centroids(spark, sf):
    """The five rows nearest to the mean vector of each label."""
    rows = all_vectors(spark, sf)
    centroids = vectors.group_means(rows, "label", "vector").select(F.col("label").cast("long").alias("id"), "vector")
    found = vectors.nearest(rows, centroids, 5, exclude_self=False)
    return found.select("query_id", "id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query(
    "mean_vector",
    f"""WITH {VECTORS_SQL}, {CENTROIDS_SQL}
    SELECT label, i - 1 AS pos, round(x, 6) AS x FROM parts""",
)
def mean_vector(spark, sf):
    means = vectors.group_means(all_vectors(spark, sf), "label", "vector")
    return means.select("label", F.posexplode("vector").alias("pos", "x")).select(
        "label", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x")
    )


@query(
    "l2_normalize",
    f"""WITH {VECTORS_SQL}
    SELECT id, i - 1 AS pos, round(vector[i] / sqrt(list_dot_product(vector, vector)), 6) AS x
    FROM vectors, unnest(range(1, 65)) AS r(i)""",
)
def l2_normalized(spark, sf):
    return all_vectors(spark, sf).select("id", F.posexplode(l2_normalize("vector")).alias("pos", "x")).select(
        "id", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x")
    )


@query(
    "masked_mean_pooling",
    f"""WITH {VECTORS_SQL}
    SELECT id, round((vector[i] + CASE WHEN label % 2 = 0 THEN vector[i + 16] ELSE 0 END
                      + vector[i + 32]) / CASE WHEN label % 2 = 0 THEN 3 ELSE 2 END, 6) AS x, i - 1 AS pos
    FROM vectors, unnest(range(1, 17)) AS r(i)""",
)
def masked_mean_pooling(spark, sf):
    """Each vector read as four token vectors; the last is padding, the second in odd labels too."""
    tokens = F.array(*[F.slice("vector", 1 + 16 * n, 16) for n in range(4)])
    mask = F.array(F.lit(1), (F.col("label") % 2 == 0).cast("int"), F.lit(1), F.lit(0))
    pooled = all_vectors(spark, sf).select("id", tokens.alias("tokens"), mask.alias("mask"))
    pooled = pooled.select("id", F.posexplode(masked_mean("tokens", "mask")).alias("pos", "x"))
    return pooled.select("id", F.round("x", 6).alias("x"), F.col("pos").cast("long").alias("pos"))


@query(
    "compare_models",
    f"""WITH {VECTORS_SQL}, center AS (
      SELECT list(x ORDER BY i) AS c FROM (
        SELECT i, avg(vector[i]) AS x FROM vectors, unnest(range(1, 65)) AS r(i) GROUP BY i)),
    second AS (SELECT id, [vector[i] - c[i] FOR i IN range(1, 65)] AS vector FROM vectors, center),
    s AS (
      SELECT x.id AS a, y.id AS b, list_cosine_similarity(x.vector, y.vector) AS sa,
             list_cosine_similarity(v.vector, w.vector) AS sb
      FROM vectors x JOIN vectors y ON y.id = x.id + 1 JOIN second v ON v.id = x.id JOIN second w ON w.id = y.id)
    SELECT a, b, round(sa, 4) AS sim_a, round(sb, 4) AS sim_b, round(sa - sb, 4) AS delta FROM s""",
)
def compare_models(spark, sf):
    """Plain vectors against vectors centred on the mean of all."""
    rows = all_vectors(spark, sf)
    center = vectors.group_means(rows.withColumn("one", F.lit(1)), "one", "vector").select("vector").scalar()
    centred = rows.withColumn("_c", center).select(
        "id", F.zip_with("vector", "_c", lambda x, c: x - c).alias("vector")
    )
    return vectors.compare_models(next_pairs(spark, sf), rows.select("id", "vector"), centred)


def word_table(spark, sf):
    """The most frequent words, each with the embedding of its rank."""
    ranked = corpus.zipf(counts(spark, sf)).select("word", (F.col("rank") - 1).alias("id"))
    return ranked.join(all_vectors(spark, sf).select("id", "vector"), "id").select("word", "vector")


@query(
    "document_vectors",
    f"""WITH {WORDS_SQL}, {VECTORS_SQL}, w AS (
      SELECT word, vector FROM (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS id FROM counts) r
      JOIN vectors USING (id)), m AS (
      SELECT doc_id, i, avg(vector[i]) AS x FROM words JOIN w USING (word), unnest(range(1, 65)) AS r(i)
      GROUP BY doc_id, i), v AS (
      SELECT doc_id, list(x ORDER BY i) AS vector FROM m GROUP BY doc_id)
    SELECT d.doc_id, round(coalesce(vector[1], 0), 6) AS first, round(coalesce(vector[64], 0), 6) AS last,
           round(coalesce(sqrt(list_dot_product(vector, vector)), 0), 6) AS length
    FROM documents d LEFT JOIN v ON d.doc_id = v.doc_id""",
)
def document_vectors(spark, sf):
    """Mean word vector of every document, shown by its ends and its length."""
    from newslake.functions.vectors import norm

    found = vectors.document_vectors(tokenized(spark, sf), word_table(spark, sf), 64)
    return found.select(
        "doc_id",
        F.round(F.element_at("vector", 1), 6).alias("first"),
        F.round(F.element_at("vector", -1), 6).alias("last"),
        F.round(norm("vector"), 6).alias("length"),
    )


@query("pca_2d")
def pca_2d(spark, sf):
    projected = vectors.project(all_vectors(spark, sf))
    return projected.select("id", *[F.round(F.abs(F.element_at("projection", n)), 4).alias(f"pc{n}") for n in (1, 2)])


@query("word2vec_neighbours")
def word2vec_neighbours(spark, sf):
    """Nearest words of the five most frequent ones under vectors trained on the documents.

    Sentences, anchors and vectors are set down, as the training and the search read them several times.
    """
    docs = texts(spark, sf, "documents", "doc_id", "text")
    sentences = set_down(corpus.training_corpus(docs, "text").select("tokens"), "sentences")
    model = vectors.train_word_vectors(sentences, dims=16, epochs=1)
    anchors = set_down(corpus.top_tokens(corpus.token_counts(sentences), 5), "anchors")
    words = set_down(vectors.word_vectors(model), "word-vectors")
    found = vectors.similar_words(words, anchors, 5)
    return found.select("query_id", "word", F.round("similarity", 4).alias("similarity"), "rank")


def letter_counts(batch: list[str]) -> np.ndarray:
    """An encoder that SQL can repeat: length, and how often some characters occur."""
    return np.array([[len(t), *(t.count(c) for c in " e.")] for t in batch], dtype="float64")


@query(
    "batch_embed",
    """SELECT doc_id, CAST(length(text) AS DOUBLE) AS size,
              CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS blanks,
              CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS letters_e,
              CAST(length(text) - length(replace(text, '.', '')) AS DOUBLE) AS stops
    FROM documents""",
)
def batch_embed(spark, sf):
    """Vectors of all documents from a text encoder, here one that counts."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    embedded = vectors.embed(docs, "text", lambda: letter_counts)
    names = ["size", "blanks", "letters_e", "stops"]
    return embedded.select("doc_id", *[F.element_at("vector", n + 1).alias(c) for n, c in enumerate(names)])


@query("sample_rows", "SELECT doc_id, source FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 80")
def sample_rows(spark, sf):
    return vectors.sample_rows(table(spark, sf, "documents").select("doc_id", "source"), 80, "doc_id")


@query(
    "sample_pairs",
    f"""WITH {VECTORS_SQL}, x AS (
      SELECT id, row_number() OVER (ORDER BY md5(id || ':42'), id) AS n FROM vectors), y AS (
      SELECT id, row_number() OVER (ORDER BY md5(id || ':43'), id) AS n FROM vectors), p AS (
      SELECT DISTINCT least(x.id, y.id) AS a, greatest(x.id, y.id) AS b FROM x JOIN y USING (n) WHERE x.id <> y.id), s AS (
      SELECT a, b FROM p ORDER BY md5(a || ':' || b || ':42'), a, b LIMIT 6)
    SELECT a, b, round(list_cosine_similarity(u.vector, v.vector), 6) AS similarity
    FROM s JOIN vectors u ON u.id = a JOIN vectors v ON v.id = b""",
)
def sample_pairs(spark, sf):
    rows = all_vectors(spark, sf)
    pairs = vectors.sample_pairs(rows, 6, "id")
    scored = vectors.pair_similarity(pairs, rows)
    return scored.withColumn("similarity", F.round("similarity", 6))
