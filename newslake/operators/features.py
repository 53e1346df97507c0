"""Term weights and the hashed feature job."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import normalize_for_ml
from newslake.operators.compute import compute_once, explode_once
from newslake.operators.filters import MIN_FEATURE_LENGTH
from newslake.operators.ordering import join_per_key, top_per_key
from newslake.session import cut_lineage, set_down

# Width of the hashed vector and the version written beside it.
NUM_FEATURES = 4096
VERSION = "spark_v1"


def normalized(articles: DataFrame, min_length: int = MIN_FEATURE_LENGTH) -> DataFrame:
    """Add ``normalized_text`` to ``(article_id, clean_text)`` and drop short rows."""
    text = compute_once(articles, normalized_text=normalize_for_ml("clean_text"))
    return text.filter(F.length("normalized_text") >= min_length)


def term_frequencies(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    return explode_once(docs, [key], tokens, "term").groupBy(key, "term").agg(F.count("*").alias("tf"))


def _idf(docs: int | object, df: str = "df"):
    return F.log((docs + F.lit(1.0)) / (F.col(df) + F.lit(1.0)))


def tf_idf(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``(key, term, tf, df, idf, tf_idf)`` with idf = ln((N + 1) / (df + 1)).

    The term frequencies are set down: the counts of documents, their sum and the weights
    read different columns of them, and would each have the tokens made anew.
    """
    total = docs.agg(F.count("*").alias("n")).scalar()
    tf = set_down(term_frequencies(docs, key, tokens), "term-frequencies")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weighted = join_per_key(tf, df, "term", "df").withColumn("idf", _idf(total))
    return weighted.select(key, "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def top_terms_by_group(docs: DataFrame, group: str, tokens: str = "tokens", k: int = 10) -> DataFrame:
    """The ``k`` terms with the highest summed tf-idf in every group.

    The weight of a term is the same in all documents, so the documents are never
    brought together again: one shuffle of ``(group, term)`` counts, added up in
    the map tasks, carries everything.  Each token counts for the term frequency,
    each distinct token of a document once more for the document frequency.  The sums
    are set down, as their sums over all groups are joined to them.
    """
    total = docs.agg(F.count("*").alias("n")).scalar()

    def marked(words, tf: int, df: int):
        return F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(tf).alias("tf"), F.lit(df).alias("df")))

    made = compute_once(docs, _tokens=F.col(tokens))
    listed = F.concat(marked(F.col("_tokens"), 1, 0), marked(F.array_distinct("_tokens"), 0, 1))
    counts = explode_once(made, [group], listed, "t").select(group, "t.*")
    sums = counts.groupBy(group, "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df_group"))
    both = set_down(sums, "group-terms")
    df = both.groupBy("term").agg(F.sum("df_group").alias("df"))
    scored = both.join(df, "term").withColumn("idf", _idf(total))
    scored = scored.withColumn("score", F.round(F.col("tf") * F.col("idf"), 6))
    best = top_per_key(scored, [group], [F.desc("score"), "term"], k)
    return best.select(group, "term", "tf", "df", "score")


def feature_pipeline(num_features: int = NUM_FEATURES, unicode: bool = False) -> Pipeline:
    """Tokenizer, stop words, hashed term counts, idf."""
    return Pipeline(
        stages=[
            RegexTokenizer(
                inputCol="normalized_text",
                outputCol="token_candidates",
                pattern=r"(?U)\W+" if unicode else r"\W+",
                minTokenLength=2,
            ),
            StopWordsRemover(inputCol="token_candidates", outputCol="tokens", caseSensitive=False),
            HashingTF(inputCol="tokens", outputCol="token_tf", numFeatures=num_features),
            IDF(inputCol="token_tf", outputCol="features"),
        ]
    )


def fit_features(articles: DataFrame, num_features: int = NUM_FEATURES, unicode: bool = False) -> PipelineModel:
    """Fit on ``(article_id, clean_text)``; save the result to use it again."""
    return feature_pipeline(num_features, unicode).fit(normalized(articles))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def extract_features(
    articles: DataFrame, model: PipelineModel, version: str = VERSION, processed_at=None
) -> DataFrame:
    """``(article_id, token_count, tokens, features, pipeline_version, processed_at)``.

    The vector stays sparse; rows without a token are left out.
    """
    return _feature_rows(model.transform(normalized(articles)), version, processed_at)


def fit_and_extract(
    articles: DataFrame,
    num_features: int = NUM_FEATURES,
    unicode: bool = False,
    version: str = VERSION,
    processed_at=None,
) -> tuple[DataFrame, PipelineModel]:
    """Rows as of :func:`extract_features` under a model fitted on the same articles, and the model.

    Texts are tokenised and counted once; the fit and the rows both read what was set down.
    """
    *before, idf = feature_pipeline(num_features, unicode).getStages()
    counted = normalized(articles)
    for stage in before:
        counted = stage.transform(counted)
    counted = cut_lineage(counted.select("article_id", "tokens", idf.getInputCol()))
    fitted = idf.fit(counted)
    return _feature_rows(fitted.transform(counted), version, processed_at), PipelineModel([*before, fitted])


def _feature_rows(transformed: DataFrame, version: str, processed_at) -> DataFrame:
    rows = compute_once(transformed.select("article_id", "tokens", "features"), tokens=F.col("tokens"))
    return rows.filter(F.size("tokens") > 0).select(
        "article_id",
        F.size("tokens").alias("token_count"),
        "tokens",
        "features",
        F.lit(version).alias("pipeline_version"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    )


def export_features(features: DataFrame) -> DataFrame:
    """The same with tokens and dense vector as JSON text."""
    from newslake.functions.vectors import to_list

    return features.select(
        "article_id",
        "token_count",
        F.to_json("tokens").alias("tokens"),
        F.to_json(to_list("features")).alias("feature_vector"),
        "pipeline_version",
        "processed_at",
    )
