"""The feature job: article text to token and vector rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from newslake.operators.features import extract_features, fit_and_extract
from newslake.sources.store import articles_for_processing
from newslake.operators.filters import MIN_FEATURE_LENGTH


def process_articles(
    articles: DataFrame,
    model: PipelineModel | None = None,
    since_id: int | None = None,
    limit: int | None = None,
    prefer_full_content: bool = True,
    **options,
) -> tuple[DataFrame, PipelineModel]:
    """Feature rows and the model they were made with.

    Without a model one is fitted on these articles.  Save it and pass it again,
    so that later runs weigh terms the same way.
    """
    texts = articles_for_processing(articles, since_id, limit, MIN_FEATURE_LENGTH, prefer_full_content)
    if model is None:
        return fit_and_extract(texts, **options)
    return extract_features(texts, model, **options), model
