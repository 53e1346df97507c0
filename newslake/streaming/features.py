"""Feature rows for articles as they arrive in the store."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from newslake.functions.text import preferred_text
from newslake.operators.features import extract_features
from newslake.operators.filters import MIN_FEATURE_LENGTH, min_trimmed_length
from newslake.functions.vectors import to_list
from pyspark.sql import functions as F


def article_texts(articles: DataFrame, prefer_full_content: bool = True) -> DataFrame:
    text = preferred_text("full_content", "content", prefer_full_content)
    return min_trimmed_length(
        articles.select(F.col("id").alias("article_id"), text.alias("clean_text")), "clean_text", MIN_FEATURE_LENGTH
    )


def stream_features(articles: DataFrame, model: PipelineModel, path: str, checkpoint: str) -> DataStreamWriter:
    """Write feature rows of new article files; the checkpoint remembers what was read.

    Text that is filled in later arrives as a new file row and gives a new feature
    row, so nothing is lost to a highest-id mark.
    """
    rows = extract_features(article_texts(articles), model)
    dense = rows.withColumn("feature_vector", to_list("features")).drop("features")
    return dense.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
