"""Moving an older store into the current one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.dates import parse_iso
from newslake.operators.merge import drop_orphans, migrate_articles, migrate_features


def legacy_features(rows: DataFrame, now=None) -> DataFrame:
    """Feature rows that were kept as JSON text, as typed rows."""
    return rows.select(
        "article_id",
        F.col("token_count").cast("int").alias("token_count"),
        F.from_json("tokens", "array<string>").alias("tokens"),
        F.from_json("feature_vector", "array<double>").alias("feature_vector"),
        "pipeline_version",
        parse_iso("processed_at", now).alias("processed_at"),
    )


def migrate(
    target: DataFrame, legacy: DataFrame, target_features: DataFrame, features: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The target's articles and features after the migration; features need their article."""
    articles = migrate_articles(target, legacy)
    return articles, drop_orphans(migrate_features(target_features, features), articles)
