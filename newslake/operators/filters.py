"""Row filters and small projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import has_text, is_blank, strip
from newslake.schemas import FEED_ITEM_KEYS

# Thresholds of the feed check and of the text filters.
FULL_TEXT_LENGTH = 900
FULL_TEXT_RATIO = 1.35
MIN_FULL_LENGTH = 800
MIN_FEATURE_LENGTH = 80
MIN_CONTENT_LENGTH = 50


def required_fields(items: DataFrame) -> DataFrame:
    """Items with a title and a link that are not blank."""
    return items.filter((strip("title") != "") & (strip("link") != ""))


def _complete() -> Column:
    complete = F.lit(True)
    for key in FEED_ITEM_KEYS:
        complete = complete & F.col(key).isNotNull()
    return complete


def valid_records(items: DataFrame) -> DataFrame:
    return items.filter(_complete())


def rejected_records(items: DataFrame) -> DataFrame:
    """What :func:`valid_records` leaves out, with the names of the absent keys."""
    missing = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in FEED_ITEM_KEYS]))
    return items.filter(~_complete()).withColumn("missing_keys", missing)


def min_trimmed_length(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.filter(F.length(F.trim(column)) >= n)


def min_length(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.filter(F.length(column) >= n)


def after_id(df: DataFrame, since_id: int, id_col: str = "id") -> DataFrame:
    return df.filter(F.col(id_col) > since_id)


def missing_content(articles: DataFrame) -> DataFrame:
    return articles.filter(is_blank("full_content"))


def populated_content(articles: DataFrame) -> DataFrame:
    return articles.filter(has_text("full_content"))


def select_categories(df: DataFrame, categories: Iterable[str]) -> DataFrame:
    return df.filter(F.col("category").isin([c.strip() for c in categories if c.strip()]))


def unknown_categories(known: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested categories that the registry does not have."""
    return requested.select("category").distinct().join(known.select("category"), "category", "left_anti")


def critical_fields(articles: DataFrame, longer_than: int = MIN_CONTENT_LENGTH) -> DataFrame:
    """Rows with title and content, the content longer than the bound."""
    return articles.dropna(subset=["title", "content"]).filter(F.length("content") > longer_than)


def non_empty_tokens(df: DataFrame, column: str = "tokens") -> DataFrame:
    return df.filter(F.size(column) > 0)


def is_full_text(
    content_length: Column | str,
    summary_length: Column | str,
    threshold: int = FULL_TEXT_LENGTH,
    ratio: float = FULL_TEXT_RATIO,
) -> Column:
    """Long enough, and clearly longer than the summary if there is one."""
    content = F.col(content_length) if isinstance(content_length, str) else content_length
    summary = F.col(summary_length) if isinstance(summary_length, str) else summary_length
    return (content >= threshold) & ((summary == 0) | (content >= summary * F.lit(ratio)))


def in_vocabulary(probes: DataFrame, vocabulary: DataFrame, fallback: int = 5) -> DataFrame:
    """Probe words ``(pos, word)`` that the vocabulary ``(word, n)`` knows.

    If it knows none, the most frequent words are taken.
    """
    known = probes.join(vocabulary.select("word"), "word", "left_semi").select("pos", "word")
    frequent = vocabulary.orderBy(F.desc("n"), "word").limit(fallback).select("word", "n")
    any_known = known.limit(1).agg(F.count("*") > 0).scalar()
    replaced = frequent.filter(~any_known).select(
        F.lit(None).cast(probes.schema["pos"].dataType).alias("pos"), "word"
    )
    return known.unionByName(replaced)


def below_coverage(stats: DataFrame, minimum: float) -> DataFrame:
    """Categories under the threshold; any row means the gate fails."""
    return stats.filter(F.col("coverage_pct") < minimum)
