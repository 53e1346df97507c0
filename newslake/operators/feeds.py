"""Feed registry rules and feed quality."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.functions.html import clean_html
from newslake.functions.text import strip
from newslake.operators.filters import FULL_TEXT_LENGTH, FULL_TEXT_RATIO, is_full_text, select_categories
from newslake.operators.ordering import top_per_key

# Shares of full-text entries from which a feed counts as full or mixed.
LIKELY_FULL, MIXED = 0.6, 0.3
ENTRY_FIELDS = ["title", "link", "published", "updated", "summary", "description", "content"]


def without_denied(registry: DataFrame, deny: DataFrame) -> DataFrame:
    return registry.join(deny.select("feed_url").distinct(), "feed_url", "left_anti")


def with_allowed(registry: DataFrame, allow: DataFrame) -> DataFrame:
    """Mark feeds on their category's allow list, and categories that have such a list."""
    listed = allow.select("category", "feed_url").distinct().withColumn("_listed", F.lit(True))
    has_list = allow.select("category").distinct().withColumn("_has_list", F.lit(True))
    joined = registry.join(listed, ["category", "feed_url"], "left").join(has_list, "category", "left")
    return joined.select(
        *registry.columns,
        F.col("_listed").isNotNull().alias("is_allowed"),
        F.col("_has_list").isNotNull().alias("has_allow_list"),
    )


def build_registry(
    registry: DataFrame,
    allow: DataFrame,
    deny: DataFrame,
    categories: Iterable[str] | None = None,
    allowlist_only: bool = False,
) -> DataFrame:
    """The feeds to poll, from ``(category, pos, feed_url)``.

    Denied feeds go first.  Then either only allowed feeds stay (a category
    without an allow list keeps all), or allowed feeds come before the others.
    ``rank`` is the place inside the category; a category without a feed left
    simply has no rows.
    """
    if categories is not None:
        registry = select_categories(registry, categories)
    marked = with_allowed(without_denied(registry, deny), allow)
    if allowlist_only:
        marked = marked.filter(F.col("is_allowed") | ~F.col("has_allow_list"))
        first = F.lit(0)
    else:
        first = F.when(F.col("is_allowed"), 0).otherwise(1)
    # A category's feed list is what one poll reads, so a window per category stays small.
    place = F.row_number().over(W.partitionBy("category").orderBy(first, "pos"))
    return marked.withColumn("rank", place).select("category", "rank", "feed_url", "is_allowed")


def entry_summaries(
    entries: DataFrame, threshold: int = FULL_TEXT_LENGTH, ratio: float = FULL_TEXT_RATIO
) -> DataFrame:
    """What is known of each entry: title, link, date, text lengths and whether it is full text.

    ``entries`` has ``title, link, published, updated, summary, description`` and
    ``content``, an array of ``(value)`` fragments.
    """
    fragments = F.transform(F.coalesce("content", F.array()), lambda c: c["value"])
    joined = strip(F.array_join(F.filter(fragments, lambda v: v.isNotNull() & (v != "")), "\n"))
    summary = F.coalesce("summary", "description", F.lit(""))
    raw = F.when(joined == "", summary).otherwise(joined)
    keep = [c for c in entries.columns if c not in ENTRY_FIELDS]
    texts = entries.select(
        *keep,
        strip(_first_given("title", "<no title>")).alias("title"),
        strip(_first_given("link", "")).alias("link"),
        strip(F.coalesce(_given("published"), _given("updated"), F.lit(""))).alias("published"),
        raw.alias("_content"),
        summary.alias("_summary"),
    )
    cleaned = texts.select(
        *keep,
        "title",
        "link",
        "published",
        F.length(clean_html("_content")).alias("content_length"),
        F.length(clean_html("_summary")).alias("summary_length"),
    )
    return cleaned.withColumn("is_full_text", is_full_text("content_length", "summary_length", threshold, ratio))


def _given(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _first_given(name: str, default: str) -> Column:
    return F.coalesce(_given(name), F.lit(default))


def fullness_label(share: Column | str) -> Column:
    """Label from the share of full-text entries; NULL (no entries) is NO_DATA."""
    share = F.col(share) if isinstance(share, str) else share
    return (
        F.when(share.isNull(), F.lit("NO_DATA"))
        .when(share >= LIKELY_FULL, F.lit("LIKELY_FULL_TEXT"))
        .when(share >= MIXED, F.lit("MIXED"))
        .otherwise(F.lit("LIKELY_SUMMARY"))
    )


def feed_fullness(feeds: DataFrame, summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Entries, full-text entries and label of every feed, also of those without entries."""
    counts = summaries.groupBy(*keys).agg(
        F.count("*").alias("entries"), F.count_if("is_full_text").alias("full_text")
    )
    joined = feeds.select(*keys).distinct().join(counts, keys, "left")
    return joined.select(
        *keys,
        F.coalesce("entries", F.lit(0)).alias("entries"),
        F.coalesce("full_text", F.lit(0)).alias("full_text"),
        fullness_label(F.col("full_text") / F.col("entries")).alias("label"),
    )


def first_entries(entries: DataFrame, n: int, keys: list[str], order: list) -> DataFrame:
    """The first ``n`` entries of every feed."""
    return top_per_key(entries, keys, order, n)
