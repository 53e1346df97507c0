"""Counts, coverage and quality figures of the article table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import has_text, percentage

UNCATEGORIZED = "(uncategorized)"
UNKNOWN = "(unknown)"


def _label(column: str, name: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(name))


def total_count(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count("*").alias("total_articles"))


def count_by_category(articles: DataFrame) -> DataFrame:
    """NULL and '' are shown under one name; their counts are added up."""
    counts = articles.groupBy("category").agg(F.count("*").alias("n"))
    return counts.groupBy(_label("category", UNCATEGORIZED).alias("category")).agg(F.sum("n").alias("total"))


def top_sources(articles: DataFrame, k: int = 10) -> DataFrame:
    counts = articles.groupBy("source").agg(F.count("*").alias("total"))
    named = counts.select(_label("source", UNKNOWN).alias("source"), "total")
    return named.orderBy(F.desc("total"), "source").limit(k)


def coverage_by_category(articles: DataFrame) -> DataFrame:
    """Share of articles with full text, and the mean length of that text."""
    length = F.length(F.trim("full_content"))
    counts = articles.groupBy("category").agg(
        F.count("*").alias("total"),
        F.sum(F.when(length > 0, 1).otherwise(0)).alias("with_full"),
        F.avg(F.nullif(length, F.lit(0))).alias("avg_length"),
    )
    return counts.select(
        _label("category", UNCATEGORIZED).alias("category"),
        "total",
        "with_full",
        (F.col("total") - F.col("with_full")).alias("missing"),
        percentage("with_full", "total").alias("coverage_pct"),
        F.round("avg_length", 1).alias("avg_full_length"),
    )


def coverage_with_overall(articles: DataFrame) -> DataFrame:
    """Per category and overall; ``is_overall`` marks the total row.

    The rollup runs over the category counts, so the texts are read once.
    """
    counts = articles.groupBy("category").agg(
        F.count("*").alias("total"),
        F.sum(F.when(F.length(F.trim("full_content")) > 0, 1).otherwise(0)).alias("with_full"),
    )
    rolled = counts.rollup("category").agg(
        F.grouping("category").cast("int").alias("is_overall"),
        F.sum("total").alias("total"),
        F.sum("with_full").alias("with_full"),
    )
    return rolled.select(
        F.when(F.col("is_overall") == 1, F.lit("(overall)"))
        .otherwise(_label("category", UNCATEGORIZED))
        .alias("category"),
        "is_overall",
        "total",
        "with_full",
        percentage("with_full", "total").alias("coverage_pct"),
    )


def content_counts(articles: DataFrame) -> DataFrame:
    """Rows, rows whose full text is not NULL, and rows whose full text is not blank."""
    return articles.agg(
        F.count("*").alias("total"),
        F.count("full_content").alias("non_null_full_content"),
        F.count_if(has_text("full_content")).alias("non_empty_full_content"),
    )


def save_stats(marked: DataFrame) -> DataFrame:
    """Per category from rows marked ``inserted``: total, saved, duplicates."""
    return marked.groupBy("category").agg(
        F.count("*").alias("total"),
        F.count_if("inserted").alias("saved"),
        (F.count("*") - F.count_if("inserted")).alias("duplicates"),
    )


def run_counters(deduplicated: DataFrame) -> DataFrame:
    """Totals of one collection run from rows with a ``drop_reason`` (NULL = kept)."""
    return deduplicated.agg(
        F.count("*").alias("total_articles"),
        F.count("drop_reason").alias("duplicates_removed"),
        F.count_if(F.col("drop_reason").isNull()).alias("kept"),
        F.count_if(F.col("drop_reason") == "duplicate_url").alias("duplicate_url"),
        F.count_if(F.col("drop_reason") == "duplicate_content").alias("duplicate_content"),
        F.count_if(F.col("drop_reason") == "similar_title").alias("similar_title"),
    )


def fetch_counters(fetched: DataFrame) -> DataFrame:
    """Totals of one fetch run from rows with ``fetch_status`` and ``status``."""
    return fetched.agg(
        F.count("*").alias("articles_requested"),
        F.count_if(F.col("fetch_status") == "success").alias("articles_fetched"),
        F.count_if(F.col("fetch_status") == "error").alias("articles_failed"),
        F.count_if(F.col("fetch_status") == "skipped").alias("articles_skipped"),
        F.count_if(F.col("status") == 403).alias("blocked_403"),
    )


def message_counters(results: DataFrame) -> DataFrame:
    """Totals of a consumer run from rows with ``enrichment_status`` (NULL = failed)."""
    return results.agg(
        F.count("*").alias("messages_consumed"),
        F.count("enrichment_status").alias("processing_success"),
        F.count_if(F.col("enrichment_status") == "summary_only").alias("processing_partial"),
        F.count_if(F.col("enrichment_status").isNull()).alias("processing_failures"),
    )


def category_share(df: DataFrame, column: str = "category") -> DataFrame:
    """Count and percentage of each value; the total is a one-row subquery."""
    total = df.agg(F.count(column).alias("n")).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.select(column, "n", F.round(F.col("n") / total * 100, 4).alias("pct"))


def data_quality(df: DataFrame, column: str = "content") -> DataFrame:
    """NULL, empty and valid values of a column.

    A NULL is counted as NULL only, so ``valid`` is the number of usable rows.
    """
    c = F.col(column)
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(c.isNull()).alias("null_count"),
        F.count_if(c == "").alias("empty_count"),
    )
    valid = F.col("total") - F.col("null_count") - F.col("empty_count")
    return counts.select(
        "*", valid.alias("valid_count"), percentage(valid, F.col("total")).alias("valid_pct")
    )


def data_quality_as_published(df: DataFrame, column: str = "content") -> DataFrame:
    """The same figures where empty includes NULL, so NULLs are subtracted twice."""
    c = F.col(column)
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(c.isNull()).alias("null_count"),
        F.count_if(F.coalesce(c, F.lit("")) == "").alias("empty_count"),
    )
    valid = F.col("total") - F.col("null_count") - F.col("empty_count")
    return counts.select(
        "*", valid.alias("valid_count"), percentage(valid, F.col("total")).alias("valid_pct")
    )


def corpus_overview(df: DataFrame, key: str, text: str, category: str) -> DataFrame:
    """Distinct keys, distinct categories and the mean length of the distinct texts."""
    counts = df.agg(F.count_distinct(key).alias("keys"), F.count_distinct(category).alias("categories"))
    texts = df.select(text).distinct().agg(
        F.count("*").alias("texts"), F.round(F.avg(F.length(text)), 4).alias("mean_length")
    )
    return counts.select(
        "*",
        texts.select("texts").scalar().alias("distinct_texts"),
        texts.select("mean_length").scalar().alias("mean_length"),
    )


def distinct_size_by_category(df: DataFrame, columns: list[str], category: str = "category") -> DataFrame:
    """Rows per category after whole-row duplicates are gone."""
    return df.select(*columns).dropDuplicates().groupBy(category).agg(F.count("*").alias("n"))


def date_range(df: DataFrame, column: str = "publish_ts") -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def expansion(articles: DataFrame) -> DataFrame:
    """How many times longer the full text is than the summary (NULL without a summary)."""
    summary = F.length(F.coalesce("content", F.lit("")))
    full = F.length("full_content")
    return articles.select(
        "id",
        summary.alias("summary_length"),
        full.alias("full_length"),
        F.round(F.when(summary > 0, full / summary), 1).alias("expansion"),
    )


def success_rate(requested: Column | str, updated: Column | str) -> Column:
    return percentage(updated, requested, 1)


def improvement(before: DataFrame, after: DataFrame) -> DataFrame:
    """Articles with full text before and after a run."""
    n = F.count_if(has_text("full_content"))
    old = before.agg(n.alias("n")).scalar()
    return after.agg(n.alias("after")).select(
        old.alias("before"), "after", (F.col("after") - old).alias("improvement")
    )


def run_performance(runs: DataFrame) -> DataFrame:
    """Speed per model from a run log ``(model, docs, seconds, vocab_size)``."""
    totals = runs.groupBy("model").agg(
        F.sum("docs").alias("docs"), F.sum("seconds").alias("seconds"), F.max("vocab_size").alias("vocab_size")
    )
    docs, seconds = F.col("docs"), F.col("seconds")
    return totals.select(
        "*",
        F.round(F.when(seconds > 0, docs / seconds), 2).alias("docs_per_sec"),
        F.round(F.when(docs > 0, seconds * 1000 / docs), 2).alias("ms_per_doc"),
    )


def snapshot_changes(
    current: DataFrame, previous: DataFrame, categories: DataFrame
) -> DataFrame:
    """Per listed category ``(pos, category)``: the current figures and growth since the last check."""
    now = current.select("category", "total", "with_full", "coverage_pct")
    then = previous.select("category", F.col("total").alias("previous_total"))
    joined = categories.join(now, "category", "left").join(then, "category", "left")
    total = F.coalesce("total", F.lit(0))
    return joined.select(
        "pos",
        "category",
        F.coalesce("with_full", F.lit(0)).alias("with_full"),
        total.alias("total"),
        F.coalesce("coverage_pct", F.lit(0.0)).alias("coverage_pct"),
        (total - F.coalesce("previous_total", F.lit(0))).alias("growth"),
    )


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Summary length before and full-text length after, for the same articles."""
    old = before.select("id", "title", F.length(F.coalesce("content", F.lit(""))).alias("summary_length"))
    new = after.select("id", F.length(F.coalesce("full_content", F.lit(""))).alias("full_length"))
    return old.join(new, "id", "left")


def newest(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    return df.orderBy(F.desc(id_col)).limit(n)


def latest_published(df: DataFrame, n: int = 20, column: str = "publish_ts") -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column), F.desc("id")).limit(n)


def last_updated_with_text(articles: DataFrame) -> DataFrame:
    """The most recently updated article that has full text."""
    return (
        articles.filter(F.col("full_content").isNotNull()).orderBy(F.desc("updated_at"), F.desc("id")).limit(1)
    )
