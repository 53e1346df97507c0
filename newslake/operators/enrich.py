"""Fetched pages joined to articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.html import extract_main_content
from newslake.functions.text import is_blank, is_blocked_or_paywalled, strip
from newslake.operators.filters import MIN_FULL_LENGTH
from newslake.operators.ordering import first_per_key
from newslake.operators.stats import newest


def fetch_outcomes(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """What fetching the page of every requested item gave.

    ``requests`` are items ``(title, link, publish_date, source, category)``,
    ``pages`` the fetched bodies ``(link, status, html)``, one per link.  Several
    fetches of a link need a column ``fetched_at``; the newest one counts.  A page
    counts as fetched if its status is 200 and it is neither blocked nor behind a
    paywall.  The output adds ``content, raw_length, cleaned_length,
    fetch_status, error``, and keeps an arrival number ``seq`` if there is one.
    """
    items = requests.select(
        *[c for c in ("seq",) if c in requests.columns],
        strip(F.coalesce("title", F.lit(""))).alias("title"),
        strip(F.coalesce("link", F.lit(""))).alias("link"),
        F.coalesce("publish_date", F.lit("")).alias("publish_date"),
        F.coalesce("source", F.lit("Unknown")).alias("source"),
        F.coalesce("category", F.lit("unknown")).alias("category"),
    ).withColumn("skipped", (F.col("title") == "") | (F.col("link") == ""))
    if "fetched_at" in pages.columns:
        newest_first = [F.col("fetched_at").desc_nulls_last(), F.col("status"), F.col("html")]
        pages = first_per_key(pages.select("link", "status", "html", "fetched_at"), ["link"], newest_first)
    usable = F.coalesce((F.col("status") == 200) & ~is_blocked_or_paywalled("status", "html"), F.lit(False))
    # Only requested pages are read for their text, each once, before the join can repeat it.
    asked = items.filter(~F.col("skipped")).select("link").distinct()
    bodies = pages.join(asked, "link", "left_semi").select(
        "link", "status", F.when(usable, F.col("html")).alias("html")
    )
    texts = bodies.select(
        "link",
        "status",
        F.length("html").alias("raw_length"),
        extract_main_content("html").alias("text"),
        F.col("html").isNotNull().alias("usable"),
    )
    joined = items.join(texts, "link", "left")
    found = F.coalesce("usable", F.lit(False)) & ~F.col("skipped")
    filled = found & (F.length("text") > 0)
    return joined.select(
        *[c for c in ("seq",) if c in requests.columns],
        F.when(F.col("title") == "", F.lit("<missing>")).otherwise(F.col("title")).alias("title"),
        F.when(F.col("link") == "", F.lit("<missing>")).otherwise(F.col("link")).alias("link"),
        "publish_date",
        "source",
        "category",
        "status",
        F.when(filled, F.col("text")).otherwise(F.lit("")).alias("content"),
        F.when(found, F.col("raw_length")).otherwise(F.lit(0)).alias("raw_length"),
        F.when(filled, F.length("text")).otherwise(F.lit(0)).alias("cleaned_length"),
        F.when(F.col("skipped"), F.lit("skipped"))
        .when(filled, F.lit("success"))
        .otherwise(F.lit("error"))
        .alias("fetch_status"),
        F.when(F.col("skipped"), F.lit("Missing title or URL"))
        .when(~found, F.lit("Fetch failed"))
        .when(~filled, F.lit("Empty content after extraction"))
        .alias("error"),
    )


def successful(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("fetch_status") == "success")


def attach_full_content(items: DataFrame, fetched: DataFrame) -> DataFrame:
    """Items with the full text that was fetched for their link, if any.

    ``fetched`` is ``(link, content)`` with one row per link.
    """
    full = fetched.select("link", F.col("content").alias("full_content"))
    return items.join(full, "link", "left")


def enrich_or_fall_back(messages: DataFrame, fetched: DataFrame) -> DataFrame:
    """Messages with full text where there is one, else marked as summary only."""
    enriched = attach_full_content(messages, fetched)
    status = F.when(F.col("full_content").isNull(), F.lit("summary_only")).otherwise(F.lit("full"))
    return enriched.withColumn("enrichment_status", status)


def backlog(stored: DataFrame, limit: int | None) -> DataFrame:
    """The newest articles that lack their text."""
    lacking = stored.filter(is_blank("full_content"))
    return newest(lacking, limit) if limit is not None else lacking


def backfill(
    stored: DataFrame, fetched: DataFrame, limit: int | None = 20, min_full_length: int = MIN_FULL_LENGTH
) -> DataFrame:
    """``(id, link, full_content)`` for the newest articles that lack their text.

    ``fetched`` is ``(link, content)``.  Text that is too short is not accepted.
    """
    requested = backlog(stored.select("id", "link", "full_content"), limit)
    accepted = fetched.filter(F.length("content") >= min_full_length).select("link", "content")
    # A text of blanks counts as missing when choosing, yet is not overwritten.
    empty = F.coalesce("full_content", F.lit("")) == ""
    return (
        requested.filter(empty)
        .join(accepted, "link")
        .select("id", "link", F.col("content").alias("full_content"))
    )


def backfill_counters(
    stored: DataFrame, fetched: DataFrame, limit: int | None = 20, min_full_length: int = MIN_FULL_LENGTH
) -> DataFrame:
    """How many articles were requested, fetched, failed and updated."""
    requested = backlog(stored.select("id", "link", "full_content"), limit)
    joined = requested.join(fetched.select("link", F.length("content").alias("n")), "link", "left")
    empty = F.coalesce("full_content", F.lit("")) == ""
    return joined.agg(
        F.count("*").alias("requested"),
        F.count("n").alias("fetched_full"),
        F.count_if(F.col("n").isNull()).alias("failed_full"),
        F.count_if((F.col("n") >= min_full_length) & empty).alias("updated"),
    )


def apply_backfill(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """The store with the backfilled texts and their status."""
    new = updates.select("id", F.col("full_content").alias("new_full"))
    joined = stored.join(new, "id", "left")
    filled = F.col("new_full").isNotNull()
    return (
        joined.withColumn("full_content", F.when(filled, F.col("new_full")).otherwise(F.col("full_content")))
        .withColumn(
            "full_content_status", F.when(filled, F.lit("success")).otherwise(F.col("full_content_status"))
        )
        .select(stored.columns)
    )
