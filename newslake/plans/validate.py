"""Feed validation: how much text the feeds carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.operators.feeds import entry_summaries, feed_fullness
from newslake.operators.filters import FULL_TEXT_LENGTH, FULL_TEXT_RATIO
from newslake.sources.feeds import feed_entries, parse_feeds

ENTRIES_PER_FEED = 5


def validate_feeds(
    bodies: DataFrame,
    limit: int = ENTRIES_PER_FEED,
    threshold: int = FULL_TEXT_LENGTH,
    ratio: float = FULL_TEXT_RATIO,
    skip_bozo: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(report, entries)``: a label per feed, and what was seen of each entry.

    A malformed feed is read as far as it parses; ``skip_bozo`` leaves it without data.
    """
    feeds = parse_feeds(bodies)
    read = feeds.filter(~F.col("bozo")) if skip_bozo else feeds
    entries = feed_entries(read, limit).drop("feed_title", "bozo")
    summaries = entry_summaries(entries, threshold, ratio)
    return feed_fullness(feeds, summaries, ["category", "feed_url"]), summaries
