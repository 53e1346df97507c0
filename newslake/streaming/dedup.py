"""Duplicate links on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_seen_links(stream: DataFrame, ts: str = "fetched_at", within: str = "7 days") -> DataFrame:
    """Pass on each link once.

    Links are remembered for the time given, so the state does not grow for ever;
    take at least as long as a link may come again.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", within)
    return timed.dropDuplicatesWithinWatermark(["link"]).drop("_ts")


def drop_stored_links(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Items of a micro-batch whose link is not stored yet, each link once."""
    return batch.dropDuplicates(["link"]).join(stored.select("link"), "link", "left_anti")
