"""The registry of feeds to poll, from the built-in lists or policy files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from newslake.operators.feeds import build_registry
from newslake.sources.feeds import load_policy
from newslake.sources.registry import feed_registry


def resolve_registry(
    spark: SparkSession,
    categories: Iterable[str] | None = None,
    extended: bool = False,
    allowlist_only: bool = False,
    allow_path: str | None = None,
    deny_path: str | None = None,
) -> DataFrame:
    """``(category, rank, feed_url, is_allowed)`` after the policy was applied."""
    allow, deny = load_policy(spark, allow_path, deny_path)
    return build_registry(feed_registry(spark, extended), allow, deny, categories, allowlist_only)
