"""Row types of the tables and messages."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# What one stored article looks like.
ARTICLE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("link", T.StringType(), False),
        *_strings("publish_date", "source", "category", "content", "full_content", "full_content_status"),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Features derived from an article, one row per article.
PROCESSED = T.StructType(
    [
        T.StructField("article_id", T.LongType(), False),
        T.StructField("token_count", T.IntegerType(), False),
        T.StructField("tokens", T.ArrayType(T.StringType()), False),
        T.StructField("feature_vector", T.ArrayType(T.DoubleType()), False),
        T.StructField("pipeline_version", T.StringType(), False),
        T.StructField("processed_at", T.TimestampType(), False),
    ]
)

# An item read from a feed; all six keys are required.
FEED_ITEM_KEYS = ["title", "link", "publish_date", "source", "category", "content"]
FEED_ITEM = T.StructType(_strings(*FEED_ITEM_KEYS))

# Message on the item stream, and what enrichment adds to it.
ITEM_MESSAGE = T.StructType(
    _strings("id", "title", "link", "publish_date", "source", "category", "summary", "fetched_at")
)
CLEANED_MESSAGE = T.StructType(
    ITEM_MESSAGE.fields + _strings("full_content", "enrichment_status", "enriched_at")
)
ALERT_MESSAGE = T.StructType(_strings("type", "error", "ts"))

# One pipeline health check.
HEALTH = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("database_total", T.LongType()),
        T.StructField("database_enriched", T.LongType()),
        T.StructField("coverage_percentage", T.DoubleType()),
        T.StructField("kafka_running", T.BooleanType()),
        T.StructField("recent_growth", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("last_extraction", T.StringType()),
        T.StructField("performance_score", T.DoubleType()),
    ]
)

# The outcomes an article's full text can have.
CONTENT_STATUSES = ["success", "timeout", "paywall", "parse_error"]
