"""Stream sources and sinks: Kafka topics, files as their stand-in, timers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from newslake.functions.dates import now_iso
from newslake.schemas import FEED_ITEM_KEYS, ITEM_MESSAGE

# Topic names and how long each keeps its messages.
ITEMS_TOPIC = "rss.items"
CLEANED_TOPIC = "articles.cleaned"
ALERTS_TOPIC = "alerts.feed_failures"
RETENTION = {ITEMS_TOPIC: "7 days", CLEANED_TOPIC: "30 days", ALERTS_TOPIC: "30 days"}


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """A topic from its start as ``(key, value)`` text; the checkpoint holds the offsets."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files that arrive in a folder; stands in for a topic."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_timer(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Ticks only, for jobs that poll something else."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def build_messages(items: DataFrame, message_id: Column | None = None, fetched_at: Column | None = None) -> DataFrame:
    """Items as item messages; absent values get the message defaults.

    The id defaults to a random UUID.  Pass a hash of link and time instead to get
    the same id when a task runs again.
    """
    filled = {
        "title": F.coalesce("title", F.lit("")),
        "link": F.coalesce("link", F.lit("")),
        "publish_date": F.coalesce("publish_date", F.lit("")),
        "source": F.coalesce("source", F.lit("Unknown")),
        "category": F.coalesce("category", F.lit("uncategorized")),
        "content": F.coalesce("content", F.lit("")),
    }
    body = items.select(
        *[filled[k].alias(k) for k in FEED_ITEM_KEYS],
        (now_iso() if fetched_at is None else fetched_at).alias("fetched_at"),
    ).withColumnRenamed("content", "summary")
    identified = body.withColumn("id", F.uuid() if message_id is None else message_id)
    return identified.select(*ITEM_MESSAGE.fieldNames())


def stable_message_id(link: str = "link", fetched_at: str = "fetched_at") -> Column:
    return F.sha2(F.concat_ws("|", F.col(link), F.col(fetched_at)), 256)


def keyed_json(messages: DataFrame, key: str | None = "link") -> DataFrame:
    """Messages as ``(key, value)``; the key spreads and orders them by link."""
    value = F.to_json(F.struct(*messages.columns), {"ignoreNullFields": "false"})
    key_col = F.lit(None).cast("string") if key is None else F.col(key)
    return messages.select(key_col.alias("key"), value.alias("value"))


def parse_json(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """``(key, value)`` to the message's columns; ``malformed`` marks text that is no such object."""
    corrupt = "_corrupt"
    parsed = F.from_json(
        "value",
        T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    opened = messages.withColumn("m", parsed)
    malformed = F.col("value").isNull() | F.col("m").isNull() | F.col(f"m.{corrupt}").isNotNull()
    return opened.select("value", malformed.alias("malformed"), *[f"m.{f.name}" for f in schema.fields])


def batch_to_topic(messages: DataFrame, servers: str, topic: str, key: str | None = "link") -> None:
    """Publish one batch; every broker copy must acknowledge it."""
    (
        keyed_json(messages, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .save()
    )


def stream_to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        keyed_json(messages)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def stream_to_files(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The same ``(key, value)`` rows as JSON files."""
    return (
        keyed_json(messages)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def scheduled(writer: DataStreamWriter, every_minutes: float | None = None) -> DataStreamWriter:
    """Run once over what is there, or again every so many minutes."""
    if every_minutes is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{every_minutes} minutes")
