"""The enrichment stream: item messages to store, cleaned messages and alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from newslake.functions.dates import now_iso
from newslake.functions.html import extract_main_content
from newslake.functions.text import is_blocked_or_paywalled, strip
from newslake.operators.enrich import fetch_outcomes, successful
from newslake.schemas import ITEM_MESSAGE
from newslake.session import held
from newslake.sources.store import ArticleLog
from newslake.sources.streams import keyed_json, parse_json


def split_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(key, value)`` messages to well-formed items and to alerts for the others."""
    parsed = parse_json(raw, ITEM_MESSAGE)
    good = parsed.filter(~F.col("malformed")).drop("malformed", "value")
    bad = parsed.filter("malformed").select(
        F.lit("enrichment_failure").alias("type"),
        F.concat(F.lit("malformed message: "), F.coalesce("value", F.lit(""))).alias("error"),
    )
    return good, bad


def as_items(messages: DataFrame) -> DataFrame:
    """Messages with the defaults for absent keys; the summary is the content."""
    return messages.select(
        *[c for c in messages.columns if c not in ("title", "publish_date", "source", "category", "summary")],
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("publish_date", F.lit("")).alias("publish_date"),
        F.coalesce("source", F.lit("Unknown")).alias("source"),
        F.coalesce("category", F.lit("uncategorized")).alias("category"),
        F.coalesce("summary", F.lit("")).alias("content"),
    )


def enrich_messages(messages: DataFrame, pages: DataFrame) -> DataFrame:
    """Messages with ``full_content`` and ``enrichment_status``; the summary stays if there is no text.

    Each message is judged by itself: one without a title is skipped, whatever
    other messages of its link have.
    """
    wanted = as_items(messages)
    given = (strip(F.coalesce(F.col("title"), F.lit(""))) != "") & (strip(F.coalesce(F.col("link"), F.lit(""))) != "")
    links = wanted.filter(given).select(strip(F.col("link")).alias("link")).distinct()
    requests = links.select("link", F.lit("-").alias("title"), *[F.lit("").alias(c) for c in ("publish_date", "source", "category")])
    texts = successful(fetch_outcomes(requests, pages)).select(F.col("link").alias("_link"), F.col("content").alias("full_content"))
    titled = strip(F.coalesce(messages["title"], F.lit(""))) != ""
    asked = F.when(titled, strip(messages["link"]))
    enriched = messages.withColumn("_asked", asked)
    enriched = enriched.join(texts, enriched["_asked"] == texts["_link"], "left").drop("_asked", "_link")
    status = F.when(F.col("full_content").isNull(), F.lit("summary_only")).otherwise(F.lit("full"))
    return enriched.withColumn("enrichment_status", status)


def enrich_as_pages_arrive(messages: DataFrame, pages: DataFrame, wait: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """A stream of messages joined to a stream of fetched pages, whichever comes first.

    ``pages`` are ``(link, status, html, fetched_at)``, ``messages`` item messages; times are
    texts as in messages.  A message takes the text of its link's page if that was fetched
    at most ``wait`` before or after it, and is passed on at once when both are there.  When
    the watermarks show that no page can come any more it is passed on with its summary.
    Rows may come up to ``late`` behind the newest of their stream.  Of the fetches of a
    link within ``wait`` the first to arrive counts.  Pages are read for their text before
    they are kept, and both sides are forgotten after the wait.
    """
    usable = (F.col("status") == 200) & ~is_blocked_or_paywalled("status", "html")
    fetched = (
        pages.withColumn("_fetched", F.to_timestamp("fetched_at"))
        .withWatermark("_fetched", late)
        .withColumn("_page", strip(F.coalesce("link", F.lit(""))))
    )
    once = fetched.filter(F.coalesce(usable, F.lit(False))).dropDuplicatesWithinWatermark(["_page"])
    texts = once.select("_page", "_fetched", extract_main_content("html").alias("full_content")).filter(
        F.length("full_content") > 0
    )
    titled = strip(F.coalesce("title", F.lit(""))) != ""
    # A message that asks for nothing waits under a link of its own.
    asked = F.when(titled, strip(F.coalesce("link", F.lit("")))).otherwise(F.concat(F.lit(" "), "id"))
    sent = messages.withColumn("_sent", F.to_timestamp("fetched_at")).withWatermark("_sent", late).withColumn("_asked", asked)
    span = F.expr(f"INTERVAL {wait}")
    near = (F.col("_fetched") >= F.col("_sent") - span) & (F.col("_fetched") <= F.col("_sent") + span)
    joined = sent.join(texts, (F.col("_asked") == F.col("_page")) & near, "left_outer")
    status = F.when(F.col("full_content").isNull(), F.lit("summary_only")).otherwise(F.lit("full"))
    return joined.select(*messages.columns, "full_content", status.alias("enrichment_status"))


def failed_fetches(enriched: DataFrame) -> DataFrame:
    """An alert for every message whose page gave no text."""
    return enriched.filter(F.col("enrichment_status") == "summary_only").select(
        F.lit("enrichment_failure").alias("type"),
        F.concat(F.lit("Failed to fetch: "), F.coalesce("link", F.lit(""))).alias("error"),
    )


def to_cleaned(enriched: DataFrame, at=None) -> DataFrame:
    return enriched.withColumn("enriched_at", now_iso() if at is None else at)


def _incoming(enriched: DataFrame) -> DataFrame:
    items = as_items(enriched).filter(F.coalesce("link", F.lit("")) != "")
    # Ranges of the arrival order, so that no task sees more than its share of a burst.
    ordered = items.repartitionByRange("fetched_at", "id").sortWithinPartitions("fetched_at", "id")
    return ordered.withColumn("seq", F.monotonically_increasing_id()).withColumn(
        "full_content_status", F.lit(None).cast("string")
    )


def _publish(messages: DataFrame, path: str) -> None:
    messages.write.mode("overwrite").option("compression", "gzip").json(path)


class EnrichmentJob:
    """One micro-batch at a time: append to the store, publish, raise alerts.

    Every write goes to a place named after the batch and replaces what is there,
    so a batch that runs again leaves the same result.  Nothing outside the batch
    is rewritten, and nothing compacts the store: whoever reads it folds all batches
    since its base again.  ``pages`` is read once per batch and should hold recent
    fetches, not an archive.

    A message without a text is stored with its summary.  With ``alert_on_failure``
    it is neither stored nor published but raises an alert, as a synchronous
    consumer does.
    """

    def __init__(
        self, store: ArticleLog, pages: DataFrame, cleaned_path: str, alerts_path: str, alert_on_failure: bool = False
    ):
        self.alert_on_failure = alert_on_failure
        self.store = store
        self.pages = pages
        self.cleaned_path = cleaned_path.rstrip("/")
        self.alerts_path = alerts_path.rstrip("/")

    def run_batch(self, raw: DataFrame, batch_id: int) -> None:
        good, bad = split_messages(raw)
        # Three sinks read the batch; it is set down so that they see the same rows.
        with held(to_cleaned(enrich_messages(good, self.pages)), "batch") as enriched:
            if self.alert_on_failure:
                bad = bad.unionByName(failed_fetches(enriched))
                enriched = enriched.filter(F.col("enrichment_status") == "full")
            self.store.append(_incoming(enriched), batch_id)
            _publish(keyed_json(enriched), f"{self.cleaned_path}/batch={batch_id}")
            _publish(keyed_json(bad.withColumn("ts", now_iso()), None), f"{self.alerts_path}/batch={batch_id}")

    def writer(self, raw: DataFrame, checkpoint: str) -> DataStreamWriter:
        return raw.writeStream.foreachBatch(self.run_batch).option("checkpointLocation", checkpoint)


def stop_after(process: Callable[[DataFrame, int], None], batches: int) -> tuple[Callable, Callable]:
    """Wrap a batch function and get a check that tells when enough batches ran."""
    done = {"n": 0}

    def counted(df: DataFrame, batch_id: int) -> None:
        process(df, batch_id)
        done["n"] += 1

    return counted, lambda: done["n"] >= batches


def run_bounded(writer: DataStreamWriter, finished: Callable[[], bool], poll_seconds: float = 0.2) -> None:
    """Run a stream until the check says so or the source has nothing more."""
    query: StreamingQuery = writer.start()
    try:
        while query.isActive and not finished():
            query.awaitTermination(poll_seconds)
    finally:
        query.stop()
