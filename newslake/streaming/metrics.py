"""Counters of running streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def observe_messages(stream: DataFrame, name: str = "messages") -> DataFrame:
    """Count messages and those without full text while they pass."""
    return stream.observe(
        name,
        F.count("*").alias("messages_consumed"),
        F.count_if(F.col("enrichment_status") == "summary_only").alias("processing_partial"),
        F.count_if(F.col("enrichment_status") == "full").alias("processing_full"),
    )


def observed_totals(query: StreamingQuery, name: str = "messages") -> dict[str, int]:
    """The observed counters of the batches that a query still remembers, added up."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            totals[key] = totals.get(key, 0) + value
    return totals


class MetricsLog(StreamingQueryListener):
    """Adds up the observed counters of all batches."""

    def __init__(self, name: str = "messages"):
        super().__init__()
        self.name = name
        self.totals: dict[str, int] = {}
        self.batches = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        self.batches += 1
        for key, value in row.asDict().items():
            self.totals[key] = self.totals.get(key, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def attach(spark: SparkSession, name: str = "messages") -> MetricsLog:
    log = MetricsLog(name)
    spark.streams.addListener(log)
    return log
