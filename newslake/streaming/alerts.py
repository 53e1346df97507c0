"""Alert pauses on a stream of raised alerts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from newslake.operators.health import COOLDOWN

#: State on disk; many small stores must not reserve disk space ahead.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams that this session starts from now on keep their state in RocksDB."""
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)


@contextmanager
def state_per_core(spark: SparkSession) -> Iterator[None]:
    """Streams started in here spread their state over twice as many partitions as there are cores.

    Every partition of every stateful step commits a store to the checkpoint in every
    micro-batch, however few rows it has; a stream keeps its number for ever, and adaptive
    execution cannot lower it.  Where the session asks for fewer, that holds.
    """
    given = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = min(int(given), 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", given)


class Cooldown(StatefulProcessor):
    """Per type: alerts that wait for the watermark, and the time of the last one sent.

    A timer stands at the earliest alert that waits.  When the watermark has passed it, no
    earlier alert can come any more, and what is older than the watermark is decided in
    the order of its times.  A type that has been quiet for a pause is forgotten.
    """

    def __init__(self, pause: int):
        self.pause = pause

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, body string")
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        earliest = None
        for part in rows:
            fresh = part[part["at"] >= watermark]
            if len(fresh):
                self.waiting.appendList(list(zip(fresh["at"].tolist(), fresh["body"].tolist(), strict=True)))
                first = int(fresh["at"].min())
                earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self.handle.registerTimer(earliest // 1000)
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        due = sorted(row for row in waiting if row[0] < watermark)
        later = [row for row in waiting if row[0] >= watermark]
        last = self.last.get()[0] if self.last.exists() else None
        sent = []
        for at, body in due:
            if last is None or at - last >= self.pause:
                sent.append((*key, at, body))
                last = at
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(min(later)[0] // 1000)
        elif waiting:
            self.waiting.clear()
        if last is not None and last + self.pause >= watermark:
            self.last.update((last,))
            self.handle.registerTimer((last + self.pause) // 1000)
        elif last is not None:
            self.last.clear()
        if sent:
            yield pd.DataFrame(sent, columns=["alert_type", "at", "body"])


def cool_down_stream(raised: DataFrame, seconds: int = COOLDOWN, late: str = "10 minutes") -> DataFrame:
    """Alerts that are sent, as ``operators.health.cool_down`` would choose them from the whole stream.

    ``raised`` has a ``timestamp`` and an ``alert_type``.  Alerts may come in any order, up to
    ``late`` behind the newest one; what comes later than that is left out.  An alert is
    passed on when the watermark has gone by its time.  Of several alerts of one time the
    smallest is sent.  The state is kept by key in RocksDB, which the session must use
    (:func:`keep_state_on_disk`).
    """
    others = [c for c in raised.columns if c not in ("timestamp", "alert_type")]
    body = F.to_json(F.struct(*others)) if others else F.lit("{}")
    packed = raised.withWatermark("timestamp", late).select(
        "alert_type", "timestamp", F.unix_micros("timestamp").alias("at"), body.alias("body")
    )
    kind = raised.schema["alert_type"].dataType.simpleString()
    sent = packed.groupBy("alert_type").transformWithStateInPandas(
        Cooldown(seconds * 1_000_000), f"alert_type {kind}, at long, body string", "Append", "EventTime"
    )
    opened = sent.withColumn("timestamp", F.timestamp_micros("at"))
    if others:
        opened = opened.withColumn("row", F.from_json("body", raised.select(*others).schema)).select("*", "row.*")
    return opened.select(*raised.columns)
