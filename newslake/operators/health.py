"""Pipeline health over time: growth, error rate, score, alerts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.operators.compute import explode_once
from newslake.operators.ordering import first_per_key, trailing_frames, with_previous
from newslake.session import work_dir

HOUR, DAY = 3600, 86400
# History kept, alert thresholds, pause between equal alerts.
HISTORY = 7 * DAY
MIN_COVERAGE = 50.0
MIN_GROWTH = 10
MAX_ERROR_RATE = 0.1
COOLDOWN = 1800
# Times that one task follows at once.
RANGE = 1 << 18


def with_history(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add what each check knew of the past, from ``(timestamp, database_total, error_count)``.

    * ``recent_growth``: last minus first total of the last hour, 0 below two checks;
    * ``error_rate``: mean errors per check of the last 24 hours, 0 below two earlier checks;
    * ``error_rate_now``: the same with the current check counted in.

    All frames end before the current check, as it is not part of the history yet.
    """
    frames = {"_hour": HOUR, "_day": DAY, "_known": HISTORY}
    framed = trailing_frames(checks, "timestamp", frames, "database_total", {"errors": "error_count"}, keys)
    growth = F.when(F.col("_hour_n") >= 2, F.col("_hour_last") - F.col("_hour_first")).otherwise(F.lit(0))
    errors, n = F.col("_day_errors"), F.col("_day_n")
    before = F.when((F.col("_known_n") >= 2) & (n > 0), errors / n).otherwise(F.lit(0.0))
    now = F.when(F.col("_known_n") >= 1, (errors + F.col("error_count")) / (n + 1)).otherwise(F.lit(0.0))
    return framed.select(
        *checks.columns,
        growth.cast("long").alias("recent_growth"),
        before.alias("error_rate"),
        now.alias("error_rate_now"),
    )


def performance_score(
    coverage: Column | str, growth: Column | str, infrastructure: Column | str, error_rate: Column | str
) -> Column:
    """0.4 x coverage + 30 for growth + 20 for running services + 10 for few errors, at most 100."""
    coverage, growth, infrastructure, error_rate = (
        F.col(c) if isinstance(c, str) else c for c in (coverage, growth, infrastructure, error_rate)
    )
    score = (
        F.least(coverage, F.lit(100.0)) * 0.4
        + F.least(growth / 50, F.lit(1.0)) * 100 * 0.3
        + F.when(infrastructure, F.lit(20.0)).otherwise(F.lit(0.0))
        + F.greatest(F.lit(0.0), 1 - error_rate) * 100 * 0.1
    )
    return F.least(score, F.lit(100.0))


def health_label(score: Column | str) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score > 75, F.lit("HEALTHY")).when(score > 50, F.lit("WARNING")).otherwise(F.lit("CRITICAL"))


def scored_checks(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Checks with history, ``performance_score`` and ``health``."""
    score = performance_score("coverage_percentage", "recent_growth", "kafka_running", "error_rate")
    scored = with_history(checks, keys).withColumn("performance_score", score)
    return scored.withColumn("health", health_label("performance_score"))


def alerts(
    scored: DataFrame,
    min_coverage: float = MIN_COVERAGE,
    min_growth: int = MIN_GROWTH,
    max_error_rate: float = MAX_ERROR_RATE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(timestamp, alert_type, message)``, one row per threshold a check breaks."""

    def alert(condition: Column, name: str, message: Column) -> Column:
        return F.when(condition, F.struct(F.lit(name).alias("alert_type"), message.alias("message")))

    rules = F.array(
        alert(
            F.col("coverage_percentage") < min_coverage,
            "LOW_COVERAGE",
            F.format_string(f"Coverage dropped to %.1f%% (threshold: {min_coverage}%%)", "coverage_percentage"),
        ),
        alert(
            F.col("recent_growth") < min_growth,
            "LOW_GROWTH",
            F.format_string(f"Recent growth: %d articles/hour (threshold: {min_growth})", "recent_growth"),
        ),
        alert(~F.col("kafka_running"), "KAFKA_DOWN", F.lit("Kafka infrastructure is not running")),
        alert(
            F.col("error_rate_now") > max_error_rate,
            "HIGH_ERROR_RATE",
            F.format_string(
                f"Error rate: %.2f%% (threshold: {max_error_rate * 100:.2f}%%)", F.col("error_rate_now") * 100
            ),
        ),
    )
    broken = explode_once(scored, [*keep, "timestamp"], F.array_compact(rules), "a")
    return broken.select(*keep, "timestamp", "a.alert_type", "a.message")


def _follow(at: np.ndarray, starts: np.ndarray, first: list[int], pause: int) -> list[int]:
    """Places of the times that are sent, by chains that start at the places ``first``.

    ``at`` holds the times of several keys, each sorted; ``starts`` marks the first time of each.
    Gaps count for a pause at most, and so does the gap between two keys: then one sorted
    scale holds all times, and the first one a pause later is where it was.
    """
    gaps = np.diff(at, prepend=at[:1])
    gaps = np.where(starts, pause, np.minimum(gaps, pause))
    scale = np.cumsum(gaps)
    later = np.searchsorted(scale, scale + pause).tolist()
    ends = np.append(np.flatnonzero(starts), len(at))
    sent = []
    for place in first:
        end = int(ends[np.searchsorted(ends, place, side="right")])
        while place < end:
            sent.append(place)
            place = later[place]
    return sent


def _send_in_ranges(rows: DataFrame, entries: dict[int, int | None], whole: bool, pause: int) -> DataFrame:
    """What is sent in the ranges ``entries``; their numbers are the keys.

    A value is the time from which on the first key of a range, which goes on from the
    range before, may send again.  With ``whole`` the other keys are worked on as well, and
    a first key that goes on without a known time waits.
    """

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "at"], ignore_index=True)
        number = int(part["range"].iloc[0])
        keys, at = part["key"].to_numpy(dtype=object), part["at"].to_numpy()
        starts = np.append(True, keys[1:] != keys[:-1])
        own = np.flatnonzero(starts).tolist()
        first = own[1:] if whole else []
        if number not in entries:
            first = own
        elif entries[number] is not None:
            head = own[1] if len(own) > 1 else len(at)
            place = int(np.searchsorted(at[:head], entries[number]))
            first = [*([place] if place < head else []), *first]
        return part.iloc[_follow(at, starts, first, pause)][["range", "key", "at"]]

    return rows.groupBy("range").applyInPandas(choose, "range int, key string, at long")


def _sent_times(times: DataFrame, pause: int) -> DataFrame:
    """``(key, at)`` of the alerts that are sent, of distinct ``(key, at)``.

    The times are sorted into ranges of bounded size.  A key that starts in a range is
    followed there at once; one that goes on from the range before waits until that one's
    last sent time is known, and reads its own ranges only.  So every range is read at
    most twice, all keys go on side by side, and there are as many rounds as ranges that
    the key with the most times covers.
    """
    spark = times.sparkSession
    folder = work_dir(spark, "cooldown")
    parts = max(1, -(-times.count() // RANGE))
    ranged = times.repartitionByRange(parts, "key", "at").withColumn("range", F.spark_partition_id())
    ranged.write.partitionBy("range").parquet(f"{folder}/times")
    stored = spark.read.schema("key string, at long, range int").parquet(f"{folder}/times")
    edges = stored.groupBy("range").agg(F.min("key").alias("head"), F.max("key").alias("tail")).orderBy("range").collect()
    # Per range one row: which key leads in, which one leads out.
    goes_on = {b.range: a.range for a, b in zip(edges, edges[1:], strict=False) if a.tail == b.head}
    single = {e.range for e in edges if e.head == e.tail}
    last: dict[int, int] = {}
    rounds = 0

    def run(entries: dict[int, int | None], whole: bool) -> None:
        nonlocal rounds
        rows = stored if whole else stored.filter(F.col("range").isin(list(entries)))
        out = f"{folder}/sent/round={rounds}"
        _send_in_ranges(rows, entries, whole, pause).write.parquet(out)
        rounds += 1
        found = spark.read.schema("range int, key string, at long").parquet(out)
        if goes_on:
            ends = found.groupBy("range").agg(F.max_by("at", F.struct("key", "at")).alias("at"), F.max("key").alias("key"))
            tails = {e.range: e.tail for e in edges}
            last.update({r.range: r.at for r in ends.collect() if r.key == tails[r.range]})

    run(dict.fromkeys(goes_on), True)
    # Ranges that hold nothing but the end of a key wait for the one before.
    settled = {e.range for e in edges if e.range not in goes_on or e.range not in single}
    waiting = dict(goes_on)
    while waiting:
        ready = {r: before for r, before in waiting.items() if before in settled}
        run({r: last[before] + pause for r, before in ready.items()}, False)
        for r, before in ready.items():
            del waiting[r]
            settled.add(r)
            if r in single:
                last.setdefault(r, last[before])
    return spark.read.schema("key string, at long").parquet(f"{folder}/sent/round=*")


def cool_down(raised: DataFrame, seconds: int = COOLDOWN, keys: Sequence[str] = ("alert_type",)) -> DataFrame:
    """Alerts that are sent: none within the pause after the last one *sent* of its type.

    Whether an alert is sent hangs on the whole chain before it.  Times are sorted into
    ranges of bounded size that are followed one after the other for one type, and side by
    side for several.  No group holds a type or a day.
    """
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    timed = raised.withColumn("_key", F.to_json(F.struct(*keys))).withColumn("_at", at)
    times = timed.select(F.col("_key").alias("key"), F.col("_at").alias("at")).filter("at IS NOT NULL").distinct()
    sent = _sent_times(times, seconds * 1_000_000)
    one_each = first_per_key(timed, ["_key", "_at"], raised.columns)
    return one_each.join(sent.toDF("_key", "_at"), ["_key", "_at"], "left_semi").select(raised.columns)


def day_of(ts: str = "timestamp") -> Column:
    return F.date_trunc("day", F.col(ts))


def trends(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Change of coverage and total since the check before; 0 for the first."""
    linked = with_previous(
        checks,
        day_of(),
        "timestamp",
        {"_coverage": "coverage_percentage", "_total": "database_total"},
        keys,
    )
    return linked.select(
        *checks.columns,
        F.coalesce(F.col("coverage_percentage") - F.col("_coverage"), F.lit(0.0)).alias("coverage_trend"),
        F.coalesce(F.col("database_total") - F.col("_total"), F.lit(0)).alias("growth_trend"),
    )


def recent_history(checks: DataFrame, days: int = 7) -> DataFrame:
    """Checks of the last days before the newest one."""
    newest = checks.agg(F.max("timestamp").alias("t")).scalar()
    return checks.filter(F.col("timestamp") > newest - F.make_dt_interval(F.lit(days)))


def snapshot_growth(snapshots: DataFrame, ts: str = "ts", key: str = "category", total: str = "total") -> DataFrame:
    """Growth of each category since its snapshot before; the first counts from 0."""
    linked = with_previous(snapshots, F.date_trunc("month", F.col(ts)), ts, {"_before": total}, [key])
    return linked.select(
        *snapshots.columns, (F.col(total) - F.coalesce("_before", F.lit(0))).alias("growth")
    )


def overall_growth(snapshots: DataFrame, ts: str = "ts", total: str = "total") -> DataFrame:
    """Total over the categories per snapshot, with its growth."""
    sums = snapshots.groupBy(ts).agg(F.sum(total).alias(total))
    linked = with_previous(sums, F.date_trunc("month", F.col(ts)), ts, {"_before": total})
    return linked.select(ts, total, (F.col(total) - F.coalesce("_before", F.lit(0))).alias("growth"))


def latest_per_key(messages: DataFrame, key: str, offset: str) -> DataFrame:
    """What a compacted topic keeps: the last message of every key."""
    return first_per_key(messages, [key], [F.desc(offset)])


def within_retention(messages: DataFrame, ts: str, days: int) -> DataFrame:
    newest = messages.agg(F.max(ts).alias("t")).scalar()
    return messages.filter(F.col(ts) > newest - F.make_dt_interval(F.lit(days)))


def health_report(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every check with score, label and trends: what the status report shows."""
    return trends(scored_checks(checks, keys), keys)
