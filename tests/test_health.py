"""Health series against loops over the checks."""

import random
from datetime import datetime, timedelta

import pytest

from newslake.operators import health, ordering
from pyspark.sql import functions as F


def random_checks(seed, n):
    rng = random.Random(seed)
    at, total = datetime(2024, 3, 1), 0
    rows = []
    for _ in range(n):
        at += timedelta(minutes=rng.choice([5, 20, 30, 60, 300, 1440 * 8 if rng.random() < 0.03 else 10]))
        total += rng.choice([0, 3, 40, -2])
        enriched = max(total - rng.randrange(5), 0)
        coverage = round(enriched / total * 100, 2) if total > 0 else 0.0
        rows.append((at, total, enriched, coverage, rng.random() < 0.9, rng.choice([0, 0, 1, 3])))
    return rows


SCHEMA = (
    "timestamp timestamp, database_total long, database_enriched long, coverage_percentage double, "
    "kafka_running boolean, error_count long"
)


def expected(rows):
    out = []
    for n, (at, total, _, coverage, up, errors) in enumerate(rows):
        past = [r for r in rows[:n] if r[0] > at - timedelta(days=7)]
        hour = [r for r in past if r[0] > at - timedelta(hours=1)]
        day = [r for r in past if r[0] > at - timedelta(hours=24)]
        growth = hour[-1][1] - hour[0][1] if len(hour) >= 2 else 0
        rate = sum(r[5] for r in day) / len(day) if len(past) >= 2 and day else 0.0
        now = day + [rows[n]]
        rate_now = sum(r[5] for r in now) / len(now) if len(past) >= 1 else 0.0
        score = min(coverage, 100) * 0.4 + min(growth / 50, 1.0) * 30 + (20 if up else 0) + max(0, 1 - rate) * 10
        out.append((at, growth, round(rate, 9), round(rate_now, 9), round(min(score, 100.0), 6)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_and_score(spark, seed):
    rows = random_checks(seed, 300)
    scored = health.scored_checks(spark.createDataFrame(rows, SCHEMA)).orderBy("timestamp").collect()
    got = [
        (r.timestamp, r.recent_growth, round(r.error_rate, 9), round(r.error_rate_now, 9), round(r.performance_score, 6))
        for r in scored
    ]
    assert got == expected(rows)


def test_series_are_kept_apart(spark):
    a, b = random_checks(4, 80), random_checks(5, 80)
    rows = [("a", *r) for r in a] + [("b", *r) for r in b]
    frame = spark.createDataFrame(rows, f"pipeline string, {SCHEMA}")
    scored = health.scored_checks(frame, ["pipeline"]).orderBy("pipeline", "timestamp").collect()
    assert [r.recent_growth for r in scored] == [e[1] for e in expected(a) + expected(b)]
    linked = health.trends(frame, ["pipeline"]).orderBy("pipeline", "timestamp").collect()
    steps = [y[1] - x[1] for s in (a, b) for x, y in zip([(None, s[0][1]), *s], s)]
    assert [r.growth_trend for r in linked] == steps


def test_frames_of_one_series_in_many_ranges(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=rng.randrange(4000)), rng.randrange(100), rng.randrange(5)) for _ in range(700)]
    frame = spark.createDataFrame(rows, "at timestamp, v long, e long").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        framed = ordering.trailing_frames(frame, "at", {"a": 60, "b": 900}, "v", {"e": "e"}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((r.at, r.v, r.e) for r in framed) == sorted(rows)
    for r in framed:
        for name, seconds in (("a", 60), ("b", 900)):
            past = [x for x in rows if r.at - timedelta(seconds=seconds) < x[0] < r.at]
            ends = [(min(x[1] for x in past if x[0] == min(past)[0]), max(x[1] for x in past if x[0] == max(past)[0]))] if past else [(None, None)]
            assert (r[f"{name}_n"], r[f"{name}_e"]) == (len(past), sum(x[2] for x in past))
            assert (r[f"{name}_first"], r[f"{name}_last"]) == ends[0]


def test_medians_of_a_hot_key(spark):
    from statistics import median

    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, -5, rng.randrange(9000), 7])) for _ in range(3000)]
    rows += [("one", 4), ("two", 4), ("two", 5), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v long").withColumn("k", F.coalesce("k", F.lit("-")))
    got = {r.k: r.m for r in ordering.exact_medians(frame, "v", ["k"], width=10, name="m").collect()}
    values = {}
    for k, v in rows:
        if v is not None:
            values.setdefault(k or "-", []).append(v)
    assert got == {k: median(v) for k, v in values.items()}
    assert ordering.exact_medians(frame, "v").first()[0] == median([v for _, v in rows if v is not None])


def test_alert_rules(spark):
    row = (datetime(2024, 1, 1), 10, 4, 40.0, False, 1, 3, 0.0, 0.25)
    frame = spark.createDataFrame([row], f"{SCHEMA}, recent_growth long, error_rate double, error_rate_now double")
    got = {r.alert_type: r.message for r in health.alerts(frame).collect()}
    assert got == {
        "LOW_COVERAGE": "Coverage dropped to 40.0% (threshold: 50.0%)",
        "LOW_GROWTH": "Recent growth: 3 articles/hour (threshold: 10)",
        "KAFKA_DOWN": "Kafka infrastructure is not running",
        "HIGH_ERROR_RATE": "Error rate: 25.00% (threshold: 10.00%)",
    }


def sent_by_loop(rows, seconds):
    last, sent = {}, []
    for at, kind in sorted(rows):
        if kind not in last or at - last[kind] >= timedelta(seconds=seconds):
            sent.append((at, kind))
            last[kind] = at
    return sent


@pytest.mark.parametrize("seed", [1, 2])
def test_cool_down(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [
        (start + timedelta(seconds=rng.choice([0, 600, 1800, 1799]) + 300 * rng.randrange(2000)), rng.choice(["x", "y"]))
        for _ in range(900)
    ]
    rows += [(start, "exact"), (start + timedelta(seconds=1800), "exact"), (start + timedelta(seconds=3599), "exact")]
    rows = list(dict.fromkeys(rows))
    frame = spark.createDataFrame(rows, "timestamp timestamp, alert_type string")
    got = sorted((r.timestamp, r.alert_type) for r in health.cool_down(frame, 1800).collect())
    assert got == sorted(sent_by_loop(rows, 1800))


def test_cool_down_with_one_type_bursts_and_missing_values(spark):
    start = datetime(2024, 1, 1)
    rng = random.Random(8)
    burst = [(start + timedelta(microseconds=rng.randrange(10**9)), "burst") for _ in range(1500)]
    later = [(start + timedelta(days=d), "burst") for d in (1, 1, 2)]
    rows = [*burst, *later, (start, None), (start + timedelta(seconds=5), None), (None, "burst"), (None, "never")]
    frame = spark.createDataFrame(rows, "timestamp timestamp, alert_type string")
    got = sorted(((r.timestamp, r.alert_type) for r in health.cool_down(frame, 60).collect()), key=repr)
    timed = [(at, kind or "") for at, kind in rows if at]
    assert got == sorted(((at, kind or None) for at, kind in set(sent_by_loop(timed, 60))), key=repr)
    assert health.cool_down(frame.limit(0), 60).count() == 0


def test_cool_down_over_many_ranges(spark, monkeypatch):
    """Chains that pass through several ranges, and pauses longer than a range."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = {(start + timedelta(seconds=rng.randrange(40_000)), rng.choice("aaaaab")) for _ in range(3000)}
    rows |= {(start + timedelta(seconds=n), f"k{n % 200}") for n in range(400)}
    frame = spark.createDataFrame(list(rows), "timestamp timestamp, alert_type string").coalesce(2)
    monkeypatch.setattr(health, "RANGE", 400)
    for pause in (7, 9000):
        got = sorted((r.timestamp, r.alert_type) for r in health.cool_down(frame, pause).collect())
        assert got == sorted(sent_by_loop(rows, pause))


def test_cool_down_takes_no_more_jobs_for_longer_chains(spark):
    counts = []
    for n in (10, 3000):
        times = spark.range(n).select(F.timestamp_seconds("id").alias("timestamp"), F.lit("a").alias("alert_type"))
        spark.sparkContext.setJobGroup(f"cool-down-{n}", "")
        assert health.cool_down(times, 1).count() == n
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cool-down-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_labels(spark):
    frame = spark.createDataFrame([(75.1,), (75.0,), (50.1,), (50.0,)], "s double")
    assert [r[0] for r in frame.select(health.health_label("s")).collect()] == ["HEALTHY", "WARNING", "WARNING", "CRITICAL"]


def test_numbering_and_totals(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(5), rng.randrange(1000), n) for n in range(400)]
    frame = spark.createDataFrame(rows, "g int, v int, id long")
    numbered = ordering.number_rows(frame, [-F.col("g"), F.floor(F.col("v") / 100)], ["v", "id"], "n").collect()
    ordered = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    assert [(r.g, r.v, r.id) for r in sorted(numbered, key=lambda r: r.n)] == ordered
    assert sorted(r.n for r in numbered) == list(range(1, 401))
    totals = ordering.running_totals(frame, F.floor(F.col("id") / 50), "id", {"t": "v"}).orderBy("id").collect()
    running = 0
    for row, got in zip(rows, totals):
        running += row[1]
        assert got.t == running
