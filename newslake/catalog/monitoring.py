"""Queries of pipeline health and snapshots, over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog.base import query
from newslake.catalog.fixtures import table
from newslake.operators import health, stats
from newslake.operators.ordering import running_totals

# One check per hour: all events so far, those without error so far, errors of the hour.
CHECKS_SQL = """hours AS (
  SELECT date_trunc('hour', ts) AS ts, count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS ok,
         count(*) FILTER (WHERE event_type = 'error') AS error_count
  FROM events GROUP BY 1
), checks AS (
  SELECT ts, CAST(sum(n) OVER w AS BIGINT) AS total, CAST(sum(ok) OVER w AS BIGINT) AS enriched, error_count
  FROM hours WINDOW w AS (ORDER BY ts)
), covered AS (
  SELECT *, round(CAST(enriched AS DOUBLE) / total * 100, 2) AS coverage FROM checks
), hist AS (
  SELECT *, first(total) OVER hour AS h_first, last(total) OVER hour AS h_last, count(*) OVER hour AS h_n,
         coalesce(sum(error_count) OVER day, 0) AS d_errors, count(*) OVER day AS d_n, count(*) OVER week AS w_n
  FROM covered
  WINDOW hour AS (ORDER BY ts RANGE BETWEEN INTERVAL '3599.999999' SECOND PRECEDING
                                        AND INTERVAL '0.000001' SECOND PRECEDING),
         day AS (ORDER BY ts RANGE BETWEEN INTERVAL '86399.999999' SECOND PRECEDING
                                       AND INTERVAL '0.000001' SECOND PRECEDING),
         week AS (ORDER BY ts RANGE BETWEEN INTERVAL '604799.999999' SECOND PRECEDING
                                        AND INTERVAL '0.000001' SECOND PRECEDING)
), scored AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M') AS checked_at, ts, total, enriched, coverage, error_count,
         CAST(CASE WHEN h_n >= 2 THEN h_last - h_first ELSE 0 END AS BIGINT) AS growth,
         CASE WHEN w_n >= 2 AND d_n > 0 THEN CAST(d_errors AS DOUBLE) / d_n ELSE 0.0 END AS error_rate,
         CASE WHEN w_n >= 1 THEN CAST(d_errors + error_count AS DOUBLE) / (d_n + 1) ELSE 0.0 END AS error_rate_now
  FROM hist
)"""
def checks(spark, sf):
    events = table(spark, sf, "events").withColumn("timestamp", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    failed = F.col("event_type") == "error"
    hours = events.groupBy("timestamp").agg(
        F.count("*").alias("n"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("error_count")
    )
    totals = running_totals(
        hours, F.date_trunc("day", F.col("timestamp")), "timestamp", {"database_total": "n", "database_enriched": "ok"}
    )
    return totals.select(
        "timestamp",
        "database_total",
        "database_enriched",
        F.round(F.col("database_enriched") / F.col("database_total") * 100, 2).alias("coverage_percentage"),
        F.lit(True).alias("kafka_running"),
        "error_count",
    )


def checked_at(column="timestamp"):
    return F.date_format(column, "yyyy-MM-dd HH:mm").alias("checked_at")


@query("health_checks", f"WITH {CHECKS_SQL} SELECT checked_at, total, enriched, coverage, error_count FROM scored")
def health_checks(spark, sf):
    return checks(spark, sf).select(
        checked_at(),
        F.col("database_total").alias("total"),
        F.col("database_enriched").alias("enriched"),
        F.col("coverage_percentage").alias("coverage"),
        "error_count",
    )


# Growth needs two earlier checks inside the hour, so it is taken from a check per minute.
DENSE_SQL = """dense AS (
  SELECT ts, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS total FROM events
), d AS (
  SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS checked_at, date_trunc('minute', ts) AS ts, max(total) AS total
  FROM dense GROUP BY 1, 2
)"""


@query(
    "health_growth",
    f"""WITH {DENSE_SQL}
    SELECT checked_at, total, CAST(CASE WHEN count(*) OVER h >= 2 THEN last(total) OVER h - first(total) OVER h ELSE 0 END
                           AS BIGINT) AS growth
    FROM d WINDOW h AS (ORDER BY ts RANGE BETWEEN INTERVAL '3599.999999' SECOND PRECEDING
                                              AND INTERVAL '0.000001' SECOND PRECEDING)""",
)
def health_growth(spark, sf):
    """A check in every minute that has an event."""
    events = table(spark, sf, "events").withColumn("timestamp", F.date_trunc("minute", F.col("ts").cast("timestamp")))
    minutes = events.groupBy("timestamp").agg(F.count("*").alias("n"))
    series = running_totals(
        minutes, F.date_trunc("day", F.col("timestamp")), "timestamp", {"database_total": "n"}
    ).withColumn("error_count", F.lit(0))
    return health.with_history(series).select(
        checked_at(), F.col("database_total").alias("total"), F.col("recent_growth").alias("growth")
    )


@query(
    "health_error_rate",
    f"""WITH {CHECKS_SQL}
    SELECT checked_at, round(error_rate, 6) AS error_rate, round(error_rate_now, 6) AS error_rate_now FROM scored""",
)
def health_error_rate(spark, sf):
    return health.with_history(checks(spark, sf)).select(
        checked_at(), F.round("error_rate", 6).alias("error_rate"), F.round("error_rate_now", 6).alias("error_rate_now")
    )


SCORE_SQL = """score AS (
  SELECT *, least(least(coverage, 100.0) * 0.4 + least(growth / 50.0, 1.0) * 30 + 20
                  + greatest(0.0, 1 - error_rate) * 10, 100.0) AS score FROM scored
)"""


@query(
    "health_score",
    f"""WITH {CHECKS_SQL}, {SCORE_SQL}
    SELECT checked_at, round(score, 4) AS score, CASE WHEN score > 75 THEN 'HEALTHY' WHEN score > 50 THEN 'WARNING'
                                              ELSE 'CRITICAL' END AS health FROM score""",
)
def health_score(spark, sf):
    return health.scored_checks(checks(spark, sf)).select(
        checked_at(), F.round("performance_score", 4).alias("score"), "health"
    )


ALERTS_SQL = """raised AS (
  SELECT checked_at, ts, 'LOW_COVERAGE' AS alert_type,
         printf('Coverage dropped to %.1f%% (threshold: 79.5%%)', round(coverage, 1)) AS message
  FROM scored WHERE coverage < 79.5
  UNION ALL
  SELECT checked_at, ts, 'LOW_GROWTH', printf('Recent growth: %d articles/hour (threshold: 10)', growth) FROM scored
  WHERE growth < 10
  UNION ALL
  SELECT checked_at, ts, 'HIGH_ERROR_RATE',
         printf('Error rate: %.2f%% (threshold: 250.00%%)', round(error_rate_now * 100, 2)) FROM scored
  WHERE error_rate_now > 2.5
)"""


def raised(spark, sf):
    return health.alerts(health.scored_checks(checks(spark, sf)), min_coverage=79.5, max_error_rate=2.5)


@query("health_alerts", f"WITH {CHECKS_SQL}, {ALERTS_SQL} SELECT checked_at, alert_type, message FROM raised")
def health_alerts(spark, sf):
    return raised(spark, sf).select(checked_at(), "alert_type", "message")


COOLDOWN_SQL = """WITH RECURSIVE raised AS (
  SELECT DISTINCT event_type, ts FROM events
), sent AS (
  SELECT event_type, min(ts) AS ts FROM raised GROUP BY event_type
  UNION ALL
  SELECT s.event_type, (SELECT min(r.ts) FROM raised r
                    WHERE r.event_type = s.event_type AND r.ts >= s.ts + INTERVAL 6 HOUR)
  FROM sent s WHERE s.ts IS NOT NULL
)
SELECT event_type AS alert_type, epoch_us(ts) AS micros FROM sent WHERE ts IS NOT NULL"""


@query("alerts_cooldown", COOLDOWN_SQL)
def alerts_cooldown(spark, sf):
    """Every event as an alert of its type; the pause is six hours."""
    rows = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("alert_type")
    )
    sent = health.cool_down(rows, 6 * 3600)
    return sent.select("alert_type", F.unix_micros("timestamp").alias("micros"))


@query(
    "health_trend",
    f"""WITH {CHECKS_SQL}
    SELECT checked_at, round(coalesce(coverage - lag(coverage) OVER (ORDER BY ts), 0.0), 6) AS coverage_trend,
           coalesce(total - lag(total) OVER (ORDER BY ts), 0) AS growth_trend FROM scored""",
)
def health_trend(spark, sf):
    return health.trends(checks(spark, sf)).select(
        checked_at(), F.round("coverage_trend", 6).alias("coverage_trend"), "growth_trend"
    )


@query(
    "health_retention",
    f"WITH {CHECKS_SQL} SELECT checked_at FROM scored WHERE ts > (SELECT max(ts) FROM scored) - INTERVAL 7 DAY",
)
def health_retention(spark, sf):
    return health.recent_history(checks(spark, sf)).select(checked_at())


SNAPSHOTS_SQL = """daily AS (
  SELECT event_type AS category, date_trunc('day', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2
), snapshots AS (
  SELECT category, ts, CAST(sum(n) OVER (PARTITION BY category ORDER BY ts) AS BIGINT) AS total FROM daily
)"""


def snapshots(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.date_trunc("day", F.col("ts").cast("timestamp")))
    daily = events.groupBy(F.col("event_type").alias("category"), F.col("day").alias("ts")).agg(F.count("*").alias("n"))
    return running_totals(daily, F.date_trunc("month", F.col("ts")), "ts", {"total": "n"}, ["category"]).drop("n")


def on(column="ts"):
    return F.date_format(column, "yyyy-MM-dd").alias("day")


@query(
    "snapshot_growth",
    f"""WITH {SNAPSHOTS_SQL}
    SELECT strftime(ts, '%Y-%m-%d') AS day, category, total,
           total - coalesce(lag(total) OVER (PARTITION BY category ORDER BY ts), 0) AS growth FROM snapshots""",
)
def snapshot_growth(spark, sf):
    return health.snapshot_growth(snapshots(spark, sf)).select(on(), "category", "total", "growth")


@query(
    "overall_growth",
    f"""WITH {SNAPSHOTS_SQL}, o AS (SELECT ts, CAST(sum(total) AS BIGINT) AS total FROM snapshots GROUP BY ts)
    SELECT strftime(ts, '%Y-%m-%d') AS day, total, total - coalesce(lag(total) OVER (ORDER BY ts), 0) AS growth
    FROM o""",
)
def overall_growth(spark, sf):
    return health.overall_growth(snapshots(spark, sf)).select(on(), "total", "growth")


@query(
    "snapshot_compare",
    """WITH cut AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS t FROM events), now AS (
      SELECT event_type AS category, count(*) AS total, count(*) FILTER (WHERE value > 5) AS with_full
      FROM events GROUP BY 1), before AS (
      SELECT event_type AS category, count(*) AS total FROM events, cut WHERE ts <= t GROUP BY 1), listed AS (
      SELECT unnest(['purchase', 'view', 'click', 'none']) AS category, unnest([0, 1, 2, 3]) AS pos)
    SELECT pos, listed.category, coalesce(with_full, 0) AS with_full, coalesce(now.total, 0) AS total,
           coalesce(round(CAST(with_full AS DOUBLE) / now.total * 100, 2), 0.0) AS coverage_pct,
           coalesce(now.total, 0) - coalesce(before.total, 0) AS growth
    FROM listed LEFT JOIN now ON listed.category = now.category
         LEFT JOIN before ON listed.category = before.category""",
)
def snapshot_compare(spark, sf):
    """Event types as categories: all events against those of the first half of the time."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    half = ends.select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("t")).scalar()
    named = events.withColumn("category", F.col("event_type"))
    current = named.groupBy("category").agg(
        F.count("*").alias("total"), F.count_if(F.col("value") > 5).alias("with_full")
    )
    current = current.withColumn("coverage_pct", F.round(F.col("with_full") / F.col("total") * 100, 2))
    previous = named.filter(F.col("ts") <= half).groupBy("category").agg(F.count("*").alias("total"))
    listed = spark.createDataFrame(
        [(0, "purchase"), (1, "view"), (2, "click"), (3, "none")], "pos int, category string"
    )
    return stats.snapshot_changes(current, previous, listed)


@query(
    "latest_per_key",
    """SELECT user_id, event_id FROM (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events)
    WHERE n = 1""",
)
def latest_per_key(spark, sf):
    return health.latest_per_key(table(spark, sf, "events"), "user_id", "event_id").select("user_id", "event_id")


@query(
    "topic_retention",
    "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY",
)
def topic_retention(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return health.within_retention(events, "ts", 7).select("event_id")


@query(
    "health_report",
    f"""WITH {CHECKS_SQL}, {SCORE_SQL}
    SELECT checked_at, round(score, 4) AS score,
           CASE WHEN score > 75 THEN 'HEALTHY' WHEN score > 50 THEN 'WARNING' ELSE 'CRITICAL' END AS health,
           coalesce(total - lag(total) OVER (ORDER BY ts), 0) AS growth_trend FROM score""",
)
def health_report(spark, sf):
    report = health.health_report(checks(spark, sf))
    return report.select(checked_at(), F.round("performance_score", 4).alias("score"), "health", "growth_trend")
