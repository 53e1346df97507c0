"""Queries over the article table: counts, coverage, quality, selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog.base import query
from newslake.catalog.fixtures import ARTICLES_SQL, articles, table
from newslake.catalog.sqltext import collapse, strip
from newslake.functions import text as t
from newslake.operators import corpus, filters, merge, stats
from newslake.sources import reports, store
from newslake.sources.streams import build_messages, keyed_json, stable_message_id

FULL = "length(trim(full_content)) > 0"
PCT = "round(CASE WHEN {total} > 0 THEN CAST({part} AS DOUBLE) / {total} * 100 ELSE 0 END, {digits})"


def pct(part: str, total: str, digits: int = 2) -> str:
    return PCT.format(part=part, total=total, digits=digits)


COVERAGE_SQL = f"""coverage AS (
  SELECT coalesce(nullif(category, ''), '(uncategorized)') AS category, total, with_full,
         total - with_full AS missing, {pct('with_full', 'total')} AS coverage_pct,
         round(avg_length, 1) AS avg_full_length
  FROM (SELECT category, count(*) AS total, count(*) FILTER (WHERE {FULL}) AS with_full,
               avg(nullif(length(trim(full_content)), 0)) AS avg_length
        FROM articles GROUP BY category)
)"""


@query("coverage_by_category", f"WITH {ARTICLES_SQL}, {COVERAGE_SQL} SELECT * FROM coverage")
def coverage_by_category(spark, sf):
    return stats.coverage_by_category(articles(spark, sf)).orderBy(F.desc("total"), "category")


@query(
    "coverage_overall",
    f"""WITH {ARTICLES_SQL}, {COVERAGE_SQL}
    SELECT category, 0 AS is_overall, total, with_full, coverage_pct FROM coverage
    UNION ALL
    SELECT '(overall)', 1, count(*), count(*) FILTER (WHERE {FULL}),
           {pct(f'count(*) FILTER (WHERE {FULL})', 'count(*)')}
    FROM articles""",
)
def coverage_overall(spark, sf):
    return stats.coverage_with_overall(articles(spark, sf))


@query(
    "coverage_report",
    f"""WITH {ARTICLES_SQL}, {COVERAGE_SQL}
    SELECT category,
           printf('%-15s %7d %7d %7d %8.2f %11s', substr(category, 1, 15), total, with_full, missing, coverage_pct,
                  coalesce(CAST(nullif(avg_full_length, 0) AS VARCHAR), '-')) AS line
    FROM coverage""",
)
def coverage_report(spark, sf):
    return reports.coverage_table(stats.coverage_by_category(articles(spark, sf)))


@query(
    "below_coverage",
    f"WITH {ARTICLES_SQL}, {COVERAGE_SQL} SELECT category, coverage_pct FROM coverage WHERE coverage_pct < 35",
)
def below_coverage(spark, sf):
    return filters.below_coverage(stats.coverage_by_category(articles(spark, sf)), 35.0).select(
        "category", "coverage_pct"
    )


@query("total_count", "SELECT count(*) AS total_articles FROM documents")
def total_count(spark, sf):
    return stats.total_count(articles(spark, sf))


@query(
    "count_by_category",
    """SELECT coalesce(nullif(lang, ''), '(uncategorized)') AS category, count(*) AS total
    FROM documents GROUP BY 1""",
)
def count_by_category(spark, sf):
    return stats.count_by_category(articles(spark, sf))


@query(
    "top_sources",
    """SELECT coalesce(nullif(source, ''), '(unknown)') AS source, count(*) AS total
    FROM documents GROUP BY source ORDER BY total DESC, source LIMIT 10""",
)
def top_sources(spark, sf):
    return stats.top_sources(articles(spark, sf))


@query(
    "category_share",
    """SELECT lang AS category, count(*) AS n,
              round(CAST(count(*) AS DOUBLE) / (SELECT count(lang) FROM documents) * 100, 4) AS pct
    FROM documents WHERE lang IS NOT NULL GROUP BY lang""",
)
def category_share(spark, sf):
    return stats.category_share(articles(spark, sf))


@query(
    "non_blank_counts",
    f"""WITH {ARTICLES_SQL}
    SELECT count(*) AS total, count(full_content) AS non_null_full_content,
           count(*) FILTER (WHERE {FULL}) AS non_empty_full_content
    FROM articles""",
)
def non_blank_counts(spark, sf):
    return stats.content_counts(articles(spark, sf))


QUALITY = """WITH {articles}, c AS (
      SELECT count(*) AS total, count(*) FILTER (WHERE full_content IS NULL) AS null_count,
             count(*) FILTER (WHERE {empty} = '') AS empty_count FROM articles)
    SELECT *, total - null_count - empty_count AS valid_count, {pct} AS valid_pct FROM c"""


@query(
    "data_quality",
    QUALITY.format(
        articles=ARTICLES_SQL, empty="full_content", pct=pct("(total - null_count - empty_count)", "total")
    ),
)
def data_quality(spark, sf):
    return stats.data_quality(articles(spark, sf), "full_content")


@query(
    "data_quality_as_published",
    QUALITY.format(
        articles=ARTICLES_SQL,
        empty="coalesce(full_content, '')",
        pct="round(CASE WHEN total > 0 THEN CAST(total - null_count - empty_count AS DOUBLE) / total * 100 END, 2)",
    ),
)
def data_quality_as_published(spark, sf):
    return stats.data_quality_as_published(articles(spark, sf), "full_content")


@query(
    "corpus_overview",
    """SELECT count(DISTINCT doc_id) AS keys, count(DISTINCT lang) AS categories,
              count(DISTINCT text) AS distinct_texts,
              (SELECT round(avg(length(text)), 4) FROM (SELECT DISTINCT text FROM documents)) AS mean_length
    FROM documents""",
)
def corpus_overview(spark, sf):
    return stats.corpus_overview(table(spark, sf, "documents"), "doc_id", "text", "lang")


@query(
    "distinct_size_by_category",
    "SELECT lang, count(*) AS n FROM (SELECT DISTINCT lang, source, text FROM documents) GROUP BY lang",
)
def distinct_size_by_category(spark, sf):
    return stats.distinct_size_by_category(table(spark, sf, "documents"), ["lang", "source", "text"], "lang")


@query(
    "backlog_newest",
    f"""WITH {ARTICLES_SQL}
    SELECT id, title, link FROM articles WHERE full_content IS NULL OR length(trim(full_content)) = 0
    ORDER BY id DESC LIMIT 30""",
)
def backlog_newest(spark, sf):
    return stats.newest(filters.missing_content(articles(spark, sf)), 30).select("id", "title", "link")


@query(
    "missing_and_populated",
    f"""WITH {ARTICLES_SQL}
    SELECT id, CASE WHEN {FULL} THEN 'populated' ELSE 'missing' END AS state FROM articles""",
)
def missing_and_populated(spark, sf):
    rows = articles(spark, sf)
    missing = filters.missing_content(rows).select("id", F.lit("missing").alias("state"))
    return missing.unionByName(filters.populated_content(rows).select("id", F.lit("populated").alias("state")))


@query(
    "processing_scan",
    f"""WITH {ARTICLES_SQL}
    SELECT id AS article_id, coalesce(nullif(full_content, ''), nullif(content, '')) AS clean_text
    FROM articles
    WHERE id > 10 AND length(trim(coalesce(nullif(full_content, ''), nullif(content, '')))) >= 80""",
)
def processing_scan(spark, sf):
    return store.articles_for_processing(articles(spark, sf), since_id=10, min_length=80)


@query(
    "processing_scan_summary",
    f"""WITH {ARTICLES_SQL}
    SELECT id AS article_id, coalesce(nullif(content, ''), nullif(full_content, '')) AS clean_text
    FROM articles
    WHERE length(trim(coalesce(nullif(content, ''), nullif(full_content, '')))) >= 50
    ORDER BY id LIMIT 100""",
)
def processing_scan_summary(spark, sf):
    return store.articles_for_processing(articles(spark, sf), limit=100, prefer_full_content=False)


UPDATED_SQL = """updates AS (
  SELECT user_id, max(ts) AS updated_at FROM events GROUP BY user_id
), dated AS (
  SELECT a.*, u.updated_at FROM articles a JOIN updates u ON a.id = u.user_id
)"""


def dated_articles(spark, sf):
    """Articles with the time of their reader's last event as update time."""
    updates = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.max("ts").alias("updated_at"))
    )
    return articles(spark, sf).join(updates, "id")


@query(
    "latest_enriched",
    f"""WITH {ARTICLES_SQL}, {UPDATED_SQL}
    SELECT id, title, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated
    FROM dated WHERE full_content IS NOT NULL ORDER BY updated_at DESC, id DESC LIMIT 1""",
)
def latest_enriched(spark, sf):
    return stats.last_updated_with_text(dated_articles(spark, sf)).select(
        "id", "title", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated")
    )


@query(
    "full_corpus_scan",
    f"""WITH {ARTICLES_SQL} SELECT id, title, category, source, CAST(NULL AS VARCHAR) AS publish_date
    FROM articles""",
)
def full_corpus_scan(spark, sf):
    return store.scan(articles(spark, sf), ["id", "title", "category", "source", "publish_date"])


@query("available_columns", f"WITH {ARTICLES_SQL} SELECT id, title, category, source FROM articles")
def available_columns(spark, sf):
    return store.available(articles(spark, sf), ["id", "title", "category", "source", "publish_date"])


@query("split_first_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 20")
def split_first_n(spark, sf):
    return store.split_slice(table(spark, sf, "documents"), "doc_id", n=20).select("doc_id", "text")


@query(
    "critical_fields",
    f"""WITH {ARTICLES_SQL}
    SELECT id, {strip("concat(coalesce(title, ''), '. ', coalesce(content, ''))")} AS text,
           {strip("concat(coalesce(title, ''), ' ', coalesce(content, ''))")} AS text_spaced
    FROM articles WHERE title IS NOT NULL AND content IS NOT NULL AND length(content) > 50""",
)
def critical_fields(spark, sf):
    return filters.critical_fields(articles(spark, sf)).select(
        "id",
        t.combine_title_content("title", "content").alias("text"),
        t.combine_title_content("title", "content", " ").alias("text_spaced"),
    )


@query(
    "required_fields",
    f"""WITH {ARTICLES_SQL}
    SELECT id FROM articles WHERE {strip('title')} <> '' AND {strip('link')} <> ''""",
)
def required_fields(spark, sf):
    return filters.required_fields(articles(spark, sf)).select("id")


@query(
    "record_validation",
    f"""WITH {ARTICLES_SQL}
    SELECT id, full_content IS NOT NULL AS is_valid,
           CASE WHEN full_content IS NULL THEN 'content' ELSE '' END AS missing FROM articles""",
)
def record_validation(spark, sf):
    records = articles(spark, sf).select(
        "id", "title", "link", F.lit("").alias("publish_date"), "source", "category", F.col("full_content").alias("content")
    )
    good = filters.valid_records(records).select("id", F.lit(True).alias("is_valid"), F.lit("").alias("missing"))
    bad = filters.rejected_records(records).select(
        "id", F.lit(False).alias("is_valid"), F.array_join("missing_keys", ",").alias("missing")
    )
    return good.unionByName(bad)


@query(
    "category_selection",
    f"WITH {ARTICLES_SQL} SELECT id, category FROM articles WHERE category IN ('fr', 'de', 'xx')",
)
def category_selection(spark, sf):
    return filters.select_categories(articles(spark, sf), ["fr", " de ", "xx"]).select("id", "category")


@query(
    "unknown_categories",
    """SELECT DISTINCT role AS category FROM conversations
    WHERE role NOT IN (SELECT lang FROM documents)""",
)
def unknown_categories(spark, sf):
    requested = table(spark, sf, "conversations").select(F.col("role").alias("category"))
    return filters.unknown_categories(articles(spark, sf), requested)


@query(
    "expansion_ratio",
    f"""WITH {ARTICLES_SQL}
    SELECT id, length(coalesce(content, '')) AS summary_length, length(full_content) AS full_length,
           round(CASE WHEN length(content) > 0 THEN CAST(length(full_content) AS DOUBLE) / length(content) END, 1)
             AS expansion
    FROM articles WHERE {FULL}""",
)
def expansion_ratio(spark, sf):
    return stats.expansion(filters.populated_content(articles(spark, sf)))


PUBLISHED_SQL = """published AS (
  SELECT doc_id AS id, lang AS category,
         timestamp '2024-01-01 00:00:00' + to_minutes(doc_id * 37) AS published_at FROM documents
)"""


def published(spark, sf):
    """Documents with a publish date as text: RFC 822 in English, ISO in other languages."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = F.timestamp_seconds(F.unix_timestamp(start) + F.col("doc_id") * 37 * 60)
    rfc = F.concat(F.date_format(at, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("category"),
        F.when(F.col("lang") == "en", rfc).otherwise(iso).alias("publish_date"),
    )


def parsed(spark, sf):
    from newslake.functions.dates import parse_publish_date

    return published(spark, sf).withColumn("publish_ts", parse_publish_date("publish_date"))


@query(
    "publish_dates",
    f"""WITH {PUBLISHED_SQL}
    SELECT id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM published""",
)
def publish_dates(spark, sf):
    return parsed(spark, sf).select("id", F.date_format("publish_ts", "yyyy-MM-dd HH:mm:ss").alias("published"))


@query(
    "date_range",
    f"""WITH {PUBLISHED_SQL}
    SELECT strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS first_date,
           strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS last_date FROM published""",
)
def date_range(spark, sf):
    found = stats.date_range(parsed(spark, sf))
    return found.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in found.columns])


@query(
    "latest_published",
    f"""WITH {PUBLISHED_SQL}
    SELECT id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM published
    ORDER BY published_at DESC, id DESC LIMIT 20""",
)
def latest_published(spark, sf):
    return stats.latest_published(parsed(spark, sf)).select(
        "id", F.date_format("publish_ts", "yyyy-MM-dd HH:mm:ss").alias("published")
    )


@query(
    "status_coercion",
    f"""WITH {ARTICLES_SQL}, raw AS (
      SELECT a.id, a.full_content, CASE WHEN l.toxic = 1 THEN 'unheard_of' WHEN l.toxic = 0 AND l.quality = 0
             THEN a.full_content_status END AS status
      FROM articles a LEFT JOIN labels l ON a.id = l.doc_id)
    SELECT id, CASE WHEN coalesce(status, '') <> '' THEN
                    CASE WHEN status IN ('success', 'timeout', 'paywall', 'parse_error') THEN status END
               WHEN coalesce(full_content, '') <> '' THEN 'success' END AS status
    FROM raw""",
)
def status_coercion(spark, sf):
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    raw = articles(spark, sf).join(labels, "id", "left")
    given = F.when(F.col("toxic") == 1, F.lit("unheard_of")).when(
        (F.col("toxic") == 0) & (F.col("quality") == 0), F.col("full_content_status")
    )
    return raw.withColumn("full_content_status", given).select("id", merge.coerced_status().alias("status"))


@query(
    "messages",
    f"""WITH {ARTICLES_SQL}
    SELECT sha2_id, key, title, summary FROM (
      SELECT sha256(link || '|' || '2024-01-31T00:00:00') AS sha2_id, link AS key,
             {collapse('title')} AS title, {collapse('content')} AS summary FROM articles)""",
)
def messages(spark, sf):
    """Item messages as keyed JSON, read back."""
    from newslake.schemas import ITEM_MESSAGE
    from newslake.sources.streams import parse_json

    items = articles(spark, sf).withColumn("publish_date", F.lit(None).cast("string"))
    at = F.lit("2024-01-31T00:00:00")
    built = build_messages(items.withColumn("fetched_at", at), stable_message_id(), at)
    back = parse_json(keyed_json(built).select("key", "value"), ITEM_MESSAGE).filter(~F.col("malformed"))
    return back.select(
        F.col("id").alias("sha2_id"),
        F.col("link").alias("key"),
        t.collapse("title").alias("title"),
        t.collapse("summary").alias("summary"),
    )


@query(
    "message_defaults",
    f"""WITH {ARTICLES_SQL}
    SELECT id, coalesce(CASE WHEN full_content_status = 'success' THEN source END, 'Unknown') AS source,
           coalesce(CASE WHEN full_content_status = 'success' THEN category END, 'uncategorized') AS category,
           coalesce(full_content, '') AS summary
    FROM articles""",
)
def message_defaults(spark, sf):
    known = F.col("full_content_status") == "success"
    items = articles(spark, sf).select(
        "id",
        F.col("id").cast("string").alias("link"),
        "title",
        F.lit(None).cast("string").alias("publish_date"),
        F.when(known, F.col("source")).alias("source"),
        F.when(known, F.col("category")).alias("category"),
        F.col("full_content").alias("content"),
    )
    built = build_messages(items)
    return built.select(F.col("link").cast("long").alias("id"), "source", "category", "summary")


@query(
    "flatten_categories",
    """SELECT doc_id AS id, lang AS category FROM documents
    UNION ALL SELECT item_id, 'benchmark' FROM benchmark""",
)
def flatten_categories(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("category"))
    extra = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.lit("benchmark").alias("category"))
    return docs.unionByName(extra)


@query("distinct_rows", "SELECT DISTINCT lang, source FROM documents")
def distinct_rows(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").dropDuplicates()


@query(
    "set_difference",
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
)
def set_difference(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("word"))
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("word"))
    return corpus.not_listed(docs, known).withColumnRenamed("word", "doc_id")
