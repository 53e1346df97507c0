"""Queries over fetched pages: text extraction, outcomes, enrichment, backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog import fixtures
from newslake.catalog import sqltext as q
from newslake.catalog.articles import pct
from newslake.catalog.base import query
from newslake.catalog.fixtures import ARTICLES_SQL, articles, table
from newslake.functions import html as h
from newslake.functions import text as t
from newslake.operators import enrich, stats

FETCHED_SQL = """fetched AS (
  SELECT url AS link, CASE WHEN page_id % 10 = 0 THEN 403 ELSE 200 END AS status, html FROM pages
)"""


def fetched(spark, sf):
    """Pages as fetched bodies; every tenth one was refused."""
    return pages(spark, sf).select(
        F.col("url").alias("link"),
        F.when(F.col("page_id") % 10 == 0, 403).otherwise(200).alias("status"),
        "html",
    )


def pages(spark, sf):
    return fixtures.texts(spark, sf, "pages", "page_id", "url", "html")


@query("html_clean", f"SELECT page_id, {q.html_text('html')} AS text FROM pages")
def html_clean(spark, sf):
    return pages(spark, sf).select("page_id", h.clean_html("html").alias("text"))


@query("html_clean_expression", f"SELECT page_id, {q.html_text('html')} AS text FROM pages")
def html_clean_expression(spark, sf):
    # The given pages also hold '&amp' without its semicolon.
    whole = F.regexp_replace("html", "&amp(?!;)", "&amp;")
    return pages(spark, sf).select("page_id", h.strip_html(whole).alias("text"))


@query("html_main", f"SELECT page_id, {q.main_text('html')} AS text FROM pages")
def html_main(spark, sf):
    return pages(spark, sf).select("page_id", h.extract_main_content("html").alias("text"))


@query(
    "url_domain",
    r"""SELECT page_id, coalesce(nullif(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), ''),
              'unknown-domain') AS domain FROM pages""",
)
def url_domain(spark, sf):
    return pages(spark, sf).select("page_id", t.url_domain("url").alias("domain"))


@query(
    "paywall",
    f"""WITH {FETCHED_SQL}
    SELECT link, status = 403 OR regexp_matches(lower(substr(html, 1, 600)),
           'paywall|subscribe|account required|sign in|subscriber-only') AS blocked FROM fetched""",
)
def paywall(spark, sf):
    return fetched(spark, sf).select("link", t.is_blocked_or_paywalled("status", "html").alias("blocked"))


REQUESTS_SQL = (
    FETCHED_SQL
    + f""", first_pages AS (
  SELECT link, min(html) AS html, max(status) AS status FROM fetched GROUP BY link
), requests AS (
  SELECT {q.strip("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS title, link, status, html FROM first_pages
), outcomes AS (
  SELECT title, link, status, html,
         status = 200 AND NOT regexp_matches(lower(substr(html, 1, 600)),
           'paywall|subscribe|account required|sign in|subscriber-only') AS usable,
         {q.main_text('html')} AS body
  FROM requests
)"""
)
OUTCOME_SQL = """CASE WHEN title = '' THEN 'skipped' WHEN usable AND length(body) > 0 THEN 'success' ELSE 'error' END"""


def requests(spark, sf):
    """One request per distinct link, titled by the page's own title."""
    pages = first_pages(spark, sf)
    return pages.select(
        F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"),
        "link",
        F.lit("").alias("publish_date"),
        F.lit("web").alias("source"),
        F.lit("test").alias("category"),
    )


def first_pages(spark, sf):
    return fetched(spark, sf).groupBy("link").agg(F.min("html").alias("html"), F.max("status").alias("status"))


@query(
    "fetch_outcome",
    f"""WITH {REQUESTS_SQL}
    SELECT link, {OUTCOME_SQL} AS fetch_status,
           CASE WHEN title = '' THEN 'Missing title or URL' WHEN NOT usable THEN 'Fetch failed'
                WHEN length(body) = 0 THEN 'Empty content after extraction' END AS error,
           CASE WHEN usable AND title <> '' THEN length(html) ELSE 0 END AS raw_length,
           CASE WHEN usable AND title <> '' THEN length(body) ELSE 0 END AS cleaned_length,
           CASE WHEN usable AND title <> '' THEN body ELSE '' END AS content
    FROM outcomes""",
)
def fetch_outcome(spark, sf):
    found = enrich.fetch_outcomes(requests(spark, sf), first_pages(spark, sf))
    return found.select(
        "link",
        "fetch_status",
        "error",
        F.col("raw_length").cast("long").alias("raw_length"),
        F.col("cleaned_length").cast("long").alias("cleaned_length"),
        "content",
    )


@query(
    "fetch_counters",
    f"""WITH {REQUESTS_SQL}, o AS (SELECT status, {OUTCOME_SQL} AS s FROM outcomes)
    SELECT count(*) AS articles_requested, count(*) FILTER (WHERE s = 'success') AS articles_fetched,
           count(*) FILTER (WHERE s = 'error') AS articles_failed,
           count(*) FILTER (WHERE s = 'skipped') AS articles_skipped,
           count(*) FILTER (WHERE status = 403) AS blocked_403 FROM o""",
)
def fetch_counters(spark, sf):
    return stats.fetch_counters(enrich.fetch_outcomes(requests(spark, sf), first_pages(spark, sf)))


# Texts fetched for articles: every link with a labelled document; a text can be short.
TEXTS_SQL = """texts AS (
  SELECT concat('https://news.example.com/', d.lang, '/', md5(d.text)) AS link, min(d.text) AS content
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1
)"""


def texts(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    link = F.concat(F.lit("https://news.example.com/"), "lang", F.lit("/"), F.md5("text"))
    return rows.groupBy(link.alias("link")).agg(F.min("text").alias("content"))


@query(
    "enrich_join",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}
    SELECT a.id, a.link, length(t.content) AS full_length
    FROM articles a LEFT JOIN texts t ON a.link = t.link""",
)
def enrich_join(spark, sf):
    items = articles(spark, sf).select("id", "link")
    joined = enrich.attach_full_content(items, texts(spark, sf))
    return joined.select("id", "link", F.length("full_content").cast("long").alias("full_length"))


@query(
    "enrich_fallback",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}
    SELECT a.id, CASE WHEN t.content IS NULL THEN 'summary_only' ELSE 'full' END AS enrichment_status
    FROM articles a LEFT JOIN texts t ON a.link = t.link""",
)
def enrich_fallback(spark, sf):
    return enrich.enrich_or_fall_back(articles(spark, sf).select("id", "link"), texts(spark, sf)).select(
        "id", "enrichment_status"
    )


@query(
    "message_counters",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}
    SELECT count(*) AS messages_consumed, count(*) AS processing_success,
           count(*) FILTER (WHERE t.content IS NULL) AS processing_partial, 0 AS processing_failures
    FROM articles a LEFT JOIN texts t ON a.link = t.link""",
)
def message_counters(spark, sf):
    found = enrich.enrich_or_fall_back(articles(spark, sf).select("id", "link"), texts(spark, sf))
    return stats.message_counters(found)


BACKFILL_SQL = """requested AS (
  SELECT id, link FROM articles WHERE full_content IS NULL OR length(trim(full_content)) = 0
), hits AS (
  SELECT r.id, r.link, t.content FROM requested r LEFT JOIN texts t ON r.link = t.link
)"""


@query(
    "backfill",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}, {BACKFILL_SQL}
    SELECT id, link, content AS full_content FROM hits WHERE length(content) >= 800""",
)
def backfill(spark, sf):
    return enrich.backfill(articles(spark, sf), texts(spark, sf), limit=None)


@query(
    "backfill_counters",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}, {BACKFILL_SQL}, c AS (
      SELECT count(*) AS requested, count(content) AS fetched_full, count(*) - count(content) AS failed_full,
             count(*) FILTER (WHERE length(content) >= 500) AS updated FROM hits)
    SELECT *, {pct('updated', 'requested', 1)} AS success_rate FROM c""",
)
def backfill_counters(spark, sf):
    counted = enrich.backfill_counters(articles(spark, sf), texts(spark, sf), limit=None, min_full_length=500)
    return counted.withColumn("success_rate", stats.success_rate("requested", "updated"))


@query(
    "backfill_improvement",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}, {BACKFILL_SQL}, c AS (
      SELECT (SELECT count(*) FROM articles WHERE length(trim(full_content)) > 0) AS before,
             (SELECT count(*) FROM hits WHERE length(content) >= 800) AS improvement)
    SELECT before, before + improvement AS after, improvement FROM c""",
)
def backfill_improvement(spark, sf):
    stored = articles(spark, sf)
    filled = enrich.apply_backfill(stored, enrich.backfill(stored, texts(spark, sf), limit=None))
    return stats.improvement(stored, filled)


@query(
    "before_after",
    f"""WITH {ARTICLES_SQL}, {TEXTS_SQL}, {BACKFILL_SQL}
    SELECT a.id, length(coalesce(a.content, '')) AS summary_length,
           length(coalesce(CASE WHEN length(h.content) >= 800 THEN h.content END, a.full_content, '')) AS full_length
    FROM articles a LEFT JOIN hits h ON a.id = h.id""",
)
def before_after(spark, sf):
    stored = articles(spark, sf)
    filled = enrich.apply_backfill(stored, enrich.backfill(stored, texts(spark, sf), limit=None))
    return stats.before_after(stored, filled).select(
        "id",
        F.col("summary_length").cast("long").alias("summary_length"),
        F.col("full_length").cast("long").alias("full_length"),
    )
