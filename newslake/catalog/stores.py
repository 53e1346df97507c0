"""Queries of duplicate removal, merging and migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog import sqltext as q
from newslake.catalog.base import query
from newslake.catalog.fixtures import ARRIVALS_SQL, ARTICLES_SQL, arrivals, articles, table
from newslake.functions.text import first_sentence
from newslake.operators import dedup, merge, stats
from newslake.plans import collect, migrate
from newslake.session import work_dir
from newslake.sources import store


@query(
    "dedup_url",
    f"""WITH {ARRIVALS_SQL}
    SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY link ORDER BY seq) AS n FROM arrivals) WHERE n = 1""",
)
def dedup_url(spark, sf):
    return dedup.first_by_link(arrivals(spark, sf)).select("id")


HASHED_SQL = f"hashed AS (SELECT *, {q.content_hash('title', 'content')} AS h FROM arrivals)"


@query(
    "dedup_hash",
    f"""WITH {ARRIVALS_SQL}, {HASHED_SQL}
    SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY h ORDER BY seq) AS n FROM hashed) WHERE n = 1""",
)
def dedup_hash(spark, sf):
    return dedup.first_by_hash(arrivals(spark, sf)).select("id")


@query(
    "dedup_url_hash",
    f"""WITH {ARRIVALS_SQL}, {HASHED_SQL}, u AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY seq) AS n FROM hashed) WHERE n = 1)
    SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY h ORDER BY seq) AS m FROM u) WHERE m = 1""",
)
def dedup_url_hash(spark, sf):
    return dedup.deduplicate_by_link_and_hash(arrivals(spark, sf)).select("id")


@query("dedup_articles")
def dedup_articles(spark, sf):
    """Every article with the reason it is dropped for, if any."""
    return dedup.mark_duplicates(arrivals(spark, sf)).select("id", "category", "drop_reason")


@query("run_counters")
def run_counters(spark, sf):
    return stats.run_counters(dedup.mark_duplicates(arrivals(spark, sf)))


# The store before a run: the first article of each link, with full text only where it is good.
# The run brings every labelled document again, some under a new title, and the benchmark items.
STORED_SQL = f"""stored AS (
  SELECT id, title, link, CAST(NULL AS VARCHAR) AS publish_date, source, category,
         CASE WHEN full_content_status = 'parse_error' THEN '' ELSE content END AS content,
         full_content, full_content_status
  FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS n FROM articles) WHERE n = 1
), incoming AS (
  SELECT d.doc_id AS seq,
         CASE WHEN l.toxic = 1 THEN 'Update: ' || {q.first_sentence('d.text')} ELSE '' END AS title,
         concat('https://news.example.com/', d.lang, '/', md5(d.text)) AS link,
         '2024-02-01' AS publish_date, CASE WHEN l.quality = 1 THEN d.source END AS source, d.lang AS category,
         d.text AS content,
         CASE WHEN l.quality = 0 AND l.toxic = 0 THEN d.text END AS full_content,
         CASE WHEN l.toxic = 1 THEN 'paywall' WHEN l.quality = 0 THEN 'not_a_status' END AS full_content_status
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL
  SELECT 1000000000 + item_id, {q.first_sentence('text')}, concat('https://news.example.com/benchmark/', md5(text)),
         NULL, 'benchmark', 'benchmark', text, text, NULL
  FROM benchmark
)"""


def stored(spark, sf):
    from newslake.operators.ordering import first_per_key

    rows = first_per_key(articles(spark, sf), ["link"], ["id"])
    return rows.select(
        "id",
        "title",
        "link",
        F.lit(None).cast("string").alias("publish_date"),
        "source",
        "category",
        F.when(F.col("full_content_status") == "parse_error", F.lit("")).otherwise(F.col("content")).alias("content"),
        "full_content",
        "full_content_status",
    )


def incoming(spark, sf):
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    text = F.col("text")
    again = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("seq"),
        F.when(toxic, F.concat(F.lit("Update: "), first_sentence(text))).otherwise(F.lit("")).alias("title"),
        F.concat(F.lit("https://news.example.com/"), "lang", F.lit("/"), F.md5(text)).alias("link"),
        F.lit("2024-02-01").alias("publish_date"),
        F.when(good, F.col("source")).alias("source"),
        F.col("lang").alias("category"),
        text.alias("content"),
        F.when((F.col("quality") == 0) & (F.col("toxic") == 0), text).alias("full_content"),
        F.when(toxic, F.lit("paywall")).when(F.col("quality") == 0, F.lit("not_a_status")).alias("full_content_status"),
    )
    new = table(spark, sf, "benchmark").select(
        (F.lit(1000000000) + F.col("item_id")).alias("seq"),
        first_sentence(text).alias("title"),
        F.concat(F.lit("https://news.example.com/benchmark/"), F.md5(text)).alias("link"),
        F.lit(None).cast("string").alias("publish_date"),
        F.lit("benchmark").alias("source"),
        F.lit("benchmark").alias("category"),
        text.alias("content"),
        text.alias("full_content"),
        F.lit(None).cast("string").alias("full_content_status"),
    )
    return again.unionByName(new)


def _last(c: str) -> str:
    return f"arg_max({c}, seq) FILTER (WHERE coalesce({c}, '') <> '')"


FOLDED_SQL = f"""valid AS (
  SELECT *, CASE WHEN full_content_status IN ('success', 'timeout', 'paywall', 'parse_error')
                 THEN full_content_status END AS s FROM incoming
), folded AS (
  SELECT link, min(seq) AS seq, {_last('title')} AS title, {_last('publish_date')} AS publish_date,
         {_last('source')} AS source, {_last('category')} AS category,
         arg_min(title, seq) AS first_title,
         arg_min(content, seq) FILTER (WHERE coalesce(content, '') <> '') AS content,
         arg_min(full_content, seq) FILTER (WHERE coalesce(full_content, '') <> '') AS fill,
         min(seq) FILTER (WHERE coalesce(full_content, '') <> '') AS fill_seq,
         arg_min(coalesce(s, 'success'), seq) FILTER (WHERE coalesce(full_content, '') <> '') AS fill_status,
         arg_max(s, seq) FILTER (WHERE s IS NOT NULL) AS last_status,
         max(seq) FILTER (WHERE s IS NOT NULL) AS last_status_seq
  FROM valid GROUP BY link
)"""

STATUS_SQL = """CASE WHEN {fills} THEN CASE WHEN f.last_status_seq > f.fill_seq THEN f.last_status ELSE f.fill_status END
       ELSE coalesce(f.last_status, {old}) END"""

UPSERT_SQL = f"""WITH {ARTICLES_SQL}, {STORED_SQL}, {FOLDED_SQL}, merged AS (
  SELECT e.id, coalesce(f.title, e.title) AS title, e.link, coalesce(f.publish_date, e.publish_date) AS publish_date,
         coalesce(f.source, e.source) AS source, coalesce(f.category, e.category) AS category,
         CASE WHEN coalesce(e.content, '') <> '' THEN e.content ELSE coalesce(f.content, e.content) END AS content,
         CASE WHEN coalesce(e.full_content, '') = '' THEN coalesce(f.fill, e.full_content) ELSE e.full_content END
           AS full_content,
         {STATUS_SQL.format(fills="coalesce(e.full_content, '') = '' AND f.fill IS NOT NULL",
                            old='e.full_content_status')} AS full_content_status,
         false AS inserted
  FROM stored e LEFT JOIN folded f ON e.link = f.link
  UNION ALL
  SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY f.seq), coalesce(f.title, f.first_title), f.link,
         f.publish_date, f.source, f.category, f.content, f.fill,
         {STATUS_SQL.format(fills='f.fill IS NOT NULL', old='NULL')}, true
  FROM folded f WHERE f.link NOT IN (SELECT link FROM stored)
)"""


STORE_PARTS = 16


def _with_flag(articles, merged):
    """Stored articles with a flag for those that the merge has put in."""
    new = merged.filter("inserted").select("link", "inserted")
    return articles.join(new, "link", "left").withColumn("inserted", F.coalesce("inserted", F.lit(False)))


@query("upsert_articles", f"{UPSERT_SQL} SELECT * FROM merged")
def upsert_articles(spark, sf):
    """The whole store after its touched parts were replaced."""
    articles = store.LinkStore(spark, work_dir(spark, "articles"), STORE_PARTS).create(stored(spark, sf))
    merged = articles.merge(
        incoming(spark, sf), lambda old, rows: merge.merge_articles(old, rows, articles.highest_id())
    )
    return _with_flag(articles.read(), merged).select(
        "id", "title", "link", "publish_date", "source", "category", "content", "full_content",
        "full_content_status", "inserted",
    )


@query("next_ids", f"{UPSERT_SQL} SELECT id, link FROM merged WHERE inserted")
def next_ids(spark, sf):
    merged = merge.merge_articles(stored(spark, sf), incoming(spark, sf))
    return merged.filter("inserted").select("id", "link")


@query(
    "save_stats",
    f"""WITH {ARTICLES_SQL}, {STORED_SQL}, marked AS (
      SELECT category, row_number() OVER (PARTITION BY link ORDER BY seq) = 1
                       AND link NOT IN (SELECT link FROM stored) AS inserted FROM incoming)
    SELECT category, count(*) AS total, count(*) FILTER (WHERE inserted) AS saved,
           count(*) FILTER (WHERE NOT inserted) AS duplicates FROM marked GROUP BY category""",
)
def save_stats(spark, sf):
    return stats.save_stats(merge.mark_inserted(incoming(spark, sf), stored(spark, sf)))


@query(
    "new_and_known_links",
    f"""WITH {ARTICLES_SQL}, {STORED_SQL}
    SELECT seq, link IN (SELECT link FROM stored) AS is_known FROM incoming""",
)
def new_and_known_links(spark, sf):
    rows, known = incoming(spark, sf), stored(spark, sf)
    new = merge.new_links(rows, known).select("seq", F.lit(False).alias("is_known"))
    return new.unionByName(merge.known_links(rows, known).select("seq", F.lit(True).alias("is_known")))


# Feature rows: one per label (older run) and one per document with a quality label (newer run).
FEATURES_SQL = """old_features AS (
  SELECT doc_id AS article_id, quality AS token_count, timestamp '2024-01-01' AS processed_at FROM labels
), new_features AS (
  SELECT doc_id AS article_id, CAST(n_chars AS INTEGER) AS token_count, timestamp '2024-01-02' AS processed_at
  FROM documents WHERE lang <> 'en'
)"""


def features(spark, sf):
    old = table(spark, sf, "labels").select(
        F.col("doc_id").alias("article_id"),
        F.col("quality").alias("token_count"),
        F.lit("2024-01-01").cast("timestamp").alias("processed_at"),
    )
    new = table(spark, sf, "documents").filter(F.col("lang") != "en").select(
        F.col("doc_id").alias("article_id"),
        F.col("n_chars").cast("int").alias("token_count"),
        F.lit("2024-01-02").cast("timestamp").alias("processed_at"),
    )
    return old, new


@query(
    "upsert_features",
    f"""WITH {FEATURES_SQL}
    SELECT article_id, token_count, strftime(processed_at, '%Y-%m-%d') AS processed_on FROM new_features
    UNION ALL
    SELECT article_id, token_count, strftime(processed_at, '%Y-%m-%d') FROM old_features
    WHERE article_id NOT IN (SELECT article_id FROM new_features)""",
)
def upsert_features(spark, sf):
    return merge.merge_features(*features(spark, sf)).select(
        "article_id", "token_count", F.date_format("processed_at", "yyyy-MM-dd").alias("processed_on")
    )


@query("latest_processed_id", "SELECT coalesce(max(doc_id), 0) AS latest_id FROM labels")
def latest_processed_id(spark, sf):
    return store.latest_processed_id(features(spark, sf)[0])


@query(
    "cascade_delete",
    f"""WITH {ARTICLES_SQL}
    SELECT doc_id AS article_id FROM labels
    WHERE doc_id IN (SELECT id FROM articles WHERE full_content IS NOT NULL)""",
)
def cascade_delete(spark, sf):
    live = articles(spark, sf).filter(F.col("full_content").isNotNull())
    return merge.drop_orphans(features(spark, sf)[0], live).select("article_id")


@query(
    "articles_with_features",
    "SELECT d.doc_id AS id, l.quality AS token_count FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def articles_with_features(spark, sf):
    return merge.articles_with_features(articles(spark, sf), features(spark, sf)[0]).select("id", "token_count")


MIGRATE_SQL = f"""WITH {ARTICLES_SQL}, {STORED_SQL}, legacy AS (
  SELECT seq + 5000000 AS id, title, link, publish_date, source, category, content, full_content, full_content_status
  FROM incoming
), coerced AS (
  SELECT *, CASE WHEN coalesce(full_content_status, '') <> '' THEN
                 CASE WHEN full_content_status IN ('success', 'timeout', 'paywall', 'parse_error')
                      THEN full_content_status END
            WHEN coalesce(full_content, '') <> '' THEN 'success' END AS s FROM legacy
), folded AS (
  SELECT link, min(id) AS id, arg_min(title, id) AS title, arg_min(source, id) AS source,
         arg_min(category, id) AS category,
         arg_min(content, id) FILTER (WHERE coalesce(content, '') <> '') AS content,
         arg_min(full_content, id) FILTER (WHERE coalesce(full_content, '') <> '') AS fill,
         list(s ORDER BY id) FILTER (WHERE coalesce(full_content, '') <> '') AS fill_status,
         list(s ORDER BY id) AS any_status
  FROM coerced GROUP BY link
), merged AS (
  SELECT e.id, e.title, e.link, e.source,
         CASE WHEN coalesce(e.content, '') = '' THEN coalesce(f.content, e.content) ELSE e.content END AS content,
         CASE WHEN coalesce(e.full_content, '') = '' AND f.fill IS NOT NULL THEN f.fill ELSE e.full_content END
           AS full_content,
         CASE WHEN coalesce(e.full_content, '') = '' AND f.fill IS NOT NULL THEN f.fill_status[1]
              ELSE e.full_content_status END AS full_content_status,
         false AS inserted
  FROM stored e LEFT JOIN folded f ON e.link = f.link
  UNION ALL
  SELECT id, title, link, source, content, fill,
         CASE WHEN fill IS NOT NULL THEN fill_status[1] ELSE any_status[1] END, true
  FROM folded WHERE link NOT IN (SELECT link FROM stored)
)"""


@query("migrate_merge", f"{MIGRATE_SQL} SELECT * FROM merged")
def migrate_merge(spark, sf):
    legacy = incoming(spark, sf).withColumn("id", F.col("seq") + 5000000).drop("seq")
    target = store.LinkStore(spark, work_dir(spark, "target"), STORE_PARTS).create(stored(spark, sf))
    merged = target.merge(legacy, merge.migrate_articles)
    return _with_flag(target.read(), merged).select("id", "title", "link", "source", "content", "full_content", "full_content_status", "inserted")


@query(
    "migrate_features",
    """SELECT doc_id AS article_id, quality AS token_count FROM labels
    UNION ALL SELECT doc_id, CAST(n_chars AS INTEGER) FROM documents
    WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def migrate_features(spark, sf):
    old, new = features(spark, sf)
    return merge.migrate_features(old, new).select("article_id", "token_count")


ENRICH_STORE_SQL = f"""WITH {ARTICLES_SQL}, {STORED_SQL}, ok AS (
  SELECT d.doc_id AS seq, {q.first_sentence('d.text')} AS title,
         concat('https://news.example.com/', d.lang, '/', md5(d.text)) AS link,
         {q.collapse('d.text')} AS content
  FROM documents d WHERE concat('https://news.example.com/', d.lang, '/', md5(d.text)) IN (
    SELECT concat('https://news.example.com/', x.lang, '/', md5(x.text))
    FROM documents x JOIN labels l ON x.doc_id = l.doc_id WHERE l.quality = 1)
    AND {q.first_sentence("d.text")} <> ''
), by_link AS (
  SELECT *, {q.content_hash('title', 'content')} AS h FROM (
    SELECT *, row_number() OVER (PARTITION BY link ORDER BY seq) AS n FROM ok WHERE content <> '') WHERE n = 1
), uniq AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY seq) AS m FROM by_link) WHERE m = 1
), english AS (
  SELECT link FROM stored WHERE category = 'en'
)
SELECT (SELECT count(*) FROM documents) AS requested, (SELECT count(*) FROM uniq) AS fetched_full,
       (SELECT count(*) FROM documents) - (SELECT count(*) FROM ok WHERE content <> '') AS failed_full,
       (SELECT count(*) FROM uniq WHERE link NOT IN (SELECT link FROM english)) AS saved,
       (SELECT count(*) FROM ok WHERE content <> '') - (SELECT count(*) FROM uniq) AS skipped_duplicates"""


@query("enrich_and_store", ENRICH_STORE_SQL)
def enrich_and_store(spark, sf):
    """Counters of storing all articles whose page was fetched into a store of English ones."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    link = F.concat(F.lit("https://news.example.com/"), "lang", F.lit("/"), F.md5("text"))
    escaped = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    good = documents.join(labels.filter(F.col("quality") == 1).select("doc_id"), "doc_id")
    pages = good.groupBy(link.alias("link")).agg(F.min(escaped).alias("text")).select(
        "link", F.lit(200).alias("status"), F.concat(F.lit("<article>"), "text", F.lit("</article>")).alias("html")
    )
    # The paywall words are looked for at the head of the page, which is document text here.
    items = articles(spark, sf).select(
        F.col("id").alias("seq"), "title", "link", F.lit("").alias("publish_date"), "source", "category"
    )
    english = stored(spark, sf).filter(F.col("category") == "en")
    return collect.enrich_and_store(items, pages, english)[1]


@query(
    "migration_run",
    f"""{MIGRATE_SQL}, target AS (SELECT doc_id FROM labels), moved AS (
      SELECT doc_id FROM documents WHERE lang <> 'en' UNION SELECT doc_id FROM target)
    SELECT count(*) AS articles, count(*) FILTER (WHERE inserted) AS inserted,
           (SELECT count(*) FROM moved WHERE doc_id IN (SELECT id FROM merged)) AS features FROM merged""",
)
def migration_run(spark, sf):
    """Articles and feature rows of a whole migration, counted."""
    old, new = features(spark, sf)
    legacy = incoming(spark, sf).withColumn("id", F.col("seq") + 5000000).drop("seq")
    moved, rows = migrate.migrate(stored(spark, sf), legacy, old, new)
    return moved.agg(F.count("*").alias("articles"), F.count_if("inserted").alias("inserted")).select(
        "*", rows.agg(F.count("*").alias("n")).scalar().alias("features")
    )
