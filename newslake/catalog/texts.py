"""Queries of the text functions, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog import sqltext as q
from newslake.catalog.base import query
from newslake.catalog.fixtures import ARTICLES_SQL, arrivals, articles, table, texts
from newslake.functions import text as t
from newslake.operators import filters
from newslake.operators.compute import compute_once, explode_once


def docs(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text")


@query("normalize_ml", f"SELECT doc_id, {q.normalize('text')} AS text FROM documents")
def normalize_ml(spark, sf):
    return docs(spark, sf).select("doc_id", t.normalize_for_ml("text").alias("text"))


@query(
    "normalized_length_filter",
    f"SELECT doc_id FROM documents WHERE length({q.normalize('text')}) >= 80",
)
def normalized_length_filter(spark, sf):
    normalized = compute_once(docs(spark, sf), normalized_text=t.normalize_for_ml("text"))
    return filters.min_length(normalized, "normalized_text", 80).select("doc_id")


@query("clean_notebook", f"SELECT doc_id, {q.corpus_clean('text')} AS text FROM documents")
def clean_notebook(spark, sf):
    return docs(spark, sf).select("doc_id", t.clean_for_corpus("text").alias("text"))


@query(
    "strip_urls_handles",
    q.collapse(
        rf"regexp_replace(regexp_replace(concat(url, ' ', text), 'https?://[^{q.BLANK}]+', ' ', 'g'), "
        r"'@[\p{L}\p{N}_]+', ' ', 'g')"
    ).join(
        [
            "SELECT doc_id, ",
            " AS text FROM (SELECT doc_id, text, 'https://news.example.com/' || md5(text) AS url FROM documents)",
        ]
    ),
)
def strip_urls_handles(spark, sf):
    url = F.concat(F.lit("https://news.example.com/"), F.md5("text"), F.lit(" "))
    return docs(spark, sf).select("doc_id", t.strip_urls_handles(F.concat(url, "text")).alias("text"))


def _joined(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


@query(
    "tokens",
    f"SELECT doc_id, {_joined(q.ascii_tokens(q.normalize('text')))} AS tokens FROM documents",
)
def tokens(spark, sf):
    words = t.tokenize(t.normalize_for_ml("text"), 2)
    return docs(spark, sf).select("doc_id", F.array_join(words, " ").alias("tokens"))


@query(
    "tokens_unicode",
    f"SELECT doc_id, {_joined(q.unicode_tokens(q.normalize('text')))} AS tokens FROM documents",
)
def tokens_unicode(spark, sf):
    words = t.tokenize(t.normalize_for_ml("text"), 2, unicode=True)
    return docs(spark, sf).select("doc_id", F.array_join(words, " ").alias("tokens"))


@query(
    "tokens_no_stop",
    f"""SELECT doc_id, {_joined('tokens')} AS tokens, len(tokens) AS token_count
    FROM (SELECT doc_id, {q.feature_tokens('text')} AS tokens FROM documents) WHERE len(tokens) > 0""",
)
def tokens_no_stop(spark, sf):
    rows = compute_once(docs(spark, sf), tokens=t.feature_tokens("text"))
    return filters.non_empty_tokens(rows).select(
        "doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").cast("long").alias("token_count")
    )


@query(
    "tokens_corpus",
    f"SELECT doc_id, {_joined(q.corpus_tokens('text'))} AS tokens FROM documents",
)
def tokens_corpus(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(t.corpus_tokens("text"), " ").alias("tokens"))


@query(
    "word_counts",
    f"""SELECT doc_id, CAST(CASE WHEN length({q.strip('text')}) = 0 THEN 0
                 ELSE len(string_split_regex({q.strip('text')}, '[{q.BLANK}]+')) END AS BIGINT) AS words,
               CAST(len(string_split(text, ' ')) AS BIGINT) AS pieces FROM documents""",
)
def word_counts(spark, sf):
    return docs(spark, sf).select(
        "doc_id", t.word_count("text").cast("long").alias("words"), t.space_count("text").cast("long").alias("pieces")
    )


@query(
    "sentences",
    f"""WITH s AS (
      SELECT doc_id, [x FOR x IN string_split(regexp_replace({q.strip('text')}, '([.!?])[{q.BLANK}]+',
             '\\1' || chr(1), 'g'), chr(1)) IF length(x) > 0] AS parts FROM documents)
    SELECT doc_id, CAST(pos - 1 AS BIGINT) AS pos, sentence,
           array_to_string({q.unicode_tokens('sentence', 1)}, ' ') AS words
    FROM s, unnest(s.parts) WITH ORDINALITY AS u(sentence, pos)""",
)
def sentences(spark, sf):
    split = explode_once(docs(spark, sf), ["doc_id"], t.sentences("text"), "sentence", "pos")
    words = F.array_join(t.tokenize("sentence", 1, unicode=True), " ").alias("words")
    return split.select("doc_id", F.col("pos").cast("long").alias("pos"), "sentence", words)


@query(
    "chunks",
    """SELECT doc_id, CAST(i AS BIGINT) AS pos, substr(text, CAST(i * 1400 + 1 AS BIGINT), 1500) AS chunk
    FROM documents, unnest(range(greatest(CAST(ceil((length(text) - 100) / 1400.0) AS BIGINT), 1))) AS r(i)
    WHERE length(text) > 0""",
)
def chunks(spark, sf):
    return explode_once(docs(spark, sf), ["doc_id"], t.chunk_text("text"), "chunk", "pos").select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "chunk"
    )


@query(
    "chunks_udtf",
    """SELECT doc_id, CAST(i AS BIGINT) AS pos, substr(text, CAST(i * 450 + 1 AS BIGINT), 500) AS chunk
    FROM documents, unnest(range(greatest(CAST(ceil((length(text) - 50) / 450.0) AS BIGINT), 1))) AS r(i)
    WHERE length(text) > 0""",
)
def chunks_udtf(spark, sf):
    from newslake.functions.register import register

    register(spark)
    docs(spark, sf).createOrReplaceTempView("chunk_source")
    return spark.sql(
        """SELECT doc_id, CAST(c.pos AS BIGINT) AS pos, c.chunk
        FROM chunk_source, LATERAL chunk_text(text, 500, 50) c"""
    )


@query(
    "language_code",
    r"""SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'unknown'
             WHEN regexp_matches(substr(text, 1, 400), '[\x{0600}-\x{06FF}]') THEN 'ar' ELSE 'en' END AS language
    FROM documents""",
)
def language_code(spark, sf):
    return docs(spark, sf).select("doc_id", t.detect_language("text").alias("language"))


@query(
    "keyword_category",
    """SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'uncategorized'
             WHEN regexp_matches(lower(text), 'stock|market|finance|bank') THEN 'finance'
             WHEN regexp_matches(lower(text), 'ai|software|technology|startup') THEN 'tech'
             WHEN regexp_matches(lower(text), 'election|president|government|war') THEN 'international'
             ELSE 'uncategorized' END AS category, 'neutral' AS sentiment
    FROM documents""",
)
def keyword_category(spark, sf):
    return docs(spark, sf).select(
        "doc_id", t.auto_categorize("text").alias("category"), t.analyze_sentiment("text").alias("sentiment")
    )


@query(
    "snippets",
    """SELECT doc_id, substr(text, 1, 60) || '...' AS snippet,
              CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS preview
    FROM documents""",
)
def snippets(spark, sf):
    return docs(spark, sf).select(
        "doc_id", t.snippet("text").alias("snippet"), t.snippet_if_longer("text").alias("preview")
    )


@query(
    "content_hash",
    f"WITH {ARTICLES_SQL} SELECT id, {q.content_hash('title', 'content')} AS content_hash FROM articles",
)
def content_hash(spark, sf):
    return articles(spark, sf).select("id", t.content_hash("title", "content").alias("content_hash"))


@query(
    "json_round_trip",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS line
    FROM events""",
)
def json_round_trip(spark, sf):
    opened = F.from_json("props", "k long")
    return table(spark, sf, "events").select(
        "event_id", opened["k"].alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("line")
    )


@query(
    "title_similarity_neighbours",
)
def title_similarity_neighbours(spark, sf):
    """Each article's title against that of the article before it in the same category."""
    from newslake.functions.similarity import title_key, title_ratio
    from newslake.operators.ordering import with_previous

    keyed = arrivals(spark, sf).select("id", "category", title_key("title").alias("title"))
    linked = with_previous(keyed, F.floor(F.col("id") / 10000), "id", {"before": "title"}, ["category"])
    return linked.filter(F.col("before").isNotNull()).select(
        "id", F.round(title_ratio("title", "before"), 6).alias("similarity")
    )
