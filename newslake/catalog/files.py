"""Queries that write the given tables out in the forms of files that jobs read, and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog import sqltext as q
from newslake.catalog.base import query
from newslake.catalog.feeds import REGISTRY_SQL, policy
from newslake.catalog.fixtures import ARTICLES_SQL, table
from newslake.catalog.monitoring import CHECKS_SQL, SCORE_SQL, checked_at, checks
from newslake.functions import text as t
from newslake.operators import health
from newslake.session import work_dir
from newslake.sources import feeds, files, reports

#: The columns of the tab-separated corpus.
CORPUS = "category string, filename string, title string, content string"


@query("policy_lists", f"WITH {ARTICLES_SQL}, {REGISTRY_SQL} SELECT category, feed_url FROM allow")
def policy_lists(spark, sf):
    """The allow lists as the JSON object of a policy file."""
    lists = policy(spark, sf)[0].groupBy("category").agg(F.sort_array(F.collect_list("feed_url")).alias("urls"))
    entries = F.map_from_entries(F.collect_list(F.struct("category", "urls")))
    path = work_dir(spark, "policy")
    lists.agg(F.to_json(entries).alias("value")).write.text(path)
    return feeds.read_policy_lists(spark, path)


def corpus(spark, sf):
    """Documents as lines of the corpus: no line ends or tabs in a text."""
    return table(spark, sf, "documents").select(
        F.col("lang").alias("category"),
        F.concat("doc_id", F.lit(".txt")).alias("filename"),
        t.collapse(t.first_sentence("text")).alias("title"),
        t.collapse("text").alias("content"),
    )


def _digests(read):
    empty = F.lit("")
    return read.select(
        "category",
        "filename",
        F.md5(F.coalesce("title", empty)).alias("title"),
        F.md5(F.coalesce("content", empty)).alias("content"),
    )


CORPUS_SQL = f"""SELECT lang AS category, concat(doc_id, '.txt') AS filename,
    md5({q.collapse(q.first_sentence('text'))}) AS title, md5({q.collapse('text')}) AS content FROM documents"""


@query("tab_separated_corpus", CORPUS_SQL)
def tab_separated_corpus(spark, sf):
    path = work_dir(spark, "corpus")
    corpus(spark, sf).write.option("sep", "\t").option("header", True).csv(path)
    return _digests(files.read_tab_separated(spark, path, CORPUS))


@query("latin1_corpus", rf"{CORPUS_SQL} WHERE regexp_full_match({q.collapse('text')}, '[\x{{0}}-\x{{ff}}]*')")
def latin1_corpus(spark, sf):
    """Those documents whose texts ISO-8859-1 can hold."""
    path = work_dir(spark, "latin1")
    rows = corpus(spark, sf).filter(~F.col("content").rlike(r"[^\x00-\xff]"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return _digests(files.read_latin1_csv(spark, path, CORPUS))


@query(
    "aligned_pairs",
    f"""WITH lines AS (
      SELECT row_number() OVER (ORDER BY item_id) - 1 AS line_no, string_split({q.collapse('text')}, ' ') AS words
      FROM benchmark
    ), w AS (SELECT line_no, unnest(words) AS token, generate_subscripts(words, 1) - 1 AS pos FROM lines)
    SELECT line_no, CAST(pos AS INTEGER) AS pos, token,
           CASE WHEN regexp_matches(token, '^[A-Z]') THEN 'B-name' ELSE 'O' END AS tag FROM w""",
)
def aligned_pairs(spark, sf):
    """The benchmark's passages as a file of sentences and a file of tags, joined line by line and word by word."""
    base = work_dir(spark, "pairs")
    lines = table(spark, sf, "benchmark").select("item_id", t.collapse("text").alias("value"))
    tag = F.transform(F.split("value", " "), lambda w: F.when(w.rlike("^[A-Z]"), "B-name").otherwise("O"))
    # A pair of files is in one order, so each is one file; the benchmark is a table of fixed size.
    ordered = lines.repartitionByRange(1, "item_id").sortWithinPartitions("item_id")
    ordered.select("value").write.text(f"{base}/sentences")
    ordered.select(F.array_join(tag, " ").alias("value")).write.text(f"{base}/labels")
    sides = [files.numbered_lines(spark, f"{base}/{name}") for name in ("sentences", "labels")]
    return files.aligned_tokens(*sides)


@query(
    "metrics_history",
    f"WITH {CHECKS_SQL}, {SCORE_SQL} SELECT checked_at, total, round(score, 4) AS score FROM score",
)
def metrics_history(spark, sf):
    """Health checks appended to the history in two runs, and read back."""
    path = work_dir(spark, "metrics")
    scored = health.scored_checks(checks(spark, sf))
    middle = scored.agg(F.percentile_approx("timestamp", 0.5)).first()[0]
    for part in (F.col("timestamp") <= middle, F.col("timestamp") > middle):
        reports.write_metrics(scored.filter(part), path)
    return reports.read_metrics(spark, path).select(
        checked_at(), F.col("database_total").alias("total"), F.round("performance_score", 4).alias("score")
    )
