"""The given tables read as article, page and health tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.catalog import sqltext as q
from newslake.functions.text import first_sentence
from newslake.sources.store import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose texts are worked on, spread over all cores."""
    return spread(table(spark, sf_dir, name).select(*columns))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles under their first sentence or line; a quality label of 1 means the full text is known."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    text = F.col("text")
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("id"),
            first_sentence(text).alias("title"),
            F.concat(F.lit("https://news.example.com/"), "lang", F.lit("/"), F.md5(text)).alias("link"),
            "source",
            F.col("lang").alias("category"),
            text.alias("content"),
            F.when(F.col("quality") == 1, text).alias("full_content"),
            F.when(F.col("quality") == 1, F.lit("success"))
            .when(F.col("quality") == 0, F.lit("parse_error"))
            .alias("full_content_status"),
        )
    )


ARTICLES_SQL = f"""articles AS (
  SELECT d.doc_id AS id,
         {q.first_sentence('d.text')} AS title,
         concat('https://news.example.com/', d.lang, '/', md5(d.text)) AS link,
         d.source AS source, d.lang AS category,
         d.text AS content,
         CASE WHEN l.quality = 1 THEN d.text END AS full_content,
         CASE WHEN l.quality = 1 THEN 'success' WHEN l.quality = 0 THEN 'parse_error' END AS full_content_status
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

# The order in which the categories are collected.
CATEGORY_ORDER = ["en", "fr", "de", "es"]


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with their arrival number: category by category, then by id."""
    place = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_ORDER]), F.col("category"))
    return articles(spark, sf_dir).withColumn("seq", F.shiftleft(place, 40) + F.col("id"))


ARRIVALS_SQL = (
    ARTICLES_SQL
    + """, arrivals AS (
  SELECT *, CAST(list_position(['en', 'fr', 'de', 'es'], category) AS BIGINT) * 1099511627776 + id AS seq
  FROM articles
)"""
)
