"""Delimited, line-oriented and log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators.ordering import number_rows

# Words that mark a line worth keeping in the run logs.
CONSUMER_WORDS = ["consumed", "enriched", "success", "processed", "metrics"]


def read_tab_separated(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab-separated news corpus with a header line."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def read_latin1_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV in ISO-8859-1 with a header line."""
    return spark.read.option("encoding", "ISO-8859-1").csv(path, header=True, schema=schema)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, value)`` of text files, counted from 0 within each file.

    A large file is read in splits.  Their place in the file gives the order of the
    splits, and the reading order that of the lines inside one.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
        "value",
    )
    numbered = number_rows(lines, [F.col("file"), F.col("_start")], ["_place"], "_n")
    first = numbered.groupBy("file").agg(F.min("_n").alias("_first"))
    return numbered.join(first, "file").select("file", (F.col("_n") - F.col("_first")).alias("line_no"), "value")


def aligned_tokens(sentences: DataFrame, labels: DataFrame) -> DataFrame:
    """Two line-numbered tables to ``(line_no, pos, token, tag)``."""
    words = sentences.select("line_no", F.split("value", " ").alias("tokens"))
    tags = labels.select("line_no", F.split("value", " ").alias("tags"))
    pairs = words.join(tags, "line_no").select(
        "line_no", F.posexplode(F.arrays_zip("tokens", "tags")).alias("pos", "p")
    )
    return pairs.select(
        "line_no",
        "pos",
        F.col("p.tokens").alias("token"),
        F.col("p.tags").alias("tag"),
    )


def producer_lines(lines: DataFrame) -> DataFrame:
    """Log lines about categories, produced messages and totals."""
    v = F.col("value")
    about_category = v.contains("Category '") & v.contains("articles")
    return lines.filter(
        about_category
        | v.contains("Producing")
        | v.contains("messages_produced")
        | v.contains("Total articles fetched:")
    ).select(F.trim("value").alias("line"))


def consumer_lines(lines: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Log lines that hold one of the consumer's words."""
    v = F.lower("value") if ignore_case else F.col("value")
    return lines.filter(v.rlike("|".join(CONSUMER_WORDS))).select(F.trim("value").alias("line"))


def coverage_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").contains("Overall coverage")).select(F.trim("value").alias("line"))
