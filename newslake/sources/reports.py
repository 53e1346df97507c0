"""Report and metric files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.schemas import HEALTH


def write_metrics(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append health checks to the history, one JSON object per line."""
    df.write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEALTH).json(path)


def write_report_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def coverage_table(stats: DataFrame) -> DataFrame:
    """One fixed-width text line per category, with its place in the report."""
    length = F.coalesce(F.nullif("avg_full_length", F.lit(0.0)).cast("string"), F.lit("-"))
    line = F.concat(
        F.rpad(F.substring("category", 1, 15), 15, " "),
        F.format_string(" %7d %7d %7d %8.2f ", "total", "with_full", "missing", "coverage_pct"),
        F.lpad(length, 11, " "),
    )
    return stats.select("category", line.alias("line"))


def overall_line(overall: DataFrame) -> DataFrame:
    return overall.select(
        F.format_string("Overall coverage: %d/%d (%.2f%%)", "with_full", "total", "coverage_pct").alias("line")
    )
