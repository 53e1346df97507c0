"""The article store: a base table with a Parquet folder of changes per batch, scans and feature tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from newslake.functions.text import preferred_text
from newslake.session import cut_lineage

ARTICLE_COLUMNS = ["id", "title", "link", "publish_date", "source", "category", "content", "full_content"]


def scan(df: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Take the wanted columns; one that the table lacks becomes NULL."""
    types = types or {}
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c) for c in columns]
    )


def available(df: DataFrame, columns: list[str]) -> DataFrame:
    """Take those of the wanted columns that the table has."""
    return df.select(*[c for c in columns if c in df.columns])


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan of few large splits to all cores before heavy work on its rows.

    The number of splits is known without reading anything.  A table with at least
    as many splits as cores, as any large one, stays as it is and is not shuffled.
    Only for plain scans: on a plan with a shuffle the count itself would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def articles_for_processing(
    articles: DataFrame,
    since_id: int | None = None,
    limit: int | None = None,
    min_length: int = 50,
    prefer_full_content: bool = True,
) -> DataFrame:
    """``(article_id, clean_text)`` of articles with enough text, by id.

    ``since_id`` is pushed down to the scan.  A limit sorts; without one the
    rows are left where they are, since a global sort would only cost a shuffle.
    """
    if since_id is not None:
        articles = articles.filter(F.col("id") > since_id)
    text = articles.select(
        F.col("id").alias("article_id"),
        preferred_text("full_content", "content", prefer_full_content).alias("clean_text"),
    ).filter(F.length(F.trim("clean_text")) >= min_length)
    return text.orderBy("article_id").limit(limit) if limit is not None else text


def split_slice(df: DataFrame, id_col: str, n: int | None = None, percent: float | None = None) -> DataFrame:
    """The first ``n`` rows by id, or the first ``percent`` of them, rounded to the nearest row."""
    if n is not None:
        return df.orderBy(id_col).limit(n)
    from newslake.operators.ordering import number_sorted

    wanted = F.round(F.lit(percent / 100.0) * df.count())
    return number_sorted(df, [F.col(id_col)], "_row").filter(F.col("_row") <= wanted).select(*df.columns)


class ArticleLog:
    """The article store of a stream: a base table and the changes since, a folder per batch.

    A batch only appends its own rows, so its cost does not grow with the store.
    Readers see base and changes merged.  A batch that runs again replaces its own
    rows and nothing else.  To start afresh, write ``current()`` elsewhere and make
    a new log on it.
    """

    CHANGES = [
        "seq", "link", "title", "publish_date", "source", "category", "content", "full_content", "full_content_status"
    ]

    def __init__(self, spark: SparkSession, path: str, base: DataFrame | None = None):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/changes"
        self.base = base

    def append(self, incoming: DataFrame, batch_id: int) -> None:
        """Write the rows of a batch; ``seq`` orders them inside it."""
        rows = incoming.select(self.CHANGES).write.mode("overwrite").option("compression", "zstd")
        rows.parquet(f"{self.path}/batch={batch_id}")

    def changes(self) -> DataFrame:
        """All rows since the base, ordered by batch and then by their number in it."""
        types = ", ".join(f"{c} string" for c in self.CHANGES[1:])
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], f"seq struct<batch: long, seq: long>, {types}")
        rows = self.spark.read.schema(f"seq long, {types}, batch long").parquet(self.path)
        return rows.withColumn("seq", F.struct("batch", "seq")).drop("batch")

    def current(self) -> DataFrame:
        """All articles as of the last batch."""
        from newslake.operators.merge import STORED, merge_articles

        schema = ", ".join(f"{c} string" for c in STORED)
        # A limit of none is known to be empty, so without a base nothing is looked up in one.
        stored = self.base if self.base is not None else self.spark.createDataFrame([], f"id long, {schema}").limit(0)
        return merge_articles(stored, self.changes()).drop("inserted", "updated")


class LinkStore:
    """Articles in folders by a hash of their link, for stores too large to rewrite.

    A merge finds the folders that its rows touch with a bitmap of their hashes, which is
    a few KB whatever the rows, reads these alone, and replaces these alone.  Links are
    spread evenly, and the store has one row of each.  The highest id is kept in a small
    table beside, so that new ids need no look at the other folders.
    """

    PART = "_part"

    def __init__(self, spark: SparkSession, path: str, parts: int = 256, schema: StructType | None = None):
        if not 0 < parts <= 32768:
            raise ValueError("a bitmap tells up to 32768 parts apart")
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.ids = f"{self.path}-ids"
        self.schema = schema

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("link"), F.lit(self.parts)).cast("int")

    def _write(self, articles: DataFrame) -> None:
        by_part = articles.withColumn(self.PART, self._part()).repartition(self.PART)
        writer = by_part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.PART).parquet(self.path)
        articles.agg(F.max("id").alias("id")).write.mode("append").parquet(self.ids)

    def create(self, articles: DataFrame) -> LinkStore:
        """Fill the store, which must be new."""
        self.schema = articles.schema
        self._write(articles)
        return self

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """All articles, or those of some parts."""
        reader = self.spark.read
        if self.schema is not None:  # else some file is opened for it
            reader = reader.schema(StructType([*self.schema.fields, StructField(self.PART, IntegerType())]))
        articles = reader.parquet(self.path)
        if parts is not None:
            articles = articles.filter(F.col(self.PART).isin(parts))
        return articles.drop(self.PART)

    def highest_id(self) -> int:
        return self.spark.read.parquet(self.ids).agg(F.max("id")).first()[0] or 0

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that the links of some rows belong to."""
        # The bit of a positive number n is n - 1.
        position = F.bitmap_bit_position((self._part() + 1).cast("long"))
        bits = bytes(rows.agg(F.bitmap_construct_agg(position)).first()[0])
        return [part for part in range(self.parts) if bits[part >> 3] >> (part & 7) & 1]

    def merge(self, rows: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Replace the touched parts by ``how(their articles, rows)``; gives what was written.

        Columns that the store lacks, such as flags, are given but not stored.  The result
        is set down before anything is replaced, so a replacement that is cut short can be
        made again from it.
        """
        parts = self.touched(rows)
        old = self.read(parts)
        merged = cut_lineage(how(old, rows))
        self._write(merged.select(old.columns))
        return merged


def latest_processed_id(processed: DataFrame) -> DataFrame:
    """One row with the highest processed article id, 0 for an empty table."""
    return processed.agg(F.coalesce(F.max("article_id"), F.lit(0)).alias("latest_id"))


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """Articles of an older store; the status column may be missing."""
    return scan(spark.read.parquet(path), [*ARTICLE_COLUMNS, "full_content_status"])


def read_legacy_jdbc(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """The same from a database, read in id ranges (needs the database's JDBC driver)."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn="id", lowerBound=lower, upperBound=upper, numPartitions=partitions
    )
    return scan(reader.options(**options).load(), [*ARTICLE_COLUMNS, "full_content_status"])
