"""Exact duplicates, found by a stream with keyed state on disk.

1. Every text is normalised and reduced to a digest; only digests and ids go on.
2. A stream groups them by digest.  Its state (RocksDB, in the checkpoint folder,
   without expiry) holds per digest the stable identifier, which is the largest id
   so far and, as the table's key, also the locator of the content, and the number
   of copies.  Arrivals are counted in map tasks before they are shuffled, so a
   digest with a third of all rows is one row a task.
3. Where a digest was hit again, the texts themselves are compared with the content
   at the locator, byte for byte.  The content is dealt out once per ``COPIES_A_TASK``
   members of its group, so large groups are compared in many tasks.
4. Digests whose texts differ are grouped by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm.common import by_place, pick, place_of, remove, rows_of_ids, write, written
from newslake.operators.ordering import join_per_key
from newslake.session import work_dir

#: Members of a group that are compared with one dealt-out copy of its content.
COPIES_A_TASK = 1000
#: What a micro-batch of digests holds at most.
BATCH_BYTES = 4 << 30
#: State on disk; many small stores must not reserve disk space ahead.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalise(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def track(arrivals: DataFrame) -> DataFrame:
    """The streaming aggregation: one state row per digest, never expired."""
    return arrivals.groupBy("digest").agg(F.max("id").alias("keep"), F.count("*").alias("copies"))


def groups_of(spark: SparkSession, folder: str, checkpoint: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Stream a folder of ``(id, digest)`` through the state and read the state back.

    A later call with the same checkpoint takes up only the files that arrived since.
    """
    schema = spark.read.parquet(folder).schema
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in STATE.items():
        session.conf.set(key, value)
    stream = session.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(folder)
    run = (
        track(stream)
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    keep, copies = (f"value.`{n}`" for n in state.schema["value"].dataType.names)
    return state.select(F.col("key.digest").alias("digest"), F.col(keep).alias("keep"), F.col(copies).alias("copies"))


def differing(members: DataFrame) -> DataFrame:
    """Digests that stand for more than one text: every body against the kept row's."""
    parts = F.ceil(F.col("copies") / COPIES_A_TASK)
    dealt = members.withColumn("part", F.pmod(F.monotonically_increasing_id(), parts))
    content = (
        members.filter(F.col("id").eqNullSafe(F.col("keep")))
        .dropDuplicates(["digest"])
        .select("digest", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("body").alias("content"))
    )
    return dealt.join(content, ["digest", "part"]).filter("body != content").select("digest").distinct()


def duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row: ``id_col, keep_id, group_size long, kept boolean, digest``.

    Texts are equal when they are identical after A-Z is lower-cased; the row with the
    largest id of a group stays.  A null text counts as empty.  Null ids come after
    all others: such a row stays only if its group has no id, and then all of them
    are marked as kept.  Rows that repeat an id and its text are counted one by one
    and marked alike.  An empty table gives an empty one.  Other columns are left
    out, whatever their names.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_col, text=text_col).select("id", normalise(F.col("text")).alias("body"))
    rows = rows.select("id", digest(F.col("body")).alias("digest"), "body")
    folder = write(rows.select("id", "digest"), "exact-arrivals")
    arrivals = spark.read.schema(rows.schema).parquet(folder).select("id", "digest")
    if arrivals.isEmpty():
        groups = track(arrivals)
    else:
        state = work_dir(spark, "exact-state")
        groups = written(groups_of(spark, folder, state, batch_bytes), "exact-groups")
        remove(spark, state)

    # A digest with very many rows is spread: its group travels to them.
    hits = join_per_key(arrivals.distinct(), groups.filter("copies > 1"), "digest", "copies").filter("copies IS NOT NULL")
    same_row = rows["id"].eqNullSafe(hits["id"]) & (rows["digest"] == hits["digest"])
    members = write(rows.join(hits, same_row).select(hits["*"], "body"), "exact-members")
    unlike = written(differing(spark.read.parquet(members)), "exact-differing")
    remove(spark, members)

    by_digest = join_per_key(arrivals, groups, "digest", "copies").join(unlike, "digest", "left_anti")
    texts = rows.join(unlike, "digest", "left_semi")
    by_text = texts.join(
        texts.groupBy("digest", "body").agg(F.max("id").alias("keep"), F.count("*").alias("copies")), ["digest", "body"]
    )
    found = by_digest.select("id", "digest", "keep", "copies").unionByName(by_text.drop("body"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        "digest",
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The whole rows of one document per text; rows that repeat an id and its text become one."""
    kept = duplicates(docs, id_col, text_col).filter("kept").select(id_col)
    rows = by_place(rows_of_ids(docs, id_col, kept.distinct()))
    once = rows.dropDuplicates([f"c{place_of(docs, c)}" for c in (id_col, text_col)])
    return once.toDF(*docs.columns)
