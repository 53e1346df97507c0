"""Chat logs: snapshots of growing conversations collapsed, the rest rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.llm.common import pick, written

#: Turns that one window or one rendered row holds, where turn numbers are dense.
PART_TURNS = 1024


def _number(turns: DataFrame) -> DataFrame:
    """Add ``place`` from 1 and ``n``, the length of the conversation.

    Windows run over parts of a conversation; only the sizes of the parts are summed up
    per conversation, so a conversation may hold any share of all rows.  Parts lie in
    even ranges of the whole order, so turns without a number, or with the same one, are
    split by role and text.  The ranges are sampled and therefore written.
    """
    order = ["key", "turn", "role", "text"]
    ranged = written(turns.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    dense = F.floor(F.col("turn").cast("double") / PART_TURNS)
    parts = ranged.withColumn("part", F.struct("range", dense.alias("dense"))).drop("range")
    sizes = parts.groupBy("key", "part").agg(F.count("*").alias("size"))
    whole = W.partitionBy("key")
    before = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "key", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"), F.sum("size").over(whole).alias("n")
    )
    inside = F.row_number().over(W.partitionBy("key", "part").orderBy("turn", "role", "text"))
    return (
        parts.withColumn("inside", inside)
        .join(offsets, ["key", "part"])
        .select("key", "role", "text", (F.col("offset") + F.col("inside")).alias("place"), "n")
    )


def _with_prefix_hashes(numbered: DataFrame) -> DataFrame:
    """Add two 64-bit hashes of the turns up to each one.

    A prefix hash is the exclusive or of the hashes of its turns, each with its place,
    so it can be worked out part by part.
    """
    said = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashed = numbered.select(
        "key",
        "place",
        "n",
        F.floor((F.col("place") - 1) / PART_TURNS).alias("part"),
        F.xxhash64(F.lit(1), *said).alias("a"),
        F.xxhash64(F.lit(2), *said).alias("b"),
    )
    per_part = hashed.groupBy("key", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = per_part.select(
        "key", "part", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}0") for c in "ab"]
    )
    upto = W.partitionBy("key", "part").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    inside = hashed.select("key", "part", "place", "n", *[F.bit_xor(c).over(upto).alias(c) for c in "ab"])
    return inside.join(carried, ["key", "part"]).select(
        "key", "place", "n", *[F.col(c).bitwiseXOR(F.col(f"{c}0")).alias(c) for c in "ab"]
    )


def collapse(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The turns of maximal conversations: ``key, place, n, role, text``.

    A conversation goes if another one begins with all of its turns and goes on; of
    equal ones that with the smallest id stays.  ``key`` is a struct with the id.
    """
    turns = pick(df, conv=conv_col, turn=turn_col, role=role_col, text=text_col).distinct()
    keyed = turns.select(F.struct(F.col("conv").alias("id")).alias("key"), "turn", "role", "text")
    numbered = written(_number(keyed), "turns")
    prefixes = written(_with_prefix_hashes(numbered), "prefixes")
    whole = prefixes.filter("place = n").groupBy("place", "a", "b").agg(F.min("key").alias("key"))
    begun = prefixes.filter("place < n").select("place", "a", "b").distinct()
    maximal = whole.join(begun, ["place", "a", "b"], "left_anti").select("key")
    return numbered.join(maximal, "key", "left_semi")


def chat_turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, empty), F.lit("\n"), F.coalesce(text, empty), F.lit("<|im_end|>\n")
    )


def render(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Chat texts of maximal conversations: ``conv_col, part, n_turns long, text``.

    A row holds ``PART_TURNS`` turns, so almost every conversation is one row (part 0);
    the texts of its parts, put together, are the whole conversation.

    Turns are in the order of turn, role and text, nulls first; rows that repeat all
    four columns count once, and turns that share a number are all kept.  A null role or
    text differs from an empty one and is rendered like it.  Rows without a conversation
    id are one conversation.  An empty table gives an empty one.  Other columns are left
    out, whatever their names.
    """
    turns = collapse(df, conv_col, turn_col, role_col, text_col)
    part = F.floor((F.col("place") - 1) / PART_TURNS).alias("part")
    lines = turns.select("key", part, "n", "place", chat_turn(F.col("role"), F.col("text")).alias("line"))
    texts = lines.groupBy("key", "part", "n").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines"))
    return texts.select(
        F.col("key.id").alias(conv_col),
        "part",
        F.col("n").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"),
    )
