"""Mixing sources to target weights by temperature.

The weight of a source is its share of all tokens to the power of an exponent between 0
(all equal) and 1 (as they are), divided by the sum.  The exponent is the largest one
whose weights reach a target entropy; where that would repeat a source too often, it is
the smallest one that keeps the repetition limit.  Both are found by bisection, with
many points at a time, over the table of sources.

The weights are then realised in blocks: every source is a stream of passes over its
documents, each pass in an order of its own, and each block takes from every stream the
source's share of the block's tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import by_place, pick, place_of, written
from newslake.operators.ordering import running_totals

#: Target entropy as a share of that of equal weights.
EVENNESS = 0.95
#: How often a source may be gone through for each time of the least repeated one.
REPEATS = 2.0
BLOCK_TOKENS = 1 << 17
#: Exponents are looked for in so many rounds with so many points each; 12 decimals come out, 6 are kept.
ROUNDS, POINTS = 10, 15
SEED = "mix"


def token_count(text: Column) -> Column:
    """Words between ASCII white space, and one token for the end of the document."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def _entropy(share: Column, exponent: float) -> Column:
    total = F.sum(F.pow(share, F.lit(exponent)))
    return F.log(total) - exponent * F.sum(F.pow(share, F.lit(exponent)) * F.log(share)) / total


def _repetition(share: Column, exponent: float) -> Column:
    times = F.pow(share, F.lit(exponent - 1))
    return F.max(times) / F.min(times)


def _highest(shares: DataFrame, reaches) -> float:
    """The largest exponent in [0, 1] that ``reaches``, a condition that holds below it."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
        row = shares.agg(*[reaches(p).alias(f"p{i}") for i, p in enumerate([*points, high])]).first()
        if row[POINTS]:
            return high
        good = [p for p, ok in zip(points, row, strict=False) if ok]
        low, high = (good[-1] if good else low), (points[len(good)] if len(good) < POINTS else high)
    return low


def exponent_for(shares: DataFrame, evenness: float | None, repeats: float | None) -> float:
    """The exponent for a table of sources with a column ``share``; 1 without a target."""
    share, exponent = F.col("share"), 1.0
    if evenness is not None:
        wanted = F.lit(evenness) * F.log(F.count("*").cast("double")) - 1e-12
        exponent = _highest(shares, lambda a: _entropy(share, a) >= wanted)
    if repeats is not None:
        too_often = _highest(shares, lambda a: _repetition(share, a) > repeats)
        allowed = shares.agg((_repetition(share, 0.0) <= repeats).alias("ok")).first().ok
        exponent = max(exponent, 0.0 if allowed else too_often)
    return math.floor(exponent * 1e6 + 0.5) / 1e6


def weights(
    counted: DataFrame,
    evenness: float | None = EVENNESS,
    repeats: float | None = REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``key, n, weight, budget, quota``: what each source gets, in all and a block."""
    totals = written(counted.groupBy("key").agg(F.sum("tokens").alias("n")), "sources")
    everything = totals.agg(F.sum("n").alias("n")).first().n or 0
    shares = totals.withColumn("share", F.col("n") / F.lit(float(everything)))
    exponent = exponent_for(shares, evenness, repeats) if everything else 1.0
    powers = shares.withColumn("power", F.pow("share", F.lit(exponent)))
    scale = powers.agg(F.sum("power").alias("z"), F.max(F.col("n") / F.col("power")).alias("least")).first()
    weight = F.col("power") / F.lit(scale.z or 1.0)
    if budget is None:  # the smallest one that takes every document once
        wanted = F.greatest(F.round(F.col("power") * F.lit(scale.least or 0.0)).cast("long"), F.col("n"))
    else:
        wanted = F.round(weight * budget).cast("long")
    quota = F.greatest(F.round(weight * block_tokens).cast("long"), F.lit(1))
    return written(powers.select("key", "n", weight.alias("weight"), wanted.alias("budget"), quota.alias("quota")), "weights")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    evenness: float | None = EVENNESS,
    repeats: float | None = REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = SEED,
) -> DataFrame:
    """One row per use of a document: ``id_col, source_col, tokens, pass, block, place``.

    ``block`` is where in the mix the document is used, ``place`` orders a block.
    Without a ``budget`` of tokens every document is used at least once: the least
    repeated source is gone through exactly once, the others as often as their weight
    asks, the last pass in part.  With a budget, sources with too many tokens are used
    in part.  A document is used if its pass has not reached the budget before it.

    Rows without a source are a source of their own; a null or empty text has one token,
    that of its end; null ids come first in a pass; rows that repeat an id are used one
    by one.  An empty table gives an empty one.  Other columns are left out, whatever
    their names.
    """
    rows = pick(df, id=id_col, source=source_col, text=text_col)
    key = F.struct(F.col("source").alias("name")).alias("key")
    counted = written(rows.select("id", key, token_count(F.col("text")).alias("tokens")), "counted")
    table = weights(counted, evenness, repeats, budget, block_tokens)
    passes = F.sequence(F.lit(0), F.ceil(F.col("budget") / F.col("n")).cast("int") - 1)
    used = counted.join(table.filter("budget > 0"), "key").withColumn("pass", F.explode(passes))
    name = F.concat(F.lit(seed), F.lit(":"), F.col("pass").cast("string"), F.lit(":"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    placed = used.withColumn("place", F.md5(name.cast("binary")))
    placed = running_totals(
        placed, F.substring("place", 1, 3), F.struct("place", "tokens"), {"upto": "tokens"}, ["key", "pass"]
    )
    at = F.col("pass") * F.col("n") + F.col("upto") - F.col("tokens")
    return (
        placed.withColumn("at", at)
        .filter("at < budget")
        .select(
            F.col("id").alias(id_col),
            F.col("key.name").alias(source_col),
            "tokens",
            "pass",
            F.floor(F.col("at") / F.col("quota")).alias("block"),
            "place",
        )
    )


def dealt(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **targets) -> DataFrame:
    """The whole rows of the mix, as often as they are used.

    A block is in one partition, its rows in the order of the block.  Rows that share an
    id are all used where one of them is.
    """
    uses = mix(df, id_col, source_col, text_col, **targets).withColumnRenamed(id_col, "used")
    once = uses.groupBy("used", "pass").agg(F.min(F.struct("block", "place")).alias("at"))
    rows = by_place(df)
    mixed = rows.join(once, rows[f"c{place_of(df, id_col)}"].eqNullSafe(once["used"]))
    ordered = mixed.repartition("at.block").sortWithinPartitions("at")
    return ordered.select(*rows.columns).toDF(*df.columns)
