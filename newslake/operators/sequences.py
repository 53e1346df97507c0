"""Token and tag sequences for tagging models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.functions.vectors import argmax
from newslake.operators.compute import compute_once, explode_once
from newslake.operators.ordering import number_rows, number_sorted

PAD, UNKNOWN = "<PAD>", "UNK"


def build_vocabulary(counts: DataFrame) -> DataFrame:
    """``(word, id)``: id 0 is padding, 1 the unknown word, then words by frequency."""
    ranked = number_sorted(counts, [F.desc("n"), F.col("word")], "id", start=2)
    special = counts.sparkSession.createDataFrame([(PAD, 0), (UNKNOWN, 1)], "word string, id long")
    return special.unionByName(ranked.select("word", F.col("id").cast("long").alias("id")))


def encode(docs: DataFrame, vocabulary: DataFrame, keys: list[str], tokens: str = "tokens", unknown: int = 1) -> DataFrame:
    """Token ids of each row in order; words without an id get the unknown one.

    The places of a word in a row are gathered first, so a word is looked up once per row.
    """
    made = compute_once(docs, _words=F.col(tokens))
    placed = F.transform("_words", lambda w, n: F.struct(w.alias("word"), n.alias("pos")))
    words = explode_once(made, keys, placed, "p").select(*keys, "p.*")
    places = words.groupBy(*keys, "word").agg(F.collect_list("pos").alias("at"))
    found = places.join(vocabulary.select("word", "id"), "word", "left")
    number = F.coalesce("id", F.lit(unknown))
    pairs = found.select(*keys, F.transform("at", lambda n: F.struct(n.alias("pos"), number.alias("id"))).alias("p"))
    ordered = pairs.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("p"))).alias("ps"))
    ids = ordered.select(*keys, F.transform("ps", lambda p: p["id"]).alias("ids"))
    empty = F.array().cast("array<bigint>")
    return docs.select(*keys).join(ids, keys, "left").select(*keys, F.coalesce("ids", empty).alias("ids"))


def decode(df: DataFrame, tags: DataFrame, keys: list[str], scores: str = "scores") -> DataFrame:
    """Tag names ``(keys, pos, tag)`` for score arrays: the best index, looked up in ``(id, tag)``."""
    best = df.select(*keys, F.posexplode(scores).alias("pos", "s")).select(*keys, "pos", argmax("s").alias("id"))
    return best.join(tags, "id").select(*keys, "pos", "tag")


def pad_in_batches(
    df: DataFrame, batch_size: int, coarse: Column, order: list, sequences: list[str], pad: int = 0
) -> DataFrame:
    """Cut rows into batches in order and pad each sequence to the longest of its batch.

    The reference length is that of the first sequence column; the last batch may
    be smaller.
    """
    numbered = number_rows(df, [coarse], order, "_n", start=0)
    batched = numbered.withColumn("batch_no", F.floor(F.col("_n") / batch_size).cast("long")).drop("_n")
    longest = F.max(F.size(sequences[0])).over(W.partitionBy("batch_no"))
    sized = batched.withColumn("max_len", longest)
    for name in sequences:
        filler = F.array_repeat(F.lit(pad).cast(df.schema[name].dataType.elementType), F.col("max_len") - F.size(name))
        sized = sized.withColumn(name, F.concat(F.col(name), filler))
    return sized


def shuffled_order(key: str, seed: int) -> Column:
    """A repeatable random order."""
    return F.xxhash64(F.col(key), F.lit(seed))


def tag_accuracy(df: DataFrame, predicted: str, labels: str, pad: int) -> DataFrame:
    """Matches over labels that are not padding.

    Matches on padding count as matches, so the value can exceed 1.
    """
    zipped = F.arrays_zip(F.col(predicted).alias("p"), F.col(labels).alias("l"))
    pairs = explode_once(df, [], zipped, "x")
    return _accuracy(pairs.select("x.p", "x.l"), F.col("p") == F.col("l"), pad)


def masked_tag_accuracy(df: DataFrame, predicted: str, labels: str, pad: int) -> DataFrame:
    """The same with matches on padding left out."""
    zipped = F.arrays_zip(F.col(predicted).alias("p"), F.col(labels).alias("l"))
    pairs = explode_once(df, [], zipped, "x")
    return _accuracy(pairs.select("x.p", "x.l"), (F.col("p") == F.col("l")) & (F.col("l") != pad), pad)


def _accuracy(pairs: DataFrame, match: Column, pad: int) -> DataFrame:
    sums = pairs.agg(F.count_if(match).alias("matches"), F.count_if(F.col("l") != pad).alias("labels"))
    ratio = F.when(F.col("labels") > 0, F.col("matches") / F.col("labels"))
    return sums.withColumn("accuracy", F.round(ratio, 6))
