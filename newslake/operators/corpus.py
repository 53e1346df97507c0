"""Vocabulary and corpus figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import (
    BLANK,
    UNICODE_SPLIT,
    remove_stop_words,
    strip_urls_handles,
    tokenize,
    truncate,
)
from newslake.operators.compute import compute_once, explode_once
from newslake.operators.ordering import exact_medians, number_sorted
from newslake.session import cut_lineage


def token_counts(df: DataFrame, tokens: Column | str = "tokens") -> DataFrame:
    """``(word, n)`` over the whole corpus."""
    return explode_once(df, [], tokens, "word").groupBy("word").agg(F.count("*").alias("n"))


def top_tokens(counts: DataFrame, k: int = 20) -> DataFrame:
    return counts.orderBy(F.desc("n"), "word").limit(k)


def vocabulary_size(counts: DataFrame) -> DataFrame:
    """Vocabulary, tokens and their ratio, from the word counts."""
    sums = counts.agg(F.count("*").alias("vocab_size"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_tokens"))
    ratio = F.when(F.col("total_tokens") > 0, F.col("vocab_size") / F.col("total_tokens")).otherwise(F.lit(0.0))
    return sums.withColumn("type_token_ratio", F.round(ratio, 6))


def approximate_vocabulary_size(df: DataFrame, tokens: str = "tokens", error: float = 0.02) -> DataFrame:
    """The same in one pass with bounded memory; the vocabulary is an estimate."""
    words = explode_once(df, [], tokens, "word")
    return words.agg(
        F.approx_count_distinct("word", error).alias("vocab_size"), F.count("*").alias("total_tokens")
    )


#: Sketches of 2 ** PRECISION registers; their standard error.
PRECISION, SKETCH_ERROR = 12, 0.0163


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``(*keys, sketch)``: what is needed to count the distinct values of each key, and of any keys together.

    A sketch is a few KB whatever it has seen.  Stored by day or batch, sketches are
    united later without a look at the rows again.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, PRECISION).alias("sketch"))


def united_counts(sketches: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """About how many distinct values the sketches of each key have seen together."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def tokenizers(c: Column | str) -> dict[str, Column]:
    """Named ways to split a text into words."""
    c = F.col(c) if isinstance(c, str) else c
    return {
        "blank": F.filter(F.split(c, rf"[{BLANK}]+"), lambda w: F.length(w) > 0),
        "word": F.filter(F.split(c, UNICODE_SPLIT), lambda w: F.length(w) > 0),
        "word_or_sign": F.regexp_extract_all(c, F.lit(rf"([\p{{L}}\p{{Nd}}_]+|[^\p{{L}}\p{{Nd}}_{BLANK}])"), 1),
    }


def vocabulary_by_tokenizer(df: DataFrame, text: str) -> DataFrame:
    """Vocabulary size and tokens of each tokenizer over the distinct texts."""
    distinct = df.select(text).distinct()
    named = F.array(
        *[F.struct(F.lit(name).alias("tokenizer"), words.alias("words")) for name, words in tokenizers(text).items()]
    )
    split = explode_once(distinct, [], named, "t").select("t.tokenizer", "t.words")
    words = split.select("tokenizer", F.explode("words").alias("word"))
    counts = words.groupBy("tokenizer", "word").agg(F.count("*").alias("n"))
    return counts.groupBy("tokenizer").agg(F.count("*").alias("vocab_size"), F.sum("n").alias("total_tokens"))


def zipf(counts: DataFrame) -> DataFrame:
    """``(word, n, freq, rank)``: most frequent first, equal counts by word.

    Ranks come from the sizes of even ranges, so no task sorts the whole vocabulary.
    """
    total = counts.agg(F.sum("n").alias("t")).scalar()
    ranked = number_sorted(counts, [F.desc("n"), F.col("word")], "rank")
    return ranked.select("word", "n", (F.col("n") / total).alias("freq"), "rank")


def vocabulary_coverage(counts: DataFrame, min_count: int = 3) -> DataFrame:
    """Share of the vocabulary frequent enough to get a word vector."""
    sums = counts.agg(F.count("*").alias("corpus_vocab"), F.count_if(F.col("n") >= min_count).alias("model_vocab"))
    return sums.withColumn("coverage_pct", F.round(F.col("model_vocab") / F.col("corpus_vocab") * 100, 4))


def shared_vocabulary(counts: DataFrame, known: DataFrame) -> DataFrame:
    """Share of the vocabulary that another corpus knows."""
    marked = counts.join(known.select("word", F.lit(1).alias("known")), "word", "left")
    sums = marked.agg(F.count("*").alias("corpus_vocab"), F.count("known").alias("known_vocab"))
    return sums.withColumn("coverage_pct", F.round(F.col("known_vocab") / F.col("corpus_vocab") * 100, 4))


def token_summary(counted: DataFrame, min_tokens: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Retention and token figures from one ``token_count`` per document, over all or per key.

    The counts are set down, as the median reads them again.
    """
    counted = cut_lineage(counted.select(*keys, "token_count"))
    kept = F.col("token_count") >= min_tokens
    figures = counted.groupBy(*keys).agg(
        F.count("*").alias("docs"),
        F.count_if(kept).alias("kept"),
        F.round(F.count_if(kept) / F.count("*") * 100, 4).alias("retention_pct"),
        F.sum(F.when(kept, F.col("token_count"))).alias("total_tokens"),
        F.round(F.avg(F.when(kept, F.col("token_count"))), 4).alias("mean_tokens"),
        F.max(F.when(kept, F.col("token_count"))).alias("max_tokens"),
    )
    medians = exact_medians(counted.filter(kept), "token_count", keys, name="median_tokens")
    if keys:
        return figures.join(medians, list(keys), "left")
    return figures.withColumn("median_tokens", medians.scalar())


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``(bin, lower, upper, n)`` for equal-width bins; the maximum falls into the last.

    Values are counted first, so the bounds and the bins read only the distinct ones.
    """
    values = compute_once(df.select(column), x=F.col(column).cast("double")).filter(F.col("x").isNotNull())
    counts = values.groupBy("x").agg(F.count("*").alias("n"))
    low = counts.agg(F.min("x").alias("v")).scalar()
    high = counts.agg(F.max("x").alias("v")).scalar()
    bounded = counts.withColumn("low", low).withColumn("high", high)
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    place = F.least(F.floor((F.col("x") - F.col("low")) / width) + 1, F.lit(bins)).cast("int")
    number = F.when(width == 0, F.lit(1)).otherwise(place)
    binned = bounded.select(number.alias("bin"), "low", width.alias("width"), "n")
    return binned.groupBy("bin", "low", "width").agg(F.sum("n").alias("n")).select(
        "bin",
        (F.col("low") + (F.col("bin") - 1) * F.col("width")).alias("lower"),
        (F.col("low") + F.col("bin") * F.col("width")).alias("upper"),
        "n",
    )


def training_corpus(
    df: DataFrame, text: str, max_chars: int | None = None, min_tokens: int = 5, lemma=None
) -> DataFrame:
    """Token lists for word-vector training.

    Cleaned, letters only, no stop words, five tokens or more.  ``max_chars``
    takes the head of every text only.  ``lemma`` maps a token column to its base
    form; without it tokens stay as they are.
    """
    whole = F.col(text) if max_chars is None else truncate(F.col(text), max_chars)
    words = remove_stop_words(tokenize(strip_urls_handles(whole), 1, unicode=True))
    words = F.filter(words, lambda w: w.rlike(r"^\p{L}+$"))
    if lemma is not None:
        words = F.transform(words, lemma)
    return compute_once(df, tokens=words).filter(F.size("tokens") >= min_tokens)


def distinct_in_order(lists: list[DataFrame]) -> DataFrame:
    """Union of word lists ``(pos, word)`` without repeats, first place first."""
    parts = [d.select(F.lit(n).alias("part"), "pos", "word") for n, d in enumerate(lists)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    first = union.groupBy("word").agg(F.min(F.struct("part", "pos")).alias("p"))
    placed = first.select("word", "p.part", F.col("p.pos").alias("place"))
    return number_sorted(placed, [F.col("part"), F.col("place"), F.col("word")], "pos").select("pos", "word")


def not_listed(words: DataFrame, listed: DataFrame) -> DataFrame:
    return words.join(listed.select("word"), "word", "left_anti")


def entity_counts(entities: DataFrame, key: str, types: list[str]) -> DataFrame:
    """One row per document, one column per entity type, from ``(key, entity_type)``."""
    counts = [F.count_if(F.col("entity_type") == t).alias(t) for t in types]
    return entities.groupBy(key).agg(*counts)
