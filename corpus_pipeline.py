"""The training-data pipeline: stages over documents, each written and read again.

A stage takes ``(spark, docs, sf_dir)``, works on all that the one before it kept, and
returns the columns of its input; the last one returns token ids.  Null texts count as
empty, texts of any length are read whole, extra columns are carried along whatever
their names, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newslake.llm import exact, minhash, mixing, tokens, toxicity
from newslake.llm.common import small_batches, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from the labelled ones among them.

    Empty texts have a score like any other; repeated rows and rows without an id are judged one by one.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    # Written here, as the size of the batches holds for what runs now.
    with small_batches(spark):
        return written(toxicity.keep(docs, model), "pipeline-clean")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, empty ones included: that with the largest id.

    Rows that repeat an id and its text become one; a row without an id stays if its text has no other.
    """
    return exact.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id.

    Texts without words are in no group and all stay.
    """
    # What sends texts to Python is written in here.
    with small_batches(spark):
        return minhash.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources more often, in mixed blocks.

    Rows without a source are a source of their own; rows that repeat an id are dealt one by one.
    """
    return mixing.dealt(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; the ids as little-endian 32-bit integers."""
    with small_batches(spark):
        ids = tokens.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
        return written(ids, "pipeline-ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact", drop_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: The stages learn, keep state and verify sets: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
