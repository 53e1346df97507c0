"""Registered queries of this package, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import (
    chat,
    embeddings,
    exact,
    licenses,
    minhash,
    mixing,
    quality,
    repair,
    spans,
    tokens,
    toxicity,
    warc,
    wrappers,
)
from newslake.llm.common import pick, remove, table
from newslake.session import work_dir

QUERIES = {}
SQL: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to, as digests."""
    ids = tokens.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    both = tokens.decode(ids, RANKS)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op10_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
        FROM documents
    ), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
    FROM d JOIN g USING (body)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the equal one that stays."""
    found = exact.duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


@query("op7_minhash")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near copies it belongs to."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_embedding_dedup")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and the component of near copies it belongs to."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query(
    "op4_mixing",
    f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS tokens
        FROM documents
    ), t AS (SELECT source, sum(tokens) AS n FROM d GROUP BY source
    ), s AS (SELECT source, n, n / (SELECT sum(n) FROM t) AS share, (SELECT count(*) FROM t) AS sources FROM t
    ), bisected(i, lo, hi) AS (
        SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
        UNION ALL
        SELECT i + 1, if(even, (lo + hi) / 2, lo), if(even, hi, (lo + hi) / 2)
        FROM (
            SELECT i, lo, hi,
                ln(sum(pow(share, (lo + hi) / 2)))
                - (lo + hi) / 2 * sum(pow(share, (lo + hi) / 2) * ln(share)) / sum(pow(share, (lo + hi) / 2))
                >= {mixing.EVENNESS} * ln(max(sources)) - 1e-12 AS even
            FROM bisected, s WHERE i < 45 GROUP BY i, lo, hi
        )
    ), limited AS (
        SELECT CASE WHEN max(share) / min(share) <= {mixing.REPEATS} THEN 0
            ELSE 1 - ln({mixing.REPEATS}) / ln(max(share) / min(share)) END AS lowest
        FROM s
    ), e AS (
        SELECT floor(greatest((SELECT max(lo) FROM bisected WHERE i = 45), lowest) * 1e6 + 0.5) / 1e6 AS x FROM limited
    ), p AS (SELECT source, n, pow(share, x) AS power FROM s, e
    ), w AS (
        SELECT source, n,
            greatest(round(power * (SELECT max(n / power) FROM p))::BIGINT, n) AS budget,
            greatest(round(power / (SELECT sum(power) FROM p) * {mixing.BLOCK_TOKENS})::BIGINT, 1) AS quota
        FROM p
    ), u AS (
        SELECT doc_id, source, tokens, n, budget, quota, pass,
            md5('{mixing.SEED}:' || pass || ':' || doc_id) AS place
        FROM (SELECT *, unnest(range(0, ceil(budget / n)::BIGINT)) AS pass FROM d JOIN w USING (source))
    ), a AS (
        SELECT *, pass * n + sum(tokens) OVER (PARTITION BY source, pass ORDER BY place, tokens) - tokens AS spot FROM u
    )
    SELECT doc_id, source, tokens::BIGINT AS tokens, pass::INT AS pass, (spot // quota)::BIGINT AS block, place
    FROM a WHERE spot < budget
    """,
)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of every document in the mix of all sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_licenses")
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return licenses.summary(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query(
    "op9_chat",
    """
    WITH c AS (
        SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) AS said
        FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations) GROUP BY conv_id
    ), begun AS (SELECT DISTINCT said[1:k] AS said FROM c, unnest(range(1, len(said))) AS _(k)
    ), whole AS (SELECT said, min(conv_id) AS conv_id FROM c GROUP BY said)
    SELECT conv_id, 0::BIGINT AS part, len(said)::BIGINT AS n_turns,
        array_to_string(list_transform(said, lambda x: '<|im_start|>' || coalesce(x.r, '') || chr(10)
            || coalesce(x.t, '') || '<|im_end|>' || chr(10)), '') AS text
    FROM whole ANTI JOIN begun USING (said)
    """,
)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat texts of all conversations that no longer one begins with."""
    return chat.render(table(spark, sf_dir, "conversations"))


@query("op5_main_text")
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


@query("op12_spans")
def op12_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every document, with the counts of their links."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = spans.align(table(spark, sf_dir, "documents"), *paths, hashed=True)
    return spans.with_counts(aligned.withColumnRenamed("groups", "groups_sha256"), spans.vocabulary_sizes(*paths))


@query(
    "op13_warc",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
    ), f AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first FROM p
    ), r AS (SELECT *, strlen(html) >= {warc.SHARED_BYTES} AND page_id > first AS again FROM f)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
        if(again, 'revisit', 'response') AS record_type, if(again, first, NULL) AS refers_to
    FROM r
    """,
)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say of each page, read back by their record chains."""
    folder = work_dir(spark, "warc")
    warc.write_archives(warc.records_of(table(spark, sf_dir, "pages")), folder)
    found = warc.read_archives(spark, folder, payloads=False)
    remove(spark, folder)
    again = F.col("type") == "revisit"
    return found.select(
        F.col("id").cast("long").alias("page_id"),
        F.when(again, F.col("stated_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(again, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers").cast("long").alias("refers_to"),
    )


@query("op11_repair")
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults and its cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    report, turns = repair.repair(repair.damage(conversations), "conv")
    ids = pick(conversations, conv_id="conv_id").distinct()
    hashes = repair.digests(turns).withColumnRenamed("conv", "hashed")
    found = ids.join(report, ids["conv_id"].eqNullSafe(report["conv"]), "left")
    both = found.join(hashes, found["conv_id"].eqNullSafe(hashes["hashed"]), "left")
    figures = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select(
        "conv_id",
        *figures,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
