"""Queries of vocabulary, term weights, features and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslake.catalog import sqltext as q
from newslake.catalog.base import query
from newslake.catalog.fixtures import ARTICLES_SQL, table, texts
from newslake.functions import text as t
from newslake.operators import corpus, features, filters, sequences, stats
from newslake.session import work_dir

WORDS_SQL = f"""words AS (
  SELECT doc_id, lang, unnest({q.corpus_tokens('text')}) AS word FROM documents
), counts AS (
  SELECT word, count(*) AS n FROM words GROUP BY word
)"""


def tokenized(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text")
    return docs.select("doc_id", "lang", t.corpus_tokens("text").alias("tokens"))


def counts(spark, sf):
    return corpus.token_counts(tokenized(spark, sf))


@query("vocab_top_k", f"WITH {WORDS_SQL} SELECT word, n FROM counts ORDER BY n DESC, word LIMIT 30")
def vocab_top_k(spark, sf):
    return corpus.top_tokens(counts(spark, sf), 30)


@query(
    "vocab_ttr",
    f"""WITH {WORDS_SQL}
    SELECT count(*) AS vocab_size, CAST(sum(n) AS BIGINT) AS total_tokens,
           round(CAST(count(*) AS DOUBLE) / sum(n), 6) AS type_token_ratio FROM counts""",
)
def vocab_ttr(spark, sf):
    return corpus.vocabulary_size(counts(spark, sf))


@query(
    "vocab_ttr_approximate",
    f"""WITH {WORDS_SQL}
    SELECT CAST(sum(n) AS BIGINT) AS total_tokens, true AS within_three_errors FROM counts""",
)
def vocab_ttr_approximate(spark, sf):
    """The estimate in one pass, held against the exact count."""
    exact = corpus.vocabulary_size(counts(spark, sf)).select("vocab_size").scalar()
    near = F.abs(F.col("vocab_size") - exact) <= 3 * 0.02 * exact
    return corpus.approximate_vocabulary_size(tokenized(spark, sf)).select(
        "total_tokens", near.alias("within_three_errors")
    )


@query(
    "vocab_sketches",
    f"""SELECT lang, count(DISTINCT word) AS vocab_size, true AS within_three_errors
    FROM (SELECT lang, unnest({q.corpus_tokens('text')}) AS word FROM documents) GROUP BY lang""",
)
def vocab_sketches(spark, sf):
    """Sketches of the words of every hundred documents, stored, and united to the vocabulary of each language."""
    path = work_dir(spark, "sketches")
    words = tokenized(spark, sf).select("lang", F.floor(F.col("doc_id") / 100).alias("part"), F.explode("tokens").alias("word"))
    # The part is a column: a folder for each would be a file for every hundred documents and task.
    corpus.distinct_sketches(words, ["lang", "part"], "word").write.parquet(path)
    stored = spark.read.schema("lang string, part long, sketch binary").parquet(path)
    about = corpus.united_counts(stored, ["lang"], "estimate")
    exact = words.select("lang", "word").distinct().groupBy("lang").agg(F.count("*").alias("vocab_size"))
    near = F.abs(F.col("estimate") - F.col("vocab_size")) <= 3 * corpus.SKETCH_ERROR * F.col("vocab_size")
    return exact.join(about, "lang").select("lang", "vocab_size", near.alias("within_three_errors"))


@query(
    "users_by_week",
    """SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week, count(DISTINCT user_id) AS users,
              true AS within_three_errors FROM events GROUP BY ALL""",
)
def users_by_week(spark, sf):
    """Sketches of the users of each day and type, stored, and united to weeks; held against exact counts."""
    path = work_dir(spark, "daily")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    corpus.distinct_sketches(events, ["event_type", "day"], "user_id").write.parquet(path)
    stored = spark.read.schema("event_type string, day date, sketch binary").parquet(path)
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    about = corpus.united_counts(stored.select("event_type", week, "sketch"), ["event_type", "week"], "estimate")
    exact = events.select("event_type", week, "user_id").distinct().groupBy("event_type", "week").agg(F.count("user_id").alias("users"))
    near = F.abs(F.col("estimate") - F.col("users")) <= 3 * corpus.SKETCH_ERROR * F.col("users")
    return exact.join(about, ["event_type", "week"]).select("event_type", "week", "users", near.alias("within_three_errors"))


@query(
    "zipf",
    f"""WITH {WORDS_SQL}
    SELECT word, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM counts), 10) AS freq,
           row_number() OVER (ORDER BY n DESC, word) AS rank FROM counts""",
)
def zipf(spark, sf):
    return corpus.zipf(counts(spark, sf)).withColumn("freq", F.round("freq", 10))


@query(
    "vocab_coverage",
    f"""WITH {WORDS_SQL}
    SELECT count(*) AS corpus_vocab, count(*) FILTER (WHERE n >= 3) AS model_vocab,
           round(CAST(count(*) FILTER (WHERE n >= 3) AS DOUBLE) / count(*) * 100, 4) AS coverage_pct FROM counts""",
)
def vocab_coverage(spark, sf):
    return corpus.vocabulary_coverage(counts(spark, sf))


@query(
    "vocab_shared",
    f"""WITH {WORDS_SQL}, b AS (SELECT DISTINCT unnest({q.corpus_tokens('text')}) AS word FROM benchmark)
    SELECT count(*) AS corpus_vocab, count(b.word) AS known_vocab,
           round(CAST(count(b.word) AS DOUBLE) / count(*) * 100, 4) AS coverage_pct
    FROM counts LEFT JOIN b ON counts.word = b.word""",
)
def vocab_shared(spark, sf):
    bench = table(spark, sf, "benchmark").select(t.corpus_tokens("text").alias("tokens"))
    return corpus.shared_vocabulary(counts(spark, sf), corpus.token_counts(bench))


@query(
    "vocab_by_tokenizer",
    rf"""WITH texts AS (SELECT DISTINCT text FROM documents), w AS (
      SELECT 'blank' AS tokenizer, unnest([x FOR x IN string_split_regex(text, '[{q.BLANK}]+') IF x <> '']) AS word
      FROM texts
      UNION ALL
      SELECT 'word', unnest([x FOR x IN string_split_regex(text, '[^\p{{L}}\p{{Nd}}_]+') IF x <> '']) FROM texts
      UNION ALL
      SELECT 'word_or_sign', unnest(regexp_extract_all(text, '[\p{{L}}\p{{Nd}}_]+|[^\p{{L}}\p{{Nd}}_{q.BLANK}]'))
      FROM texts)
    SELECT tokenizer, count(DISTINCT word) AS vocab_size, count(*) AS total_tokens FROM w GROUP BY tokenizer""",
)
def vocab_by_tokenizer(spark, sf):
    return corpus.vocabulary_by_tokenizer(texts(spark, sf, "documents", "text"), "text")


COUNTED_SQL = f"""counted AS (
  SELECT doc_id, CAST(len({q.corpus_tokens('text')}) AS BIGINT) AS token_count FROM documents
)"""


@query(
    "token_stats",
    f"""WITH {COUNTED_SQL}
    SELECT count(*) AS docs, count(*) FILTER (WHERE token_count >= 20) AS kept,
           round(CAST(count(*) FILTER (WHERE token_count >= 20) AS DOUBLE) / count(*) * 100, 4) AS retention_pct,
           CAST(sum(token_count) FILTER (WHERE token_count >= 20) AS BIGINT) AS total_tokens,
           round(avg(token_count) FILTER (WHERE token_count >= 20), 4) AS mean_tokens,
           median(token_count) FILTER (WHERE token_count >= 20) AS median_tokens,
           max(token_count) FILTER (WHERE token_count >= 20) AS max_tokens FROM counted""",
)
def token_stats(spark, sf):
    counted = tokenized(spark, sf).select(F.size("tokens").cast("long").alias("token_count"))
    return corpus.token_summary(counted, 20)


@query(
    "token_stats_by_language",
    f"""SELECT lang, count(*) AS docs, count(*) FILTER (WHERE n >= 20) AS kept,
           round(CAST(count(*) FILTER (WHERE n >= 20) AS DOUBLE) / count(*) * 100, 4) AS retention_pct,
           CAST(sum(n) FILTER (WHERE n >= 20) AS BIGINT) AS total_tokens,
           round(avg(n) FILTER (WHERE n >= 20), 4) AS mean_tokens, median(n) FILTER (WHERE n >= 20) AS median_tokens,
           max(n) FILTER (WHERE n >= 20) AS max_tokens
    FROM (SELECT lang, CAST(len({q.corpus_tokens('text')}) AS BIGINT) AS n FROM documents) GROUP BY lang""",
)
def token_stats_by_language(spark, sf):
    counted = tokenized(spark, sf).select("lang", F.size("tokens").cast("long").alias("token_count"))
    return corpus.token_summary(counted, 20, ["lang"])


@query(
    "length_histogram",
    f"""WITH {COUNTED_SQL}, b AS (
      SELECT CAST(min(token_count) AS DOUBLE) AS low, CAST(max(token_count) AS DOUBLE) AS high FROM counted), p AS (
      SELECT least(CAST(floor((token_count - low) / ((high - low) / 30.0)) AS INTEGER) + 1, 30) AS bin, low,
             (high - low) / 30.0 AS width FROM counted, b)
    SELECT bin, round(low + (bin - 1) * width, 4) AS lower, round(low + bin * width, 4) AS upper, count(*) AS n
    FROM p GROUP BY bin, low, width""",
)
def length_histogram(spark, sf):
    counted = tokenized(spark, sf).select(F.size("tokens").alias("token_count"))
    bins = corpus.histogram(counted, "token_count")
    return bins.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


PROBES = ["market", "the", "technology", "und", "mention", "que", "ation"]


@query(
    "probe_words",
    f"""WITH {WORDS_SQL}, probes AS (
      SELECT unnest(['market', 'the', 'technology', 'und', 'mention', 'que', 'ation']) AS word,
             unnest([0, 1, 2, 3, 4, 5, 6]) AS pos),
    known AS (SELECT pos, word FROM probes WHERE word IN (SELECT word FROM counts))
    SELECT pos, word FROM known
    UNION ALL
    SELECT NULL, word FROM (SELECT word FROM counts ORDER BY n DESC, word LIMIT 5)
    WHERE NOT EXISTS (SELECT 1 FROM known)""",
)
def probe_words(spark, sf):
    probes = spark.createDataFrame(list(enumerate(PROBES)), "pos int, word string")
    return filters.in_vocabulary(probes, counts(spark, sf))


@query(
    "anchors_and_frequent_words",
    f"""WITH {WORDS_SQL}, ranked AS (
      SELECT word, row_number() OVER (ORDER BY n DESC, word) AS p FROM counts),
    b AS (SELECT unnest({q.corpus_tokens('text')}) AS word FROM benchmark),
    bench AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS p FROM b GROUP BY word),
    u AS (SELECT 0 AS part, p, word FROM bench WHERE p <= 20 UNION ALL
          SELECT 1, p, word FROM ranked WHERE p <= 60),
    f AS (SELECT word, min(part * 1000 + p) AS k FROM u GROUP BY word)
    SELECT row_number() OVER (ORDER BY k) AS pos, word FROM f""",
)
def anchors_and_frequent_words(spark, sf):
    """The benchmark's 20 most frequent words, then the corpus' 60, without repeats."""
    bench = table(spark, sf, "benchmark").select(t.corpus_tokens("text").alias("tokens"))

    def listed(df, n):
        top = corpus.zipf(df).filter(F.col("rank") <= n)
        return top.select(F.col("rank").alias("pos"), "word")

    return corpus.distinct_in_order([listed(corpus.token_counts(bench), 20), listed(counts(spark, sf), 60)])


@query(
    "training_corpus",
    rf"""WITH c AS (
      SELECT doc_id, {q.no_stop("[w FOR w IN string_split_regex(lower(" + q.collapse(
          rf"regexp_replace(regexp_replace(text, 'https?://[^{q.BLANK}]+', ' ', 'g'), "
          r"'@[\p{L}\p{N}_]+', ' ', 'g')") + r"), '[^\p{L}\p{Nd}_]+') IF regexp_full_match(w, '\p{L}+')]")} AS tokens
      FROM documents)
    SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM c WHERE len(tokens) >= 5""",
)
def training_corpus(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return corpus.training_corpus(docs, "text").select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    "entity_counts",
    """SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS user,
              count(*) FILTER (WHERE role = 'assistant') AS assistant,
              count(*) FILTER (WHERE role = 'system') AS system
    FROM conversations GROUP BY conv_id""",
)
def entity_counts(spark, sf):
    """Roles stand for entity types, conversations for titles."""
    rows = table(spark, sf, "conversations").select("conv_id", F.col("role").alias("entity_type"))
    return corpus.entity_counts(rows, "conv_id", ["user", "assistant", "system"])


# ------------------------------------------------------------ term weights

TFIDF_SQL = f"""docs AS (
  SELECT doc_id, lang, {q.feature_tokens('text')} AS tokens FROM documents
), terms AS (
  SELECT doc_id, lang, unnest(tokens) AS term FROM docs
), tf AS (
  SELECT doc_id, lang, term, count(*) AS tf FROM terms GROUP BY doc_id, lang, term
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), idf AS (
  SELECT term, df, ln(((SELECT count(*) FROM docs) + 1.0) / (df + 1.0)) AS idf FROM df
)"""


def feature_docs(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text")
    return docs.select("doc_id", "lang", t.feature_tokens("text").alias("tokens"))


@query(
    "tfidf_terms",
    f"""WITH {TFIDF_SQL}
    SELECT doc_id, tf.term, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS tf_idf
    FROM tf JOIN idf ON tf.term = idf.term""",
)
def tfidf_terms(spark, sf):
    weighted = features.tf_idf(feature_docs(spark, sf))
    return weighted.select(
        "doc_id", "term", "tf", "df", F.round("idf", 6).alias("idf"), F.round("tf_idf", 6).alias("tf_idf")
    )


@query(
    "top_terms_by_category",
    f"""WITH {TFIDF_SQL}, g AS (
      SELECT lang, tf.term, CAST(sum(tf) AS BIGINT) AS tf FROM tf GROUP BY lang, tf.term), s AS (
      SELECT lang, g.term, g.tf, df, round(g.tf * idf, 6) AS score FROM g JOIN idf ON g.term = idf.term)
    SELECT lang, term, tf, CAST(df AS BIGINT) AS df, score FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS r FROM s) WHERE r <= 10""",
)
def top_terms_by_category(spark, sf):
    return features.top_terms_by_group(feature_docs(spark, sf), "lang", k=10)


def processing_texts(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    full = F.when(F.col("quality") == 1, F.col("text"))
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("article_id"),
        t.preferred_text(full, "text").alias("clean_text"),
    )


@query("tfidf_hashed")
def tfidf_hashed(spark, sf):
    """Hashed feature rows; the vector is shown by its size and its sum."""
    from newslake.functions.vectors import to_list

    source = processing_texts(spark, sf)
    rows = features.fit_and_extract(source, processed_at=F.lit(0).cast("timestamp"))[0]
    values = to_list("features")
    return rows.select(
        "article_id",
        "token_count",
        F.size(F.filter(values, lambda x: x > 0)).alias("non_zero"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 4).alias("weight"),
        "pipeline_version",
    )


@query(
    "feature_token_counts",
    f"""WITH {ARTICLES_SQL}, c AS (
      SELECT id AS article_id, {q.normalize("coalesce(nullif(full_content, ''), nullif(content, ''))")} AS text
      FROM articles), n AS (
      SELECT article_id, CAST(len({q.no_stop(q.ascii_tokens('text'))}) AS INTEGER) AS token_count
      FROM c WHERE length(text) >= 80)
    SELECT * FROM n WHERE token_count > 0""",
)
def feature_token_counts(spark, sf):
    source = processing_texts(spark, sf)
    rows = features.fit_and_extract(source, num_features=64)[0]
    return rows.select("article_id", "token_count")


# ------------------------------------------------------------ sequences

TURNS_SQL = rf"""turns AS (
  SELECT conv_id, turn, role, string_split(lower({q.collapse('text')}), ' ') AS tokens FROM conversations
), turn_words AS (
  SELECT unnest(tokens) AS word FROM turns
), vocab AS (
  SELECT word, 1 + row_number() OVER (ORDER BY count(*) DESC, word) AS id FROM turn_words GROUP BY word
)"""


def turns(spark, sf):
    words = F.split(F.lower(t.collapse("text")), " ")
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", words.alias("tokens"))


def encoded(spark, sf):
    """Turns as ids, the vocabulary being that of the user's turns alone."""
    rows = turns(spark, sf)
    vocabulary = sequences.build_vocabulary(corpus.token_counts(rows.filter(F.col("role") == "user")))
    return sequences.encode(rows, vocabulary, ["conv_id", "turn"])


ENCODED_SQL = (
    TURNS_SQL.replace("FROM turns\n)", "FROM turns WHERE role = 'user'\n)")
    + """, ids AS (
  SELECT conv_id, turn, pos, coalesce(v.id, 1) AS id
  FROM turns, unnest(turns.tokens) WITH ORDINALITY AS u(word, pos) LEFT JOIN vocab v ON u.word = v.word
), encoded AS (
  SELECT conv_id, turn, list(id ORDER BY pos) AS ids FROM ids GROUP BY conv_id, turn
)"""
)


@query("vocab_build", f"WITH {TURNS_SQL} SELECT word, CAST(id AS BIGINT) AS id FROM vocab")
def vocab_build(spark, sf):
    vocabulary = sequences.build_vocabulary(corpus.token_counts(turns(spark, sf)))
    return vocabulary.filter(F.col("id") >= 2)


@query(
    "vocab_encode",
    f"WITH {ENCODED_SQL} SELECT conv_id, turn, array_to_string(ids, ' ') AS ids FROM encoded",
)
def vocab_encode(spark, sf):
    return encoded(spark, sf).select("conv_id", "turn", F.array_join("ids", " ").alias("ids"))


@query(
    "pad_sequences",
    f"""WITH {ENCODED_SQL}, n AS (
      SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 32 AS batch_no FROM encoded), m AS (
      SELECT *, max(len(ids)) OVER (PARTITION BY batch_no) AS max_len FROM n)
    SELECT conv_id, turn, CAST(batch_no AS BIGINT) AS batch_no, CAST(max_len AS BIGINT) AS max_len,
           array_to_string(list_concat(ids, list_transform(range(max_len - len(ids)), lambda x: 0)), ' ') AS ids
    FROM m""",
)
def pad_sequences(spark, sf):
    padded = sequences.pad_in_batches(
        encoded(spark, sf), 32, F.floor(F.col("conv_id") / 1000), ["conv_id", "turn"], ["ids"]
    )
    return padded.select(
        "conv_id", "turn", "batch_no", F.col("max_len").cast("long").alias("max_len"), F.array_join("ids", " ").alias("ids")
    )


@query(
    "masked_accuracy",
    f"""WITH {ENCODED_SQL}, p AS (
      SELECT unnest(ids) AS l, unnest(list_reverse(ids)) AS p FROM encoded)
    SELECT count(*) FILTER (WHERE p = l) AS matches, count(*) FILTER (WHERE l <> 1) AS labels,
           round(CAST(count(*) FILTER (WHERE p = l) AS DOUBLE) / count(*) FILTER (WHERE l <> 1), 6) AS accuracy,
           count(*) FILTER (WHERE p = l AND l <> 1) AS masked_matches FROM p""",
)
def masked_accuracy(spark, sf):
    """Each turn read backwards as the prediction; the unknown word stands for padding."""
    rows = encoded(spark, sf).withColumn("predicted", F.reverse("ids"))
    masked = sequences.masked_tag_accuracy(rows, "predicted", "ids", 1)
    plain = sequences.tag_accuracy(rows, "predicted", "ids", 1)
    return plain.withColumn("masked_matches", masked.select("matches").scalar())


@query(
    "label_decode",
    """WITH best AS (
      SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS id FROM embeddings), tags AS (
      SELECT DISTINCT vec_id % 64 AS id, 'tag' || (vec_id % 64) AS tag FROM embeddings)
    SELECT vec_id, tag FROM best JOIN tags ON best.id = tags.id""",
)
def label_decode(spark, sf):
    """The numbers of a vector as scores of 64 labels."""
    rows = table(spark, sf, "embeddings")
    label = F.col("vec_id") % 64
    tags = rows.select(label.cast("int").alias("id"), F.concat(F.lit("tag"), label).alias("tag")).distinct()
    scored = rows.select("vec_id", F.array("embedding").alias("scores"))
    return sequences.decode(scored, tags, ["vec_id"]).select("vec_id", "tag")


@query(
    "run_performance",
    """SELECT source AS model, count(*) AS docs, round(sum(n_chars) / 1000.0, 4) AS seconds,
              max(n_chars) AS vocab_size,
              round(count(*) / (sum(n_chars) / 1000.0), 2) AS docs_per_sec,
              round(sum(n_chars) / 1000.0 * 1000 / count(*), 2) AS ms_per_doc
    FROM documents GROUP BY source""",
)
def run_performance(spark, sf):
    """A run log derived from the documents: one run per document, a millisecond per character."""
    runs = table(spark, sf, "documents").select(
        F.col("source").alias("model"),
        F.lit(1).alias("docs"),
        (F.col("n_chars") / 1000.0).alias("seconds"),
        F.col("n_chars").alias("vocab_size"),
    )
    return stats.run_performance(runs).withColumn("seconds", F.round("seconds", 4))
