"""Near copies and token ids: few documents at once, and nothing left in the Python workers."""

import corpus_pipeline
import pyarrow as pa
import pytest

from newslake.llm import minhash


@pytest.fixture
def docs(spark):
    return spark.range(2000).coalesce(1).selectExpr("id AS doc_id", "concat('some text of number ', id) AS text")


def limited(function):
    """Fails in the task when more documents come at once."""

    def work(batch):
        if batch.num_rows > 512:
            raise ValueError(f"{batch.num_rows} documents at once")
        yield from function(batch)

    return work


def test_near_copies_and_few_documents_at_once(spark, docs, monkeypatch):
    for name in ("_signatures", "_sets"):
        monkeypatch.setattr(minhash, name, limited(getattr(minhash, name)))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(name)
    assert corpus_pipeline.drop_near_copies(spark, docs, "").count() == 2000
    assert spark.conf.get(name) == given


def test_token_ids_and_few_documents_at_once(spark, docs, monkeypatch):
    def sizes(rows, path, pattern):
        def work(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["rows"])

        return rows.mapInArrow(work, "rows long")

    monkeypatch.setattr(corpus_pipeline.tokens, "encode", sizes)
    found = [r.rows for r in corpus_pipeline.encode(spark, docs, "").collect()]
    assert sum(found) == 2000 and max(found) <= 512


def test_workers_forget_words(spark, docs):
    assert minhash.near_duplicates(docs).count() == 2000

    def remembered(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(minhash.WORD_HASHES)], pa.int64())], ["words"])

    left = spark.range(0, 64, 1, 8).mapInArrow(remembered, "words long").collect()
    assert max(r.words for r in left) == 0
