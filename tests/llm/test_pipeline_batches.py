"""The toxicity stage sends whole documents to Python in small batches."""

import corpus_pipeline
import pyarrow as pa


def test_toxicity_stage_sends_few_documents_at_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.range(2000).coalesce(1).selectExpr("id AS doc_id", "'some text' AS text")

    def sizes(rows, model):
        def work(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["rows"])

        return rows.mapInArrow(work, "rows long")

    monkeypatch.setattr(corpus_pipeline.toxicity, "keep", sizes)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(name)
    found = [r.rows for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()]
    assert sum(found) == 2000 and max(found) <= 512
    assert spark.conf.get(name) == given
