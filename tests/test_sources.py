"""File readers, metric files, scans."""

from datetime import datetime

from pyspark.sql import functions as F

from newslake.catalog.fixtures import articles, table
from newslake.operators.health import scored_checks
from newslake.sources import files, reports, store, streams
from newslake.schemas import ITEM_MESSAGE


def test_tab_separated_and_latin1(spark, tmp_path):
    (tmp_path / "news.csv").write_text("category\tfilename\ttitle\tcontent\nbiz\t1.txt\tT\tA, b\n")
    schema = "category string, filename string, title string, content string"
    assert files.read_tab_separated(spark, str(tmp_path / "news.csv"), schema).first().content == "A, b"
    (tmp_path / "ner.csv").write_bytes("Sentence #,Word\nSentence: 1,café\n".encode("latin-1"))
    assert files.read_latin1_csv(spark, str(tmp_path / "ner.csv"), "s string, word string").first().word == "café"


def test_aligned_lines(spark, tmp_path):
    (tmp_path / "s.txt").write_text("Thousands of people\nIran\n")
    (tmp_path / "l.txt").write_text("O O O\nB-geo\n")
    sentences = files.numbered_lines(spark, str(tmp_path / "s.txt"))
    labels = files.numbered_lines(spark, str(tmp_path / "l.txt"))
    got = files.aligned_tokens(sentences, labels).orderBy("line_no", "pos").collect()
    assert [(r.line_no, r.pos, r.token, r.tag) for r in got] == [
        (0, 0, "Thousands", "O"), (0, 1, "of", "O"), (0, 2, "people", "O"), (1, 0, "Iran", "B-geo"),
    ]


def test_log_lines(spark):
    lines = spark.createDataFrame(
        [(" Category 'tech': 5 unique articles",), ("Producing 9",), ("Total articles fetched: 3",), ("noise",),
         ("Consumed 5",), ("consumed 5",), ("Overall coverage: 1/2",)],
        "value string",
    )
    assert [r.line for r in files.producer_lines(lines).collect()] == [
        "Category 'tech': 5 unique articles", "Producing 9", "Total articles fetched: 3",
    ]
    assert files.consumer_lines(lines).count() == 1 and files.consumer_lines(lines, ignore_case=True).count() == 2
    assert files.coverage_lines(lines).count() == 1


def test_metrics_history(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, h), 10 * h, 5 * h, 50.0, True, 0) for h in range(3)]
    checks = spark.createDataFrame(
        rows,
        "timestamp timestamp, database_total long, database_enriched long, coverage_percentage double, "
        "kafka_running boolean, error_count long",
    )
    path = str(tmp_path / "metrics")
    reports.write_metrics(scored_checks(checks), path)
    reports.write_metrics(scored_checks(checks), path)
    back = reports.read_metrics(spark, path)
    assert back.count() == 6 and back.agg(F.max("database_total")).first()[0] == 20


def test_scan_is_pushed_down(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content")).withColumn(
        "full_content", F.lit(None).cast("string")
    )
    plan = store.articles_for_processing(rows, since_id=5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(doc_id,5)" in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_optional_columns(spark, sf):
    rows = articles(spark, sf)
    scanned = store.scan(rows, ["id", "publish_date", "updated_at"], {"updated_at": "timestamp"})
    assert dict(scanned.dtypes) == {"id": "bigint", "publish_date": "string", "updated_at": "timestamp"}
    assert store.available(rows, ["id", "publish_date"]).columns == ["id"]


def test_split_percent(spark):
    frame = spark.range(1000)
    assert store.split_slice(frame, "id", percent=1).count() == 10
    assert store.split_slice(frame, "id", n=7).count() == 7


def test_messages_round_trip(spark):
    items = spark.createDataFrame(
        [("t", "l", None, None, None, "x")],
        "title string, link string, publish_date string, source string, category string, content string",
    )
    keyed = streams.keyed_json(streams.build_messages(items))
    raw = keyed.unionByName(spark.createDataFrame([("k", "{bad"), ("k", None), ("k", "[1]")], "key string, value string"))
    good, bad = [streams.parse_json(raw, ITEM_MESSAGE).filter(c).collect() for c in (~F.col("malformed"), F.col("malformed"))]
    assert len(good) == 1 and len(bad) == 3
    assert (good[0].source, good[0].category, good[0].publish_date, good[0].summary) == ("Unknown", "uncategorized", "", "x")
    assert len(good[0].id) == 36 and keyed.first().key == "l"


def test_legacy_reader(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([(1, "l")], "id long, link string").write.parquet(path)
    assert store.read_legacy(spark, path).first().full_content_status is None
