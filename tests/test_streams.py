"""Streams over files give what the batch forms give."""

import json

from pyspark.sql import functions as F

from newslake import session
from newslake.catalog import QUERIES
from newslake.catalog.streams import in_parts
from newslake.schemas import ITEM_MESSAGE
from newslake.sources.store import ArticleLog
from newslake.sources.streams import keyed_json, read_files, read_timer, scheduled
from newslake.streaming import metrics
from newslake.streaming.dedup import drop_seen_links, drop_stored_links
from newslake.streaming.enrich import EnrichmentJob, enrich_messages, run_bounded, split_messages, stop_after

KEYED = "key string, value string"


def message(n, link, summary="s", **extra):
    base = {
        "id": f"m{n}", "title": f"t{n}", "link": link, "publish_date": "", "source": "S", "category": "c",
        "summary": summary, "fetched_at": f"2024-01-01T00:00:{n:02d}",
    }
    return json.dumps({**base, **extra})


def pages(spark):
    return spark.createDataFrame(
        [("a", 200, "<article>full a</article>"), ("b", 403, "<article>no</article>")],
        "link string, status int, html string",
    )


def write(spark, path, n, values):
    spark.createDataFrame([(None, v) for v in values], KEYED).coalesce(1).write.json(f"{path}/in/f{n}")


def test_enrichment_in_batches(spark, tmp_path):
    base = str(tmp_path)
    write(spark, base, 0, [message(0, "a"), message(1, "b"), "{broken"])
    write(spark, base, 1, [message(2, "a", title="newer"), message(3, "c", title=None)])
    log = ArticleLog(spark, f"{base}/store")
    job = EnrichmentJob(log, pages(spark), f"{base}/cleaned", f"{base}/alerts")
    schema = spark.createDataFrame([], KEYED).schema
    source = read_files(spark, f"{base}/in/*", schema, "json", max_files_per_trigger=1)
    counted, done = stop_after(job.run_batch, 2)
    writer = source.writeStream.foreachBatch(counted).option("checkpointLocation", f"{base}/cp")
    run_bounded(writer.trigger(processingTime="0 seconds"), done)
    # Started again from its checkpoint, the stream has nothing left to do.
    again = job.writer(source, f"{base}/cp").trigger(availableNow=True).start()
    again.awaitTermination()
    cleaned = spark.read.schema(KEYED).json(f"{base}/cleaned")
    rows = [json.loads(r.value) for r in cleaned.collect()]
    status = {(r["id"], r["enrichment_status"], r["full_content"]) for r in rows}
    assert status == {("m0", "full", "full a"), ("m1", "summary_only", None), ("m2", "full", "full a"), ("m3", "summary_only", None)}
    assert all(r["enriched_at"] for r in rows)
    store = {r.link: r for r in log.current().collect()}
    assert set(store) == {"a", "b", "c"} and store["a"].title == "newer" and store["a"].full_content_status == "success"
    assert store["b"].full_content is None and store["c"].title == ""
    alerts = [json.loads(r.value) for r in spark.read.schema(KEYED).json(f"{base}/alerts").collect()]
    assert len(alerts) == 1 and alerts[0]["type"] == "enrichment_failure" and alerts[0]["ts"]


def test_batch_twice_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    log = ArticleLog(spark, f"{base}/store")
    job = EnrichmentJob(log, pages(spark), f"{base}/cleaned", f"{base}/alerts")
    raw = spark.createDataFrame([(None, message(0, "a")), (None, message(1, "b"))], KEYED)
    job.run_batch(raw, 0)
    before = sorted(map(str, log.current().collect()))
    job.run_batch(raw, 0)
    assert sorted(map(str, log.current().collect())) == before
    assert spark.read.schema(KEYED).json(f"{base}/cleaned").count() == 2


def test_metrics_of_a_stream(spark, tmp_path):
    base = str(tmp_path)
    write(spark, base, 0, [message(0, "a"), message(1, "b")])
    write(spark, base, 1, [message(2, "c")])
    log = metrics.attach(spark)
    try:
        source = read_files(spark, f"{base}/in/*", spark.createDataFrame([], KEYED).schema, "json", 1)
        good, _ = split_messages(source)
        observed = metrics.observe_messages(enrich_messages_static(good, pages(spark)))
        query = observed.writeStream.format("noop").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        import time

        for _ in range(50):
            if log.totals.get("messages_consumed", 0) >= 3:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert log.totals == {"messages_consumed": 3, "processing_partial": 2, "processing_full": 1}
    assert log.batches >= 2


def enrich_messages_static(stream, pages):
    """The stream joined to pages whose text is known, without state."""
    from newslake.operators.enrich import enrich_or_fall_back

    texts = pages.filter("status = 200").select("link", F.col("html").alias("content"))
    return enrich_or_fall_back(stream, texts)


def test_fallback_keeps_every_message(spark):
    rows = [json.loads(message(n, link)) for n, link in enumerate(["a", "a", "b", "zz", ""])]
    frame = spark.createDataFrame([tuple(r[f] for f in ITEM_MESSAGE.fieldNames()) for r in rows], ITEM_MESSAGE)
    got = {r.id: r.enrichment_status for r in enrich_messages(frame, pages(spark)).collect()}
    assert got == {"m0": "full", "m1": "full", "m2": "summary_only", "m3": "summary_only", "m4": "summary_only"}


def test_messages_of_a_link_are_judged_one_by_one(spark):
    rows = [json.loads(message(n, "a", title=t)) for n, t in enumerate(["", "titled", None, " ", "other"])]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame([tuple(r[f] for f in ITEM_MESSAGE.fieldNames()) for r in order], ITEM_MESSAGE)
        got = {r.id: r.enrichment_status for r in enrich_messages(frame, pages(spark)).collect()}
        assert got == {"m0": "summary_only", "m1": "full", "m2": "summary_only", "m3": "summary_only", "m4": "full"}


def test_newest_page_of_a_link(spark):
    fetched = spark.createDataFrame(
        [("a", 200, "<article>old</article>", 1), ("a", 200, "<article>new</article>", 2), ("b", 200, "<p>x</p>", 1), ("b", 500, "", 3)],
        "link string, status int, html string, fetched_at int",
    )
    rows = [json.loads(message(n, link)) for n, link in enumerate("ab")]
    frame = spark.createDataFrame([tuple(r[f] for f in ITEM_MESSAGE.fieldNames()) for r in rows], ITEM_MESSAGE)
    got = {r.id: r.full_content for r in enrich_messages(frame, fetched).collect()}
    assert got == {"m0": "new", "m1": None}


def test_alert_on_failure(spark, tmp_path):
    base = str(tmp_path)
    log = ArticleLog(spark, f"{base}/store")
    job = EnrichmentJob(log, pages(spark), f"{base}/cleaned", f"{base}/alerts", alert_on_failure=True)
    long = "{broken " + "x" * 500
    job.run_batch(spark.createDataFrame([(None, message(0, "a")), (None, message(1, "b")), (None, long)], KEYED), 0)
    assert [r.link for r in log.current().collect()] == ["a"]
    alerts = {json.loads(r.value)["error"] for r in spark.read.schema(KEYED).json(f"{base}/alerts").collect()}
    assert alerts == {"Failed to fetch: b", f"malformed message: {long}"}


def test_seen_links(spark, tmp_path):
    base = str(tmp_path)
    write(spark, base, 0, [message(0, "a"), message(1, "b"), message(2, "a")])
    write(spark, base, 1, [message(3, "a"), message(4, "c")])
    source = read_files(spark, f"{base}/in/*", spark.createDataFrame([], KEYED).schema, "json", 1)
    passed = drop_seen_links(split_messages(source)[0], within="1 day").select("link")
    writer = passed.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
    scheduled(writer).start().awaitTermination()
    assert sorted(r.link for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b", "c"]
    batch = spark.createDataFrame([("a",), ("a",), ("n",)], "link string")
    assert [r.link for r in drop_stored_links(batch, spark.createDataFrame([("a",)], "link string")).collect()] == ["n"]


def test_timer_and_json_sink(spark, tmp_path):
    assert read_timer(spark, 5).isStreaming
    frame = spark.createDataFrame([("l", None)], "link string, title string")
    assert keyed_json(frame).first().value == '{"link":"l","title":null}'


def folder_of_tables(spark, sf, tmp_path, names, parts=3):
    """Tables as folders of several files."""
    for name in names:
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(parts).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_tables_in_folders_arrive_whole(spark, sf, tmp_path):
    folder = folder_of_tables(spark, sf, tmp_path, ["documents", "labels", "conversations"])
    for name in ("stream_messages", "stream_metrics", "stream_features", "stream_enrich", "stream_alerts", "stream_store"):
        found, wanted = (sorted(map(str, QUERIES[name](spark, d).collect())) for d in (folder, sf))
        assert found == wanted and len(found) > 0, name


def test_streams_in_parts_keep_few_state_stores(spark, tmp_path):
    """Each store commits in every micro-batch; two for a core are enough, and the session's number comes back."""
    given = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for wanted in ("400", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", wanted)
            folder = str(tmp_path / wanted)
            in_parts([(folder, spark.range(20), F.col("id"))], lambda: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))))
            assert spark.conf.get("spark.sql.shuffle.partitions") == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", given)
    assert seen == [2 * spark.sparkContext.defaultParallelism] * 5 + [3] * 5


def test_a_batch_leaves_only_its_packed_sinks(spark, tmp_path, monkeypatch):
    held = tmp_path / "held"
    monkeypatch.setattr(session, "work_dir", lambda _, name: f"{held}/{name}")
    log = ArticleLog(spark, f"{tmp_path}/store")
    job = EnrichmentJob(log, pages(spark), f"{tmp_path}/cleaned", f"{tmp_path}/alerts")
    job.run_batch(spark.createDataFrame([(None, message(0, "a")), (None, message(1, "b"))], KEYED), 0)
    assert not list(held.glob("*/*"))
    for sink, kind in (("store/changes", "*.zstd.parquet"), ("cleaned", "*.json.gz")):
        files = [f for f in (tmp_path / sink / "batch=0").glob("part-*")]
        assert files and all(f.match(kind) for f in files)
    # Without a base there is nothing to update, so texts are folded once and not joined.
    plan = log.current()._jdf.queryExecution().optimizedPlan().toString()
    assert "any_full_content" in plan and "LogicalRDD" not in plan and "LeftOuter" not in plan
    assert log.current().count() == 2
