"""Whole jobs, and the shape of their plans."""

import re

import pytest
from pyspark.sql import functions as F

from newslake.catalog import QUERIES
from newslake.catalog.fixtures import articles
from newslake.operators import features
from newslake.plans import collect, features as feature_plan
from newslake.session import cut_lineage, shared_dir, work_dir
from newslake.sources.registry import lists_to_table


def rss(title, items):
    body = "".join(f"<item><title>{t}</title><link>{k}</link><description>{d}</description></item>" for t, k, d in items)
    return f"<rss><channel><title>{title}</title>{body}</channel></rss>"


@pytest.fixture(scope="module")
def run(spark):
    registry = lists_to_table(spark, {"world": ["f1", "f2"], "tech": ["f3", "f4"]})
    bodies = spark.createDataFrame(
        [
            ("f1", "world", rss("One", [("Floods hit the coast of Spain", "l1", "a"), ("Talks resume in Geneva", "l2", "b")])),
            ("f2", "world", rss("Two", [("Floods hit the coast of Spain!", "l3", "c"), ("Talks resume", "l1", "d")])),
            ("f3", "tech", rss("Three", [("Talks resume in Geneva", "l4", "b"), ("New chip out", "l5", "e")])),
            ("f4", "tech", "<rss><channel><title>Four</title><item>"),
        ],
        "feed_url string, category string, body string",
    )
    pages = spark.createDataFrame(
        [("l2", 200, f"<article>{'full two ' * 100}</article>"), ("l5", 403, "<article>x</article>"),
         ("old", 200, f"<article>{'old text ' * 100}</article>")],
        "link string, status int, html string",
    )
    store = spark.createDataFrame(
        [(4, "old", "Old", None, "s", "world", "summary", None, None)],
        "id long, link string, title string, publish_date string, source string, category string, content string, "
        "full_content string, full_content_status string",
    )
    marked = cut_lineage(collect.fetch_feeds(bodies, registry, skip_bozo=True))
    return marked, collect.collect_and_store(marked, pages, store)


def test_marked_items(run):
    marked, _ = run
    got = {(r.feed_url, r.link): r.drop_reason for r in marked.collect()}
    assert got == {
        ("f1", "l1"): None, ("f1", "l2"): None, ("f2", "l3"): "similar_title", ("f2", "l1"): "duplicate_url",
        ("f3", "l4"): "duplicate_content", ("f3", "l5"): None,
    }


def test_store_after_run(run):
    _, result = run
    store = {r.link: r for r in result.store.collect()}
    assert {k: r.id for k, r in store.items()} == {"old": 4, "l1": 5, "l2": 6, "l5": 7}
    assert store["l2"].full_content.startswith("full two") and store["l2"].full_content_status == "success"
    assert store["old"].full_content.startswith("old text") and store["l5"].full_content is None
    assert {r.category: (r.total, r.saved) for r in result.saved.collect()} == {"world": (2, 2), "tech": (1, 1)}
    counters = result.collected.first()
    assert (counters.total_articles, counters.duplicates_removed, counters.kept) == (6, 3, 3)
    assert tuple(result.backfilled.first()) == (3, 1, 2, 1)


def test_without_full_text(run, spark):
    marked, _ = run
    store = spark.createDataFrame([], "id long, link string, title string, publish_date string, source string, "
                                      "category string, content string, full_content string, full_content_status string")  # fmt: skip
    pages = spark.createDataFrame([], "link string, status int, html string")
    result = collect.collect_and_store(marked, pages, store, enrich_full=False)
    assert result.backfilled is None and result.store.filter(F.col("full_content").isNotNull()).count() == 0
    assert sorted(r.id for r in result.store.collect()) == [1, 2, 3]


def test_feature_model_is_reused(spark, sf, tmp_path):
    rows = articles(spark, sf)
    first, model = feature_plan.process_articles(rows.filter("id < 100"))
    assert first.columns == ["article_id", "token_count", "tokens", "features", "pipeline_version", "processed_at"]
    features.save_model(model, str(tmp_path / "model"))
    loaded = features.load_model(str(tmp_path / "model"))
    later, same = feature_plan.process_articles(rows, loaded, since_id=99)
    assert same is loaded and later.agg(F.min("article_id")).first()[0] > 99
    one = first.select("article_id", "features").first()
    again = features.extract_features(
        rows.filter(F.col("id") == one.article_id).select(F.col("id").alias("article_id"), F.coalesce("full_content", "content").alias("clean_text")), loaded
    ).first()
    assert again.features == one.features
    exported = features.export_features(first).first()
    assert exported.tokens.startswith("[") and exported.feature_vector.count(",") == 4095


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream")])
def test_no_cross_join(name, spark, sf):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["coverage_by_category", "top_sources", "processing_scan", "dedup_url", "latest_per_key"])
def test_columns_are_pruned(name, spark, sf):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    read = " ".join(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert "n_chars" not in read and "props" not in read
    if name == "top_sources":
        assert "text" not in read


def test_texts_are_tokenized_once(spark, sf):
    for name in ("tokens_no_stop", "feature_token_counts"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"lower\((?:text|coalesce)", plan)) <= 1, name


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_figures_of_a_whole_run(spark, sf):
    import json

    from newslake.catalog.runs import feeds_by_source, registry_of
    from newslake.catalog.streams import page_table
    from tests.test_dedup import one_by_one

    feeds = feeds_by_source(spark, sf)
    items = collect.fetch_feeds(feeds, registry_of(feeds), deduplicate=False, skip_bozo=True).collect()
    verdicts = one_by_one([r.asDict() for r in items])
    kept = [r for r in items if verdicts[r.seq] is None]
    totals = {r.category: 0 for r in feeds.select("category").distinct().collect()}
    for r in kept:
        totals[r.category] += 1
    pages = {r.link for r in page_table(spark, sf).collect()}
    got = QUERIES["collect_run"](spark, sf).first()
    assert (got.total_articles, got.duplicates_removed) == (len(items), len(items) - len(kept))
    assert got.bozo_skipped == feeds.filter(F.col("feed_url").endswith("/0")).count()
    assert json.loads(got.category_totals) == totals and got.stored_articles == len(kept)
    assert got.full_fetch_success + got.full_fetch_failed == len(kept)
    assert got.full_fetch_success <= sum(r.link in pages for r in kept)
    assert json.loads(got.backfill)


def test_an_enriched_stream_takes_early_and_late_pages(spark, tmp_path):
    from newslake.schemas import ITEM_MESSAGE
    from newslake.sources.streams import read_files
    from newslake.streaming.alerts import keep_state_on_disk
    from newslake.streaming.enrich import enrich_as_pages_arrive

    keep_state_on_disk(spark)
    base = str(tmp_path)
    schema = "link string, status int, html string, fetched_at string"

    def at(minutes):
        return f"2024-01-01T{10 + minutes // 60:02d}:{minutes % 60:02d}:00"

    def message(n, link, minutes, title="t"):
        values = {"id": f"m{n}", "title": title, "link": link, "fetched_at": at(minutes)}
        return tuple(values.get(f, "") for f in ITEM_MESSAGE.fieldNames())

    def page(link, minutes, status=200, text="text"):
        return (link, status, f"<article>{text} of {link}</article>", at(minutes))

    steps = [
        ([message(1, "early", 30), message(2, "late", 30), message(3, "none", 30)], [page("early", 5)]),
        ([message(4, "blocked", 40), message(5, "early", 50, title=" ")], [page("late", 80), page("blocked", 41, 403), page("early", 42, text="second")]),
        ([message(6, "early", 45), message(7, "out", 60)], [page("out", 200)]),
        ([message(8, "end", 700)], [page("other end", 700)]),
    ]
    for messages, pages in steps:
        spark.createDataFrame(messages, ITEM_MESSAGE).coalesce(1).write.mode("append").parquet(f"{base}/m")
        spark.createDataFrame(pages, schema).coalesce(1).write.mode("append").parquet(f"{base}/p")
        joined = enrich_as_pages_arrive(
            read_files(spark, f"{base}/m", ITEM_MESSAGE), read_files(spark, f"{base}/p", spark.createDataFrame([], schema).schema)
        )
        out = joined.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
        out.trigger(availableNow=True).start().awaitTermination()
    found = {r.id: r.full_content for r in spark.read.parquet(f"{base}/out").collect()}
    assert found == {
        "m1": "text of early", "m2": "text of late", "m3": None, "m4": None, "m5": None, "m6": "text of early", "m7": None,
    }
