"""Merging against a row-by-row oracle."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newslake.operators import enrich, merge
from newslake.plans.migrate import legacy_features
from newslake.sources.store import ArticleLog

COLUMNS = ["link", "title", "publish_date", "source", "category", "content", "full_content", "full_content_status"]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)
KNOWN = ("success", "timeout", "paywall", "parse_error")


def save(store, row):
    """Apply one row to ``store`` (link -> dict); True if it was new."""
    status = row["full_content_status"] if row["full_content_status"] in KNOWN else None
    old = store.get(row["link"])
    if old is None:
        new = {c: row[c] for c in COLUMNS}
        new["full_content_status"] = status or ("success" if row["full_content"] else None)
        new["id"] = max((r["id"] for r in store.values()), default=0) + 1
        store[row["link"]] = new
        return True
    old["content"] = old["content"] or row["content"] or old["content"]
    for c in ("title", "publish_date", "source", "category"):
        old[c] = row[c] or old[c]
    if row["full_content"] and not old["full_content"]:
        old["full_content"] = row["full_content"]
        old["full_content_status"] = status or "success"
    elif status:
        old["full_content_status"] = status
    return False


def random_row(rng, links):
    def maybe(*options):
        return rng.choice(options)

    return {
        "link": f"l{rng.randrange(links)}",
        "title": maybe("a", "b", "c", ""),
        "publish_date": maybe(None, "", "d1", "d2"),
        "source": maybe("s1", "", None),
        "category": maybe("x", "y", ""),
        "content": maybe("", None, "c1", "c2"),
        "full_content": maybe("", None, None, "f1", "f2"),
        "full_content_status": maybe(None, None, "timeout", "paywall", "success", "bogus", ""),
    }


@pytest.mark.parametrize("seed", range(5))
def test_merge_articles(spark, seed):
    rng = random.Random(seed)
    store = {}
    for n in range(12):
        row = random_row(rng, 1000)
        row["link"] = f"l{n}"
        row["full_content_status"] = rng.choice([None, "success", "timeout"])
        store[row["link"]] = {**row, "id": 10 + n}
    stored = spark.createDataFrame([tuple([r["id"], *[r[c] for c in COLUMNS]]) for r in store.values()], f"id long, {SCHEMA}")
    rows = [random_row(rng, 30) for _ in range(120)]
    incoming = spark.createDataFrame([tuple([n * 7, *[r[c] for c in COLUMNS]]) for n, r in enumerate(rows)], f"seq long, {SCHEMA}")
    flags = [save(store, r) for r in rows]
    merged = merge.merge_articles(stored, incoming).select("id", *COLUMNS).collect()
    assert sorted(map(tuple, merged), key=str) == sorted(
        (tuple([r["id"], *[r[c] for c in COLUMNS]]) for r in store.values()), key=str
    )
    marked = merge.mark_inserted(incoming, stored).orderBy("seq").select("inserted").collect()
    assert [r.inserted for r in marked] == flags


def test_small_batch_does_not_shuffle_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    spark.range(20000).select(
        "id", F.concat(F.lit("l"), "id").alias("link"), *[F.lit("x").alias(c) for c in COLUMNS if c != "link"]
    ).write.parquet(path)
    incoming = spark.createDataFrame([tuple([1, "l5", *["y"] * 7])], f"seq long, {SCHEMA}")
    merged = merge.merge_articles(spark.read.parquet(path), incoming)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "SortMergeJoin" not in final


def test_log_equals_merging_every_batch(spark, tmp_path):
    rng = random.Random(9)
    log = ArticleLog(spark, str(tmp_path / "log"))
    store = {}
    assert log.current().count() == 0
    for batch in range(4):
        rows = [random_row(rng, 12) for _ in range(15)]
        frame = spark.createDataFrame(
            [tuple([n, *[r[c] for c in COLUMNS]]) for n, r in enumerate(rows)], f"seq long, {SCHEMA}"
        )
        log.append(frame, batch)
        log.append(frame, batch)  # a batch that runs again
        for r in rows:
            save(store, r)
        if batch == 1:  # a new log on what there is
            log.current().write.parquet(str(tmp_path / "base"))
            log = ArticleLog(spark, str(tmp_path / "next"), spark.read.parquet(str(tmp_path / "base")))
        got = {r.link: r.asDict() for r in log.current().collect()}
        assert got == store


def test_order_of_many_batches(spark, tmp_path):
    log = ArticleLog(spark, str(tmp_path / "log"))
    for batch, title in ((0, "first"), (8191, "later"), (8192, "after"), (20000, "last")):
        row = tuple([2**50 + 3, "a", title, *[None] * 6])
        log.append(spark.createDataFrame([row], f"seq long, {SCHEMA}"), batch)
        assert [r.title for r in log.current().collect()] == [title]


def test_migration(spark):
    columns = ["id", *COLUMNS]
    target = spark.createDataFrame(
        [
            (1, "a", "t", None, "s", "c", "", None, None),
            (2, "b", "t", None, "s", "c", "have", "full", "timeout"),
        ],
        f"id long, {SCHEMA}",
    )
    legacy = spark.createDataFrame(
        [
            (7, "a", "other", "d", "s2", "c2", "filled", "text", "bogus"),
            (8, "b", "other", "d", "s2", "c2", "new", "new", "success"),
            (9, "n", "new", "d", "s2", "c2", None, "text", None),
        ],
        f"id long, {SCHEMA}",
    )
    got = {r.link: r for r in merge.migrate_articles(target, legacy).select(*columns, "inserted").collect()}
    assert tuple(got["a"])[1:] == ("a", "t", None, "s", "c", "filled", "text", None, False)
    assert tuple(got["b"])[1:] == ("b", "t", None, "s", "c", "have", "full", "timeout", False)
    assert tuple(got["n"]) == (9, "n", "new", "d", "s2", "c2", None, "text", "success", True)
    again = merge.migrate_articles(merge.migrate_articles(target, legacy).drop("inserted"), legacy)
    assert again.filter("inserted").count() == 0


def test_features(spark):
    rows = "article_id long, token_count int, processed_at timestamp"
    old = spark.createDataFrame([(1, 5, datetime(2024, 1, 1)), (2, 6, datetime(2024, 1, 3))], rows)
    new = spark.createDataFrame([(1, 7, datetime(2024, 1, 2)), (2, 8, datetime(2024, 1, 3)), (3, 9, datetime(2024, 1, 1))], rows)
    assert {r.article_id: r.token_count for r in merge.merge_features(old, new).collect()} == {1: 7, 2: 8, 3: 9}
    assert {r.article_id: r.token_count for r in merge.migrate_features(old, new).collect()} == {1: 5, 2: 6, 3: 9}
    texts = spark.createDataFrame(
        [(1, 2, '["a","b"]', "[0.5,1.0]", "v", "2024-01-01T00:00:00Z")],
        "article_id long, token_count int, tokens string, feature_vector string, pipeline_version string, processed_at string",
    )
    row = legacy_features(texts).first()
    assert row.tokens == ["a", "b"] and row.feature_vector == [0.5, 1.0] and row.processed_at == datetime(2024, 1, 1)


def test_fetch_outcomes(spark):
    items = spark.createDataFrame(
        [
            ("t", " good ", "d", "s", "c"), ("t", "gone", None, None, None), ("t", "paid", "d", "s", "c"),
            ("t", "hollow", "d", "s", "c"), (" ", "good", "d", "s", "c"), ("t", "", "d", "s", "c"),
            ("t", "nowhere", "d", "s", "c"), ("t", "moved", "d", "s", "c"),
        ],
        "title string, link string, publish_date string, source string, category string",
    )
    pages = spark.createDataFrame(
        [
            ("good", 200, "<article>text</article>"), ("gone", 403, "<article>text</article>"),
            ("paid", 200, "Subscribe now <article>text</article>"), ("hollow", 200, "<body> </body>"),
            ("moved", 404, "<article>text</article>"),
        ],
        "link string, status int, html string",
    )
    got = {(r.title, r.link): r for r in enrich.fetch_outcomes(items, pages).collect()}
    assert got["t", "good"].content == "text" and got["t", "good"].fetch_status == "success"
    assert (got["t", "good"].raw_length, got["t", "good"].cleaned_length) == (23, 4)
    for link in ("gone", "paid", "nowhere", "moved"):
        assert got["t", link].error == "Fetch failed" and got["t", link].raw_length == 0
    assert got["t", "hollow"].error == "Empty content after extraction" and got["t", "hollow"].raw_length == 14
    assert got["<missing>", "good"].fetch_status == "skipped"
    assert got["t", "<missing>"].error == "Missing title or URL"
    assert (got["t", "gone"].source, got["t", "gone"].category) == ("Unknown", "unknown")


def test_backfill_limit_and_blank_text(spark):
    stored = spark.createDataFrame(
        [(n, f"l{n}", full, None) for n, full in enumerate([None, "", "   ", "text", None])],
        "id long, link string, full_content string, full_content_status string",
    )
    fetched = spark.createDataFrame([(f"l{n}", "x" * 900) for n in range(4)], "link string, content string")
    updates = enrich.backfill(stored, fetched, limit=3)
    assert sorted(r.id for r in updates.collect()) == [1]  # 4 has no page, 2 is blank but not empty
    counts = enrich.backfill_counters(stored, fetched, limit=3).first()
    assert tuple(counts) == (3, 2, 1, 1)
    done = {r.id: r for r in enrich.apply_backfill(stored, updates).collect()}
    assert done[1].full_content_status == "success" and done[0].full_content is None


def test_a_merge_reads_and_writes_touched_parts_only(spark, tmp_path):
    from newslake.sources.store import LinkStore

    names = ["title", "link", "publish_date", "source", "category", "content", "full_content", "full_content_status"]
    schema = "id long, " + ", ".join(f"{c} string" for c in names)
    rows = [(n, f"t{n}", f"l{n}", "", "s", "c", f"c{n}", None, None) for n in range(1, 201)]
    store = LinkStore(spark, f"{tmp_path}/store", 64).create(spark.createDataFrame(rows, schema))
    news = [(1, "new title", "l7"), (2, "fresh", "x1"), (3, "again", "l7"), (4, "fresh too", "x2")]
    incoming = spark.createDataFrame(news, "seq long, title string, link string")
    for c in names[2:]:
        incoming = incoming.withColumn(c, F.lit(None).cast("string"))
    expected = merge.merge_articles(spark.createDataFrame(rows, schema), incoming).drop("inserted", "updated")
    expected = sorted(map(tuple, expected.select("id", "link", "title", "content").collect()))
    parts = store.touched(incoming)
    assert 2 <= len(parts) <= 3
    # Nothing of the others may be read or written: their files are made unreadable, and stay as they are.
    kept = {}
    for path in (tmp_path / "store").glob("_part=*/*.parquet"):
        if int(path.parent.name.split("=")[1]) not in parts:
            kept[path] = path.read_bytes()
            path.write_bytes(b"x" * len(kept[path]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = store.merge(incoming, lambda old, new: merge.merge_articles(old, new, store.highest_id()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r.link for r in merged.filter("inserted").collect()} == {"x1", "x2"}
    for path, content in kept.items():
        assert path.read_bytes() == b"x" * len(content)
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        path.write_bytes(content)
    found = sorted(map(tuple, store.read().select("id", "link", "title", "content").collect()))
    assert found == expected and store.highest_id() == 202
