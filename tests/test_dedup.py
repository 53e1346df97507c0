"""Duplicate removal against a row-by-row oracle."""

import random
from difflib import SequenceMatcher
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslake.catalog import QUERIES
from newslake.catalog.fixtures import arrivals
from newslake.operators import dedup, title_pairs


def one_by_one(rows, threshold=0.85):
    """Decide each article in arrival order; rows are dicts."""
    links, hashes, kept_titles, verdicts = set(), set(), {}, {}
    for row in sorted(rows, key=lambda r: r["seq"]):
        title = row["title"].strip().lower()
        mark = md5((title + row["content"][:200].strip().lower()).encode()).hexdigest()
        if row["link"] in links:
            verdicts[row["seq"]] = "duplicate_url"
            continue
        links.add(row["link"])
        known = kept_titles.setdefault(row["category"], [])
        if mark in hashes:
            verdicts[row["seq"]] = "duplicate_content"
        elif any(SequenceMatcher(None, title, k).ratio() >= threshold for k in known):
            verdicts[row["seq"]] = "similar_title"
        else:
            verdicts[row["seq"]] = None
            hashes.add(mark)
            known.append(title)
    return verdicts


def marked(spark, rows, **options):
    frame = spark.createDataFrame(rows, "seq long, link string, category string, title string, content string")
    return {r.seq: r.drop_reason for r in dedup.mark_duplicates(frame, **options).collect()}


WORDS = "market war over the new plan of state talks rise falls again as bank of île élan مصر 42".split()


def random_rows(seed, n):
    rng = random.Random(seed)
    titles = [" ".join(rng.choices(WORDS, k=rng.randint(1, 9))) for _ in range(max(3, n // 4))] + ["", "  ", "a"]
    rows = []
    for seq in range(n):
        title = rng.choice(titles)
        if rng.random() < 0.5 and title:
            place = rng.randrange(len(title))
            title = title[:place] + rng.choice(["", "x", " b", title[place].upper()]) + title[place + 1 :]
        rows.append(
            {
                "seq": seq * 3 + 1,
                "link": f"l{rng.randrange(n)}",
                "category": rng.choice(["a", "a", "b"]),
                "title": title,
                "content": rng.choice(["one", "two ", "Two", "three" * 60]),
            }
        )
    return rows


@pytest.mark.parametrize(
    "seed, n, options",
    [(1, 60, {}), (2, 120, {}), (3, 120, {"first_batch": 25}), (4, 200, {"first_batch": 30}), (5, 160, {"pair_budget": 2500})],
)
def test_random_rows(spark, seed, n, options):
    rows = random_rows(seed, n)
    assert marked(spark, rows, **options) == one_by_one(rows)


def test_one_title_fills_a_category(spark):
    rows = [
        {"seq": n, "link": f"l{n}", "category": "a", "title": f"Daily market report no {n % 40}", "content": f"c{n % 7}"}
        for n in range(300)
    ]
    rows += [{"seq": 1000 + n, "link": f"m{n}", "category": "b", "title": "Same", "content": "same"} for n in range(300)]
    expected = one_by_one(rows)
    assert marked(spark, rows) == expected
    assert marked(spark, rows, first_batch=100) == expected
    # All variants in one batch, which has to be halved until it is small enough.
    assert marked(spark, rows, pair_budget=30_000) == expected


def test_hash_of_a_dropped_article_does_not_block(spark):
    rows = [
        {"seq": 1, "link": "1", "category": "a", "title": "stocks rise on good news today", "content": "x"},
        {"seq": 2, "link": "2", "category": "a", "title": "stocks rise on good news today!", "content": "y"},
        # Same hash as the second, which was dropped for its title, but in another category.
        {"seq": 3, "link": "3", "category": "b", "title": "stocks rise on good news today!", "content": "y"},
        {"seq": 4, "link": "4", "category": "c", "title": "stocks rise on good news today!", "content": "y"},
    ]
    assert marked(spark, rows) == {1: None, 2: "similar_title", 3: None, 4: "duplicate_content"}


def test_threshold_edges(spark):
    base = "abcdefghijklmnopqrst"  # 20 characters; 3 of them replaced give a ratio of 0.85
    rows = [{"seq": 0, "link": "0", "category": "a", "title": base, "content": "0"}]
    for n, title in enumerate(["abcdefghijklmnopq###", "abcdefghijklmnop####", "abcdefghijklmnopqr##"], 1):
        rows.append({"seq": n, "link": str(n), "category": "a", "title": title, "content": str(n)})
    assert SequenceMatcher(None, rows[1]["title"], base).ratio() == 0.85
    assert marked(spark, rows) == one_by_one(rows)


def test_blank_and_missing_values(spark):
    rows = [
        {"seq": n, "link": f"{n}", "category": c, "title": t, "content": x}
        for n, (c, t, x) in enumerate([("a", "", ""), ("a", " ", "z"), ("b", "", ""), (None, "t", "x"), (None, "t", "y")])
    ]
    frame = spark.createDataFrame(rows, "seq long, link string, category string, title string, content string")
    reasons = {r.seq: r.drop_reason for r in dedup.mark_duplicates(frame).collect()}
    filled = [{**r, "category": r["category"] or ""} for r in rows]
    assert reasons == one_by_one(filled)


@pytest.mark.parametrize("threshold, blocks", [(0.7, (2048, 1 << 20)), (0.85, (7, 1 << 20)), (0.95, (2048, 90))])
def test_similar_titles_are_all_found(spark, monkeypatch, threshold, blocks):
    monkeypatch.setattr(title_pairs, "BLOCK_TITLES", blocks[0])
    monkeypatch.setattr(title_pairs, "BLOCK_CHARS", blocks[1])
    monkeypatch.setattr(title_pairs, "LANES", 100)
    rng = random.Random(7)
    titles = [r["title"].strip().lower() for r in random_rows(11, 160)]
    titles += ["".join(rng.choices("abc ", k=rng.randint(0, 30))).strip() for _ in range(60)]
    for n in (63, 64, 65, 130, 511, 512, 513, 700):
        long = rng.choices("abcdefgh é\U0001f600", k=n)
        titles += ["".join(long)] + ["".join(c for c in long if rng.random() > share) for share in (0.02, 0.1, 0.3)]
    rows = [("a", n, n, t) for n, t in enumerate(sorted({t for t in titles}))]
    rows += [("b", 1000 + n, n, t) for _, n, _, t in rows[::5]]
    seqs = {tid: (rng.randrange(900), rng.randrange(900)) for _, tid, _, _ in rows}
    table = [(tid, c, t, min(seqs[tid]), max(seqs[tid])) for c, tid, _, t in rows]
    frame = spark.createDataFrame(table, "tid long, category string, title_key string, first_seq long, last_seq long")
    found = {tuple(r) for r in title_pairs.similar_titles(frame, frame, threshold).collect()}
    expected = {
        (x[0], y[0])
        for x in table
        for y in table
        if x[1] == y[1] and x[0] != y[0] and x[4] > y[3] and SequenceMatcher(None, x[2], y[2]).ratio() >= threshold
    }
    assert found == expected and len(expected) > 20
    assert title_pairs.count_possible(frame, threshold, share=1) >= len(expected)


def test_common_subsequences_side_by_side():
    rng = random.Random(3)
    titles = ["".join(rng.choices("abcdeé中", k=rng.choice([1, 3, 63, 64, 65, 128, 200, 511, 512]))) for _ in range(60)]
    x, y = (np.array([rng.randrange(60) for _ in range(800)]) for _ in range(2))
    lengths = title_pairs.common_lengths(titles, titles, x, y).tolist()
    assert lengths == [title_pairs.common_length(titles[i], titles[j]) for i, j in zip(x, y)]
    for i, j in zip(x[:60], y[:60]):
        row = [0] * (len(titles[j]) + 1)
        for c in titles[i]:
            new = [0]
            for k, d in enumerate(titles[j]):
                new.append(row[k] + 1 if c == d else max(row[k + 1], new[k]))
            row = new
        assert title_pairs.common_length(titles[i], titles[j]) == row[-1]


def test_given_documents(spark, sf):
    rows = [r.asDict() for r in arrivals(spark, sf).select("seq", "id", "link", "category", "title", "content").collect()]
    expected = one_by_one(rows)
    got = {r.id: r.drop_reason for r in QUERIES["dedup_articles"](spark, sf).collect()}
    assert got == {r["id"]: expected[r["seq"]] for r in rows}
    counters = QUERIES["run_counters"](spark, sf).first()
    assert counters.total_articles == len(rows)
    assert counters.kept == sum(v is None for v in expected.values())
    assert counters.duplicate_url == sum(v == "duplicate_url" for v in expected.values())


def test_link_and_hash_only(spark):
    rows = random_rows(5, 150)
    frame = spark.createDataFrame(rows, "seq long, link string, category string, title string, content string")
    seen_links, seen_hashes, kept = set(), set(), []
    for row in rows:
        if row["link"] in seen_links:
            continue
        seen_links.add(row["link"])
        mark = row["title"].strip().lower() + row["content"][:200].strip().lower()
        if mark not in seen_hashes:
            seen_hashes.add(mark)
            kept.append(row["seq"])
    assert sorted(r.seq for r in dedup.deduplicate_by_link_and_hash(frame).collect()) == kept


def test_hot_link_is_cut_before_the_shuffle(spark, sf):
    plan = dedup.first_by_link(arrivals(spark, sf))._jdf.queryExecution().executedPlan().toString()
    # One limit per link in the map tasks, one after the shuffle.
    assert plan.count("WindowGroupLimit") == 2


def test_title_similarity_query(spark, sf):
    rows = sorted(arrivals(spark, sf).collect(), key=lambda r: r.id)
    last, expected = {}, {}
    for r in rows:
        title = r.title.strip().lower()
        if r.category in last:
            expected[r.id] = round(SequenceMatcher(None, title, last[r.category]).ratio(), 6)
        last[r.category] = title
    got = {r.id: r.similarity for r in QUERIES["title_similarity_neighbours"](spark, sf).collect()}
    assert got == expected


def test_a_hot_key_is_spread_over_the_join(spark):
    """Half of the rows have one key; no partition of the join may hold more than a share of them."""
    from newslake.operators.ordering import join_per_key

    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = join_per_key(rows, per_key, "k", "n").withColumn("at", F.spark_partition_id()).cache()
        assert joined.count() == 40_000
        assert joined.filter("n != CASE WHEN k = 0 THEN 20000 ELSE 1 END OR n IS NULL").isEmpty()
        assert joined.groupBy("at").count().agg(F.max("count")).first()[0] < 6_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        joined.unpersist()
