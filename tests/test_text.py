"""Column functions on hand-made edge rows."""

import re
from datetime import datetime
from html import unescape

import pytest
from pyspark.sql import functions as F

from newslake.functions import dates, html, text, vectors
from newslake.functions.register import register


def values(spark, rows, *columns, schema="x string"):
    frame = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [tuple(r) if len(r) > 1 else r[0] for r in frame.select(*columns).collect()]


def test_strip_and_collapse_match_python(spark):
    rows = ["  a  b ", "\n\ta  b　", "", "\x1c x \x85", "a\r\nb"]
    got = values(spark, rows, text.strip("x"), text.collapse("x"))
    assert got == [(r.strip(), re.sub(r"\s+", " ", r).strip()) for r in rows]


def test_normalize_and_tokens(spark):
    rows = ["Élève naïve, über 42!", "مرحبا بالعالم", "a_b c"]
    assert values(spark, rows, text.normalize_for_ml("x"))[0] == "élève naïve über 42 "
    ascii_tokens = values(spark, rows, text.feature_tokens("x"))
    assert ascii_tokens == [["ve", "na", "ve", "ber", "42"], [], []]
    assert values(spark, rows, text.feature_tokens("x", unicode=True))[:2] == [
        ["élève", "naïve", "über", "42"],
        ["مرحبا", "بالعالم"],
    ]
    assert values(spark, ["The CAT and the dog's 3 toys"], text.corpus_tokens("x")) == [["cat", "dogs", "toys"]]


def test_one_pass_tokens_equal_the_long_way(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    long_way = text.remove_stop_words(text.tokenize(text.normalize_for_ml("text"), 2))
    long_unicode = text.remove_stop_words(text.tokenize(text.normalize_for_ml("text"), 2, unicode=True))
    long_corpus = text.remove_stop_words(text.tokenize(text.clean_for_corpus("text"), 3, unicode=True))
    different = docs.filter(
        (long_way != text.feature_tokens("text"))
        | (long_unicode != text.feature_tokens("text", unicode=True))
        | (long_corpus != text.corpus_tokens("text"))
    )
    assert different.count() == 0


def test_ml_stages_give_the_same_tokens(spark, sf):
    from newslake.operators.features import feature_pipeline, normalized

    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").alias("article_id"), F.col("text").alias("clean_text")
    )
    rows = normalized(docs)
    made = feature_pipeline().fit(rows).transform(rows)
    assert made.filter(F.col("tokens") != text.feature_tokens("clean_text")).count() == 0


def test_clean_for_corpus(spark):
    assert values(spark, [None, "It's 3 O'Clock -- ok_2"], text.clean_for_corpus("x")) == ["", "its oclock ok"]


def test_urls_and_handles(spark):
    rows = ["see https://a.b/c?d=1 by @jo_é now", "mail a@b.c"]
    assert values(spark, rows, text.strip_urls_handles("x")) == ["see by now", "mail a .c"]


def test_counts_and_sentences(spark):
    rows = ["  a b\tc ", "", "One. Two!  Three? four.five"]
    assert values(spark, rows, text.word_count("x")) == [3, 0, 4]
    assert values(spark, rows, text.space_count("x")) == [len(r.split(" ")) for r in rows]
    assert values(spark, rows, text.sentences("x"))[2] == ["One.", "Two!", "Three?", "four.five"]


def test_language_category_sentiment(spark):
    late = "x" * 400 + "مصر"
    rows = [None, "", "hello", "abc مصر", late]
    assert values(spark, rows, text.detect_language("x")) == ["unknown", "unknown", "en", "ar", "en"]
    rows = [None, "Stock AI", "fair", "WARm", "hello"]
    assert values(spark, rows, text.auto_categorize("x", "none")) == ["none", "finance", "tech", "international", "none"]
    assert values(spark, ["x"], text.analyze_sentiment("x")) == ["neutral"]


def chunks_by_loop(value, size, overlap):
    pieces, start = [], 0
    while value and start < len(value):
        end = min(start + size, len(value))
        pieces.append(value[start:end])
        if end == len(value):
            break
        start = end - overlap
    return pieces


@pytest.mark.parametrize("size, overlap", [(10, 3), (10, 0), (5, 4), (100, 10)])
def test_chunks(spark, size, overlap):
    rows = ["", None, "a", "x" * 9, "0123456789", "0123456789a", "0123456789" * 7]
    expected = [chunks_by_loop(r, size, overlap) for r in rows]
    assert values(spark, rows, text.chunk_text("x", size, overlap)) == expected
    register(spark)
    spark.createDataFrame([(n, r) for n, r in enumerate(rows)], "n int, x string").createOrReplaceTempView("chunk_rows")
    found = spark.sql(f"SELECT n, c.chunk FROM chunk_rows, LATERAL chunk_text(x, {size}, {overlap}) c ORDER BY n, c.pos")
    by_row = {n: [] for n in range(len(rows))}
    for r in found.collect():
        by_row[r.n].append(r.chunk)
    assert list(by_row.values()) == expected


def test_chunk_limits(spark):
    assert values(spark, ["abc", ""], text.chunk_text("x", 0, 0)) == [["abc"], []]
    with pytest.raises(ValueError):
        text.chunk_text("x", 5, 5)


def test_sql_functions(spark):
    register(spark)
    row = spark.sql(
        "SELECT clean_html('<b>a</b>&amp;') AS a, extract_main_content('<main>m</main>') AS b, "
        "title_similarity(' ABCD ', 'abcx') AS c"
    ).first()
    assert tuple(row) == ("a &", "m", 0.75)


def test_domain(spark):
    rows = ["https://u:p@a.b:80/x", "//c.d/e", "nothing", "", "http:///x"]
    assert values(spark, rows, text.url_domain("x")) == ["u:p@a.b:80", "c.d"] + ["unknown-domain"] * 3


def test_paywall(spark):
    rows = [(200, "ok"), (403, "ok"), (200, "Please SIGN IN"), (200, "x" * 600 + "paywall"), (200, "x" * 593 + "paywall")]
    got = values(spark, rows, text.is_blocked_or_paywalled("s", "h"), schema="s int, h string")
    assert got == [False, True, True, False, True]


def test_dates(spark):
    rows = [
        "Mon, 01 Jan 2024 10:00:00 +0200", "Tue, 2 Jan 2024 03:04:05 GMT", "2024-01-02T03:04:05Z",
        "2024-01-02T03:04:05.5+01:00", "2024-01-02", "soon", None,
    ]
    got = values(spark, rows, F.date_format(dates.parse_publish_date("x"), "yyyy-MM-dd HH:mm:ss"))
    assert got == [
        "2024-01-01 08:00:00", "2024-01-02 03:04:05", "2024-01-02 03:04:05", "2024-01-02 02:04:05",
        "2024-01-02 00:00:00", None, None,
    ]
    default = F.lit("2000-01-01").cast("timestamp")
    parsed = values(spark, ["2024-05-06T07:08:09Z", "bad", None], dates.parse_iso("x", default))
    assert parsed == [datetime(2024, 5, 6, 7, 8, 9), datetime(2000, 1, 1), datetime(2000, 1, 1)]
    now = values(spark, ["x"], dates.now_iso())[0]
    assert datetime.fromisoformat(now).utcoffset().total_seconds() == 0


# ------------------------------------------------------------------ HTML

NOISE = "<script>s()</script><style>p{}</style><nav>n</nav><header>h</header><aside>a</aside><noscript>x</noscript>"
PLACES = [
    ("article", "<article>TEXT</article>"),
    ("body class", '<div class="x article-body y">TEXT</div>'),
    ("content class", '<div class="article__content">TEXT</div>'),
    ("body id", '<div id="article-body">TEXT</div>'),
    ("post", '<div class="post-content">TEXT</div>'),
    ("entry", '<div class="entry-content">TEXT</div>'),
    ("section", '<section class="article-body">TEXT</section>'),
    ("content id", '<div id="content">TEXT</div>'),
    ("main", "<main>TEXT</main>"),
]


@pytest.mark.parametrize("place", range(len(PLACES)))
def test_content_places_in_order(place):
    inner = PLACES[place][1].replace("TEXT", f"<p>the <b>best</b>{NOISE} text</p>")
    # Every place later in the order comes first in the page and must lose.
    later = "".join(markup.replace("TEXT", f"worse {n}") for n, (_, markup) in enumerate(PLACES[place + 1 :]))
    page = f"<html><body>{NOISE}{later}{inner}<footer>f</footer></body></html>"
    assert html.main_text_of(page) == "the best text"


def test_main_text_fallbacks():
    assert html.main_text_of("<body><article> <img></article><main>m</main></body>") == "m"
    # Only the first element of a kind counts.
    assert html.main_text_of("<body><article></article><article>second</article> rest</body>") == "second rest"
    assert html.main_text_of("<html><body><nav>n</nav>b</body></html>") == "b"
    assert html.main_text_of("<nav>n</nav>no body<script>x</script>") == "n no body"
    assert html.main_text_of("") == "" and html.main_text_of(None) == ""
    assert html.main_text_of("<article>a<p>b<br>c</article>d") == "a b c"


def test_clean_html_forms(spark):
    rows = [
        "<p>a<b>b</b></p>c", "x<!-- c -->y", "<script>1<2</script>t", "a &amp;&lt;b&gt; &#39;q&#39; &nbsp;z",
        "plain\n\n text", "", None, "<style>a</style>", "5 < 6 & 7",
    ]
    expected = ["a b c", "x y", "t", "a &<b> 'q' z", "plain text", "", "", "", "5 < 6 & 7"]
    assert values(spark, rows, html.clean_html("x")) == expected
    assert values(spark, rows, html.strip_html("x"))[:6] == expected[:6]
    assert html.text_of("&amp;lt;&copy &eacute;") == unescape("&amp;lt;&copy &eacute;")


# ------------------------------------------------------------------ vectors


def test_vector_functions(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [-2.0, 0.0])]
    got = values(spark, rows, vectors.cosine("a", "b"), vectors.l2_normalize("a"), schema="a array<double>, b array<double>")
    assert [round(c, 12) for c, _ in got] == [0.96, 0.0, -1.0]
    assert [[round(x, 12) for x in v] for _, v in got] == [[0.6, 0.8], [0.0, 0.0], [1.0, 0.0]]
    pooled = values(
        spark,
        [([[1.0, 2.0], [3.0, 4.0], [9.0, 9.0]], [1, 1, 0]), ([[1.0, 2.0]], [0])],
        vectors.masked_mean("v", "m"),
        schema="v array<array<double>>, m array<int>",
    )
    assert pooled == [[2.0, 3.0], [0.0, 0.0]]
    assert values(spark, [([1.0, 5.0, 5.0],)], vectors.argmax("s"), schema="s array<double>") == [1]


def test_html_is_read_in_small_batches(spark):
    """A worker must not hold thousands of pages: no Arrow batches, whatever the session says."""
    pages = spark.createDataFrame([("<p>a</p>",), (None,)], "html string").withColumn("n", F.lit(1)).repartition(2)
    read = pages.select(html.clean_html("html").alias("a"), html.extract_main_content("html").alias("b"))
    assert "ArrowEvalPython" not in read._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.a, r.b) for r in read.collect()) == [("", ""), ("a", "a")]
