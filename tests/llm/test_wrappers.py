from newslake.llm import wrappers
from tests.llm import cases

PAGE = """<!DOCTYPE html><html><head><title>T{0}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href=/>Home</a><li>More {0}</ul></nav><!-- ad --><div class="ad-slot">Buy {0}</div>
<article><h1>Title&nbsp;{0}</h1><p>One &lt;b&gt; <b>bold{0}<br>next<p>Two
   lines</p><div class="share-box">Share</div><form>f</form></article>
<section id="comments"><article><p>Nice {0}</p></article></section><footer>&copy; x</footer></body></html>"""
PLAIN = """<body><div class="top">Site name</div><div id="story"><h2>Head {0}</h2><p>Text {0} of it</p><p>Text {0} again</p>
<h2>Sub {0}</h2><p>Rest {0}</p>{1}</div><div class=low>Imprint</div></body>"""


def test_marked_article():
    page = wrappers.blocks(PAGE.format(7))
    text = wrappers.main_text(page, wrappers.reading(wrappers.stream(page)))
    assert text == "Title 7\n\nOne <b> bold7 next\n\nTwo lines"


def test_a_wrapper_has_optional_and_repeated_items_slots_and_template():
    pages = [wrappers.stream(wrappers.blocks(PLAIN.format(i, "<ul><li>extra</ul>" if i == 2 else ""))) for i in range(4)]
    wrapper = pages[0]
    for page in pages[1:]:
        wrapper = wrappers.align(wrapper, page)
    said = wrappers.expression(wrapper)
    assert said == "body/div.top (body/div.story/h2# body/div.story/p#+)+ body/div.story/ul/li? body/div.low"
    again = wrappers.align(wrapper, pages[0])
    assert wrappers.expression(again) == said
    rules = wrappers.reading(wrapper)
    page = wrappers.blocks(PLAIN.format(9, ""))
    assert wrappers.main_text(page, rules) == "Head 9\n\nText 9 of it\n\nText 9 again\n\nSub 9\n\nRest 9"


def test_extract(spark):
    table = [(i, f"https://A.example/{i}", PAGE.format(i)) for i in range(30)]
    table += [(100 + i, "http://b.example/x?y", PLAIN.format(i, "")) for i in range(5)]
    table += [(200, "http://b.example/z", None), (201, None, ""), (202, None, "plain &amp; simple"), (None, "c", "<p>x</p>")]
    table += [(300, "http://d.example", "<p>" + "long text " * 50_000 + "</p>"), (301, "http://d.example", "<p a='unclosed")]
    df = spark.createDataFrame(table, "page_id long, url string, html string").repartition(4)
    for pages in (df, cases.clashing(df)):
        found = {r.page_id: r for r in wrappers.extract(pages).collect()}
        assert len(found) == len(table)
        for i in range(30):
            assert found[i].text == f"Title {i}\n\nOne <b> bold{i} next\n\nTwo lines"
        assert found[103].text == "Head 3\n\nText 3 of it\n\nText 3 again\n\nSub 3\n\nRest 3"
        assert found[200].text == found[201].text == "" and found[202].text == "plain & simple"
        assert found[None].text == "x" and found[None].url == "c"
        assert found[300].n_chars == len(found[300].text) == 10 * 50_000 - 1
    assert wrappers.extract(cases.empty(df)).count() == 0


def test_given_pages_against_the_article_element(spark, sf):
    import html
    import re

    for row in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?p>|</?h1>", inner)]
        page = wrappers.blocks(row.html)
        assert wrappers.main_text(page, wrappers.reading(wrappers.stream(page))) == "\n\n".join(p for p in parts if p)


def test_hosts_with_one_page_or_copies_of_one_keep_single_blocks(spark):
    table = [(0, "http://one.example/0", PLAIN.format(0, ""))]
    table += [(1 + i, f"http://copies.example/{i}", PLAIN.format(7, "")) for i in range(6)]
    table += [(10 + i, f"http://asides.example/{i}", f"<nav>{i}</nav>" + PLAIN.format(7, "")) for i in range(3)]
    table += [(20 + i, f"http://many.example/{i}", PLAIN.format(i, "")) for i in range(3)]
    df = spark.createDataFrame(table, "page_id long, url string, html string").repartition(4)
    found = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    for i, n in [(0, 0), (1, 7), (6, 7), (10, 7), (12, 7)]:
        story = [f"Head {n}", f"Text {n} of it", f"Text {n} again", f"Sub {n}", f"Rest {n}"]
        assert found[i] == "\n\n".join(["Site name", *story, "Imprint"])
    assert found[21] == "Head 1\n\nText 1 of it\n\nText 1 again\n\nSub 1\n\nRest 1"
    single = "<body><h1>Headline</h1><div class=x><p>First</p><p>Second</p></div></body>"
    alone = spark.createDataFrame([(1, "http://a.example", single)], df.schema)
    assert wrappers.extract(alone).first().text == "Headline\n\nFirst\n\nSecond"


def test_class_names_that_say_a_state_lose_no_article():
    article = "<article{}><h1>Head</h1><p>Text of it</p></article>"
    pages = [
        '<body class="no-sidebar">' + article.format("") + "</body>",
        "<body>" + article.format(' class="post comments-open"') + "</body>",
        '<body><div class="search-results-open">' + article.format("") + "</div></body>",
        '<html class="js has-banner"><body class="page login"><main class="share">' + article.format("") + "</main></body>",
        '<body><div class="widget">' + article.format("") + '</div><div class="widget">Buy</div></body>',
        '<body><div class="sidebar"><div class="widget">' + article.format("") + '</div></div><div id="comments"><article>No</article></div></body>',
        '<body><nav><article>Menu</article></nav><div class="promo">' + article.format("") + "</div></body>",
        '<body><div class="sidebar"><article>Other</article></div>' + article.format("") + '<article class="comment">Me too</article></body>',
    ]
    for page in pages:
        read = wrappers.blocks(page)
        assert wrappers.main_text(read, wrappers.reading(wrappers.stream(read))) == "Head\n\nText of it", page
