"""HTML to text.

Two forms of tag stripping are offered.  ``strip_html`` is a chain of built-in
expressions and covers what well-formed feed fragments contain.  ``clean_html``
reads the markup with the standard library's HTML parser and is right for any
input.  Main-text extraction needs element nesting, which no built-in expression
sees, so it is a Python function as well.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newslake.functions.text import collapse

# Elements without content, elements never shown, and the places
# an article body is looked for, in order of preference: (tag, id, class).
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont bgsound command frame "
    "image isindex nextid spacer".split()
)
HIDDEN_TAGS = frozenset(["script", "style"])
BOILERPLATE_TAGS = frozenset(["script", "style", "noscript", "header", "footer", "nav", "aside"])
CONTENT_PLACES = [
    ("article", None, None),
    ("div", None, "article-body"),
    ("div", None, "article__content"),
    ("div", "article-body", None),
    ("div", None, "post-content"),
    ("div", None, "entry-content"),
    ("section", None, "article-body"),
    ("div", "content", None),
    ("main", None, None),
]
# Entities that the expression form decodes; '&amp;' comes last.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&copy;": "©",
    "&middot;": "·",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&amp;": "&",
}

_BLANKS = re.compile(r"\s+")
HIDDEN_PATTERN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TAG_PATTERN = r"(?s)<[/!?a-zA-Z][^>]*>"


def strip_html(c: Column | str) -> Column:
    """Text of an HTML fragment by expressions only."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(F.regexp_replace(c, HIDDEN_PATTERN, " "), TAG_PATTERN, " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse(text)


class _PageReader(HTMLParser):
    """Collects text by place while the markup streams by."""

    def __init__(self, hidden: frozenset[str], places: list[tuple]):
        super().__init__(convert_charrefs=True)
        self.hidden = hidden
        self.places = places
        self.stack: list[tuple[str, bool, list[int]]] = []
        self.hidden_depth = 0
        self.text: list[str] = []
        self.found: dict[int, list[str]] = {}
        self.open_places: list[int] = []

    def _places_of(self, tag: str, attrs: list[tuple[str, str | None]]) -> list[int]:
        values = {k: v or "" for k, v in attrs}
        classes = values.get("class", "").split()
        return [
            n
            for n, (want_tag, want_id, want_class) in enumerate(self.places)
            if n not in self.found
            and tag == want_tag
            and (want_id is None or values.get("id") == want_id)
            and (want_class is None or want_class in classes)
        ]

    def handle_starttag(self, tag, attrs):
        hides = tag in self.hidden
        starts = [] if hides or self.hidden_depth else self._places_of(tag, attrs)
        for n in starts:
            self.found[n] = []
        if tag in VOID_TAGS:
            return
        self.open_places.extend(starts)
        self.hidden_depth += hides
        self.stack.append((tag, hides, starts))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(name == tag for name, _, _ in self.stack):
            return
        while self.stack:
            name, hides, starts = self.stack.pop()
            self.hidden_depth -= hides
            for n in starts:
                self.open_places.remove(n)
            if name == tag:
                return

    def handle_data(self, data):
        if self.hidden_depth:
            return
        self.text.append(data)
        for n in self.open_places:
            self.found[n].append(data)


def _read(html: str, hidden: frozenset[str], places: list[tuple]) -> _PageReader:
    reader = _PageReader(hidden, places)
    reader.feed(html)
    reader.close()
    return reader


def _tidy(pieces: list[str]) -> str:
    return _BLANKS.sub(" ", " ".join(pieces)).strip()


def text_of(html: str | None) -> str:
    """Visible text of one fragment."""
    if not html:
        return ""
    if "<" not in html and "&" not in html:
        return _tidy([html])
    return _tidy(_read(html, HIDDEN_TAGS, []).text)


def main_text_of(html: str | None) -> str:
    """Main text of one page: the first non-empty content place, else the body, else all."""
    if not html:
        return ""
    body = len(CONTENT_PLACES)
    reader = _read(html, BOILERPLATE_TAGS, [*CONTENT_PLACES, ("body", None, None)])
    for n in range(body):
        text = _tidy(reader.found.get(n, []))
        if text:
            return text
    return _tidy(reader.found[body]) if body in reader.found else text_of(html)


# Pages and texts are long: rows travel by the hundred, not in Arrow batches of ten thousand.
@F.udf(StringType(), useArrow=False)
def clean_html(html: str | None) -> str:
    """Visible text of HTML, blanks collapsed; NULL gives ''."""
    return text_of(html)


@F.udf(StringType(), useArrow=False)
def extract_main_content(html: str | None) -> str:
    """Main text of a fetched page; NULL gives ''."""
    return main_text_of(html)
