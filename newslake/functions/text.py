"""Text functions on columns.  All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.functions.stopwords import ENGLISH

# The characters Python's ``str.strip`` and ``\s`` treat as blank.
# The class is written so that Java and RE2 read it the same way.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# The same, one by one.
BLANKS = "".join(
    chr(c)
    for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Keyword rules of the category guess, in order of precedence.
CATEGORY_KEYWORDS = {
    "finance": ["stock", "market", "finance", "bank"],
    "tech": ["ai", "software", "technology", "startup"],
    "international": ["election", "president", "government", "war"],
}
# Words that mark a blocked or paid page.
PAYWALL_KEYWORDS = ["paywall", "subscribe", "account required", "sign in", "subscriber-only"]

ASCII_SPLIT = r"\W+"
UNICODE_SPLIT = r"[^\p{L}\p{Nd}_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove blanks of any kind at both ends (``trim`` removes spaces only).

    A set of characters, as a pattern would look for the end at every blank of the text.
    """
    return F.btrim(_col(c), F.lit(BLANKS))


def collapse(c: Column | str) -> Column:
    """Every run of blanks becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(_col(c), rf"[{BLANK}]+", " "))


def is_blank(c: Column | str) -> Column:
    """NULL, empty, or spaces only."""
    c = _col(c)
    return c.isNull() | (F.length(F.trim(c)) == 0)


def has_text(c: Column | str) -> Column:
    return ~is_blank(c)


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def preferred_text(full: Column | str, summary: Column | str, prefer_full: bool = True) -> Column:
    first, second = (full, summary) if prefer_full else (summary, full)
    return F.coalesce(empty_to_null(first), empty_to_null(second))


def combine_title_content(title: Column | str, content: Column | str, separator: str = ". ") -> Column:
    return strip(
        F.concat(F.coalesce(_col(title), F.lit("")), F.lit(separator), F.coalesce(_col(content), F.lit("")))
    )


def normalize_for_ml(c: Column | str) -> Column:
    """Lower case; anything but letters, digits and blanks becomes a space; runs collapse."""
    kept = F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{Nd}\s]", " ")
    return F.regexp_replace(kept, r"\s+", " ")


def clean_for_corpus(c: Column | str) -> Column:
    """Lower case, delete ASCII punctuation, digits to space, collapse; NULL gives ''."""
    lowered = F.translate(F.lower(F.coalesce(_col(c), F.lit(""))), PUNCTUATION, "")
    return collapse(F.regexp_replace(lowered, r"\p{Nd}+", " "))


def strip_urls_handles(c: Column | str) -> Column:
    """URLs and @handles become a space, then blanks collapse."""
    without_urls = F.regexp_replace(_col(c), rf"https?://[^{BLANK}]+", " ")
    return collapse(F.regexp_replace(without_urls, r"@[\p{L}\p{N}_]+", " "))


def tokenize(c: Column | str, min_length: int = 2, unicode: bool = False) -> Column:
    """Lower-cased words of at least ``min_length`` characters.

    ``unicode=False`` splits like Java's ``\\W+`` and therefore cuts words at
    accented letters; ``unicode=True`` keeps letters of every script.
    """
    words = F.split(F.lower(_col(c)), UNICODE_SPLIT if unicode else ASCII_SPLIT)
    return F.filter(words, lambda w: F.length(w) >= min_length)


def remove_stop_words(tokens: Column | str, words: list[str] | None = None) -> Column:
    listed = [w.lower() for w in (ENGLISH if words is None else words)]
    return F.filter(_col(tokens), lambda w: ~F.lower(w).isin(listed))


def corpus_tokens(c: Column | str, min_length: int = 3) -> Column:
    """Tokens for vocabulary work: no stop words, three letters or more.

    The words of :func:`clean_for_corpus`, in one pass less: punctuation is deleted,
    and whatever else is not a letter separates words.
    """
    lowered = F.translate(F.lower(F.coalesce(_col(c), F.lit(""))), PUNCTUATION, "")
    return remove_stop_words(F.filter(F.split(lowered, r"[^\p{L}]+"), lambda w: F.length(w) >= min_length))


def feature_tokens(c: Column | str, unicode: bool = False) -> Column:
    """Tokens for the feature job: two characters or more, no stop words.

    The words of :func:`normalize_for_ml` text, in one pass: there, a word ends at
    anything but a letter or digit, or, without ``unicode``, but an ASCII one.
    """
    # No capital is left; with A-Z in the class the split takes twenty times as long.
    separators = r"[^\p{L}\p{Nd}]+" if unicode else r"[^0-9a-z]+"
    return remove_stop_words(F.filter(F.split(F.lower(_col(c)), separators), lambda w: F.length(w) >= 2))


def word_count(c: Column | str) -> Column:
    """Number of blank-separated words; 0 for blank text."""
    stripped = strip(c)
    return F.when(F.length(stripped) == 0, F.lit(0)).otherwise(
        F.size(F.split(stripped, rf"[{BLANK}]+"))
    )


def space_count(c: Column | str) -> Column:
    """Pieces when splitting at every single space (repeated spaces give empty pieces)."""
    return F.size(F.split(_col(c), " ", -1))


def sentences(c: Column | str) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by a blank; empty pieces are dropped."""
    pieces = F.split(strip(c), rf"(?<=[.!?])[{BLANK}]+")
    return F.filter(pieces, lambda s: F.length(s) > 0)


def first_sentence(c: Column | str) -> Column:
    """The first sentence or line, whichever ends first, whole and without blanks at the ends."""
    line = F.substring_index(F.substring_index(F.ltrim(_col(c), F.lit(BLANKS)), "\n", 1), "\r", 1)
    # Reads as far as the sentence goes; ``split`` would go through the whole text.
    return F.regexp_extract(F.rtrim(line, F.lit(BLANKS)), rf"(?s)^(.*?[.!?](?=[{BLANK}])|.*)", 1)


def content_hash(title: Column | str, content: Column | str) -> Column:
    """md5 over the title and the first 200 characters of the content, stripped and lower-cased."""
    title = F.coalesce(_col(title), F.lit(""))
    content = F.coalesce(_col(content), F.lit(""))
    return F.md5(F.concat(F.lower(strip(title)), F.lower(strip(F.substring(content, 1, 200)))))


def detect_language(c: Column | str) -> Column:
    """'ar' if an Arabic letter is among the first 400 characters, 'unknown' if empty, else 'en'."""
    c = _col(c)
    return (
        F.when(c.isNull() | (c == ""), F.lit("unknown"))
        .when(F.substring(c, 1, 400).rlike(r"[\x{0600}-\x{06FF}]"), F.lit("ar"))
        .otherwise(F.lit("en"))
    )


def auto_categorize(c: Column | str, fallback: str = "uncategorized") -> Column:
    """First keyword rule that matches anywhere in the text, also inside words."""
    c = _col(c)
    guess = F.when(c.isNull() | (c == ""), F.lit(fallback))
    for category, words in CATEGORY_KEYWORDS.items():
        guess = guess.when(F.lower(c).rlike("|".join(words)), F.lit(category))
    return guess.otherwise(F.lit(fallback))


def analyze_sentiment(c: Column | str) -> Column:
    """Placeholder: always 'neutral'."""
    return F.lit("neutral")


def chunk_text(c: Column | str, max_chars: int = 1500, overlap: int = 100) -> Column:
    """Array of overlapping pieces; empty text gives none, ``max_chars <= 0`` the whole text."""
    c = _col(c)
    none = F.array().cast("array<string>")
    if max_chars <= 0:
        return F.when(c.isNull() | (c == ""), none).otherwise(F.array(c))
    overlap = max(overlap, 0)
    if overlap >= max_chars:
        raise ValueError("overlap must be smaller than max_chars")
    step = max_chars - overlap
    pieces = F.greatest(F.ceil((F.length(c) - overlap) / F.lit(step)).cast("int"), F.lit(1))
    starts = F.sequence(F.lit(0), pieces - 1)
    cut = F.transform(starts, lambda i: F.substring(c, i * step + 1, F.lit(max_chars)))
    return F.when(c.isNull() | (c == ""), none).otherwise(cut)


def snippet(c: Column | str, size: int = 60) -> Column:
    """The first ``size`` characters followed by '...'."""
    return F.concat(F.substring(_col(c), 1, size), F.lit("..."))


def snippet_if_longer(c: Column | str, size: int = 80) -> Column:
    """Like :func:`snippet`, but short text stays as it is."""
    c = _col(c)
    return F.when(F.length(c) > size, snippet(c, size)).otherwise(c)


def url_domain(c: Column | str) -> Column:
    """Network location of a URL (with port and user), or 'unknown-domain'."""
    netloc = F.regexp_extract(_col(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.coalesce(empty_to_null(netloc), F.lit("unknown-domain"))


def is_blocked_or_paywalled(status: Column | str, html: Column | str) -> Column:
    """HTTP 403, or a paywall word among the first 600 characters."""
    seen = F.lower(F.substring(_col(html), 1, 600)).rlike("|".join(PAYWALL_KEYWORDS))
    return F.coalesce((_col(status) == 403) | seen, F.lit(False))


def percentage(part: Column | str, total: Column | str, digits: int = 2) -> Column:
    """``part / total * 100`` rounded; 0 when the total is 0."""
    part, total = _col(part), _col(total)
    return F.round(F.when(total > 0, part / total * 100).otherwise(F.lit(0.0)), digits)


def truncate(c: Column | str, size: int) -> Column:
    return F.substring(_col(c), 1, size)
