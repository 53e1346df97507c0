"""Pieces of SQL that several twins share."""

from newslake.functions.stopwords import ENGLISH
from newslake.functions.text import BLANK, PUNCTUATION


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP_WORDS = "(" + ", ".join(quoted(w) for w in ENGLISH) + ")"
JAVA_BLANK = r"[\t\n\x0B\f\r ]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{BLANK}]+|[{BLANK}]+$', '', 'g')"


def first_sentence(x: str) -> str:
    """The first sentence or line; the end mark stays, the blanks behind it and the rest go."""
    return rf"regexp_replace({strip(x)}, '(?s)(?:([.!?])[{BLANK}]+|[{BLANK}]*[\r\n][{BLANK}]*).*$', '\1')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{BLANK}]+', ' ', 'g'))"


def normalize(x: str) -> str:
    kept = rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{Nd}}\t\n\x0B\f\r ]', ' ', 'g')"
    return f"regexp_replace({kept}, '{JAVA_BLANK}+', ' ', 'g')"


def corpus_clean(x: str) -> str:
    no_punctuation = f"translate(lower(coalesce({x}, '')), {quoted(PUNCTUATION)}, '')"
    return collapse(rf"regexp_replace({no_punctuation}, '\p{{Nd}}+', ' ', 'g')")


def ascii_tokens(x: str, n: int = 2) -> str:
    return f"[w FOR w IN string_split_regex(lower({x}), '[^0-9A-Za-z_]+') IF length(w) >= {n}]"


def unicode_tokens(x: str, n: int = 2) -> str:
    return rf"[w FOR w IN string_split_regex(lower({x}), '[^\p{{L}}\p{{Nd}}_]+') IF length(w) >= {n}]"


def no_stop(tokens: str) -> str:
    return f"[w FOR w IN {tokens} IF w NOT IN {STOP_WORDS}]"


def feature_tokens(x: str) -> str:
    return no_stop(ascii_tokens(normalize(x)))


def corpus_tokens(x: str) -> str:
    return no_stop(unicode_tokens(corpus_clean(x), 3))


def title_key(x: str) -> str:
    return f"lower({strip(f'coalesce({x}, {quoted(str())})')})"


def content_hash(title: str, content: str) -> str:
    return f"md5(concat(lower({strip(title)}), lower({strip(f'substr({content}, 1, 200)')})))"


def html_text(x: str) -> str:
    """Text of HTML by patterns; enough for the given pages."""
    hidden = f"regexp_replace({x}, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g')"
    tags = f"regexp_replace({hidden}, '(?s)<[/!?a-zA-Z][^>]*>', ' ', 'g')"
    named = f"replace(replace(replace({tags}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    named = f"replace(replace({named}, '&lt;', '<'), '&gt;', '>')"
    return collapse(f"regexp_replace({named}, '&amp;?', '&', 'g')")


def main_text(x: str) -> str:
    """Text of the article element of a page."""
    body = rf"regexp_extract({x}, '(?is)<article\b[^>]*>(.*?)</article>', 1)"
    return html_text(body)
