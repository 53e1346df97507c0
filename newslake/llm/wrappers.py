"""Main text of web pages by wrappers inferred per host.

A page is a stream of blocks, each with the path of its structural elements.  Streams
of one host are aligned one after the other to a union-free regular expression: where a
path occurs again and again it becomes a repeated item, as does a sequence of items that
follows itself; what only some pages have becomes optional; text that differs becomes a
slot, text that all pages share stays template.  The wrapper then says which slots hold
the article, and every page is read by its host's wrapper.

Pages are folded into wrappers in map tasks first.  Wrappers are streams themselves, so
those of one host are aligned further in ``SALTS`` groups and then in one, and a host
with a third of all pages is no more than a few wrappers for any task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import map_batches, pick, written

SALTS = 64
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[/!?a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\">])*>|[^<]+|<", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(.*?)/?>\Z", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z:-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([a-zA-Z:-]+)""")

#: Elements by what they are (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template textarea title iframe svg math canvas object select button".split())
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
ASIDE = set("nav header footer aside form menu dialog".split())
MAIN = set("article main".split())
#: Words of a class, id or role that mark what is no part of an article (fixed values).
ASIDE_WORDS = set(
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification overlay "
    "pager pagination paywall popup promo promoted recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split()
)
MAIN_WORDS = {"articlebody", "main"}
#: Reader comments are no part of an article, whatever elements they are made of (fixed values).
COMMENT_WORDS = set("comment comments disqus replies reply respond".split())
#: How class names begin or end that say what state a page is in, not what an element is (fixed values).
STATE_BEGINS = set("has hide is js no non not show with without".split())
STATE_ENDS = set("active allowed closed disabled enabled hidden none off on open visible".split())
#: Elements that hold an article whatever their classes say (fixed values).
NEVER_ASIDE = {"html", "body", "main", "article"}
CLOSED_BY_ITSELF = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
_SIGN_ASIDE, _SIGN_MAIN = "-", "*"


def _attributes(source: str) -> dict[str, str]:
    out = {}
    for name, value, alone in _ATTRIBUTE.findall(source):
        out[(name or alone).lower()] = unescape(value.strip("\"'"))
    return out


def _names(given: dict[str, str]) -> list[list[str]]:
    """The words of each class name, id, role and property."""
    values = (given.get(a, "").lower().split() for a in ("class", "id", "role", "itemprop"))
    return [words for names in values for name in names if (words := [w for w in re.split(r"[^a-z]+", name) if w])]


def _element(name: str, source: str) -> tuple[str, bool]:
    """The element as a step of a path: a sign, its name and the words of its class.

    The second value says whether only its names make it an aside, and not for reader
    comments; such an element may turn out to hold the page's articles.
    """
    given = _attributes(source) if source.strip() else {}
    names = _names(given)
    words = {w for of in names for w in of}
    meant = {w for of in names if of[0] not in STATE_BEGINS and (len(of) == 1 or of[-1] not in STATE_ENDS) for w in of}
    hidden = "hidden" in given or "display:none" in given.get("style", "").replace(" ", "").lower()
    sign, doubtful = "", False
    if name in ASIDE or hidden:
        sign = _SIGN_ASIDE
    elif meant & ASIDE_WORDS and (name not in NEVER_ASIDE or name == "article" and meant & (COMMENT_WORDS | {"teaser", "promo"})):
        sign, doubtful = _SIGN_ASIDE, not meant & COMMENT_WORDS
    elif name in MAIN or meant & MAIN_WORDS:
        sign = _SIGN_MAIN
    return sign + ".".join([name, *sorted(words - MAIN_WORDS)]), doubtful


def blocks(html: str | None) -> list[tuple[str, str]]:
    """The blocks of a page in order: path and text with single spaces.

    An element that only its class calls an aside is none if it holds all articles of
    the page that lie outside of other asides.
    """
    out: list[tuple[list[int], str]] = []
    steps: list[str] = []
    open_elements: list[tuple[str, int]] = []
    doubtful: dict[int, int] = {}
    articles = 0
    text: list[str] = []
    silent = ""

    def flush() -> None:
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            out.append(([s for name, s in open_elements if name not in INLINE or steps[s][0] == _SIGN_ASIDE], joined))

    def close(place: int) -> None:
        if any(n not in INLINE or steps[s][0] == _SIGN_ASIDE for n, s in open_elements[place:]):
            flush()
        del open_elements[place:]

    for token in _TOKEN.findall(html or ""):
        if token[0] != "<" or len(token) == 1:
            if not silent:
                text.append(unescape(token))
            continue
        tag = _TAG.match(token)
        if tag is None:
            continue
        ends, name = bool(tag[1]), tag[2].lower()
        if silent:
            silent = "" if ends and name == silent else silent
        elif name == "br":
            text.append(" ")
        elif ends:
            places = [i for i, (n, _) in enumerate(open_elements) if n == name]
            if places:
                close(places[-1])
        elif name in VOID:
            if name == "hr":
                flush()
        elif name in SILENT:
            silent = "" if token.endswith("/>") else name
        else:
            step, unsure = _element(name, tag[3])
            if name not in INLINE or step[0] == _SIGN_ASIDE:
                flush()
            if name not in INLINE:
                names = [n for n, _ in open_elements]
                if name in CLOSED_BY_ITSELF and name in names:
                    place = len(names) - 1 - names[::-1].index(name)
                    if not {"table", "ul", "ol", "dl"} & set(names[place:]):
                        close(place)
                elif "p" in names:
                    close(len(names) - 1 - names[::-1].index("p"))
            within = [s for _, s in open_elements if steps[s][0] == _SIGN_ASIDE]
            if name in MAIN and step[0] == _SIGN_MAIN and all(s in doubtful for s in within):
                articles += 1
                for s in within:
                    doubtful[s] += 1
            if unsure:
                doubtful[len(steps)] = 0
            open_elements.append((name, len(steps)))
            steps.append(step)
    flush()
    for s, held in doubtful.items():
        if articles and held == articles:
            steps[s] = steps[s][1:]
    return [("/".join(steps[s] for s in path), joined) for path, joined in out]


# A wrapper is a list of items: {"p": path, "?": optional, "+": repeated, "t": digest of
# the template text or None for a slot, "n": characters}, or {"g": [items], "?", "+"}.


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _shape(item: dict) -> str:
    return item["p"] if "p" in item else "(" + " ".join(map(_shape, item["g"])) + ")"


def _same(a: dict, b: dict, optional: bool = False, repeated: bool = False) -> dict:
    """One item for two of the same shape."""
    out = {"?": a["?"] or b["?"] or optional, "+": a["+"] or b["+"] or repeated}
    if "g" in a:
        return out | {"g": [_same(x, y) for x, y in zip(a["g"], b["g"], strict=True)]}
    text = a["t"] if a["t"] == b["t"] and not repeated else None
    return out | {"p": a["p"], "t": text, "n": a["n"] + b["n"]}


def _folded(items: list[dict], longest: int = 6) -> list[dict]:
    """Items, and sequences of up to ``longest`` items, that follow themselves become one."""
    for size in range(1, longest + 1):
        out: list[dict] = []
        shapes: list[str] = []
        for item in items:
            out.append(item)
            shapes.append(_shape(item))
            if len(out) >= 2 * size and shapes[-size:] == shapes[-2 * size : -size]:
                both = [_same(a, b, repeated=size == 1) for a, b in zip(out[-2 * size : -size], out[-size:], strict=True)]
                whole = both if size == 1 else [{"g": both, "?": False, "+": True}]
                del out[-2 * size :], shapes[-2 * size :]
                if size > 1 and out and shapes[-1] == _shape(whole[0]):
                    whole = [_same(out.pop(), whole[0], repeated=True)]
                    shapes.pop()
                out += whole
                shapes += map(_shape, whole)
        items = out
    return items


def stream(page: list[tuple[str, str]]) -> list[dict]:
    """The wrapper of a single page."""
    return _folded([{"p": p, "?": False, "+": False, "t": _digest(t), "n": len(t)} for p, t in page])


def align(wrapper: list[dict], other: list[dict]) -> list[dict]:
    """The wrapper of both: what matches is one item, what does not is optional."""
    out: list[dict] = []
    matcher = SequenceMatcher(None, [_shape(i) for i in wrapper], [_shape(i) for i in other], autojunk=False)
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            out += [_same(x, y) for x, y in zip(wrapper[a:b], other[c:d], strict=True)]
        else:
            out += [{**item, "?": True} for item in [*wrapper[a:b], *other[c:d]]]
    return _folded(out)


def expression(wrapper: list[dict]) -> str:
    """The wrapper as a regular expression over paths; ``#`` is a slot."""
    parts = []
    for item in wrapper:
        body = f"({expression(item['g'])})" if "g" in item else item["p"] + ("" if item["t"] else "#")
        parts.append(body + {(0, 0): "", (0, 1): "+", (1, 0): "?", (1, 1): "*"}[item["?"], item["+"]])
    return " ".join(parts)


def _leaves(wrapper: list[dict]) -> Iterator[dict]:
    for item in wrapper:
        yield from _leaves(item["g"]) if "g" in item else [item]


def _aside(path: str) -> bool:
    return any(step[0] == _SIGN_ASIDE for step in path.split("/") if step)


def _main(path: str) -> bool:
    return any(step[0] == _SIGN_MAIN for step in path.split("/") if step)


def _container(path: str) -> str:
    return path.rpartition("/")[0]


def reading(wrapper: list[dict], differ: bool = True) -> dict:
    """How a host's pages are read, from the items of its wrapper.

    ``article`` are the paths of the items inside marked articles, ``container`` the
    element whose slots hold most text, ``template`` the texts that all pages share.
    Where no two pages ``differ``, nothing is known to be template and no container
    stands out.
    """
    volumes: dict[str, int] = {}
    template, article = set(), set()
    for item in _leaves(wrapper):
        if _aside(item["p"]):
            continue
        if _main(item["p"]):
            article.add(item["p"])
        if not differ:
            continue
        if item["t"] is None or item["?"]:
            volumes[_container(item["p"])] = volumes.get(_container(item["p"]), 0) + item["n"]
        else:
            template.add(f"{item['p']} {item['t']}")
    best = max(volumes, key=lambda c: (volumes[c], c)) if volumes else None
    return {"article": sorted(article), "container": best, "template": sorted(template)}


def main_text(page: list[tuple[str, str]], rules: dict) -> str:
    """The blocks of the article, joined by empty lines.

    Where the page has items of a marked article, all of them; else the slots of the
    container that holds most of what differs between the host's pages; a page without
    that container gives all that is neither aside nor template.
    """
    article, template = set(rules["article"]), set(rules["template"])
    if marked := [t for p, t in page if p in article]:
        return "\n\n".join(marked)
    own = [(p, t) for p, t in page if not _aside(p)]
    if rules["container"] is None:  # all pages alike: nothing can be told apart
        return "\n\n".join(t for _, t in own)
    slots = [(p, t) for p, t in own if f"{p} {_digest(t)}" not in template]
    inside = [t for p, t in slots if f"{p}/".startswith(f"{rules['container']}/")]
    return "\n\n".join(inside or [t for _, t in slots])


#: Stands for the texts of pages that are not all alike.
_SEVERAL = "*"


def _text_of(page: list[tuple[str, str]]) -> str | None:
    """A digest of what a page holds besides asides; None for a page without any."""
    own = [block for block in page if not _aside(block[0])]
    return _digest(json.dumps(own)) if own else None


def _all_of(texts: list[str | None]) -> str | None:
    """The one digest among those given, or that there are several."""
    known = {t for t in texts if t is not None}
    return _SEVERAL if len(known) > 1 else next(iter(known), None)


def _fold_pages(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    found: dict[str, list[dict]] = {}
    seen: dict[str, int] = {}
    texts: dict[str, str | None] = {}
    for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
        read = blocks(html)
        page = stream(read)
        if page:
            found[host] = align(found[host], page) if host in found else page
            seen[host] = seen.get(host, 0) + 1
            texts[host] = _all_of([texts.get(host), _text_of(read)])
    columns = [list(found), [seen[h] for h in found], [texts[h] for h in found], [json.dumps(w) for w in found.values()]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)],
        ["host", "pages", "texts", "wrapper"],
    )


def _fold_wrappers(group: pd.DataFrame) -> pd.DataFrame:
    wrappers = sorted(group["wrapper"])
    merged = json.loads(wrappers[0])
    for wrapper in wrappers[1:]:
        merged = align(merged, json.loads(wrapper))
    return pd.DataFrame(
        {
            "host": [group["host"].iloc[0]],
            "pages": [int(group["pages"].sum())],
            "texts": [_all_of(group["texts"].dropna().tolist())],
            "wrapper": [json.dumps(merged)],
        }
    )


_WRAPPERS = "host string, pages long, texts string, wrapper string"


def infer(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, pages, texts, wrapper``: one wrapper (JSON) per host, from all of its pages.

    ``texts`` is "*" where pages differ outside of asides.  Hosts are compared in lower case; pages without a url share the host "".
    """
    pages = _pages(pick(df, url=url_col, html=html_col))
    partial = map_batches(pages.select("host", "html"), _fold_pages, _WRAPPERS)
    salted = written(partial, "wrappers").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInPandas(_fold_wrappers, _WRAPPERS)
    return some.groupBy("host").applyInPandas(_fold_wrappers, _WRAPPERS)


def _pages(rows: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return rows.withColumn("host", host)


def _read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, dict] = {}
    texts = []
    columns = [batch.column(c).to_pylist() for c in ("html", "wrapper", "differ")]
    for html, wrapper, differ in zip(*columns, strict=True):
        if (wrapper, differ) not in known:
            known[wrapper, differ] = reading(json.loads(wrapper or "[]"), bool(differ))
        texts.append(main_text(blocks(html), known[wrapper, differ]))
    yield pa.RecordBatch.from_arrays(
        [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"]
    )


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text string, n_chars long`` for every page.

    A null or empty page, or one without an article, gives an empty text; null ids and
    urls stay null; repeated rows are read one by one and, like ties, do not change a
    wrapper's rules; an empty table gives an empty one.  Where a host has a single page,
    or copies of one, nothing shows what is template: without a marked article all
    that is not aside counts.  Other columns are left out,
    whatever their names.
    """
    wrappers = written(infer(df, url_col, html_col), "hosts")
    pages = _pages(pick(df, id=id_col, url=url_col, html=html_col))
    differ = F.col("texts").eqNullSafe(_SEVERAL).alias("differ")
    rules = wrappers.select("host", "wrapper", differ)
    joined = pages.join(rules, "host", "left").select("id", "url", "html", "wrapper", "differ")
    kinds = dict(joined.dtypes)
    texts = map_batches(joined, _read, f"id {kinds['id']}, url {kinds['url']}, text string")
    return texts.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars")
    )
