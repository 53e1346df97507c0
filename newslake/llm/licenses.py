"""Licence notices: phrases and identifier tags by Aho-Corasick, expressions by shunting-yard."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import pick

#: Phrases and their labels (fixed values).  The base ones are the first three.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "released into the public domain": "public-domain",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "permission is hereby granted free of charge": "mit",
    "gnu gpl": "gpl",
    "gnu lgpl": "lgpl",
    "gnu agpl": "agpl",
    "zlib license": "zlib",
    "this is free and unencumbered software": "unlicense",
    "sil open font license": "ofl",
    "common development and distribution license": "cddl",
    "artistic license": "artistic",
    "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:",)
#: How freely a text may be used under a licence, from 0 to 1, by how its label begins.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 1.0, "isc": 1.0, "bsd": 1.0, "bsl": 1.0, "zlib": 1.0,
    "apache": 0.9, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.6, "cc-by": 0.9, "mpl": 0.6, "epl": 0.6,
    "ofl": 0.8, "artistic": 0.7, "cddl": 0.6, "lgpl": 0.5, "agpl": 0.2, "gpl": 0.3, "reserved": 0.05,
}
UNKNOWN = 0.1
#: What an exception (``GPL-2.0 WITH Classpath-exception-2.0``) adds.
EXCEPTION = 0.3
#: The letters of a word are 0-9, a-z and everything that is not ASCII.
_WORDS = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}
_FOUND = "array<struct<label:string,base:boolean,first:long,words:int>>"
_STATED = "array<struct<expression:string,labels:array<string>,freedom:double>>"


@functools.lru_cache(maxsize=1)
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in (PHRASES | BASE_PHRASES).items():
        phrases.add_word(f" {phrase} ", (label, phrase in BASE_PHRASES, len(phrase.split())))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def freedom(label: str) -> float:
    fitting = [k for k in FREEDOM if label == k or label.startswith((f"{k}-", f"{k}+"))]
    return FREEDOM[max(fitting, key=len)] if fitting else UNKNOWN


def parse(text: str) -> tuple[str, list[str], float] | None:
    """The longest licence expression a text begins with, on one line.

    Its source, its labels (lower-case identifiers, ``x with y`` for exceptions) and
    its freedom: the freest of alternatives, the least free of what holds together.
    ``with`` binds closest, then ``and``, then ``or``; it takes one identifier and one
    exception, so a group, or an exception, beside it ends the expression.  The work
    is linear in the text.
    """
    labels: list[str] = []
    values: list[float] = []
    waiting: list[str] = []
    groups = 0
    best, at, operand, plain = None, 0, True, False

    def apply(values: list[float], name: str) -> None:
        right, left = values.pop(), values.pop()
        values.append(max(left, right) if name == "or" else min(left, right))

    while token := _TOKEN.match(text, at):
        word = token[1].lower()
        if operand:
            if word == "(" and waiting[-1:] != ["with"]:
                waiting.append(word)
                groups += 1
            elif word in "()" or word in _BINDS:
                break
            else:
                label = word.rstrip(".")
                if waiting[-1:] == ["with"]:
                    waiting.pop()
                    labels[-1] += f" with {label}"
                    values[-1] = min(1.0, values[-1] + EXCEPTION)
                    plain = False
                else:
                    labels.append(label)
                    values.append(freedom(label))
                    plain = True
                operand = False
        elif word == ")":
            if not groups:
                break
            while (name := waiting.pop()) != "(":
                apply(values, name)
            groups -= 1
            plain = False
        elif word in _BINDS:
            if word == "with" and not plain:
                break
            while word != "with" and waiting and _BINDS.get(waiting[-1], 0) >= _BINDS[word]:
                apply(values, waiting.pop())
            waiting.append(word)
            operand = True
        else:
            break
        at = token.end()
        if not operand and not groups:  # then at most an "or" and an "and" wait
            left = list(values)
            for name in reversed(waiting):
                apply(left, name)
            best = at, len(labels), left[0], labels[-1]
    if best is None:
        return None
    end, n, value, last = best
    return text[:end].strip(), sorted({*labels[: n - 1], last}), value


def scan(text: str | None) -> tuple[int, list[dict], list[dict]]:
    """Number of words, phrases found (with the word they begin at), expressions stated."""
    text = text or ""
    words = text.encode().translate(_WORDS).split()
    phrases, tags = _automata()
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found, word, counted = [], 0, 0
    for end, (label, base, size) in phrases.iter(joined):
        word += joined.count(" ", counted, end)  # words that begin before the match's end
        counted = end
        found.append({"label": label, "base": base, "first": word - size, "words": size})
    stated = []
    for end, _ in tags.iter(text.encode().lower().decode()):  # only A-Z change, so places stay
        line_end = text.find("\n", end + 1)
        if parsed := parse(text[end + 1 : line_end if line_end >= 0 else len(text)]):
            stated.append(dict(zip(("expression", "labels", "freedom"), parsed, strict=True)))
    return len(words), found, stated


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [
        pa.int64(),
        pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("words", pa.int32())])),
        pa.list_(pa.struct([("expression", pa.string()), ("labels", pa.list_(pa.string())), ("freedom", pa.float64())])),
    ]
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            columns = zip(*map(scan, part.column("text").to_pylist()), strict=True)
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), *arrays], ["id", "n_words", "found", "stated"])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, found, stated`` for every row.

    ``found`` lists the notice phrases (label, whether it is a base phrase, the word it
    begins at, its number of words), ``stated`` the expressions behind identifier tags
    with their labels and their freedom.

    A null text counts as empty and has neither; null ids stay null; repeated rows are
    scanned one by one; an empty table gives an empty one.  Other columns are left out,
    whatever their names.
    """
    rows = pick(df, id=id_col, text=text_col)
    kind = dict(rows.dtypes)["id"]
    scanned = rows.mapInArrow(_scan, f"id {kind}, n_words long, found {_FOUND}, stated {_STATED}")
    return scanned.withColumnRenamed("id", id_col)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of figures per scanned row.

    ``score`` is the freedom of the least free notice or expression; 0 says that there is none.
    """
    base = F.filter("found", lambda x: x["base"])
    found = F.transform("found", lambda x: x["label"])
    stated = F.flatten(F.transform("stated", lambda x: x["labels"]))
    levels = F.create_map(*[F.lit(v) for label in sorted({*PHRASES.values(), *BASE_PHRASES.values()}) for v in (label, freedom(label))])
    values = F.concat(F.transform(found, lambda x: levels[x]), F.transform("stated", lambda x: x["freedom"]))
    return scanned.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["first"])).alias("last_word"),
        _joined(F.transform(base, lambda x: x["label"])).alias("base_labels"),
        _joined(F.concat(found, stated)).alias("labels"),
        F.coalesce(F.array_min(values), F.lit(0.0)).alias("score"),
    )
