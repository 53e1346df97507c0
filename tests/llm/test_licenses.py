import re

import pytest

from newslake.llm import licenses
from tests.llm import cases

TEXTS = [
    (10, "Released under the MIT License. mit-license; MITLicense and the GNU General  Public\nLicense!"),
    (11, "apache license Apache License, Version 2.0. mit licensee smit license"),
    (12, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode"),
    (13, "spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR mit */ x"),
    (14, "İ SPDX-License-Identifier: MIT AND"),
    (15, "general public license public license mit license license general public license"),
    (16, "Licensed under CC BY-NC 4.0."),
]


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))
    )


@pytest.mark.parametrize(
    ("text", "source", "labels", "freedom"),
    [
        ("MIT", "MIT", ["mit"], 1.0),
        ("mit or gpl-2.0 and apache-2.0", "mit or gpl-2.0 and apache-2.0", ["apache-2.0", "gpl-2.0", "mit"], 1.0),
        ("(mit or gpl-2.0) and apache-2.0 */", "(mit or gpl-2.0) and apache-2.0", ["apache-2.0", "gpl-2.0", "mit"], 0.9),
        ("GPL-2.0 WITH x AND MIT", "GPL-2.0 WITH x AND MIT", ["gpl-2.0 with x", "mit"], 0.6),
        ("MIT AND", "MIT", ["mit"], 1.0),
        ("MIT) x", "MIT", ["mit"], 1.0),
        ("((MIT) or unheard-of-1)", "((MIT) or unheard-of-1)", ["mit", "unheard-of-1"], 1.0),
        ("LGPL-2.1+ or agpl-3.0", "LGPL-2.1+ or agpl-3.0", ["agpl-3.0", "lgpl-2.1+"], 0.5),
    ],
)
def test_expressions(text, source, labels, freedom):
    assert licenses.parse(text) == (source, labels, pytest.approx(freedom))


def test_hostile_expressions_take_linear_work():
    assert licenses.parse("(a or b) with c")[:2] == ("(a or b)", ["a", "b"])
    assert licenses.parse("a with (b or c)")[:2] == ("a", ["a"])
    assert licenses.parse("a with b with c")[:2] == ("a with b", ["a with b"])
    assert licenses.parse(" with ".join(f"(a{i} or b{i})" for i in range(1000)))[1] == ["a0", "b0"]
    assert len(licenses.parse(" or ".join(f"a{i} and (b{i})" for i in range(20_000)))[1]) == 40_000
    assert licenses.parse("(" * 100_000 + "a" + ")" * 100_000)[1] == ["a"]
    tags = "SPDX-License-Identifier: mit " * 20_000
    assert len(licenses.scan(tags)[2]) == 20_000


@pytest.mark.parametrize("text", ["", "AND MIT", "()", "(MIT", ")", "with"])
def test_no_expression(text):
    assert licenses.parse(text) is None


def test_against_brute_force(spark, sf):
    table = [*TEXTS, *[(i, t) for i, t, _ in cases.EDGES]]
    table += [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    found = licenses.summary(licenses.scan_licenses(cases.clashing(df))).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in table), key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found)
    labels = {r.doc_id: (r.labels, round(r.score, 6)) for r in found}
    assert labels[12] == ("apache-2.0,bsd-3-clause,mit", 1.0)
    assert labels[13] == ("gpl-2.0-only with classpath-exception-2.0,mit", 1.0)
    assert labels[14] == ("mit", 1.0)
    assert labels[16] == ("cc-by,cc-by-nc", 0.2)
    assert licenses.scan_licenses(cases.empty(df)).count() == 0
