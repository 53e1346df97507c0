import random
import re
from zlib import crc32

import numpy as np
import pytest

from newslake.llm import quality, subwords, toxicity
from newslake.llm.common import table
from tests.llm import cases

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize(("module", "label", "parts", "rest"), [(toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)])
def test_held_out_accuracy(spark, module, label, parts, rest):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = {r.doc_id: r for r in module.score(docs, module.train(docs, labels)).collect()}
    assert len(scored) == docs.count()
    known = {r.doc_id: r[label] for r in labels.collect()}
    outside = [i for i in known if crc32(str(i).encode()) % parts == rest]
    assert all(scored[i].held_out == (crc32(str(i).encode()) % parts == rest) for i in scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())
    assert np.mean([scored[i].predicted == known[i] for i in outside]) >= 0.95


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edges(spark, module):
    docs = cases.edges(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, 0), (1, None, None), (99, 0, 1), (None, 1, 1), (6, 1, 0)], none.schema)
    for labels in (none, odd, cases.clashing(odd)):
        model = module.train(docs, labels)
        scored = module.score(cases.clashing(docs), model)
        assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
        assert sorted(repr(r.doc_id) for r in scored.collect()) == sorted(repr(i) for i, *_ in cases.EDGES)
        assert all(0 <= r.score <= 1 for r in scored.collect())
        assert module.score(cases.empty(docs), model).count() == 0
    kept = toxicity.keep(cases.clashing(docs), toxicity.train(docs, none))
    assert kept.count() == len(cases.EDGES) and kept.columns == cases.clashing(docs).columns


def test_the_bound_of_the_sample(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(40)], "id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    found = subwords.sample(docs, labels, "toxic", subwords.F.lit(True), per_class=10, size=1200)
    assert sorted(y for _, y, _ in found) == [0] * 6 + [1] * 6
    assert len(subwords.sample(docs, labels, "toxic", subwords.F.lit(True), per_class=10, size=1 << 20)) == 20


def test_the_sample_has_one_row_per_id(spark):
    texts = ["", None, "one text", "another text"]
    docs = spark.createDataFrame([(i, texts[k % 4] if i else "") for i in range(6) for k in range(40)], "id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    found = subwords.sample(docs, labels, "toxic", subwords.F.lit(True), per_class=2, size=1 << 20)
    assert len(found) == len({i for i, _, _ in found}) == 4
    assert found == subwords.sample(docs.repartition(3), labels, "toxic", subwords.F.lit(True), per_class=2, size=1 << 20)


def test_unseen_spellings_are_near():
    dice = random.Random(2)
    common = [f"{a}{b}{c}" for a in "bdfg" for b in ("an", "el", "ir") for c in ("ta", "mo", "sek")]
    texts, labels = [], []
    for n in range(300):
        words = [dice.choice(common) for _ in range(60)]
        if n % 2:
            words[dice.randrange(60)] = "scumbag" + dice.choice(["", "s", "gy", "ged"])
        texts.append(words)
        labels.append(n % 2)
    model = subwords.fit(texts, labels, 32, 2, 6, 1.0)
    plain, bad = model.words(["banta"])[0], model.words(["scumbagger", "scumbbag", "scuumbag"])
    assert (bad > plain).all()


def test_features_match_a_plain_loop():
    words = ["a", "naïve", "st*pid", "中文字", "x" * 30]
    ids, starts = subwords.features(words)
    ends = [*starts[1:], len(ids)]
    for w, a, b in zip(words, starts, ends, strict=True):
        framed = f"<{w}>"
        assert b - a == 1 + sum(max(0, len(framed) - n + 1) for n in subwords.GRAMS)
        alone, _ = subwords.features([w])
        assert sorted(alone) == sorted(ids[a:b])
    assert (ids >= 0).all() and (ids < subwords.BUCKETS).all()


def test_passages():
    assert subwords.passages_of(0, 32).tolist() == [0]
    assert subwords.passages_of(47, 32).tolist() == [0]
    assert subwords.passages_of(48, 32).tolist() == [0, 32]
    assert subwords.passages_of(1000, None).tolist() == [0]


def test_words():
    assert toxicity.words("You IDIOT, idiot! st*pid 中文") == re.findall(r"\S+", "you idiot st*pid 中文")
    assert quality.tokens("A A b") == ["A", quality.AGAIN, "b"]


def test_a_passage_over_a_border_counts():
    model = subwords.Model(np.zeros(subwords.BUCKETS, np.float32), 0.0)
    scorer = subwords.Scorer(model, str.split, 32)
    scorer.known = {"plain": 0.0, "bad": 4.0}
    text = ["plain"] * 24 + ["bad"] * 16 + ["plain"] * 24
    inside = ["bad"] * 16 + ["plain"] * 48
    over, within, none = scorer.scores([" ".join(text), " ".join(inside), " ".join(["plain"] * 64)])
    assert over == within == 1 / (1 + np.exp(-2.0)) and none == 0.5
