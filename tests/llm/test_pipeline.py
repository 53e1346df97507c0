import base64
import importlib
import re
import sys
from zlib import crc32

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
from newslake.llm.common import table
from tests.llm import cases
from tests.llm.test_minhash import shingles


def test_stages_against_brute_force(spark, sf):
    """Each stage on its own input."""
    docs, kept = table(spark, sf, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf).cache()
        kept[name] = docs.collect()
        after = {r.doc_id for r in kept[name]}
        if name != "tokens":
            assert docs.columns == columns
            assert {tuple(r) for r in kept[name]} <= {tuple(r) for r in before.values()}
        if name == "toxicity":
            known = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
            clean = [i in after for i in before if known.get(i) == 0]
            seen = [i in after for i in before if known.get(i) == 1 and crc32(str(i).encode()) % 3 != 1]
            assert np.mean(clean) > 0.95 and np.mean(seen) < 0.2  # test_classifiers has unseen ones
        elif name == "exact":
            groups = {}
            for i, r in before.items():
                body = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
                groups[body] = max(groups.get(body, -1), i)
            assert after == set(groups.values())
        elif name == "minhash":
            ids, sets = sorted(before), {i: shingles(before[i].text) for i in before}
            first = {}
            for i in ids:
                linked = [j for j in first if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
                first[i] = min([first[j] for j in linked], default=i)
            assert after == {i for i in ids if first[i] == i}
        elif name == "mixing":
            assert after == set(before)
        else:
            assert after == set(before)
            raw = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
            other = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            for r in kept[name]:
                assert np.frombuffer(r.ids, "<u4").tolist() == other.encode_ordinary(before[r.doc_id].text)


def test_run_gives_the_rows_of_the_last_stage(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    assert found.columns == ["doc_id", "n_tokens", "ids"]
    assert found.count() > 0


def test_edges(spark, sf):
    docs = cases.clashing(cases.edges(spark))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() > 0
        assert stage(spark, cases.empty(docs), sf).count() == 0
        if name != "tokens":
            assert out.columns == docs.columns
            docs = out


@pytest.mark.parametrize("missing", ["corpus_pipeline", "newslake.llm"])
def test_entry_without_the_package(monkeypatch, missing):
    """The other queries stay when the package or the pipeline is deleted."""
    for name in [n for n in sys.modules if n == missing or n.startswith(f"{missing}.")]:
        monkeypatch.delitem(sys.modules, name)

    class Absent:
        def find_spec(self, name, path=None, target=None):
            if name == missing or name.startswith(f"{missing}."):
                raise ModuleNotFoundError(f"No module named {name!r}", name=missing)

    monkeypatch.setattr(sys, "meta_path", [Absent(), *sys.meta_path])
    if missing == "newslake.llm":
        monkeypatch.delitem(sys.modules, "corpus_pipeline")
    left = importlib.reload(__spark_entry__)
    assert "total_count" in left.queries() and not any(n.startswith("op1_") for n in left.queries())
    monkeypatch.undo()
    assert "pipeline" in importlib.reload(__spark_entry__).queries()
