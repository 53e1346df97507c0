"""Registered queries against brute force over the whole smallest tables."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken

from newslake.llm.queries import QUERIES


def documents(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_op1(spark, sf):
    lines = map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = documents(spark, sf)
    found = QUERIES["op1_byte_bpe"](spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = coder.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op2(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    names = spark.read.parquet(f"{sf}/embeddings.parquet").columns
    column = next(c for c in names if isinstance(rows[0][c], list))
    ids, matrix = [r.vec_id for r in rows], np.array([r[column] for r in rows], float)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    near = np.argwhere(np.triu(matrix @ matrix.T >= 0.9, 1))
    links = [(ids[a], ids[b]) for a, b in near]
    root = components(ids, links)
    found = {r.vec_id: r for r in QUERIES["op2_embedding_dedup"](spark, sf).collect()}
    assert set(found) == set(ids)
    assert all(r.component_id == root[i] and r.kept == (root[i] == i) for i, r in found.items())
    assert sum(r.n_links for r in found.values()) == 2 * len(links)


def test_op7(spark, sf):
    shingles, holders = {}, defaultdict(list)
    for i, text in documents(spark, sf).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
        for s in shingles[i]:
            holders[s].append(i)
    pairs = {(a, b) for of in holders.values() for a in of for b in of if a < b}
    links = [
        (a, b) for a, b in pairs if 100 * len(shingles[a] & shingles[b]) >= 75 * len(shingles[a] | shingles[b])
    ]
    root = components(shingles, links)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op7_minhash"](spark, sf).collect()}
    assert found == {i: (len(s), root[i], root[i] == i) for i, s in shingles.items()}


def test_op3_and_op6(spark, sf):
    ids = set(documents(spark, sf))
    for name, parts, out in (("op3_quality", 4, 2), ("op6_toxicity", 3, 1)):
        found = {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}
        assert set(found) == ids
        for i, r in found.items():
            assert r.held_out == (zlib.crc32(str(i).encode()) % parts == out)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op5_and_op8(spark, sf):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = {r.page_id: r for r in QUERIES["op5_main_text"](spark, sf).collect()}
    assert {i: r.url for i, r in found.items()} == pages
    assert all(r.n_chars == len(r.text) and r.text == r.text.strip() for r in found.values())
    texts = documents(spark, sf)
    base = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for r in QUERIES["op8_licenses"](spark, sf).collect():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [
            (i, label) for p, label in base.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
        ]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
