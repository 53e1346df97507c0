import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from newslake.llm import queries, spans
from tests.llm import cases

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = spans.byte_of_character()
    bytes_a = {i: bytes(chars.get(c, 0) for c in t) if i < 50256 else t.encode() for t, i in a.get_vocab().items()}
    pieces = map(b.id_to_piece, range(b.get_piece_size()))
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return a, b, bytes_a, bytes_b


def brute(text, tools):
    """Groups as lists of ids, by the bytes of the whole text alone."""
    a, b, bytes_a, bytes_b = tools
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if any(b"".join(of[i] for i in ids) != (" " + text).encode() for ids, of in ((ids_a, bytes_a), (ids_b, bytes_b))):
        return []
    ends_a = np.cumsum([len(bytes_a[i]) for i in ids_a]).tolist()
    ends_b = np.cumsum([len(bytes_b[i]) for i in ids_b]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        groups.append((ids_a[i:x], ids_b[j:y]))
        i, j = x, y
    return groups


def expected(rows, tools):
    """(id, figures, digest) by brute force over all rows."""
    made = [(i, brute(t, tools)) for i, t in rows]
    links = [[(x, y) for a, b in groups for x in a for y in b] for _, groups in made]
    count = Counter(pair for of in links for pair in set(of))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (i, groups), of in zip(made, links, strict=True):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(of),
            hashlib.sha256(said.encode()).hexdigest() if groups else "",
            sum(count[p] == most[p[0]] for p in of), sum(count[p] for p in of),
        ))
    return sorted(out, key=repr)


def found(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n\n b\t", "é中😀 ok  two\n\nx ༀሴ", "ༀༀሴ", "x▁y", "x▁", "▁",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "0 a　b  ", "ﬁ ½ Å", "\x00 \x1c a", "😀😀 🏳️‍🌈 ȡ𐍈𐍈", "don't it's WE'LL",
    "word " * 3000 + "end", "x" * 3000, " " * 500, "한국어 텍스트 ไทย العربية", "ȩ́",
]


def test_groups_equal_brute_force(tools):
    made = spans.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    for texts in (TEXTS, TEXTS[::-1], *([t] for t in TEXTS)):
        for text, (said, keys, figures) in zip(texts, made.align(texts), strict=True):
            groups = brute(text, tools)
            assert said == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups), text
            links = [x * len(made.bytes_b) + y for a, b in groups for x in a for y in b]
            assert sorted(keys.tolist()) == sorted(links)
            assert figures == [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links)]
    whole = " é中😀 ok  ༀሴ"
    ids_a, ids_b, at_a, at_b, cuts = made.groups(whole)
    assert cuts[-1] == len(whole.encode()) and len(cuts) == len(brute(whole[1:], tools))


def test_query_equals_brute_force(spark, sf, tools):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.QUERIES["op12_spans"](spark, sf)) == expected([tuple(r) for r in docs], tools)


def test_edges_blocks_and_repeats(spark, tools, monkeypatch):
    monkeypatch.setattr(spans, "BLOCK_PAIRS", 50)
    rows = [(r[0], r[1]) for r in cases.EDGES] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(7, "One two three.")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for kind in (df, cases.clashing(df)):
        monkeypatch.setattr(queries, "table", lambda *_, kind=kind: kind)
        assert found(queries.QUERIES["op12_spans"](spark, "")) == expected(rows, tools)
    monkeypatch.setattr(queries, "table", lambda *_: cases.empty(df))
    assert found(queries.QUERIES["op12_spans"](spark, "")) == []


def test_known_words_are_not_aligned_again_with_other_signs():
    made = spans.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    made.align(["erntly tionoire élève x, x. x! x\nIt x.\nIt x($) x"])
    aligned, groups = [], made.groups
    made.groups = lambda text: aligned.append(text) or groups(text)
    made.align(["erntly, tionoire! élève\nIt tionoire.\nIt erntly($) élève"])
    assert aligned == []


CUT = [
    "don't 'tis a'b rock'n'roll WE'LL,it's", "a.b,c  d.\nE\n\nf.\n\n\ng \nh\n i\r\nj.\t k\xa0l. m", "a.\u0301 e\u0301. <\u0338 a<\u0338",
    "x<s>y a<|endoftext|>b.c </s>. a|b", "v1.2 3,4a é9. ß! ÿ? ×÷a×b a×.", "end.\n", "end. ", "\n\nx.", ".x", ",", "a,", "日本.語a。b.c", "a...b!?c--d$$$",
    "https://a.example/b?c=d&e#f user_name@x", "x\u2028y\x85z\x1cw.\x00v", "A" * 70 + "." + "b" * 70,
]


def test_units_equal_brute_force(tools):
    made = spans.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = [*CUT, *CUT[::-1], " ".join(CUT), "\n".join(CUT), ".".join(TEXTS[1:])]
    for text, (said, keys, figures) in zip(texts, made.align(texts), strict=True):
        groups = brute(text, tools)
        assert said == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups), text
        assert figures == [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(keys)]


def test_units_end_only_where_no_token_goes_on():
    def units(text, *tokens):
        return spans.unit_pattern(tokens).findall(text)[:-1]

    text = " a.b, c\nd.\n  e"
    assert units(text) == [" a", ".b", ",", " c", "\nd", ".", "\n  e"]
    assert units(text, b"a.") == [" a.b", ",", " c", "\nd.", "\n  e"]
    assert units(text, b".\n") == [" a", ".b", ",", " c\nd", ".\n  e"]
    assert units(text, b"\n.", b",\n", b".a", b" a") == [" a", ".b", ",", " c\nd", ".\n  e"]


def test_few_units_remembered(tools, monkeypatch):
    monkeypatch.setattr(spans, "KNOWN_UNITS", 3)
    made = spans.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    for text in [*CUT, *TEXTS, *CUT]:
        ((said, _, _),) = made.align([text])
        assert said == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute(text, tools)), text
