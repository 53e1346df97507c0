import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from newslake.llm import tokens
from tests.llm import cases

PATTERN = public_tokenizers.PATTERN


def coder(name):
    raw = open(public_tokenizers.path(name), "rb").read()
    ranks = tokens.read_ranks(raw)
    return tokens.encoder(raw, PATTERN), tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_same_as_merges(name):
    own, other = coder(name)
    dice = random.Random(5)
    parts = ["a", "aa", " ", "  ", "\n", "\t", "'s", "'S", "the", "é", "中文", "12", "!!", "…", "　", "\x1c", "\x85", "abab"]
    texts = ["".join(dice.choice(parts) for _ in range(dice.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chr(dice.choice([dice.randint(1, 0xD7FF), dice.randint(0xE000, 0x10FFFF)])) for _ in range(20)) for _ in range(500)]
    texts += ["a" * 3000, " " * 3000, "ab" * 2000, "中" * 1500, "<|endoftext|>"]
    for text in texts:
        assert ids(own.encode(text)) == other.encode_ordinary(text), repr(text)


def test_blocks_cut_between_words():
    text = "alpha beta,  gamma\n\ndelta " * 50
    for size in (1, 7, 100):
        assert "".join(tokens.blocks(text, size)) == text
    own, other = coder("byte_bpe_50k.tiktoken")
    cut = b"".join(own.encode(b) for b in tokens.blocks(text, 5))
    assert ids(cut) == other.encode_ordinary(text)


def test_small_vocabulary_with_unreachable_token():
    pairs = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 257, b"abcd": 258, b"bc": 255 + 10, b"xyz": 300}
    raw = b"\n".join(tokens.base64.b64encode(t) + b" " + str(r).encode() for t, r in pairs.items())
    own = tokens.Encoder(raw, PATTERN)
    other = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})
    for text in ("abcd", "abcdabcd", "xyz", "xyzx", "aabcdd", "bcbc", "abcabcd"):
        assert ids(own.encode(text)) == other.encode_ordinary(text), text


def test_edges(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for df in (cases.edges(spark), cases.clashing(cases.edges(spark))):
        found = tokens.decode(tokens.encode(df, path, PATTERN), path)
        assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"]
        got = sorted((repr(r.doc_id), bytes(r.decoded).decode(), r.n_tokens * 4 == len(r.ids)) for r in found.collect())
        assert got == sorted((repr(i), t or "", True) for i, t, _ in cases.EDGES)
    assert tokens.encode(cases.empty(cases.edges(spark)), path, PATTERN).count() == 0


def test_missing_byte():
    with pytest.raises(ValueError, match="lacks single bytes"):
        tokens.Encoder(b"YQ== 0", PATTERN)
