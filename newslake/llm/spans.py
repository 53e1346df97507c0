"""Alignment of two tokenizers over the same bytes, with corpus counts of linked tokens.

The first tokenizer (A) is a byte-level one of the ``tokenizers`` library, the second (B)
a ``sentencepiece`` model with byte fallback.  A's character offsets and B's spans give
coarse cuts: the characters after which both have a token end.  Only where both split
characters into tokens, a segment is cut further, by the bytes that the tokens decode to.

No token of either goes from a character that is no white space to a space, so a text is the
sequence of its words, each with the space before it.  Words are cut further where no token
of either goes from a letter to the sign behind it, or to a line end.  Such units recur more
often than words with their signs.  Units that a task has not met yet are aligned together,
as one text; the others are looked up.

How many documents hold a linked pair is counted over the whole corpus.  Documents go into
blocks of bounded size; a block has each of its pairs once, so what is shuffled, counted
and looked up are the blocks' pairs, and a pair in every document is one row a block.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from newslake.llm.common import pick, written
from newslake.llm.tokens import SPACE

#: Characters of texts that a task works on together, and of unknown units aligned as one text.
SLICE_CHARS, JOINED_CHARS = 1 << 18, 1 << 17
#: Units of a task that are remembered, at most twice so many and those of one slice.
KNOWN_UNITS = 200_000
#: Longer units are not remembered.
KNOWN_CHARS = 64
#: Pairs of documents in a block (a document is never split).
BLOCK_PAIRS = 1 << 21
#: A space that follows no white space: no token of either tokenizer goes over the place before it.
BORDER = re.compile(f"(?<=[^{SPACE}]) ")
#: Letters behind which words may be cut, and the signs before which they may.
LETTER, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Comes before units aligned together and ends in a letter, as what stands before a sign does.
HEAD = " x"

_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The values of one ascending array without repeats that another such one has too."""
    at = np.searchsorted(b, a)
    return a[b[np.minimum(at, len(b) - 1)] == a] if len(b) else b


def unit_pattern(tokens: Iterable[bytes]) -> re.Pattern[str]:
    """Finds the units of a text that begins with a space, one behind the other.

    A unit ends before a space, and where no token goes over the place: before a line end,
    and between a letter and a sign.  White space before that is part of it.
    """
    texts = [token.decode("utf-8", "replace") for token in tokens]
    after_letter = set("".join(itertools.chain.from_iterable(re.findall(f"(?<=[{LETTER}])[^{LETTER}]", t) for t in texts)))
    signs = "".join(re.escape(c) for c in SIGNS if c not in after_letter)
    ends = " " if any(re.search(f"[^{SPACE}]\n", t) for t in texts) else " \n"
    inside = re.sub(f"[{ends}]", "", "".join(re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001))))))
    rest = f"[^{SPACE}{LETTER}]*[{LETTER}]*"
    return re.compile(f"[{SPACE}]*{rest}(?:(?:[^{SPACE}{LETTER}{signs}]|[{inside}][{SPACE}]*){rest})*")


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from U+0100.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and the units aligned of late."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        stands_for = byte_of_character()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in stands_for for c in token)
            self.bytes_a[i] = bytes(stands_for[c] for c in token) if known else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.pairs = len(self.bytes_a) * len(self.bytes_b)
        self.key = np.dtype("<u4") if self.pairs <= 1 << 32 else np.dtype("<u8")
        self._length_a, self._length_b = (np.array([len(x) for x in v], "i8") for v in (self.bytes_a, self.bytes_b))
        # Ids as text, with what may follow them: A "," and "|", then B "." (a comma later) and ";".
        numbers_a, numbers_b = (list(map(str, range(len(v)))) for v in (self.bytes_a, self.bytes_b))
        self._said = [n + end for v, ends in ((numbers_a, ",|"), (numbers_b, ".;")) for end in ends for n in v]
        self._said_length = np.array(list(map(len, self._said)), "i8")
        self._units = unit_pattern([*self.bytes_a, *self.bytes_b]).findall
        # The text of a unit's groups, and the keys of its links; None if its bytes don't fit.
        self._said_of, self._keys_of = {}, {}
        self._older: tuple[dict, dict] = ({}, {})

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and B, the group of every token, and the byte offsets where groups end.

        ``text`` begins with a space; None where the tokens' bytes are not its bytes.
        """
        raw = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        # Given bytes, the spans are in bytes too.
        found = self.b.encode(raw[1:], return_type="offset_mapping")
        list_a, list_b = encoding.ids, found["ids"]
        if b"".join(map(self.bytes_a.__getitem__, list_a)) != raw or b"".join(map(self.bytes_b.__getitem__, list_b)) != raw:
            return None
        ids_a, ids_b = np.array(list_a, "i8"), np.array(list_b, "i8")
        # Characters' offsets of A as bytes; tokens inside a character share its span.
        spans = np.fromiter(itertools.chain.from_iterable(encoding.offsets), "i8", 2 * len(list_a)).reshape(-1, 2)
        if len(raw) != len(text):
            first = np.flatnonzero((np.frombuffer(raw, "u1") & 0xC0) != 0x80)
            spans = np.append(first, len(raw))[spans]
        end_a = spans[:, 1]
        whole_a = np.append(spans[1:, 0] >= end_a[:-1], True)
        # B's spans leave the added space out; the bytes of a character but the last have no width.
        end_b = np.fromiter([end for _, end in found["offsets"]], "i8", len(list_b)) + 1
        whole_b = np.diff(end_b, prepend=0) > 0
        ending = np.flatnonzero(whole_b)
        end_b = end_b[ending[np.searchsorted(ending, np.arange(len(end_b)))]]

        cuts = _common(end_a[whole_a], end_b[whole_b])
        at_a, at_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        both = np.intersect1d(at_a[~whole_a], at_b[~whole_b])  # few
        if len(both):
            end_a, end_b = np.cumsum(self._length_a[ids_a]), np.cumsum(self._length_b[ids_b])
            finer = np.intersect1d(end_a[np.isin(at_a, both)], end_b[np.isin(at_b, both)])
            cuts = np.union1d(cuts, finer)
            at_a, at_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        return ids_a, ids_b, at_a, at_b, cuts

    def _parts(self, text: str, sizes: list[int]) -> list[tuple[str, bytes]] | None:
        """The text of the groups, and the keys of the links, of each part of a text.

        None if its bytes or cuts don't fit.  In these texts full stops part ids of B.
        """
        found = self.groups(text)
        if found is None:
            return None
        ids_a, ids_b, at_a, at_b, cuts = found
        ends = np.cumsum(sizes)
        upto = np.searchsorted(cuts, ends)  # the last group of every part
        if (cuts[np.minimum(upto, len(cuts) - 1)] != ends).any():
            return None
        n_a, n_b = np.bincount(at_a, minlength=len(cuts)), np.bincount(at_b, minlength=len(cuts))
        tokens_upto, links_upto = np.cumsum(n_a + n_b)[upto], np.cumsum(n_a * n_b)[upto] * self.key.itemsize

        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        last_a, last_b = np.append(at_a[1:] != at_a[:-1], True), np.append(at_b[1:] != at_b[:-1], True)
        codes = np.concatenate([ids_a + size_a * last_a, ids_b + 2 * size_a + size_b * last_b])
        order = np.argsort(np.concatenate([2 * at_a, 2 * at_b + 1]), kind="stable")
        codes = codes[order]
        said = "".join(map(self._said.__getitem__, codes.tolist()))
        said_upto = np.cumsum(self._said_length[codes])[tokens_upto - 1].tolist()

        times = n_b[at_a]  # links of every token of A
        begun = np.cumsum(times) - times
        first_b = (np.cumsum(n_b) - n_b)[at_a]
        partner = np.arange(times.sum()) + np.repeat(first_b - begun, times)
        keys = (np.repeat(ids_a, times) * size_b + ids_b[partner]).astype(self.key).tobytes()

        links_upto = links_upto.tolist()
        borders = zip([0, *said_upto], said_upto, [0, *links_upto], links_upto, strict=False)
        return [(said[a : b - 1], keys[c:d]) for a, b, c, d in borders]

    def _learn(self, units: list[str], head: bool) -> None:
        """Align units as one text; with ``head`` each follows a letter, else only the first does."""
        step = 2 if head else 1
        joined = [HEAD, *units] if not head else [part for unit in units for part in (HEAD, unit)]
        parts = self._parts("".join(joined), [len(part.encode()) for part in joined])
        if parts is not None:
            said, keys = zip(*parts[1::step], strict=True)
            self._said_of.update(zip(units, said, strict=True))
            self._keys_of.update(zip(units, keys, strict=True))
        elif len(units) > 1:
            half = len(units) // 2
            self._learn(units[:half], head)
            self._learn(units[half:], head)
        else:
            self._said_of[units[0]] = self._keys_of[units[0]] = None

    def _look_up(self, units: set[str]) -> list[str]:
        """Have all units known; those that are not to be remembered."""
        missing = units.difference(self._said_of)
        said, keys = self._older
        unknown = missing.difference(said)
        for unit in missing - unknown:
            self._said_of[unit], self._keys_of[unit] = said[unit], keys[unit]
        # White space ends a text; no unit of another one must come behind it.
        batches = {True: [], False: []}
        sizes = {True: 0, False: 0}
        for unit in unknown:
            if unit[-1].isspace():
                self._learn([unit], False)
                continue
            head = unit[0] not in " \n"
            batches[head].append(unit)
            sizes[head] += len(unit)
            if sizes[head] >= JOINED_CHARS:
                self._learn(batches[head], head)
                batches[head], sizes[head] = [], 0
        for head, batch in batches.items():
            if batch:
                self._learn(batch, head)
        return [unit for unit in unknown if len(unit) > KNOWN_CHARS or self._said_of[unit] is None]

    def align(self, texts: list[str | None]) -> list[tuple[str, np.ndarray, list[int]]]:
        """Per text: its groups, the keys of all links, and the four figures."""
        # The last one found is empty.
        split = [self._units(" " + t)[:-1] if t else [] for t in texts]
        passing = self._look_up(set().union(*split))
        unfit = {unit for unit in passing if self._said_of[unit] is None}
        out = []
        for units in split:
            if not units or (unfit and not unfit.isdisjoint(units)):
                out.append(("", np.empty(0, self.key), [0, 0, 0, 0]))
                continue
            said = ";".join(map(self._said_of.__getitem__, units))
            links = np.frombuffer(b"".join(map(self._keys_of.__getitem__, units)), self.key)
            n = said.count(";") + 1
            out.append((said.replace(".", ","), links, [n + said.count(","), n + said.count("."), n, len(links)]))
        for unit in passing:
            del self._said_of[unit], self._keys_of[unit]
        if len(self._said_of) >= KNOWN_UNITS:
            self._older = self._said_of, self._keys_of
            self._said_of, self._keys_of = {}, {}
        return out


@functools.lru_cache(maxsize=1)
def aligner(a_json: str, b_model: bytes) -> Aligner:
    """One per Python worker and pair of tokenizers."""
    made = Aligner(a_json, b_model)
    for token in [*made.bytes_a, *made.bytes_b]:
        if BORDER.search(token.decode("utf-8", "replace")):
            raise ValueError(f"a token joins a word to a space behind it: {token!r}")
    return made


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with about ``SLICE_CHARS`` characters together, 1,024 at most."""
    sizes, start, size = pc.utf8_length(batch.column("text")).to_pylist(), 0, 0
    for i, chars in enumerate(sizes):
        size += chars or 0
        if size >= SLICE_CHARS or i - start == 1023:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def align(
    df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False
) -> DataFrame:
    """Align the tokens of every whole text:
    ``id_col, n_a, n_b, n_groups, n_links long, groups string, pairs binary, times binary``.

    A encodes a space and the text, B the text, to which it adds the space itself; special
    tokens in texts are plain text.  Byte offsets where both have a token end cut the tokens
    into groups.  ``groups`` says them as ``a1,a2|b1;a3|b2,b3``, ids of A before those of B;
    that is several times the text, and ``hashed`` gives its SHA-256 (hex) in its place.
    Tokens of a group are linked; ``pairs`` holds the distinct linked pairs in order, as
    little-endian unsigned integers ``a * |B| + b`` (32 bits where that is enough, else
    64), ``times`` how often each occurs (32 bits).

    Texts that are null or empty, or whose tokens of A or B don't decode to a space and the
    text, have no tokens: figures of 0, empty texts and bytes.  Null ids stay null; repeated
    rows are aligned one by one; an empty table gives an empty one; other columns are left
    out, whatever their names.  Texts of any length are worked on unit by unit; one text
    is held in memory as a whole.  The tokenizers' files are read on the driver and
    travel with the tasks (a few MB).  Neither may have tokens that join a word to a
    space behind it, which is checked.
    """
    a_json, b_model = Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes()
    rows = pick(df, id=id_col, text=text_col)
    numbers = [StructField(n, LongType()) for n in _FIGURES]
    texts = [StructField("groups", StringType()), StructField("pairs", BinaryType()), StructField("times", BinaryType())]
    schema = StructType([rows.schema["id"], *numbers, *texts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(a_json, b_model)
        for part in (part for batch in batches for part in _slices(batch)):
            found = made.align(part.column("text").to_pylist())
            unique = [np.unique(keys, return_counts=True) for _, keys, _ in found]
            columns = [part.column("id")]
            columns += [pa.array([figures[i] for _, _, figures in found], pa.int64()) for i in range(4)]
            said = [groups for groups, _, _ in found]
            if hashed:
                said = [hashlib.sha256(groups.encode()).hexdigest() if groups else "" for groups in said]
            columns.append(pa.array(said, pa.string()))
            columns.append(pa.array([keys.tobytes() for keys, _ in unique], pa.binary()))
            columns.append(pa.array([times.astype("<u4").tobytes() for _, times in unique], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def vocabulary_sizes(a_path: str, b_path: str) -> tuple[int, int]:
    made = aligner(Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes())
    return len(made.bytes_a), len(made.bytes_b)


def _summary(types: list[pa.DataType], block: int, held: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    keys, docs = np.unique(np.concatenate(held), return_counts=True)
    own = [pa.array([block], pa.int64()), pa.array([keys.astype("i8")]), pa.array([docs.astype("i4")])]
    return pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types), *own], names)


def _blocks(df: DataFrame, key: np.dtype) -> DataFrame:
    """Rows dealt to blocks, and one row per block with its pairs (``keys``) and how many rows have each."""
    added = "block long, keys array<long>, docs array<int>"
    schema = StructType([*df.schema.fields, *StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [np.frombuffer(x or b"", key) for x in part.column("pairs").to_pylist()]
                yield _dealt(part, pa.array([block] * len(found), pa.int64()))
                held += found
                size += sum(map(len, found))
                if size >= BLOCK_PAIRS:
                    yield _summary(batch.schema.types, block, held, schema.names)
                    block, held, size = block + 1, [], 0
        if size:
            yield _summary(batch.schema.types, block, held, schema.names)

    def _dealt(part: pa.RecordBatch, blocks: pa.Array) -> pa.RecordBatch:
        none = [pa.nulls(part.num_rows, pa.list_(t)) for t in (pa.int64(), pa.int32())]
        return pa.RecordBatch.from_arrays([*part.columns, blocks, *none], schema.names)

    return df.mapInArrow(run, schema)


def with_counts(aligned: DataFrame, sizes: tuple[int, int]) -> DataFrame:
    """Replace ``pairs`` and ``times`` by ``n_best, count_sum long``.

    The count of a pair is the number of rows of ``aligned`` that hold it.  ``n_best`` are
    a row's links whose count is the highest of their token of A, ties included;
    ``count_sum`` is the sum of counts over a row's links.  Rows without links have 0; a
    repeated row counts as often as it is there.
    """
    size_b = sizes[1]
    key = np.dtype("<u4") if sizes[0] * sizes[1] <= 1 << 32 else np.dtype("<u8")
    dealt = written(_blocks(aligned, key), "spans-blocks")
    own = dealt.filter("keys IS NOT NULL")
    summed = own.select(F.inline(F.arrays_zip("keys", "docs"))).groupBy("keys").agg(F.sum("docs").alias("count"))
    counts = written(summed.withColumn("a", F.floor(F.col("keys") / size_b)), "spans-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    best = counts.join(most, "a").select("keys", "count", (F.col("count") == F.col("most")).alias("best"))
    asked = own.select(F.col("block").alias("asking"), F.explode("keys").alias("keys"))
    looked = asked.join(best, "keys").select("asking", "keys", "count", "best")

    docs = dealt.filter("keys IS NULL").drop("keys", "docs")
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    schema = StructType([*(aligned.schema[c] for c in kept), StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def look_up(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(keys := pairs.column("keys").to_numpy())
        keys, count, is_best = keys[order], pairs.column("count").to_numpy()[order], pairs.column("best").to_numpy()[order]
        n_best, count_sum = [], []
        for packed, times in zip(rows.column("pairs").to_pylist(), rows.column("times").to_pylist(), strict=True):
            at = np.searchsorted(keys, np.frombuffer(packed, key).astype("i8"))
            n = np.frombuffer(times, "<u4").astype("i8")
            n_best.append(int(n[is_best[at]].sum()))
            count_sum.append(int((n * count[at]).sum()))
        out = [rows.column(c) for c in kept]
        return pa.table([*out, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], names=schema.names)

    return docs.groupBy("block").cogroup(looked.groupBy("asking")).applyInArrow(look_up, schema)
