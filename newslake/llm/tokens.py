"""Byte-level BPE: texts to token ids and back.

A piece of text is encoded without replaying its merges.  An Aho-Corasick automaton
over the vocabulary (bytes as Latin-1 characters) gives the longest token at every
place; tokens are taken from left to right, and a token may follow another only if
BPE on their joint bytes gives just these two.  Where no token fits, the last one is
taken back and a shorter one is tried; places found dead are never entered again, so
the work is linear.  The result is the one that the merges would give.
"""

from __future__ import annotations

import base64
import functools
import re
import sys
from array import array
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from newslake.llm.common import map_batches, pick

#: A cache of a task holds at most twice so many entries.
CACHE_ENTRIES = 1 << 16
#: The one for words and pieces holds more, as they recur slowly.
WORD_ENTRIES = 1 << 18
#: Rows that go out together.
ROWS_OUT = 256
#: Texts are split into pieces in blocks of about so many characters.
BLOCK_CHARS = 1 << 20
#: Characters with Unicode's White_Space property (fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word with the white space before it.  No piece goes from a character that is not
#: white space to one that is, so the pieces of a text are those of its words.
WORD = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
BORDER = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")

NEVER = 1 << 62


class Recent(dict):
    """A dict of bounded size: when it is full, only entries used since then stay."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries = entries
        self.older: dict = {}

    def recall(self, key):
        """The value of a key that is not in the young half."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value


def read_ranks(ranks_file: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in ranks_file.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def bytes_by_id(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class Encoder:
    """Encoder of one rank file."""

    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = read_ranks(ranks_file)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.bytes_of = bytes_by_id(self.ranks)
        size = len(self.bytes_of)
        self.pieces_of = regex.compile(pattern).findall
        #: When BPE makes a token: its rank, or -1 for the single bytes it starts from.
        self.born = [-1] * size
        self.parts: list[tuple[int, int]] = [(0, 0)] * size
        #: The longest token that a token begins with, or -1.
        self.shorter = [-1] * size
        self.merges: dict[tuple[int, int], int] = {}
        self._fits: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self._build()
        self._length = [len(token) for token in self.bytes_of]
        self._words = Recent(WORD_ENTRIES)

    def _build(self) -> None:
        for token, rank in sorted(self.ranks.items(), key=lambda x: (len(x[0]) > 1, x[1])):
            if len(token) > 1 and not self._split(token, rank):
                continue  # the merges never give it; only a piece that equals it does
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        reachable = self.automaton
        for token, rank in self.ranks.items():
            for end in range(len(token) - 1, 0, -1):
                if token[:end].decode("latin-1") in reachable:
                    self.shorter[rank] = self.ranks[token[:end]]
                    break
        self.automaton.make_automaton()

    def _split(self, token: bytes, rank: int) -> bool:
        """Find the two tokens whose merge makes this one, all of lower rank."""
        for end in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:end]), self.ranks.get(token[end:])
            if left is None or right is None or not all(self._made_before(x, rank) for x in (left, right)):
                continue
            if self.fits(left, right):
                self.merges[left, right] = rank
                self.parts[rank] = (left, right)
                self.born[rank] = rank
                return True
        return False

    def _made_before(self, token: int, rank: int) -> bool:
        return len(self.bytes_of[token]) == 1 or -1 < self.born[token] < rank

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens as they are when one follows the other.

        Merges are undone from the latest to the earliest.  At every time two tokens
        touch at the border; if their own merge comes before the merges that took
        them up, BPE would have crossed the border.  Of equal ranks the left merge
        is done first.
        """
        left_until = right_until = NEVER
        born, parts = self.born, self.parts
        while True:
            merge = self.merges.get((left, right))
            if merge is not None and merge < left_until and merge <= right_until:
                return False
            if born[left] > born[right]:
                left_until, left = born[left], parts[left][1]
            elif born[right] >= 0:
                right_until, right = born[right], parts[right][0]
            else:
                return True

    def _fits_memo(self, key: int) -> bool:
        if len(self._fits) >= 8 * CACHE_ENTRIES:
            self._fits.clear()
        known = self._fits[key] = self.fits(*divmod(key, len(self.bytes_of)))
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, fits, vocabulary = piece.decode("latin-1"), self._fits, len(self.bytes_of)
        # Most often the longest tokens, one behind the other, fit as they are.
        out = [token for _, (token, _) in self.automaton.iter_long(text)]
        before = out[0]
        for token in out[1:]:
            key = before * vocabulary + token
            fit = fits.get(key)
            if not (fit if fit is not None else self._fits_memo(key)):
                break
            before = token
        else:
            return out
        size = len(piece)
        longest = [-1] * size
        for end, (token, length) in self.automaton.iter(text):
            longest[end - length + 1] = token  # later matches are longer
        dead: set[int] = set()
        length_of, shorter = self._length, self.shorter
        token = longest[0]
        out = [token]  # the first token may follow nothing, so it always fits
        at = length_of[token]
        token = longest[at] if at < size else -1
        while at < size:
            if out:
                before = out[-1] * vocabulary
                while token >= 0:
                    end = at + length_of[token]
                    if end not in dead:
                        fit = fits.get(before + token)
                        if fit if fit is not None else self._fits_memo(before + token):
                            break
                    token = shorter[token]
            else:
                while token >= 0 and at + length_of[token] in dead:
                    token = shorter[token]
                end = at + length_of[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                dead.add(at)
                token = out.pop()
                at -= length_of[token]
        return out

    def _word(self, word: str) -> bytes:
        """The packed ids of a word with the white space before it, or of a single piece."""
        packed = self._words.recall(word)
        if packed is not None:
            return packed
        pieces = self.pieces_of(word)
        if len(pieces) == 1:
            packed = array("I", self.encode_piece(word.encode())).tobytes()
        else:
            known, piece_ids = self._words.get, self._piece
            packed = b"".join([known(p) or piece_ids(p) for p in pieces])
        if len(word) <= 64:
            self._words.keep(word, packed)
        return packed

    def _piece(self, piece: str) -> bytes:
        """The packed ids of a piece, which is also a word of its own."""
        packed = self._words.recall(piece)
        if packed is None:
            packed = array("I", self.encode_piece(piece.encode())).tobytes()
            if len(piece) <= 64:
                self._words.keep(piece, packed)
        return packed

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        known, word_ids, out = self._words.get, self._word, []
        for block in blocks(text):
            out.append(b"".join([known(w) or word_ids(w) for w in WORD.findall(block)]))
        packed = b"".join(out)
        return packed if sys.byteorder == "little" else np.frombuffer(packed, "=u4").astype("<u4").tobytes()


def blocks(text: str, size: int = BLOCK_CHARS) -> list[str]:
    """Cut a text at places where a word ends, after about ``size`` characters each."""
    cuts = [0]
    while len(text) - cuts[-1] > size:
        border = BORDER.search(text, cuts[-1] + size)
        if border is None:
            break
        cuts.append(border.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


@functools.lru_cache(maxsize=2)
def encoder(ranks_file: bytes, pattern: str) -> Encoder:
    """One per Python worker and vocabulary."""
    return Encoder(ranks_file, pattern)


@functools.lru_cache(maxsize=2)
def decoder(ranks_file: bytes) -> list[bytes]:
    return bytes_by_id(read_ranks(ranks_file))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, ROWS_OUT) for at in range(0, batch.num_rows, ROWS_OUT))


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text: ``id_col, n_tokens long, ids binary``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers, the form
    in which token files are written.  ``ranks_path`` is a rank file on the driver;
    it travels with the tasks (a vocabulary is a few MB at most).  ``pattern`` must
    never let a piece go from a character that is no white space to one that is, nor cut
    a piece that stands alone.
    There are no special tokens: their strings are ordinary text.

    A null text counts as empty and gives no tokens; a null id stays null; repeated
    rows are encoded one by one; an empty table gives an empty one; other columns
    are left out, whatever their names.
    """
    ranks = Path(ranks_path).read_bytes()
    rows = pick(df, id=id_col, text=text_col)
    kind = dict(rows.dtypes)["id"]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(ranks, pattern).encode
        for part in slices(batch):
            ids = [to_ids(t) if t else b"" for t in part.column("text").to_pylist()]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), counts, pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"]
            )

    return map_batches(rows, work, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded binary``, the bytes of the packed ids; null ids give empty bytes.

    A column named ``decoded`` is replaced.  The bytes of whole encodings are the
    UTF-8 of the text; any slice of ids may be decoded.
    """
    ranks = Path(ranks_path).read_bytes()
    rows = df.drop("decoded")
    schema = StructType([*rows.schema.fields, StructField("decoded", BinaryType())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bytes_of = decoder(ranks).__getitem__
        for part in slices(batch):
            packed = (np.frombuffer(x or b"", "<u4") for x in part.column(ids_col).to_pylist())
            decoded = [b"".join(map(bytes_of, ids.tolist())) for ids in packed]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], schema.names)

    return map_batches(rows, work, schema)
