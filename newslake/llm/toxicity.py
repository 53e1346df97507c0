"""Toxicity by bags of subword vectors.

Words are bags of hashed character n-grams, so a misspelling or a new word on a known
stem is near the words it resembles.  The words of a passage are averaged under a
linear softmax, all trained jointly; a document is as toxic as its worst passage.  Texts
are scored with passages that overlap by half, so no border parts what belongs together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm import subwords
from newslake.llm.common import by_place, pick, place_of

PASSAGE_WORDS = 32
THRESHOLD = 0.7
EPOCHS, ROUNDS, RATE = 2, 8, 1.0
_WORD = re.compile(r"[^\W_]+(?:['@$*_.!-][^\W_]+)*")


def words(text: str) -> list[str]:
    """Lower-case words; signs inside a word stay, as in ``st*pid``.

    A word that repeats the one before it counts once, so a stutter is no passage of
    its own.
    """
    found = _WORD.findall(text.lower())
    return [a for a, b in zip(found, [None, *found], strict=False) if a != b]


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = subwords.SAMPLE_DOCS,
    sample_bytes: int = subwords.SAMPLE_BYTES,
) -> subwords.Model:
    """Fit on at most ``per_class`` labelled texts of each class, ``sample_bytes`` in all.

    The labelled rows are drawn by the hash of their id from those that are not held
    out; only the text is an input.  Null labels and labels of unknown documents are
    ignored; null and empty texts teach nothing.
    """
    rows = pick(docs, id=id_col, text=text_col)
    found = subwords.sample(rows, labels, "toxic", ~held_out(F.col("id")), per_class, sample_bytes)
    return subwords.fit([words(t) for _, _, t in found], [y for _, y, _ in found], PASSAGE_WORDS, EPOCHS, ROUNDS, RATE)


def score(docs: DataFrame, model: subwords.Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out boolean, score double, predicted int`` for every row.

    Whole texts are scored; one without words gets the score of the bias alone.  Null
    ids stay null and are not held out; repeated rows get equal scores; an empty table
    gives an empty one.  Other columns are left out, whatever their names.
    """
    scored = subwords.score(pick(docs, id=id_col, text=text_col), model, words, PASSAGE_WORDS)
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, model: subwords.Model, text_col: str = "text") -> DataFrame:
    """The whole rows whose text is not predicted toxic, without a shuffle."""
    rows = by_place(docs)
    text = place_of(docs, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = subwords.Scorer(model, words, PASSAGE_WORDS)
        for batch in batches:
            for at in range(0, batch.num_rows, subwords.DOCS_AT_ONCE):
                part = batch.slice(at, subwords.DOCS_AT_ONCE)
                clean = [s < THRESHOLD for s in scorer.scores(part.column(text).to_pylist())]
                yield part.filter(pa.array(clean))

    return rows.mapInArrow(work, rows.schema).toDF(*docs.columns)
