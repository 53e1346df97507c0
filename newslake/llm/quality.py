"""Text quality by supervised subword embeddings.

Every token (with its case and signs) is the mean of learned vectors of the hashed word
and its hashed character n-grams; tokens are averaged over the document and a softmax
gives the score.  A token that repeats the one before it counts as a token of its own
kind, so that texts which stutter are told from texts which do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm import subwords
from newslake.llm.common import pick

THRESHOLD = 0.7
EPOCHS = 6
#: Stands for a token that equals its predecessor; no token of a text has white space.
AGAIN = " again "


def tokens(text: str) -> list[str]:
    split = text.split()
    return [AGAIN if a == b else a for a, b in zip(split, [None, *split], strict=False)]


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


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
    found = subwords.sample(rows, labels, "quality", ~held_out(F.col("id")), per_class, sample_bytes)
    return subwords.fit([tokens(t) for _, _, t in found], [y for _, y, _ in found], None, EPOCHS)


def score(docs: DataFrame, model: subwords.Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out boolean, score double, predicted int`` for every row.

    Whole texts are scored; an empty one gets the score of the bias alone.  Null ids
    stay null and are not held out; repeated rows get equal scores; an empty table
    gives an empty one.  Other columns are left out, whatever their names.
    """
    scored = subwords.score(pick(docs, id=id_col, text=text_col), model, tokens)
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
