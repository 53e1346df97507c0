"""Functions for SQL users."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from newslake.functions.html import main_text_of, text_of
from newslake.functions.similarity import ratio


class ChunkText:
    """Table function: the overlapping pieces of a text with their places."""

    def eval(self, text: str, max_chars: int, overlap: int) -> Iterator[tuple[int, str]]:
        if not text:
            return
        if max_chars <= 0:
            yield 0, text
            return
        overlap = max(overlap, 0)
        if overlap >= max_chars:
            raise ValueError("overlap must be smaller than max_chars")
        step = max_chars - overlap
        for place, start in enumerate(range(0, max(len(text) - overlap, 1), step)):
            yield place, text[start : start + max_chars]


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL.

    ``clean_html(html)``, ``extract_main_content(html)``, ``title_similarity(new,
    known)`` and the table function ``chunk_text(text, max_chars, overlap)``.
    """

    @F.udf(StringType(), useArrow=False)
    def clean_html(html: str | None) -> str:
        return text_of(html)

    @F.udf(StringType(), useArrow=False)
    def extract_main_content(html: str | None) -> str:
        return main_text_of(html)

    @F.pandas_udf(DoubleType())
    def title_similarity(new: pd.Series, known: pd.Series) -> pd.Series:
        keys = (s.fillna("").str.strip().str.lower() for s in (new, known))
        return pd.Series([ratio(a, b) for a, b in zip(*keys)], dtype="float64")

    spark.udf.register("clean_html", clean_html)
    spark.udf.register("extract_main_content", extract_main_content)
    spark.udf.register("title_similarity", title_similarity)
    spark.udtf.register("chunk_text", F.udtf(ChunkText, returnType="pos int, chunk string"))
