"""Tables for the edge cases that every operator has to stand."""

from pyspark.sql import functions as F

LONG = "word " * 60_000 + "end"
EDGES = [
    (1, None, None),
    (2, "", "a"),
    (3, " \n\t ", "a"),
    (4, "One two three.", "b"),
    (4, "One two three.", "b"),
    (5, "one TWO three.", None),
    (None, "One two three.", "b"),
    (None, None, None),
    (6, LONG, "a"),
    (7, "ÉTÉ été naïve 中文 \U0001f600 Ünï", "b"),
]


def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string, source string").repartition(3)


def clashing(df):
    """Extra columns named like inner or result columns, and twins in other case."""
    names = ["id", "ID", "DOC_ID", "Text", "kept", "key", "digest", "body", "n", "root", "score", "place", "pass", "c0"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def empty(df):
    return df.filter(F.lit(False))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
