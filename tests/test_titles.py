"""Titles are whole first sentences or lines."""

from newslake.catalog import QUERIES
from newslake.functions import text


def test_first_sentence(spark):
    rows = [(" One two. Three",), ("no end",), ("head line\r\nbody. more",), ("v1.2 is out! Yes",), ("",), (None,), ("\n a?\nb",)]
    frame = spark.createDataFrame(rows, "x string").select(text.first_sentence("x").alias("t"))
    assert [r.t for r in frame.collect()] == ["One two.", "no end", "head line", "v1.2 is out!", "", None, "a?"]
    long = "word " * 10_000 + "end. next"
    assert spark.createDataFrame([(long,)], "x string").select(text.first_sentence("x")).first()[0] == long.removesuffix(" next")


def test_sentences_with_one_opening_are_different_titles(spark, tmp_path):
    opening = "according to people who know about the matter and were there "
    assert len(opening) > 60
    texts = [opening + "ships left the harbour before dawn on tuesday. a", opening + "cattle prices fell in every village up north. b"]
    texts += [texts[0][:-1] + "c"]
    documents = [(n, t, "en", "s", len(t)) for n, t in enumerate(texts)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r.id: r.drop_reason for r in QUERIES["dedup_articles"](spark, str(tmp_path)).collect()}
    assert found == {0: None, 1: None, 2: "similar_title"}
    assert QUERIES["run_counters"](spark, str(tmp_path)).first().kept == 2
    near = {r.id: r.similarity for r in QUERIES["title_similarity_neighbours"](spark, str(tmp_path)).collect()}
    assert near[1] < 0.85
