import os

from pyspark.sql import functions as F

from newslake.llm import exact
from tests.llm import cases


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(table):
    groups = {}
    for i, text, *_ in table:
        groups.setdefault(lower(text), []).append(i)
    out = []
    for i, text, *_ in table:
        group = groups[lower(text)]
        keep = max((x for x in group if x is not None), default=None)
        out.append((i, keep, len(group), i == keep))
    return sorted(out, key=repr)


def found(df, **options):
    return cases.rows(exact.duplicates(df, **options).drop("digest"))


def test_edges(spark):
    for df in (cases.edges(spark), cases.clashing(cases.edges(spark))):
        assert found(df) == brute(cases.EDGES)
    assert found(cases.empty(cases.edges(spark))) == []


def test_clashing_digests_are_told_apart_by_bytes(spark):
    table = [(i, "ab"[i % 2] * (1 + i % 5), None) for i in range(60)] + [(100, "zz", None), (None, "bb", None)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    for weak in (lambda body: F.length(body), lambda body: F.lit(1)):
        assert found(df, digest=weak) == brute(table)


def test_many_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(exact, "COPIES_A_TASK", 7)
    table = [(i, "Same" if i % 2 else f"text {i % 40}", None) for i in range(300)]
    assert found(spark.createDataFrame(table, "doc_id long, text string, source string")) == brute(table)


def test_state_takes_up_later_files(spark, tmp_path):
    folder, state = str(tmp_path / "arrivals"), str(tmp_path / "state")
    first = spark.createDataFrame([(1, "x"), (5, "y"), (2, "x")], "id long, digest string")
    first.repartition(3).write.parquet(folder)
    assert cases.rows(exact.groups_of(spark, folder, state, batch_bytes=1)) == [("x", 2, 2), ("y", 5, 1)]
    spark.createDataFrame([(9, "x"), (3, "z")], "id long, digest string").write.mode("append").parquet(folder)
    assert cases.rows(exact.groups_of(spark, folder, state)) == [("x", 9, 3), ("y", 5, 1), ("z", 3, 1)]
    assert os.listdir(state)


def test_keep(spark):
    df = cases.clashing(cases.edges(spark))
    kept = exact.keep(df)
    assert kept.columns == df.columns
    table = {(r[0], r[1]) for r in kept.collect()}
    assert table == {(3, " \n\t "), (5, "one TWO three."), (2, ""), (6, cases.LONG), (7, cases.EDGES[-1][1])}
    assert kept.count() == 5
