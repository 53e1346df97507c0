import random

from pyspark.sql import functions as F

from newslake.llm import chat
from tests.llm import cases


def brute(table):
    said = {}
    for conv, turn, role, text in set(table):
        said.setdefault(conv, []).append((turn, role, text))
    key = lambda x: tuple((v is not None, v or type(v)()) if v is not None else (False, "") for v in x)
    logs = {c: [(r, t) for _, r, t in sorted(turns, key=lambda x: [(v is not None, v if v is not None else 0) for v in x])] for c, turns in said.items()}
    out = []
    for c, log in logs.items():
        longer = any(len(o) > len(log) and o[: len(log)] == log for o in logs.values())
        smaller = any(o == log and (d is None or (c is not None and d < c)) for d, o in logs.items() if d != c)
        if not longer and not smaller:
            text = "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in log)
            out.append((c, len(log), text))
    return sorted(out, key=repr)


def found(df):
    texts = {}
    for r in df.collect():
        texts.setdefault((r.conv_id, r.n_turns), []).append((r.part, r.text))
    return sorted(((c, n, "".join(t for _, t in sorted(parts))) for (c, n), parts in texts.items()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_snapshots(spark):
    dice = random.Random(6)
    table, conv = [], 0
    for _ in range(15):
        log = [(dice.choice(["user", "assistant"]), f"t{dice.randint(0, 3)}") for _ in range(dice.randint(1, 7))]
        for _ in range(dice.randint(1, 3)):
            cut = dice.randint(1, len(log))
            table += [(conv, k, *turn) for k, turn in enumerate(log[:cut])]
            conv += 1
    table += [(900, 0, "user", None), (901, 0, "user", ""), (902, 0, None, "x"), (903, 0, "", "x")]
    table += [(904, 5, "a", "same number"), (904, 5, "b", "same number"), (904, 5, "b", "same number")]
    table += [(905, None, "a", "no turn"), (905, 1, "a", "one"), (None, 0, "user", "no id")]
    dice.shuffle(table)
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert found(chat.render(df)) == brute(table)
    assert found(chat.render(cases.clashing(df))) == brute(table)
    assert chat.render(cases.empty(df)).count() == 0


def test_long_conversations_are_rendered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_TURNS", 4)
    log = [("user", f"line {k}") for k in range(30)]
    table = [(c, k, *turn) for c, n in ((1, 30), (2, 17), (3, 4), (4, 30)) for k, turn in enumerate(log[:n])]
    table += [(5, k, "user", f"line {k if k < 9 else -k}") for k in range(12)]
    df = spark.createDataFrame(table, SCHEMA)
    assert found(chat.render(df)) == brute(table)
    assert chat.render(df).filter("conv_id = 1").count() == 8


def test_turns_without_a_number_or_with_the_same_one_are_spread(spark):
    table = [(1, None, "user", f"line {k}") for k in range(4000)] + [(2, 5, "user", f"line {k}") for k in range(4000)]
    table += [(3, k, "user", f"line {k}") for k in range(40)] + [(3, None, "user", "first"), (3, -5000, "user", "second")]
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert found(chat.render(df)) == brute(table)
    keyed = df.select(F.struct(F.col("conv_id").alias("id")).alias("key"), "turn", "role", "text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        at = chat._number(keyed).groupBy(F.spark_partition_id().alias("at")).agg(F.count("*").alias("n"))
        assert at.agg(F.max("n")).first()[0] < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    plan = chat.render(df)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
