import math
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from newslake.llm import mixing
from tests.llm import cases


def brute(table, evenness, repeats, budget, block_tokens):
    rows = [(i, s, len((t or "").encode().split()) + 1) for i, t, s in table]
    n = Counter()
    for _, s, k in rows:
        n[s] += k
    total = sum(n.values())
    share = {s: k / total for s, k in n.items()}

    def entropy(x):
        z = sum(p**x for p in share.values())
        return -sum(p**x / z * math.log(p**x / z) for p in share.values())

    x = 1.0
    if evenness is not None and entropy(1.0) < evenness * math.log(len(n)) - 1e-12:
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if entropy(mid) >= evenness * math.log(len(n)) - 1e-12 else (low, mid)
        x = low
    ratio = max(share.values()) / min(share.values())
    if repeats is not None and ratio > repeats:
        x = max(x, 1 - math.log(repeats) / math.log(ratio))
    x = math.floor(x * 1e6 + 0.5) / 1e6
    power = {s: p**x for s, p in share.items()}
    least = max(n[s] / power[s] for s in n)
    out = []
    for s in n:
        weight = power[s] / sum(power.values())
        wanted = max(round(power[s] * least), n[s]) if budget is None else round(weight * budget)
        quota = max(round(weight * block_tokens), 1)
        for k in range(math.ceil(wanted / n[s])):
            at = k * n[s]
            keyed = [(md5(f"mix:{k}:{'' if i is None else i}".encode()).hexdigest(), c, i) for i, t, c in rows if t == s]
            for place, c, i in sorted(keyed, key=lambda y: y[:2]):
                if at < wanted:
                    out.append((i, s, c, k, at // quota, place))
                at += c
    return sorted(out, key=repr)


def documents(sizes):
    table, i = [], 0
    for source, count in sizes.items():
        for _ in range(count):
            table.append((i, " ".join(["w"] * (i * 7 % 23)), source))
            i += 1
    return table


@pytest.mark.parametrize("budget", [None, 900])
@pytest.mark.parametrize(("evenness", "repeats"), [(0.95, 2.0), (0.9, None), (None, 1.5), (None, None), (0.99, 50.0)])
def test_against_brute_force(spark, budget, evenness, repeats):
    table = documents({"hot": 120, "a": 12, "b": 9, "c": 3})
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    found = mixing.mix(df, evenness=evenness, repeats=repeats, budget=budget, block_tokens=100)
    assert cases.rows(found) == brute(table, evenness, repeats, budget, 100)


def test_weights_meet_the_target(spark):
    table = documents({"hot": 200, "a": 20, "b": 20, "c": 20, "d": 20})
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    uses = mixing.mix(df, evenness=0.97, repeats=None).groupBy("source").agg(F.sum("tokens").alias("n")).collect()
    total = sum(r.n for r in uses)
    entropy = -sum(r.n / total * math.log(r.n / total) for r in uses)
    assert abs(entropy - 0.97 * math.log(5)) < 0.02
    assert {r.doc_id for r in mixing.mix(df).collect()} == {r[0] for r in table}


def test_edges(spark):
    for df in (cases.edges(spark), cases.clashing(cases.edges(spark))):
        assert cases.rows(mixing.mix(df, repeats=None)) == brute(cases.EDGES, mixing.EVENNESS, None, None, mixing.BLOCK_TOKENS)
        dealt = mixing.dealt(df)
        assert dealt.columns == df.columns
        assert {r[0] for r in dealt.collect()} == {r[0] for r in cases.EDGES}
    assert mixing.mix(cases.empty(cases.edges(spark))).count() == 0


def test_native_plan(spark):
    plan = mixing.mix(cases.edges(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
