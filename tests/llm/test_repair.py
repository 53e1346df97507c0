import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from newslake.llm import queries, repair
from tests.llm import cases

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow what


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if hit == 0:
            continue
        text = "" if hit == 1 else "".join(c for c in text if c not in ".!?") if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def faults(turns):
    """(initial, fault) of turns in order; the fault is "", blank, duplicate or truncated."""
    seen, out = set(), []
    for role, text in turns:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "" if stripped[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(marks):
    """(cost, audit, end roles) by all edits, with up to three insertions at any place."""
    best = {"": (0, "", ())}  # by last initial: cost, audit, roles

    def insert(found):
        for _ in range(3):
            for last, (cost, audit, roles) in list(found.items()):
                for new in AFTER[last].replace("s", ""):
                    option = (cost + 3, audit + "I", (*roles, ("I", new)))
                    found[new] = min(found.get(new, option), option)
        return found

    for place, (initial, fault) in enumerate(marks):
        found = {}
        for last, (cost, audit, roles) in insert(dict(best)).items():
            options = [(last, (cost + 4, audit + "D", roles))]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if initial and initial in AFTER[last]:
                    options.append((initial, (cost + extra, audit + "K", (*roles, (place, None)))))
                for new in AFTER[last].replace("s", ""):
                    options.append((new, (cost + extra + 3, audit + "R", (*roles, (place, new)))))
            for new, option in options:
                found[new] = min(found.get(new, option), option, key=lambda x: x[:2])
        best = found
    return min((v for k, v in insert(best).items() if k in ("", "a")), key=lambda x: x[:2])


def enumerated(marks):
    """The same by trying everything, with up to two insertions at any place."""
    out = []
    gaps = ["", "I", "II"]
    for before in itertools.product(gaps, repeat=len(marks) + 1):
        for edits in itertools.product("KRD", repeat=len(marks)):
            audit, last, cost = "", "", 0
            for i in range(len(marks) + 1):
                for _ in before[i]:
                    last, cost = AFTER[last][-1], cost + 3
                audit += before[i]
                if i == len(marks):
                    break
                initial, fault = marks[i]
                edit = edits[i]
                audit += edit
                if edit == "D":
                    cost += 4
                    continue
                cost += 3 * (fault == "truncated") + (3 if edit == "R" else 0)
                if fault in ("blank", "duplicate") or edit == "K" and (not initial or initial not in AFTER[last]):
                    last = None
                    break
                last = initial if edit == "K" else AFTER[last][-1]
            if last in ("", "a"):
                out.append((cost, audit))
    return min(out)


def expected(rows):
    ids = {r[0] for r in rows}
    by_conv = defaultdict(list)
    for conv, turn, role, text in damaged(rows):
        by_conv[conv].append((turn, role, text))
    out = []
    for conv in ids:
        turns = sorted(by_conv[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        numbers = {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        marks = faults([(r, t) for _, r, t in turns])
        count = {f: sum(m[1] == f for m in marks) for f in ("blank", "duplicate", "truncated")}
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(marks))
        cost, audit, roles = cheapest(marks)
        lines, names = [], {"u": "user", "a": "assistant"}
        for place, new in roles:
            role, text = (names[new], "") if place == "I" else (names[new] if new else turns[place][1], turns[place][2])
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *count.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def run(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: df)
    found = queries.QUERIES["op11_repair"](spark, "")
    assert found.columns == COLUMNS and {t for c, t in found.dtypes if c in COLUMNS[1:7]} == {"bigint"}
    return cases.rows(found)


def test_edits_against_all_possible_ones():
    kinds = [(k, f) for k in ("s", "u", "a", "x") for f in ("", "truncated")] + [("u", "blank")]
    codes = {m: chr(ord("A") + 3 * "suax".index(m[0]) + ["", "truncated", "blank"].index(m[1])) for m in kinds}
    for n in (0, 1, 2):
        for marks in itertools.product(kinds, repeat=n):
            assert enumerated(marks) == cheapest(marks)[:2]
    chance = random.Random(3)
    for n in [1, 2] * 40 + [3, 4, 5, 6, 9, 17, 40] * 60:
        marks = [chance.choice(kinds) for _ in range(n)]
        said = "".join(codes[m] for m in marks)
        end, edits = repair.whole.__wrapped__(said)
        edits = [*edits, repair.FINALLY[end]]
        assert (repair.cost_of(said, edits), "".join(edits)) == cheapest(marks)[:2]
        steps = [repair.STEPS[c] for c in said]
        cut = sorted(chance.sample(range(n + 1), min(2, n)))
        nodes = [steps[a:b] for a, b in zip([0, *cut], [*cut, n], strict=True)]
        summed = [repair.as_step(repair.summary(node)) for node in nodes if node]
        assert repair.best_end(summed) == end
        states = repair.crossings(summed, repair.START, end)
        parts = [said[a:b] for a, b in zip([0, *cut], [*cut, n], strict=True) if a < b]
        again = [e for part, a, b in zip(parts, states, states[1:], strict=False) for e in repair.edits(part, a, b)]
        assert again == edits[:-1]


def test_query_equals_brute_force(spark, sf, monkeypatch):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, df, monkeypatch) == expected(rows)


@pytest.mark.parametrize("fan_bits", [1, 10])
def test_edges_and_a_conversation_over_all_ranges(spark, monkeypatch, fan_bits):
    monkeypatch.setattr(repair, "FAN_BITS", fan_bits)
    chance = random.Random(9)
    roles = ["user", "assistant", "system", "tool", "", None, "unknown", "User"]
    texts = ["Yes.", "No!", "Why", "", None, " \n", "Well? \t", "é…", "Ok. ", "End.\x1c"]
    rows = [(c, chance.choice([None, *range(-2, 9)]), chance.choice(roles), chance.choice(texts)) for c in [*range(30), None] for _ in range(chance.randrange(9))]
    rows += [(1000, i, ["user", "assistant"][i % 2], f"Turn {i}.") for i in range(900)]
    rows += [(1001, 5, "user", "Same.")] * 300 + [(1002, None, chance.choice(roles), f"{i}") for i in range(100)]
    rows += [(1003, 1, "user", cases.LONG), (1003, 2, "assistant", cases.LONG + "."), (1004, None, None, None)]
    rows += [(2000 + i, 0, "user", "Alone.") for i in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        want = expected(rows)
        assert run(spark, df, monkeypatch) == want
        assert run(spark, cases.clashing(df), monkeypatch) == want
        assert run(spark, cases.empty(df), monkeypatch) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
