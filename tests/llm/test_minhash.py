import random
import re

from newslake.llm import components, minhash
from tests.llm import cases


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(table):
    sets = [shingles(t) for _, t, *_ in table]
    parent = list(range(len(table)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            linked = table[i][0] is not None and table[j][0] is not None and a and 100 * common >= 75 * len(a | sets[j])
            if linked or (table[i][0] is not None and table[i][0] == table[j][0] and a and sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc, *_) in enumerate(table):
        if doc is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc), doc)
    out = []
    for i, (doc, *_) in enumerate(table):
        root = doc if doc is None or not sets[i] else smallest[find(i)]
        out.append((doc, len(sets[i]), root, doc == root))
    return sorted(out, key=repr)


def test_edges(spark):
    for df in (cases.edges(spark), cases.clashing(cases.edges(spark))):
        assert cases.rows(minhash.near_duplicates(df)) == brute(cases.EDGES)
    assert cases.rows(minhash.near_duplicates(cases.empty(cases.edges(spark)))) == []


def test_against_brute_force(spark):
    dice = random.Random(11)
    table = []
    for _ in range(25):
        words = [f"w{dice.randint(0, 4000)}" for _ in range(dice.randint(3, 120))]
        for _ in range(dice.choice([1, 2, 8])):
            copy = list(words)
            for _ in range(dice.randint(0, 4)):
                copy[dice.randrange(len(copy))] = f"x{dice.randint(0, 9)}"
            table.append((len(table), " ".join(copy).title() if dice.random() < 0.3 else "\n".join(copy)))
    dice.shuffle(table)
    df = spark.createDataFrame(table, "doc_id long, text string")
    assert cases.rows(minhash.near_duplicates(df)) == brute(table)


def test_ids_with_an_empty_row_among_theirs(spark):
    dice = random.Random(5)
    base = [f"w{n}" for n in range(80)]
    other = [f"v{n}" for n in range(80)]
    table = []
    for i in range(60):
        words = list(base if i % 2 else other)
        for _ in range(dice.randint(1, 6)):
            words[dice.randrange(80)] = f"x{dice.randint(0, 900)}"
        table += [(i, " ".join(words)), (i, None if i % 3 else "")]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    assert cases.rows(minhash.near_duplicates(df)) == brute(table)


def test_components_of_a_chain_and_random_links(spark):
    dice = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(7, 7), (100, 90)]
    links += [(dice.randint(200, 260), dice.randint(200, 260)) for _ in range(40)]
    dice.shuffle(links)
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    found = dict(components.connected(spark.createDataFrame(links, "a long, b long")).collect())
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {x: found.get(x, x) for x in linked} == {x: find(x) for x in linked}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep(spark):
    df = cases.clashing(cases.edges(spark))
    kept = minhash.keep(df)
    assert kept.columns == df.columns
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == [1, 2, 3, 4, 4, 6, 7]
