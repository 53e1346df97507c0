import numpy as np
import pytest

from newslake.llm import embeddings
from tests.llm import cases


def brute(table):
    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    out, links = [], {}
    for i, (a, va) in enumerate(table):
        links[i] = [
            j for j, (b, vb) in enumerate(table)
            if i != j and a is not None and b is not None and good(va) and good(vb) and len(va) == len(vb)
            and np.dot(va, vb) / (np.linalg.norm(va) * np.linalg.norm(vb)) >= 0.9
        ]
    for i, (a, _) in enumerate(table):
        reached, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        root = a if a is None else min(table[j][0] for j in reached)
        out.append((a, len(links[i]), root, a == root))
    return sorted(out, key=repr)


def near(random, vector, cosine):
    other = random.normal(size=len(vector))
    unit = vector / np.linalg.norm(vector)
    other -= other @ unit * unit
    return cosine * unit + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def test_against_brute_force(spark):
    random = np.random.default_rng(4)
    table = [(i, random.normal(size=24).tolist()) for i in range(60)]
    for i in range(20):
        base = np.array(table[i][1])
        table += [(1000 + 10 * i + k, (near(random, base, 0.97) * (k + 1)).tolist()) for k in range(i % 4)]
    table += [(500, table[0][1]), (501, table[0][1]), (502, [2 * x for x in table[0][1]])]
    table += [(700, None), (701, []), (702, [0.0] * 24), (703, [None, 1.0]), (704, [float("nan")] * 24)]
    table += [(705, [float("inf")] + [1.0] * 23), (None, table[0][1]), (706, [1.0, 2.0]), (707, [1.0, 2.1]), (708, [5.0])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert cases.rows(embeddings.near_duplicates(df)) == brute(table)
    assert cases.rows(embeddings.near_duplicates(cases.clashing(df))) == brute(table)
    assert embeddings.near_duplicates(cases.empty(df)).count() == 0


def test_blocks_of_a_dense_cell(spark, monkeypatch):
    """Patches do not reach the workers, but the dealing into blocks is planned here."""
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 8)
    random = np.random.default_rng(9)
    base = random.normal(size=16)
    table = [(i, near(random, base, 0.99).tolist()) for i in range(50)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert cases.rows(embeddings.near_duplicates(df)) == brute(table)


@pytest.mark.parametrize(("cosine", "least"), [(0.9, 0.98), (0.95, 0.999)])
def test_recall(cosine, least):
    random = np.random.default_rng(1)
    a = random.normal(size=(2000, 64))
    b = np.array([near(random, v, cosine) for v in a])
    codes = np.concatenate([embeddings.cells(embeddings.unit_vectors(x)) for x in (a, b)])
    met = embeddings._first_meeting(codes, np.arange(2000), np.arange(2000, 4000)) != 0
    assert met.mean() >= least


def test_e8_points_are_nearest():
    random = np.random.default_rng(2)
    x = random.normal(size=(300, 8)) * 2
    points, _ = embeddings.nearest_e8(x)
    whole = (points % 1 == 0).all(axis=1) | (points % 1 == 0.5).all(axis=1)
    assert whole.all() and (points.sum(axis=1) % 2 == 0).all()
    shortest = ((x - points) ** 2).sum(axis=1)
    assert (shortest <= 1 + 1e-9).all()  # the covering radius is 1
    for i in range(8):
        for j in range(i):
            for s in (1, -1):
                step = np.zeros(8)
                step[i], step[j] = 1, s
                assert (((x - points - step) ** 2).sum(axis=1) >= shortest - 1e-9).all()
                assert (((x - points + step) ** 2).sum(axis=1) >= shortest - 1e-9).all()
