import random

import pytest

from clickfeat.llm import maxscore

SCHEMA = "vec_id long, vector array<long>"


def brute(queries, vectors, k):
    out = []
    for q, a in {(q, tuple(a)) for q, a in queries if q is not None and a is not None}:
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i is not None and b is not None and i != q]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["dense", "sparse", "positive", "ties"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(maxscore, "SHARD", 700)
    monkeypatch.setattr(maxscore, "BLOCK", 7)
    random.seed(kind)
    draw = {
        "dense": lambda: random.randint(-900, 900),
        "sparse": lambda: random.choice([0] * 9 + [random.randint(-99, 99)]),
        "positive": lambda: int(random.expovariate(0.01)),
        "ties": lambda: random.choice([0, 0, 1]),
    }[kind]
    vectors = [(i, [draw() for _ in range(12)]) for i in range(2000)]
    vectors += [(None, [1] * 12), (5000, None), (5001, []), (5002, [3, 4]), vectors[3], vectors[3]]
    queries = vectors[:2000:100] + [(5001, []), (None, [1]), (5000, None), vectors[0]]
    given = spark.createDataFrame([(i, v, 1) for i, v in vectors], SCHEMA + ", shard int")
    found = maxscore.search(spark.createDataFrame(queries, SCHEMA), given, 10).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute(queries, vectors, 10)


def test_few_and_no_candidates(spark):
    three = spark.createDataFrame([(1, [1]), (2, [2]), (3, [3])], SCHEMA)
    assert maxscore.search(three, three).count() == 6
    assert maxscore.search(three, three.limit(0)).collect() == []
    assert maxscore.search(three.limit(0), three).collect() == []


def test_integers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.0001]), (2, [nan]), (3, [1.0, inf]), (4, [None, 1.0]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    found = {r.id: r.i for r in df.select("id", maxscore.integers(df.v).alias("i")).collect()}
    assert found == {1: [512, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
