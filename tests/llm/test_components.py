import random

from clickfeat.llm import components as module
from clickfeat.llm.components import components


def test_equals_union_find(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    edges += [(random.randrange(400, 450), random.randrange(400, 450)) for _ in range(30)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    alone = {x for x in parent if all(x not in e or e == (x, x) for e in edges)}
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in parent if x not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_step_is_a_small_plan_and_stars_take_one(spark, monkeypatch):
    steps = []
    keep = module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: steps.append(df) or keep(df, name))
    found = components(spark.createDataFrame([(1, k) for k in range(2, 30)] + [(40, 50)], "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {k: 1 for k in range(1, 30)} | {40: 40, 50: 40}
    assert len(steps) == 2
    plan = steps[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange") <= 8
