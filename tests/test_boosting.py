"""Trees of many seeds at once, against Spark ML's on the same matrices."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickfeat.plans import boosting, model

SEEDS = (42, 43, 44)
PARAMS = model.FitParams(positive_weight=3.7, max_depth=4, row_share=0.7, column_share=0.6, min_rows=60, max_bins=32, rounds=5, metrics=("auc",))


@pytest.fixture(scope="module")
def matrices(spark):
    """Two written matrices of several partitions. Leaves are large, so that no two features cut off the same rows."""
    rows = spark.range(0, 9000, numPartitions=3).select(
        "id", *[(F.abs(F.hash("id", F.lit(k))) % (5**k)).alias(f"f{k}") for k in range(1, 6)]
    )
    chance = (F.col("f2") % 5 + F.col("f3") / 25 + F.rand(7) * 6) / 16
    table = rows.withColumn("is_attributed", (chance > 0.5).cast("int")).withColumn("click_id", F.col("id") % 7000).drop("id")
    store, names = model.run_store(spark), [f"f{k}" for k in range(1, 6)]
    table = store.get_or_compute("table", lambda: table)
    encoder = model.Encoder(names, [], {}, {})
    train, held_out = (
        store.get_or_compute(
            name,
            lambda cut=cut: encoder.apply(model.weighted(table.where(cut), 3.7)).select(
                model.FEATURES, F.col(model.LABEL).cast("double").alias(model.LABEL), model.WEIGHT
            ),
        )
        for name, cut in (("train", "click_id % 3 > 0"), ("held-out", "click_id % 3 = 0"))
    )
    return table, names, train, held_out


def probabilities(trees, rows):
    return np.array([r[0] for r in trees.transform(rows).select(vector_to_array("probability")[1]).collect()])


@pytest.mark.parametrize("in_lockstep", [False, True])
@pytest.mark.parametrize("bins", [32, 300])
def test_trees_are_those_of_spark_ml(monkeypatch, matrices, in_lockstep, bins):
    _, _, train, held_out = matrices
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 700)
    monkeypatch.setattr(boosting, "ROUNDS_KEPT", 2)
    if in_lockstep:
        monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    params = replace(PARAMS, max_bins=bins)
    assert train.rdd.getNumPartitions() > 1
    found = boosting.fit(train, None, model.estimator(params, SEEDS[0]), 3.7, SEEDS, [5, 3, 5])
    scores = found.scores(held_out.withColumn("key", F.lit(1)), model.FEATURES, "key").collect()
    for place, (seed, rounds) in enumerate(zip(SEEDS, (5, 3, 5))):
        theirs = model.fit_trees(train, replace(params, rounds=rounds), seed)
        assert len(found.trees[place]) == rounds
        assert np.allclose([r[f"score_{place}"] for r in scores], probabilities(theirs, held_out), rtol=1e-9, atol=1e-12)
    assert len({r["score_0"] for r in scores}) > 20


@pytest.mark.parametrize("in_lockstep", [False, True])
def test_rounds_are_those_of_a_validated_fit(monkeypatch, matrices, in_lockstep):
    _, _, train, held_out = matrices
    if in_lockstep:
        monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    params = replace(PARAMS, rounds=40, learning_rate=0.5, metrics=("auc", "logloss"))
    best = [model.fit_trees(train, params, seed, held_out, patience=3).getNumTrees for seed in SEEDS]
    found = boosting.fit(
        train, held_out, model.estimator(params, SEEDS[0]), 3.7, SEEDS, [40] * 3, params.metrics, lambda m: model.best_round(m, params.metrics, 3)
    )
    assert [len(trees) for trees in found.trees] == best and max(best) < 37
