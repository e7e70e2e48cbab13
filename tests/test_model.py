"""Model steps on a log whose label follows one column."""

import math

import pytest
from pyspark.sql import functions as F

from clickfeat.plans import model


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(600).select(
        F.col("id").alias("rid"), F.col("id").alias("click_id"), (F.col("id") % 7).alias("a"), (F.col("id") % 4).cast("string").alias("c"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("b"),
        F.when((F.col("id") % 4 == 2) & (F.col("id") % 7 > 1), 1).otherwise(0).alias("is_attributed"),
    )
    return rows.cache()


PARAMS = model.FitParams(positive_weight=3.0, max_depth=3, learning_rate=0.5, row_share=1.0, column_share=1.0, max_bins=32, rounds=5)


def test_fit_scores_and_importance(table):
    found = model.fit(table, ["a", "b", "c"], ["c"], PARAMS, validate=table)
    assert 1 <= found.best_round <= 5
    row = model.metrics(found.score(table)).first()
    assert row["auc"] > 0.99 and 0 < row["logloss"] < 0.5
    gains = {r["feature"]: r["gain"] for r in found.importance().collect()}
    assert math.isclose(sum(gains.values()), 100.0, rel_tol=1e-6) and gains["c"] > gains["b"]
    again = model.refit(found, table, PARAMS, 43)
    assert again.best_round == max(1, round(found.best_round * 1.46))


def test_unseen_category_and_missing_values_are_scored(table):
    found = model.fit(table, ["b", "c"], ["c"], PARAMS)
    odd = table.limit(3).withColumn("c", F.lit("new")).withColumn("b", F.lit(None).cast("long"))
    assert found.score(odd).where(F.col("score").isNull()).count() == 0


def test_seed_average_is_the_mean_of_the_runs(table):
    runs = [table.select("click_id", F.lit(s).alias("score")) for s in (0.2, 0.4)]
    found = model.average_scores(runs)
    assert found.count() == 600 and found.where(F.abs(F.col("score") - 0.3) > 1e-12).count() == 0


def test_metrics_of_a_constant_score(table):
    row = model.metrics(table.withColumn("score", F.lit(0.5))).first()
    assert row["auc"] == pytest.approx(0.5) and row["logloss"] == pytest.approx(math.log(2))


def test_report_has_one_row_per_click(spark, table, tmp_path):
    scored = table.withColumn("score", F.lit(0.25))
    clicks = table.select("click_id", "a", "rid").unionByName(table.select("click_id", "a", "rid"))
    made = model.write_report(clicks, scored, str(tmp_path / "report"), ["a"])
    assert made.count() == 600
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).columns == ["click_id", "is_attributed"]


def test_patience_keeps_the_best_round():
    assert model.best_of([5.0, 4.0, 3.0, 3.5, 3.4], 2) == (3, True)
    assert model.best_of([5.0, 4.0, 3.0, 3.5], 2) == (3, False)
    assert model.best_of([5.0, 4.9, 5.0, 4.8, 5.0, 5.0, 4.7], 2) == (4, True)
    assert model.best_of([1.0]) == (1, False)


def test_fit_stops_after_idle_rounds(table):
    """Validation labels are the opposite of what can be learned, so the first round is the best one."""
    learned = table.withColumn("is_attributed", (F.col("a") < 3).cast("int"))
    opposite = learned.withColumn("is_attributed", 1 - F.col("is_attributed"))
    params = model.FitParams(positive_weight=1.0, rounds=40, max_depth=2, row_share=1.0, column_share=1.0)
    assert model.fit(learned, ["a"], [], params, validate=opposite, patience=3).best_round == 1


def test_group_numbers_are_categories(table):
    from clickfeat.functions.scalars import categoricals

    assert categoricals(table.withColumn("a_ngroup", F.lit(1)).withColumn("app", F.lit(1))) == ["app", "a_ngroup"]


def test_many_categories_are_coded_without_lists_on_the_driver(spark):
    """A group number with 150,000 values, hot and NULL ones among them, becomes codes in the order of the label rate."""
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 150_000).alias("a_ngroup"),
        F.when(F.xxhash64("id") % 4 == 0, 1).otherwise(0).alias("is_attributed"),
    )
    codes = model.category_codes(rows, "a_ngroup", "is_attributed")
    n = rows.where("a_ngroup IS NOT NULL").select("a_ngroup").distinct().count()
    assert n > 90_000 and codes.count() == n and codes.select("code").distinct().count() == n
    assert codes.agg(F.min("code"), F.max("code")).first() == (0, n - 1)
    rates = rows.groupBy("a_ngroup").agg(F.avg("is_attributed").alias("rate")).join(codes, "a_ngroup")
    first, last = (rates.where(F.col("code") == x).first()["rate"] for x in (0, n - 1))
    assert (first, last) == (0.0, 1.0)
    made = model.matrix(rows, ["a_ngroup"], ["a_ngroup"], "is_attributed")
    assert made.count() == 400_000
    found = model.fit(rows, ["a_ngroup"], ["a_ngroup"], model.FitParams(rounds=2, max_depth=2))
    assert found.importance().first()["split"] > 0


@pytest.mark.parametrize("limit", [None, "0"])
def test_codes_join_by_broadcast_and_by_shuffle(spark, table, limit):
    if limit:
        spark.conf.set("spark.clickfeat.broadcastRows", limit)
    try:
        made = model.matrix(table, ["a", "c"], ["c"], "is_attributed").select("rid", "c", model.FEATURES).collect()
    finally:
        spark.conf.unset("spark.clickfeat.broadcastRows")
    assert len(made) == 600 and {(r.c, r[model.FEATURES][1]) for r in made} == {("0", 0.0), ("1", 1.0), ("3", 2.0), ("2", 3.0)}


def test_first_trees_are_a_shorter_fit(table):
    params = model.FitParams(positive_weight=3.0, max_depth=3, rounds=9)
    store = model.run_store(table.sparkSession)
    encoder = model.Encoder.learned(table, ["a", "b", "c"], ["c"], model.LABEL, store)
    rows = model.written_matrix(table, encoder, params, store, "rows")
    nine, four = (model.fit_trees(rows, model.replace(params, rounds=n), 42) for n in (9, 4))
    cut = model.first_trees(nine, 4)
    assert cut.getNumTrees == 4
    same = [[r["probability"] for r in m.transform(rows).select("probability").collect()] for m in (cut, four)]
    assert same[0] == same[1]


def test_measures_of_every_round(table):
    """Against the metrics of the ensemble cut at that round."""
    params = model.FitParams(positive_weight=3.0, max_depth=3, rounds=6)
    found = model.fit(table, ["a", "b", "c"], ["c"], params)
    held_out = model.weighted(table.where("rid % 3 = 0"), 3.0)
    measured = model.round_measures(found.trees, found.encoder.apply(held_out))
    assert len(measured) == 6
    for count in (1, 4, 6):
        cut = model.FittedModel(found.encoder, model.first_trees(found.trees, count))
        row = model.metrics(cut.score(held_out)).first()
        assert measured[count - 1]["auc"] == pytest.approx(row["auc"], abs=2e-3)
        assert measured[count - 1]["logloss"] == pytest.approx(row["logloss"], rel=1e-6)


def test_the_first_measure_to_wait_decides():
    rising = [{"auc": 0.5 + i / 100, "logloss": 1.0} for i in range(9)]
    assert model.best_round(rising, ("auc",), 3) == (9, False)
    assert model.best_round(rising, ("auc", "logloss"), 3) == (1, True)
    assert model.best_round([{"auc": None, "logloss": 1.0}], ("auc",), 3) == (1, False)


def test_importance_counts_splits(table):
    found = model.fit(table, ["a", "b", "c"], ["c"], PARAMS)
    rows = {r["feature"]: r for r in found.importance().collect()}
    text = found.trees.toDebugString
    assert {name: r["split"] for name, r in rows.items()} == {n: text.count(f"If (feature {i} ") for i, n in enumerate("abc")}
