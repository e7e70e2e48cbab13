"""Tasks follow the size of the log, and cuts are counted alike in generated code and by element."""

from pyspark.sql import functions as F

from clickfeat.operators import ranges, slices
from clickfeat.plans import model, wide
from clickfeat.plans.features import Feature


def sizes(df):
    return df.rdd.glom().map(len).collect()


def test_cut_rows_are_exchanged_into_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(slices, "TASK_ROWS", 200)
    spark.conf.set(slices.SLICE_ROWS_CONF, "400")
    try:
        log = spark.range(4000).selectExpr("id AS rid", "id % 2 AS k", "id * 1000000 AS t")
        made = ranges.rolling_counts(log, ["k"], {"n": 3})
        found = sizes(made)
        assert len(found) > 20 and max(found) < 1500
        assert {r.n for r in made.where("rid > 1").collect()} == {2}
    finally:
        spark.conf.unset(slices.SLICE_ROWS_CONF)


def test_wide_windows_take_tasks_by_the_size_of_the_log(spark, monkeypatch):
    monkeypatch.setattr(wide, "WIDE_TASK_ROWS", 50)
    log = spark.range(4000).selectExpr("id AS rid", "id % 500 AS ip", "id AS t")
    made = wide.window_features(log, [Feature("size", ("ip",), "n")], "ip")
    assert len(sizes(made)) > 20
    assert {r.n for r in made.collect()} == {8}


def test_cuts_of_any_number(spark):
    for n in (0, 1, slices.FEW_CUTS, slices.FEW_CUTS + 1, 40):
        at = F.array(*[F.struct(F.lit(2 * i).alias("a"), F.lit(i).alias("b")) for i in range(n)]) if n else F.expr("cast(array() as array<struct<a:int,b:int>>)")
        rows = spark.range(90).select(F.col("id").cast("int").alias("a"), F.lit(3).alias("b"), F.struct(at.alias("at")).alias(slices.CUTS))
        found = rows.select("a", slices._cuts_up_to(F.struct("a", "b")).alias("n")).collect()
        assert all(r.n == sum((2 * i, i) <= (r.a, 3) for i in range(n)) for r in found)


def test_steps_of_a_fit_have_few_tasks():
    assert [model.fit_tasks(n, 12) for n in (10, 320_982, 3_200_000, 18_000_000, 90_000_000)] == [1, 7, 24, 24, 91]
