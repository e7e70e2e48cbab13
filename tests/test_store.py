"""Stored tables: what counts as the same table."""

import time

from pyspark.sql import functions as F

from clickfeat.plans import wide
from clickfeat.plans.features import size, statistic
from clickfeat.sources.clicklog import events_as_clicks
from clickfeat.sources.store import FeatureStore, identity


def test_another_input_is_not_served_from_the_store(spark, sf_dir, tmp_path):
    log, store = events_as_clicks(spark, sf_dir), FeatureStore(spark, str(tmp_path))
    half = log.where(F.col("rid") % 2 == 0)
    for part in (log, half):
        made = wide.build(part, [size("app")], store, "t", columns=["rid", "app"])
        want = {r["app"]: r["count"] for r in part.groupBy("app").count().collect()}
        assert {r["app"]: r["app_count"] for r in made.collect()} == want


def test_more_features_of_a_stored_key_are_added(spark, sf_dir, tmp_path):
    log, store = events_as_clicks(spark, sf_dir), FeatureStore(spark, str(tmp_path))
    for features in ([size("app")], [size("app"), statistic("mean", "hour", "app")]):
        made = wide.build(log, features, store, "t", columns=["rid"])
        assert made.columns == ["rid", *[f.name for f in features]] and made.count() == log.count()


def test_the_same_computation_is_read_back_and_can_be_dropped(spark, sf_dir, tmp_path):
    log, store, calls = events_as_clicks(spark, sf_dir), FeatureStore(spark, str(tmp_path)), []

    def compute():
        calls.append(1)
        return log.groupBy("app").count()

    for _ in range(2):
        store.get_or_compute("apps", compute, identity(events_as_clicks(spark, sf_dir)))
    assert len(calls) == 1
    store.drop("apps")
    store.get_or_compute("apps", compute, identity(log))
    assert len(calls) == 2


def test_local_tables_with_one_schema_differ(spark):
    a, b = (spark.createDataFrame([(v,)], "x long") for v in (1, 2))
    assert identity(a) != identity(b) and identity(a) == identity(a) and identity(a, 1) != identity(a, 2)


def test_a_replaced_file_of_the_same_size_misses(spark, tmp_path):
    """The same number of bytes with other values, written a little later."""
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text("x\n1\n2\n")
    read = lambda: spark.read.schema("x long").option("header", True).csv(str(path))
    store = FeatureStore(spark, str(tmp_path / "store"))
    total = lambda: store.get_or_compute("sum", lambda: read().agg(F.sum("x").alias("s")), identity(read())).first()["s"]
    assert total() == 3
    time.sleep(0.05)
    (path / "a.csv").write_text("x\n4\n5\n")
    assert total() == 9


def test_merged_sums_read_only_new_files(spark, tmp_path):
    """Files that are added, replaced and removed; empty files and NULL keys."""
    folder, asked = tmp_path / "log", []
    folder.mkdir()

    def put(name, rows):
        (folder / f"{name} 1.csv").write_text("k,v\n" + "".join(f"{k},{v}\n" for k, v in rows))

    def read(files):
        asked.append(sorted(f.rsplit("/", 1)[1] for f in files))
        return spark.read.schema("k string, v long").option("header", True).csv(files)

    sums = {"n": ("count", F.lit(1)), "known": ("count", F.col("v")), "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))}
    store = FeatureStore(spark, str(tmp_path / "store"))

    def merged():
        paths = spark.read.csv(str(folder)).inputFiles()
        return {r["k"]: tuple(r)[1:] for r in store.merged("m", paths, read, ["k"], sums).collect()}

    put("a", [("x", 1), ("y", 5), ("", 7)])
    put("b", [("x", 3), ("x", "")])
    assert merged() == {"x": (3, 2, 4, 1, 3), "y": (1, 1, 5, 5, 5), None: (1, 1, 7, 7, 7)}
    assert merged()["x"] == (3, 2, 4, 1, 3) and asked == [["a 1.csv", "b 1.csv"]]
    put("c", [("x", 100)])
    put("none", [])
    assert merged()["x"] == (4, 3, 104, 1, 100) and asked[1:] == [["c 1.csv", "none 1.csv"]]
    time.sleep(0.05)
    put("b", [("x", 9), ("y", "")])
    assert merged() == {"x": (3, 3, 110, 1, 100), "y": (2, 1, 5, 5, 5), None: (1, 1, 7, 7, 7)} and asked[2:] == [["b 1.csv"]]
    (folder / "c 1.csv").unlink()
    assert merged()["x"] == (2, 2, 10, 1, 9) and len(asked) == 3
