"""Scalar columns and sources."""

import datetime

import pytest
from pyspark.sql import functions as F

from clickfeat.functions import scalars, timeparts
from clickfeat.operators import relational
from clickfeat.plans.features import add_features, size
from clickfeat.sources import clicklog
from clickfeat.sources.store import FeatureStore, write_csv


def times(spark, *values):
    rows = [(i, datetime.datetime.fromisoformat(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "rid long, click_time timestamp_ntz")


def test_day_changes_at_local_midnight(spark):
    log = times(spark, "2017-11-07 15:59:59", "2017-11-07 16:00:00")
    local = timeparts.add_time_parts(log.withColumn("click_time", timeparts.shift_zone("click_time")))
    assert [(r["day"], r["hour"]) for r in local.orderBy("rid").collect()] == [(7, 23), (8, 0)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_micros_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        made = times(spark, "2024-03-10 02:30:00.123456", "1969-12-31 23:59:59").select(timeparts.epoch_micros("click_time").alias("t"))
        assert [r["t"] for r in made.collect()] == [1710037800123456, -1000000]
        text = spark.range(1).select(timeparts.format_epoch(F.lit(1710037800)).alias("s")).first()["s"]
        assert text == "2024-03-10 02:30:00"
        parsed = spark.createDataFrame([("2024-03-10 02:30:00",), ("no time",)], "s string")
        micros = [r["t"] for r in parsed.select(timeparts.epoch_micros(timeparts.parse_timestamp("s")).alias("t")).collect()]
        assert micros == [1710037800000000, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_three_minute_bucket_wraps_only_on_request(spark):
    parts = timeparts.add_time_parts(times(spark, "2024-01-01 12:59:00", "2024-01-01 13:00:00"))
    found = parts.select(timeparts.day_bucket("3min").alias("b"), timeparts.day_bucket("3min", wrap_uint8=True).alias("w"))
    assert [tuple(r) for r in found.collect()] == [(259, 3), (260, 4)]


def test_hour_bands(spark):
    found = spark.range(25).select(timeparts.hour_band(F.col("id")).alias("b")).collect()
    assert [r["b"] for r in found] == [5] * 7 + [1] * 5 + [2] * 6 + [3] * 3 + [4] * 4


def test_division_by_zero_gives_null(spark):
    made = scalars.add_interactions(spark.createDataFrame([(4.0, 0.0)], "a double, b double"), "a", "b", "x").first()
    assert made["inter_x/"] is None and made["inter_x*"] == 0.0 and made["inter_x+"] == 4.0 and made["inter_x-"] == 4.0


def test_column_lists(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "ip int, app int, app_channel_ngroup int, click_time int, hour int")
    assert scalars.predictors(df) == ["app", "app_channel_ngroup", "hour"]
    assert scalars.categoricals(df) == ["app", "hour", "app_channel_ngroup"]
    assert scalars.has_columns(df, ["ip", "app"]) and not scalars.has_columns(df, ["os"])
    assert scalars.fill_missing(df.withColumn("g", F.lit(None).cast("long")), ["g"]).first()["g"] == 99999
    assert df.select(scalars.null_where(F.col("ip") == 1, "app").alias("a")).first()["a"] is None


def test_typed_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "train")
    rows = [(4294967295, 65535, 1, 2, 3, "2017-11-07 09:30:38", None, 0), (5, 9, 1, 2, 3, "2017-11-09 00:00:00", "2017-11-09 00:01:00", 1)]
    source = spark.createDataFrame(rows, "ip long, app int, device int, os int, channel int, click_time string, attributed_time string, is_attributed int")
    write_csv(source, path)
    read = clicklog.read_csv(spark, path, clicklog.TRAIN_SCHEMA)
    assert read.schema == clicklog.TRAIN_SCHEMA
    first = read.orderBy(F.col("ip").desc()).first()
    assert first["ip"] == 4294967295 and first["attributed_time"] is None
    assert first["click_time"] == datetime.datetime(2017, 11, 7, 9, 30, 38)
    assert clicklog.read_csv(spark, path, clicklog.TRAIN_SCHEMA, ["ip", "click_time"], limit=1).columns == ["ip", "click_time"]
    assert clicklog.read_csv(spark, path, clicklog.TRAIN_SCHEMA, limit=1).count() == 1
    before, after = relational.split_at(clicklog.prepare(read), "2017-11-09")
    assert before.count() == 1 and after.count() == 1


def test_store_computes_once(spark, tmp_path):
    store, calls = FeatureStore(spark, str(tmp_path)), []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert store.get_or_compute("ids", compute).count() == 3
    assert len(calls) == 1
    assert FeatureStore(spark, str(tmp_path), reuse=False).get_or_compute("ids", compute).count() == 3
    assert len(calls) == 2


def test_union_of_train_and_test_splits_back(spark):
    train = spark.createDataFrame([(1, 7, 0), (2, 7, 1)], "rid long, ip long, is_attributed int")
    test = spark.createDataFrame([(3, 7, 30)], "rid long, ip long, click_id long")
    both = add_features(relational.union_logs(train, test), [size("ip")])
    assert {r["rid"]: r["ip_count"] for r in both.collect()} == {1: 3, 2: 3, 3: 3}
    assert relational.labelled(both).count() == 2 and relational.unlabelled(both).count() == 1


def test_stacked_features_keep_all_rows(spark):
    a, b = spark.createDataFrame([(1, 2)], "rid long, a long"), spark.createDataFrame([(1, 5)], "rid long, b long")
    assert sorted(map(tuple, relational.stack_features([a, b]).collect()), key=str) == [(1, 2, None), (1, None, 5)]
