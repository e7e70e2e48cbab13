"""Row ids from places in files, and rejected lines."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.sources import positions
from clickfeat.sources.clicklog import csv_reader
from clickfeat.sources.store import FeatureStore

SCHEMA = "ip long, app int, click_time timestamp_ntz"
HEADER = "ip,app,click_time"
BAD = ("1,x,2017-11-07 00:00:00", "1,2,yesterday", "a,2,2017-11-07 00:00:00", "1,2,2017-11-07 00:00:00,9", "1")


@pytest.fixture
def files(tmp_path):
    """Three files of very different size with repeated, empty and bad lines, and all their lines in order."""
    every = []
    for name, count in (("b.csv", 3), ("a.csv", 700), ("c.csv", 40)):
        lines = [f"{i // 4},{i % 3},2017-11-07 0{i % 9}:00:00" for i in range(count)]
        lines[2:2] = BAD if name != "c.csv" else []
        every.append((name, lines))
        spaced = [line for i, row in enumerate(lines) for line in ((row, "") if i % 50 == 5 else (row,))]
        (tmp_path / name).write_text("\n".join([HEADER, *spaced]) + "\n")
    (tmp_path / "empty.csv").write_text(HEADER + "\n")
    return str(tmp_path), [line for _, lines in sorted(every) for line in lines]


@pytest.mark.parametrize("split_bytes, few", [("128m", "200000"), ("512", "200000"), ("100", "0")])
def test_places_do_not_depend_on_splits(spark, files, split_bytes, few):
    path, lines = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set(positions.SPLITS_CONF, few)
    try:
        made = positions.scan_lines(spark, path, T.StructType.fromDDL(SCHEMA))
        assert made.columns == ["rid", "ip", "app", "click_time", positions.REJECTED]
        if split_bytes != "128m":
            assert made.rdd.getNumPartitions() > 3
        for _ in range(2):
            rows = {r.rid: r for r in made.collect()}
            assert sorted(rows) == list(range(len(lines)))
            for place, line in enumerate(lines):
                row = rows[place]
                assert (row[positions.REJECTED] == line) if line in BAD else (f"{row.ip},{row.app},{row.click_time}" == line)
        # Later filters and fewer columns change neither places nor what fits.
        assert made.where("app = 1").select("rid").count() == sum(line.split(",")[1:2] == ["1"] and line not in BAD for line in lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset(positions.SPLITS_CONF)


def test_log_and_rejects_are_written(spark, files, tmp_path_factory):
    path, lines = files
    store = FeatureStore(spark, str(tmp_path_factory.mktemp("store")))
    log, bad = positions.load_csv(spark, path, T.StructType.fromDDL(SCHEMA), store)
    assert {(r.rid, r.line) for r in bad.collect()} == {(i, line) for i, line in enumerate(lines) if line in BAD}
    assert log.count() == len([x for x in lines if x not in BAD]) and log.columns == ["rid", "ip", "app", "click_time"]
    assert store.has("log-rejects") and log.select("ip").where(F.col("ip").isNull()).count() == 0


def test_parquet_files_have_places_too(spark, tmp_path):
    spark.range(1000).repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "p"))
    made = positions.with_file_positions(spark.read.parquet(str(tmp_path / "p")), "place")
    assert made.where("place <> id").count() == 0 and made.count() == 1000


def test_no_exchange_of_rows(spark, files):
    """Only the counts of splits meet in an exchange; the rows stay where they are read."""
    path, _ = files
    made = positions.with_file_positions(csv_reader(spark, "ip long, app string, click_time string").csv(path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_a_second_log_is_numbered_behind_the_first(spark, tmp_path):
    """Also where the last line of the first log is a rejected one, and where a log has no good line."""
    from clickfeat.plans import jobs

    for name, lines in (("train", ["1,2,2017-11-07 00:00:00", "x,2,2017-11-07 00:00:00"]), ("test", ["3,4,2017-11-07 01:00:00"] * 2)):
        (tmp_path / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    schema, store = T.StructType.fromDDL(SCHEMA), FeatureStore(spark, str(tmp_path / "store"))
    train, test, bad = jobs.logs_from_csv(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"), store, (schema, schema))
    assert [r.rid for r in train.collect()] == [0] and sorted(r.rid for r in test.collect()) == [2, 3]
    assert [tuple(r) for r in bad.collect()] == [("train", 1, "x,2,2017-11-07 00:00:00")]
    assert {"t", "hour", "15min"} <= set(train.columns)
    assert positions.next_row_id(test.limit(0)) == 0
