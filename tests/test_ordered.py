"""Ordered features on small logs: ties, ends of groups, global order, and groups cut into slices."""

import random

import pytest
from pyspark.sql import functions as F

from clickfeat.functions.scalars import hash_bucket
from clickfeat.operators import groups, ordered

SEC = 1_000_000


def line_of(rows, key):
    return sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))


@pytest.fixture
def rows():
    rng = random.Random(7)
    return [(i, rng.choice(["hot", "hot", "a", "b"]), rng.randrange(0, 40) * SEC * 3600, rng.random()) for i in range(80)] + [
        (900, "single", 5 * SEC, 0.5)
    ]


@pytest.fixture
def log(spark, rows):
    return spark.createDataFrame(rows, "rid long, k string, t long, x double").repartition(4)


def as_dict(df, name):
    return {r["rid"]: r[name] for r in df.collect()}


def by_line(rows, value):
    made = {}
    for key in {r[1] for r in rows}:
        line = line_of(rows, key)
        for i, row in enumerate(line):
            made[row[0]] = value(line, i)
    return made


def test_places(log, rows, slicing):
    assert as_dict(ordered.ordinal(log, ["k"]), "k_rank_True") == by_line(rows, lambda l, i: i)
    assert as_dict(ordered.ordinal(log, ["k"], False), "k_rank_False") == by_line(rows, lambda l, i: len(l) - 1 - i)


def test_place_plus_later_rows_is_size(log, slicing):
    made = groups.group_size(ordered.running_ordinals(log, ["k"], "a"), ["k"], base=log)
    assert made.where(F.col("prev_a") + F.col("future_a") + 1 != F.col("k_count")).count() == 0


def test_gaps(log, rows, slicing):
    after = by_line(rows, lambda l, i: (l[i + 1][2] - l[i][2]) // SEC if i + 1 < len(l) else None)
    before = by_line(rows, lambda l, i: (l[i][2] - l[i - 1][2]) // SEC if i else None)
    assert as_dict(ordered.click_gap(log, ["k"]), "k_next_click_next") == after
    assert as_dict(ordered.click_gap(log, ["k"], "last"), "k_next_click_last") == before
    assert as_dict(ordered.gap_seconds_field(log, ["k"], "d"), "d") == {k: v if v is None else v % 86400 for k, v in after.items()}
    hours = {k: v if v is None else v % 86400 // 3600 for k, v in after.items()}
    assert as_dict(ordered.gap_hours_field(log, ["k"], "h"), "h") == hours


def test_days_are_dropped_from_the_seconds_field(spark):
    log = spark.createDataFrame([(1, "a", 0), (2, "a", (86400 + 7200 + 5) * SEC)], "rid long, k string, t long")
    assert as_dict(ordered.gap_seconds_field(log, ["k"], "d"), "d") == {1: 7205, 2: None}
    assert as_dict(ordered.gap_hours_field(log, ["k"], "h"), "h") == {1: 2, 2: None}


def test_sentinel(log, rows, slicing):
    want = by_line(rows, lambda l, i: (l[i + 1][2] // SEC if i + 1 < len(l) else 3_000_000_000) - l[i][2] // SEC)
    assert as_dict(ordered.next_click_or_sentinel(log, ["k"], "n"), "n") == want


def test_sentinel_in_buckets_groups_by_bucket(log, rows):
    buckets = as_dict(log.withColumn("b", hash_bucket(["k"], 2)), "b")
    merged = [(r[0], buckets[r[0]], r[2], r[3]) for r in rows]
    want = by_line(merged, lambda l, i: (l[i + 1][2] // SEC if i + 1 < len(l) else 3_000_000_000) - l[i][2] // SEC)
    assert as_dict(ordered.next_click_or_sentinel(log, ["k"], "n", buckets=2), "n") == want


def test_timeline_agrees_with_single_features(log, slicing):
    line = ordered.timeline(log, ["k"])
    single = ordered.click_gap(ordered.click_gap(ordered.ordinal(log, ["k"], name="p"), ["k"], base=log), ["k"], "last", base=log)
    both = line.join(single.select("rid", "p", "k_next_click_next", "k_next_click_last"), "rid")
    wrong = both.where(
        (F.col("p") != F.col("_at"))
        | ~F.col("k_next_click_next").eqNullSafe(F.floor((F.col("_next_t") - F.col("t")) / SEC))
        | ~F.col("k_next_click_last").eqNullSafe(F.floor((F.col("t") - F.col("_prev_t")) / SEC))
    )
    assert wrong.count() == 0


def test_neighbour_holding_null_is_not_skipped(spark, slicing):
    log = spark.createDataFrame([(i, "a", i, None if i % 2 else float(i)) for i in range(20)], "rid long, k string, t long, x double")
    made = as_dict(ordered.neighbour(log, ["k"], "x", "near", -1), "near")
    assert made == {i: None if i == 0 or i % 2 == 0 else float(i - 1) for i in range(20)}


def test_whole_table_order(log, rows, slicing):
    by_id = sorted(rows)
    made = as_dict(ordered.previous_in_file(log, "x", "p"), "p")
    assert made == {r[0]: by_id[i - 1][3] if i else None for i, r in enumerate(by_id)}
    index = {r["rid"]: r["n"] for r in ordered.with_row_index(log, ["t", "rid"], "n").collect()}
    assert index == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}


def test_shifted_group_difference(log, rows, slicing):
    own = by_line(rows, lambda l, i: (l[i][2] - l[i - 1][2]) // SEC % 86400 if i else None)
    by_id = [r[0] for r in sorted(rows)]
    want = {rid: own[by_id[i + 1]] if i + 1 < len(by_id) else None for i, rid in enumerate(by_id)}
    assert as_dict(ordered.shifted_group_difference(log, ["k"], "d"), "d") == want


def test_group_numbers_follow_key_order(log, rows, slicing):
    names = sorted({r[1] for r in rows})
    made = as_dict(ordered.group_number(log, ["k"]), "k_ngroup")
    assert made == {r[0]: names.index(r[1]) for r in rows}


def test_normalised_rank(log, rows, slicing):
    made = as_dict(ordered.normalised_rank(log, ["k"], ["x"]), "rank")
    for key in {r[1] for r in rows}:
        line = sorted((r for r in rows if r[1] == key), key=lambda r: (r[3], r[0]))
        for i, row in enumerate(line):
            assert made[row[0]] == (None if len(line) == 1 else pytest.approx(i / (len(line) - 1)))


def test_keep_first_takes_the_smallest_id(spark):
    log = spark.createDataFrame([(3, "a", 1.0), (1, "a", 2.0), (2, "b", 3.0)], "rid long, k string, x double")
    assert sorted(map(tuple, ordered.keep_first(log, ["k"], ["rid"]).collect())) == [(1, "a", 2.0), (2, "b", 3.0)]
