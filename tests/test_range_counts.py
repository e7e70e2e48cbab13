"""Range counts against counting every pair of rows, on small logs with many ties and one key with a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from clickfeat.functions.timeparts import mirror
from clickfeat.operators import ranges

SEC = 1_000_000


def make_log(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for rid in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice("abc")
        # A burst puts many rows of the hot key on one instant.
        at = 50 if key == "hot" and rng.random() < 0.5 else rng.randrange(0, 100)
        rows.append((rid, key, rng.choice("xy"), at * SEC))
    rng.shuffle(rows)
    return rows


def result(df, name):
    return {r["rid"]: r[name] for r in df.collect()}


@pytest.fixture(params=[1, 2])
def rows(request):
    return make_log(request.param)


@pytest.fixture
def log(spark, rows):
    return spark.createDataFrame(rows, "rid long, k string, v string, t long").repartition(5)


def expected(rows, rule):
    return {r[0]: sum(1 for o in rows if o[1] == r[1] and rule(r, o)) for r in rows}


def test_rolling_includes_self_and_ties(log, rows, slicing):
    made = ranges.rolling_counts(log, ["k"], {"n": 7})
    assert result(made, "n") == expected(rows, lambda r, o: r[3] - 7 * SEC < o[3] <= r[3])


def test_forward_rolling_includes_self_and_ties(log, rows, slicing):
    made = ranges.forward_rolling_counts(log, ["k"], {"n": 7, "m": 20})
    assert result(made, "n") == expected(rows, lambda r, o: r[3] <= o[3] < r[3] + 7 * SEC)
    assert result(made, "m") == expected(rows, lambda r, o: r[3] <= o[3] < r[3] + 20 * SEC)


def test_recent_counts_earlier_rows_only(log, rows, slicing):
    made = ranges.recent_counts(log, ["k"], {"n": 7})
    assert result(made, "n") == expected(rows, lambda r, o: r[3] - 7 * SEC <= o[3] and (o[3], o[0]) < (r[3], r[0]))


def test_future_counts_later_rows_only(log, rows, slicing):
    made = ranges.future_counts(log, ["k"], {"n": 7})
    assert result(made, "n") == expected(rows, lambda r, o: o[3] <= r[3] + 7 * SEC and (o[3], o[0]) > (r[3], r[0]))


def test_recent_in_run_stops_at_other_value(log, rows, slicing):
    made = result(ranges.recent_counts_in_run(log, ["k"], ["v"], {"n": 30}), "n")
    want = {}
    for key in {r[1] for r in rows}:
        line = sorted((r for r in rows if r[1] == key), key=lambda r: (r[3], r[0]))
        for i, row in enumerate(line):
            run = 0
            while run < i and line[i - run - 1][2] == row[2]:
                run += 1
            want[row[0]] = min(run, sum(1 for o in line[:i] if o[3] >= row[3] - 30 * SEC))
    assert made == want


def test_edge_mark_hits_one_row(log, rows, slicing):
    made = result(ranges.recent_counts(log, ["k"], {"n": 7}, mark_edge=True), "n")
    first = min(rows, key=lambda r: (r[1], r[3], r[0]))[0]
    assert [rid for rid, n in made.items() if n == -1] == [first]
    made = result(ranges.future_counts(log, ["k"], {"n": 7}, mark_edge=True), "n")
    last = max(rows, key=lambda r: (r[1], r[3], r[0]))[0]
    assert [rid for rid, n in made.items() if n == -1] == [last]


def test_forward_is_rolling_on_mirrored_time(log):
    forward = result(ranges.forward_rolling_counts(log, ["k"], {"n": 9}), "n")
    mirrored = ranges.rolling_counts(log.withColumn("t", mirror("t")), ["k"], {"n": 9})
    assert result(mirrored, "n") == forward


def test_rows_without_key_get_null_and_are_kept(spark, slicing):
    rows = [(i, None if i % 3 else "a", i * SEC) for i in range(30)]
    log = spark.createDataFrame(rows, "rid long, k string, t long")
    for made in (
        ranges.rolling_counts(log, ["k"], {"n": 5}),
        ranges.recent_counts(log, ["k"], {"n": 5}),
        ranges.future_counts(log, ["k"], {"n": 5}),
    ):
        assert made.count() == 30
        assert made.where(F.col("k").isNull() & F.col("n").isNotNull()).count() == 0
        assert made.where(F.col("k").isNotNull() & F.col("n").isNull()).count() == 0
