"""Group statistics: edge groups, NULL keys, medians and skew."""

import datetime
import math
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickfeat.operators import groups, history, smoothing

SEC = 1_000_000


@pytest.fixture
def values(spark):
    rows = [(1, "one", 4.0), (2, "two", 1.0), (3, "two", 3.0)]
    rows += [(10 + i, "flat", 7.0) for i in range(3)]
    rows += [(20 + i, "skewed", float(v)) for i, v in enumerate([1, 1, 2, 10])]
    rows += [(30 + i, None, 1.0) for i in range(5)]
    rows += [(40, "empty", None), (41, "half", None), (42, "half", 2.0)]
    return spark.createDataFrame(rows, "rid long, k string, x double")


def per_key(df, name):
    return {r["k"]: r[name] for r in df.collect()}


def test_spread_statistics_of_small_groups(values, slicing):
    var = per_key(groups.group_stat(values, ["k"], "x", "var", "v"), "v")
    assert var["one"] is None and var["two"] == 2.0 and var["flat"] == 0.0 and var[None] is None
    skew = per_key(groups.group_stat(values, ["k"], "x", "skew", "s"), "s")
    assert skew["one"] is None and skew["two"] is None and skew["flat"] == 0.0
    assert skew["skewed"] == pytest.approx(pd.Series([1.0, 1.0, 2.0, 10.0]).skew(), rel=1e-12)


def test_counts_size_and_distinct(values, slicing):
    made = groups.group_statistics(
        values, [(["k"], "x", "count", "n"), (["k"], "x", "size", "rows"), (["k"], "x", "nunique", "u")]
    )
    assert made.count() == values.count()
    assert per_key(made, "n") == {"one": 1, "two": 2, "flat": 3, "skewed": 4, None: None, "empty": 0, "half": 1}
    assert per_key(made, "rows") == {"one": 1, "two": 2, "flat": 3, "skewed": 4, None: None, "empty": 1, "half": 2}
    assert per_key(made, "u")["skewed"] == 3 and per_key(made, "u")["half"] == 1 and per_key(made, "u")["empty"] == 0


def test_median_is_exact(spark, slicing):
    rng = random.Random(3)
    rows = [(i, rng.choice("abbbbb"), float(rng.randrange(0, 9))) for i in range(101)]
    made = per_key(groups.group_stat(spark.createDataFrame(rows, "rid long, k string, x double"), ["k"], "x", "median", "m"), "m")
    assert made == {k: statistics.median(r[2] for r in rows if r[1] == k) for k in "ab"}


def test_spans_add_up(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.randrange(10**9)) for i in range(40)]
    log = spark.createDataFrame(rows, "rid long, k string, t long")
    made = groups.time_span(log, ["k"], "span")
    made = groups.until_last(groups.since_first(made, ["k"], "a", base=log), ["k"], "b", base=log)
    made = groups.mean_gap(groups.group_size(made, ["k"], "n", base=log), ["k"], "g", base=log)
    assert made.where(F.abs(F.col("a") + F.col("b") - F.col("span")) > 1e-9).count() == 0
    assert made.where(F.abs(F.col("g") * F.col("n") - F.col("span")) > 1e-6).count() == 0


def test_two_level_and_ratio(spark, slicing):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "y")]
    log = spark.createDataFrame(rows, "rid long, k string, v string")
    made = groups.two_level_stats(log, ["v", "k"], ["k"], ["mean", "size"])
    assert per_key(made, "v_k_k_2levelmean") == {"a": 1.5, "b": 1.0}
    assert per_key(made, "v_k_k_2levelsize") == {"a": 2, "b": 1}
    ratio = {r["rid"]: r["v_k_ratio_k"] for r in groups.size_ratio(log, ["v", "k"], ["k"]).collect()}
    assert ratio == {1: pytest.approx(2 / 3), 2: pytest.approx(2 / 3), 3: pytest.approx(1 / 3), 4: 1.0}


def test_previous_day_crosses_month_end(spark):
    d = datetime.date
    rows = [(1, "a", d(2024, 1, 31), 1), (2, "a", d(2024, 1, 31), 0), (3, "a", d(2024, 2, 1), 0), (4, "a", d(2024, 2, 3), 1)]
    log = spark.createDataFrame(rows, "rid long, k string, date date, is_attributed int")
    made = {r["rid"]: r for r in history.last_day_stat(log, ["k"]).collect()}
    assert made[3]["k_last_day_count"] == 2 and made[3]["k_last_day_ratio"] == 0.5
    assert made[1]["k_last_day_count"] is None and made[4]["k_last_day_count"] is None
    ratio = {r["rid"]: r["k_last_day_ratio"] for r in history.last_day_ratio(log, ["k"]).collect()}
    assert ratio[3] == pytest.approx(1 / 102) and ratio[4] is None


def test_history_skips_unlabelled_rows_and_does_not_fan_out(spark, slicing):
    d = datetime.date
    rows = [(1, "a", d(2024, 1, 1), 1), (2, "a", d(2024, 1, 1), None), (3, "a", d(2024, 1, 2), 0), (4, "a", d(2024, 1, 5), None)]
    rows += [(5, "b", d(2024, 1, 1), None), (6, "b", d(2024, 1, 2), None)]
    log = spark.createDataFrame(rows, "rid long, k string, date date, is_attributed int")
    made = {r["rid"]: r for r in history.history(log, [["k"]]).collect()}
    assert len(made) == 6
    assert [made[i]["k_cntx"] for i in (1, 3, 4, 5, 6)] == [None, 1, 2, None, 0]
    assert made[4]["k_cvrx"] == 0.5 and made[4]["k_cvtimesx"] == 1
    assert made[6]["k_cvrx"] is None and made[6]["k_cvtimesx"] == 0


def test_digamma(spark):
    row = spark.range(1).select(*[smoothing.digamma(F.lit(x)).alias(n) for n, x in (("one", 1.0), ("half", 0.5), ("big", 1000.0))])
    found = row.first()
    assert found["one"] == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert found["half"] == pytest.approx(-1.9635100260214235, abs=1e-12)
    assert found["big"] == pytest.approx(6.907255195648812, abs=1e-12)


def test_smoothing_matches_tail_sums(spark):
    pairs = [(10, 0), (5, 5), (20, 3), (8, 1), (20, 3)]
    found = smoothing.iterate_beta_prior(spark.createDataFrame(pairs, "i long, c long"), "i", "c", 15)
    alpha = beta = 1.0

    def rise(n, a):
        return sum(1 / (a + k) for k in range(n))

    for _ in range(15):
        below = sum(rise(i, alpha + beta) for i, _ in pairs)
        alpha, beta = (
            alpha * sum(rise(c, alpha) for _, c in pairs) / below,
            beta * sum(rise(i - c, beta) for i, c in pairs) / below,
        )
    assert found.rounds == 15
    assert found.alpha == pytest.approx(alpha, rel=1e-9) and found.beta == pytest.approx(beta, rel=1e-9)


def test_smoothing_stops_when_steps_are_small(spark):
    pairs = [(10, 2), (30, 6), (50, 14), (40, 6)]
    found = smoothing.iterate_beta_prior(spark.createDataFrame(pairs, "i long, c long"), "i", "c", 50, epsilon=0.5)
    assert found.rounds < 50


def test_ratio_feature_counts_both_groups_by_hand(spark):
    from clickfeat.plans.features import ratio

    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "x"), (5, "a", None), (6, None, "x")]
    log = spark.createDataFrame(rows, "rid long, app string, channel string")
    coarse = {(r["app"], r["channel"]): r["r"] for r in ratio("app", of=("app", "channel"), name="r").table(log).collect()}
    assert coarse == {("a", "x"): 2.0, ("a", "y"): 4.0, ("b", "x"): 1.0}
    fine = {(r["app"], r["channel"]): r["r"] for r in ratio("app", "channel", of=("channel",), name="r").table(log).collect()}
    assert fine == {("a", "x"): 0.5, ("a", "y"): 1.0, ("b", "x"): 0.25}


def test_trigamma(spark):
    row = spark.range(1).select(*[smoothing.trigamma(F.lit(x)).alias(n) for n, x in (("one", 1.0), ("half", 0.5), ("big", 1000.0))]).first()
    assert row["one"] == pytest.approx(math.pi**2 / 6, abs=1e-12) and row["half"] == pytest.approx(math.pi**2 / 2, abs=1e-12)
    assert row["big"] == pytest.approx(0.0010005001666666, abs=1e-15)


def likelihood(pairs, a, b):
    g = math.lgamma
    return sum(g(c + a) + g(i - c + b) - g(i + a + b) + g(a + b) - g(a) - g(b) for i, c in pairs)


@pytest.mark.parametrize("shape", [(0.5, 0.7), (3.0, 40.0), (200.0, 300.0), (0.05, 5.0)])
def test_second_order_fit_is_a_maximum(spark, shape):
    random.seed(str(shape))
    pairs = []
    for _ in range(1500):
        i, p = random.choice([5, 60, 400]), random.betavariate(*shape)
        pairs.append((i, sum(random.random() < p for _ in range(i))))
    found = smoothing.fit_beta_prior(spark.createDataFrame([*pairs, (None, 1), (3, None)], "i long, c long"), "i", "c")
    assert found.pooled is None and found.ended and found.rounds < 20
    best = likelihood(pairs, found.alpha, found.beta)
    for f in (0.98, 1.02):
        assert best >= likelihood(pairs, found.alpha * f, found.beta) and best >= likelihood(pairs, found.alpha, found.beta * f)
    assert abs(found.alpha / (found.alpha + found.beta) - shape[0] / sum(shape)) < 0.05


@pytest.mark.parametrize("pairs, rate", [([(100, 50), (200, 100), (300, 150)], 0.5), ([(10, 0), (20, 0)], 0.0), ([(10, 10), (5, 5)], 1.0)])
def test_rates_without_spread_are_pooled(spark, pairs, rate):
    df = spark.createDataFrame(pairs, "i long, c long")
    found = smoothing.fit_beta_prior(df, "i", "c")
    assert (found.pooled, found.rounds) == (rate, 0)
    assert {r["s"] for r in df.select(found.rate("i", "c").alias("s")).collect()} == {rate}


def test_no_rows_have_no_rate(spark):
    found = smoothing.fit_beta_prior(spark.createDataFrame([], "i long, c long"), "i", "c")
    assert math.isnan(found.pooled)


def test_lattice_equals_tables_of_each_key_set(spark):
    """NULL in a key of the set drops the row from that set only; a NULL day belongs to no set."""
    random.seed(8)
    day = lambda: random.choice([None, *[datetime.date(2024, 2, 27) + datetime.timedelta(n) for n in range(4)]])
    rows = [(i, random.choice("ab"), random.choice(["x", "y", None]), random.choice([1, None]), day(), random.choice([0, 1, None])) for i in range(300)]
    log = spark.createDataFrame(rows, "rid long, ip string, app string, os int, date date, is_attributed int")
    sets = [["ip"], ["app"], ["app", "ip"], ["os", "app"], ["os"]]
    daily, lattice = history.daily_lattice(log, sets), history.history_lattice(log, sets)
    for place, keys in enumerate(sets):
        plain = history.daily_table(log, keys)
        assert sorted(map(repr, daily.where(daily._set == place).select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
        table = history.history_table(log, keys)
        made = history.history_of_set(lattice, place, keys).select(*table.columns)
        assert sorted(map(repr, made.collect())) == sorted(map(repr, table.collect()))


def test_lattice_reads_the_log_once(spark, sf_dir):
    from clickfeat.plans import catalog
    from clickfeat.sources.clicklog import events_as_clicks

    made = history.history_lattice(events_as_clicks(spark, sf_dir), catalog.HISTORY_KEYS)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan


@pytest.mark.parametrize("kind", ["double", "float", "long", "int"])
@pytest.mark.parametrize("limit", ["200000", "0"])
def test_narrowed_median(spark, kind, limit):
    """Hot, tied, negative and extreme values; keys of one row, of two rows and of NULLs only."""
    random.seed(kind)
    extreme = {"double": [1e300, -1e300, 5e-324, -0.0, 0.0, float("inf")], "float": [0.5, -0.5, 0.0, -0.0, 1e30, -1e-30]}.get(kind, [2**31 - 1, -(2**31), 0, 0, -1, 1])
    draw = (lambda: random.choice([random.gauss(0, 50), 1.5, *extreme])) if kind in ("double", "float") else (lambda: random.choice([random.randint(-99, 99), *extreme]))
    rows = [(random.choice(["hot", "hot", "a", "b"]), i % 2, draw()) for i in range(900)]
    rows += [("one", 0, draw()), ("two", 0, draw()), ("two", 0, draw()), ("none", 0, None), (None, 0, draw()), ("big", 1, extreme[0]), ("big", 1, extreme[0])]
    df = spark.createDataFrame(rows, f"k string, j int, v {kind}")
    spark.conf.set("spark.clickfeat.broadcastRows", limit)
    try:
        made = groups.narrowed_median_table(df, ["k", "j"], "v", "m").collect()
    finally:
        spark.conf.unset("spark.clickfeat.broadcastRows")
    known = df.where("k IS NOT NULL AND v IS NOT NULL").groupBy("k", "j").agg(F.sort_array(F.collect_list("v")).alias("v")).collect()
    assert {(r.k, r.j): r.m for r in made} == {(r.k, r.j): (r.v[(len(r.v) - 1) // 2] + r.v[len(r.v) // 2]) / 2.0 for r in known}


def test_narrowed_median_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert groups.narrowed_median_table(df, ["k"], "v", "m").collect() == []
