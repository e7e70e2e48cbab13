"""The wide builder: both of its paths, and what its plan looks like."""

import pytest
from pyspark.sql import functions as F

from clickfeat.operators.slices import SLICE_ROWS_CONF
from clickfeat.plans import catalog, wide
from clickfeat.plans.features import add_features, distinct, first_place, gap, last_day_ratio, last_place, mean_gap, sentinel_gap, size, span, statistic, two_level
from clickfeat.sources.clicklog import events_as_clicks
from clickfeat.sources.store import FeatureStore

SOME = [
    size("ip"), size("ip", "app"), size("app"), distinct("ip", "channel"), distinct("ip", "day", "hour"), distinct("app", "channel"),
    statistic("var", "hour", "ip", "device"), statistic("mean", "hour", "app"), two_level("mean", "os", "ip"),
    two_level("var", "ip", "app", "channel", by=("app", "channel")), first_place("ip", "device"), last_place("ip"),
    gap("next", "ip", "device"), gap("last", "ip"), sentinel_gap("ip", "os"), span("ip", "day"), mean_gap("ip", "os"),
    mean_gap("os", "device"), last_day_ratio("ip"), last_day_ratio("ip", "device"), last_day_ratio("channel"), first_place("channel"),
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df, columns):
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.select(*columns).dtypes]
    return sorted(map(str, df.select(*rounded).collect()))


@pytest.mark.parametrize("slice_rows", [None, 40, 5])
def test_paths_agree(spark, sf_dir, tmp_path, slice_rows):
    log = events_as_clicks(spark, sf_dir)
    # One ip with a third of the rows, and rows without an ip.
    log = log.withColumn("ip", F.when(F.col("rid") % 3 == 0, 1).when(F.col("rid") % 50 != 1, F.col("ip")))
    columns = ["rid", *[f.name for f in SOME]]
    want = rows_of(add_features(log, SOME), columns)
    if slice_rows:
        spark.conf.set(SLICE_ROWS_CONF, str(slice_rows))
    spark.conf.set(wide.BROADCAST_ROWS_CONF, "30")
    try:
        made = wide.build(log, SOME, FeatureStore(spark, str(tmp_path)), "t", columns=["rid"])
        assert rows_of(made, columns) == want
    finally:
        spark.conf.unset(SLICE_ROWS_CONF)
        spark.conf.unset(wide.BROADCAST_ROWS_CONF)


def test_lead_features_need_one_exchange(spark, sf_dir):
    led = [f for f in catalog.WIDE if "ip" in f.keys]
    log = events_as_clicks(spark, sf_dir)
    plan = plan_of(wide.window_features(log, led, "ip"))
    assert plan.count("Exchange") == 1
    assert "SinglePartition" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_chains_are_nested():
    for chain in wide.nested_chains(catalog.WIDE):
        assert all(a < b for a, b in zip(chain.sets, chain.sets[1:]))
        order = chain.order(next(iter(chain.sets[0])))
        for group in chain.sets:
            assert set(order[: len(group)]) == group


def test_catalogue_names_are_unique():
    for features in (catalog.WIDE, catalog.COUNTS_ALL_ROWS, catalog.SELECTED, [*catalog.DELTAS, *catalog.RUNNING]):
        names = [f.name for f in features]
        assert len(names) == len(set(names))
    assert len(catalog.WIDE) == 15 + 16 + 4 + 6 + 3 + 5 + 3 + 4 + 3


def test_bucketed_log_needs_no_exchange_on_its_key(spark, sf_dir, tmp_path):
    """All features whose key contains ip, over the log in buckets and over the plain log."""
    from clickfeat.plans import catalog, jobs
    from clickfeat.sources.clicklog import events_as_clicks
    from clickfeat.sources.store import FeatureStore

    log = events_as_clicks(spark, sf_dir)
    stored = jobs.bucketed_log(log, FeatureStore(spark, str(tmp_path)), buckets=3)
    features = [f for f in [*catalog.DELTAS, *catalog.RUNNING] if "ip" in f.keys]
    assert len(features) > 4 and wide.partitioned_by(stored, "ip") and not wide.partitioned_by(log, "ip")
    made = [wide.window_features(df.where("ip IS NOT NULL"), features, "ip") for df in (stored, log)]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in made]
    assert "Exchange" not in plans[0] and "Exchange" in plans[1]
    assert sorted(map(repr, made[0].collect())) == sorted(map(repr, made[1].select(*made[0].columns).collect()))
