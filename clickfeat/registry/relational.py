"""Queries: joins, splits, unions and the whole feature table."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from clickfeat.functions.scalars import has_columns, null_where
from clickfeat.operators import groups, ordered, ranges, relational
from clickfeat.registry.base import TIED, query
from clickfeat.sources.clicklog import events_as_clicks, orders_as_clicks, table


def train_and_test(spark, sf_dir):
    """Days up to 20 as labelled clicks without an id; the later days as unlabelled clicks with one."""
    clicks = events_as_clicks(spark, sf_dir)
    train, test = relational.split_at(clicks, "2024-01-21 00:00:00")
    return train, test.withColumn("click_id", F.col("rid")).drop("is_attributed", "attributed_t")


_BOTH = """, whole AS (SELECT rid, ip, device, app, channel, date, CASE WHEN day <= 20 THEN is_attributed END AS is_attributed,
    CASE WHEN day > 20 THEN rid END AS click_id FROM clicks)"""


@query(
    "train_test_union",
    _BOTH + """ SELECT rid, is_attributed, click_id, count(*) OVER (PARTITION BY ip, device) AS ip_device_count,
    CASE WHEN is_attributed IS NOT NULL THEN 'train' ELSE 'test' END AS part FROM whole""",
)
def train_test_union(spark, sf_dir):
    whole = groups.group_size(relational.union_logs(*train_and_test(spark, sf_dir)), ["ip", "device"])
    columns = ["rid", "is_attributed", "click_id", "ip_device_count"]
    train = relational.labelled(whole).select(*columns, F.lit("train").alias("part"))
    test = relational.unlabelled(whole).select(*columns, F.lit("test").alias("part"))
    return relational.union_like(train, test)


@query(
    "rolling_by_part",
    """ SELECT rid, count(*) OVER (PARTITION BY day > 20, channel ORDER BY t RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)
        AS channel_60min FROM clicks""",
)
def rolling_by_part(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    counted = [ranges.rolling_counts(part, ["channel"], {"channel_60min": 3600}) for part in (train, test)]
    return relational.union_like(*[c.select("rid", "channel_60min") for c in counted])


@query(
    "split_by_days",
    """ SELECT 'train' AS part, rid FROM clicks WHERE day BETWEEN 7 AND 8 UNION ALL
        SELECT 'validate', rid FROM clicks WHERE day = 9 UNION ALL
        SELECT 'score', rid FROM clicks WHERE day = 10 UNION ALL
        SELECT 'all_labelled', rid FROM clicks""",
)
def split_by_days(spark, sf_dir):
    parts = relational.split_days(events_as_clicks(spark, sf_dir), (7, 8), 9, 10)
    return relational.union_like(*[df.select(F.lit(name).alias("part"), "rid") for name, df in parts.items()])


@query(
    "stacked_features",
    """, a AS (SELECT rid, count(*) OVER (PARTITION BY ip ORDER BY t RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW) - 1 AS r600,
          count(*) OVER (PARTITION BY ip ORDER BY t RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) - 1 AS r3600 FROM clicks)
       SELECT rid, r600, NULL AS r3600 FROM a UNION ALL SELECT rid, NULL, r3600 FROM a""",
)
def stacked_features(spark, sf_dir):
    made = ranges.recent_counts(events_as_clicks(spark, sf_dir), ["ip"], {"r600": 600, "r3600": 3600})
    return relational.stack_features([made.select("rid", "r600"), made.select("rid", "r3600")])


@query(
    "merged_features",
    """ SELECT rid, hour, count(*) OVER (PARTITION BY app) AS app_count,
        row_number() OVER (PARTITION BY channel ORDER BY t, rid) - 1 AS channel_rank_True FROM clicks""",
)
def merged_features(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    sizes = groups.group_table(clicks, ["app"], {"app_count": F.count(F.lit(1))})
    counted = relational.left_merge(clicks, sizes, ["app"])
    ranked = ordered.ordinal(clicks, ["channel"]).select("rid", "channel_rank_True")
    return relational.zip_features(clicks.select("rid", "hour"), [counted, ranked])


@query(
    "inner_merge_by_id",
    """ SELECT rid, cust, row_number() OVER (PARTITION BY priority ORDER BY t, rid) - 1 AS place FROM tied""",
    views=TIED,
)
def inner_merge_by_id(spark, sf_dir):
    log = orders_as_clicks(spark, sf_dir)
    place = ordered.ordinal(log, ["priority"], name="place").select("rid", "place")
    return relational.inner_merge(log, place, ["t", "status", "priority", "price"])


@query(
    "customer_attributes",
    """ SELECT rid, c_mktsegment, n_name, count(*) OVER (PARTITION BY c_mktsegment) AS segment_orders
        FROM tied LEFT JOIN customer ON cust = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    views=TIED,
)
def customer_attributes(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    customers = customers.select(F.col("c_custkey").alias("cust"), "c_mktsegment", "n_name")
    log = groups.attach(orders_as_clicks(spark, sf_dir), customers, ["cust"])
    made = groups.group_size(log, ["c_mktsegment"], "segment_orders")
    return made.select("rid", "c_mktsegment", "n_name", "segment_orders")


@query(
    "projected_scores",
    """, scored AS (SELECT ip, device, channel, round(avg(is_attributed) OVER (PARTITION BY app), 6) AS score, rid FROM clicks),
       firsts AS (SELECT ip, device, channel, score FROM
         (SELECT *, row_number() OVER (PARTITION BY ip, device, channel ORDER BY rid) AS n FROM scored) WHERE n = 1)
       SELECT rid AS click_id, score FROM clicks LEFT JOIN firsts USING (ip, device, channel) WHERE day > 20""",
)
def projected_scores(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    scored = groups.group_stat(clicks, ["app"], "is_attributed", "mean", "score").withColumn("score", F.round("score", 6))
    test = clicks.where("day > 20").withColumn("click_id", F.col("rid"))
    return relational.project_scores(test, scored, "score", on=["ip", "device", "channel"])


@query(
    "left_merge_by_id",
    """, early AS (SELECT rid, row_number() OVER (PARTITION BY ip ORDER BY t, rid) - 1 AS place FROM clicks WHERE day < 11)
       SELECT rid, place FROM clicks LEFT JOIN early USING (rid)""",
)
def left_merge_by_id(spark, sf_dir):
    """Places in the first days only; later clicks have none."""
    clicks = events_as_clicks(spark, sf_dir)
    early = ordered.ordinal(relational.before_day(clicks, 11), ["ip"], name="place").select("rid", "place")
    return relational.left_on_id(clicks.select("rid"), early)


@query(
    "masked_gaps",
    """ SELECT rid, CASE WHEN NOT coalesce(app > 50, false) THEN t - lag(t) OVER (PARTITION BY ip ORDER BY t, rid) END AS gap,
        true AS has_app, false AS has_price FROM clicks""",
)
def masked_gaps(spark, sf_dir):
    """A feature emptied where a condition holds, and the check of a table's columns."""
    log = ordered.neighbour(events_as_clicks(spark, sf_dir), ["ip"], "t", "_before", -1)
    gap = null_where(F.col("app") > 50, F.col("t") - F.col("_before"))
    return log.select(
        "rid", gap.alias("gap"), F.lit(has_columns(log, ["app"])).alias("has_app"), F.lit(has_columns(log, ["price"])).alias("has_price")
    )


@query(
    "split_by_dates",
    """ SELECT 'train' AS part, rid FROM clicks WHERE date BETWEEN DATE '2024-01-07' AND DATE '2024-01-08' UNION ALL
        SELECT 'validate', rid FROM clicks WHERE date = DATE '2024-01-09' UNION ALL
        SELECT 'score', rid FROM clicks WHERE date = DATE '2024-01-10' UNION ALL
        SELECT 'all_labelled', rid FROM clicks""",
)
def split_by_dates(spark, sf_dir):
    """The split by calendar dates, which holds for logs of several months."""
    day = lambda n: datetime.date(2024, 1, n)
    parts = relational.split_days(events_as_clicks(spark, sf_dir), (day(7), day(8)), day(9), day(10), day="date")
    return relational.union_like(*[df.select(F.lit(name).alias("part"), "rid") for name, df in parts.items()])


@query(
    "projected_scores_six_columns",
    """, scored AS (SELECT ip, app, device, os, channel, click_time, round(avg(is_attributed) OVER (PARTITION BY app), 6) AS score, rid FROM clicks),
       firsts AS (SELECT * EXCLUDE (rid, n) FROM (SELECT *, row_number() OVER
         (PARTITION BY ip, app, device, os, channel, click_time ORDER BY rid) AS n FROM scored) WHERE n = 1)
       SELECT rid AS click_id, score FROM clicks LEFT JOIN firsts USING (ip, app, device, os, channel, click_time) WHERE day > 20""",
)
def projected_scores_six_columns(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    scored = groups.group_stat(clicks, ["app"], "is_attributed", "mean", "score").withColumn("score", F.round("score", 6))
    test = clicks.where("day > 20").withColumn("click_id", F.col("rid"))
    return relational.project_scores(test, scored, "score")
