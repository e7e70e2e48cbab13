"""Queries: sources, scalar columns and whole-group features."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.functions import scalars, timeparts
from clickfeat.functions.stats import stat
from clickfeat.operators import groups
from clickfeat.registry.base import TIED, query
from clickfeat.sources.clicklog import events_as_clicks, lineitems, orders_as_clicks, table

# A line item has no unique key; all its columns together spread its rows.
LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


# ---- scalar columns -------------------------------------------------------------------------------------------------


@query(
    "time_parts_and_buckets",
    """ SELECT rid, day, hour, minute, "15min" AS b15, "3min" AS b3, "30min" AS b30,
        CAST((20 * hour + minute // 3) % 256 AS INTEGER) AS b3_wrapped, t // 1000000 AS sec FROM clicks""",
)
def time_parts_and_buckets(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    return clicks.select(
        "rid", "day", "hour", "minute", F.col("15min").alias("b15"), F.col("3min").alias("b3"), F.col("30min").alias("b30"),
        timeparts.day_bucket("3min", wrap_uint8=True).alias("b3_wrapped"),
        timeparts.epoch_seconds("t").alias("sec"),
    )


@query(
    "zone_shift_parts",
    """, local AS (SELECT rid, click_time + INTERVAL 8 HOUR AS lt FROM clicks)
       SELECT rid, CAST(extract(day FROM lt) AS INTEGER) AS day, CAST(extract(hour FROM lt) AS INTEGER) AS hour,
       epoch_us(lt) AS local_t FROM local""",
)
def zone_shift_parts(spark, sf_dir):
    local = events_as_clicks(spark, sf_dir).select("rid", timeparts.shift_zone("click_time").alias("lt"))
    parts = timeparts.add_time_parts(local, "lt", ["day", "hour"])
    return parts.select("rid", "day", "hour", timeparts.epoch_micros("lt").alias("local_t"))


@query(
    "time_text_round_trip",
    """ SELECT rid, strftime(click_time, '%Y-%m-%d %H:%M:%S') AS as_text,
        strftime(click_time + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS as_local_text,
        epoch_us(date_trunc('second', click_time)) AS parsed_t FROM clicks""",
)
def time_text_round_trip(spark, sf_dir):
    sec = timeparts.epoch_seconds("t")
    texts = events_as_clicks(spark, sf_dir).select(
        "rid",
        timeparts.format_epoch(sec).alias("as_text"),
        timeparts.format_epoch(sec, timeparts.LOG_ZONE).alias("as_local_text"),
    )
    parsed = timeparts.epoch_micros(timeparts.parse_timestamp("as_text"))
    return texts.withColumn("parsed_t", parsed)


@query(
    "hour_bands",
    """ SELECT rid, CAST(CASE WHEN hour BETWEEN 7 AND 11 THEN 1 WHEN hour BETWEEN 12 AND 17 THEN 2
        WHEN hour BETWEEN 18 AND 20 THEN 3 WHEN hour BETWEEN 21 AND 24 THEN 4 ELSE 5 END AS INTEGER) AS hour_map
        FROM clicks""",
)
def hour_bands(spark, sf_dir):
    return events_as_clicks(spark, sf_dir).select("rid", timeparts.hour_band("hour").alias("hour_map"))


@query(
    "mirrored_time",
    """ SELECT rid, epoch_us(TIMESTAMP '2050-01-01 00:00:00') - t AS mirrored FROM clicks""",
)
def mirrored_time(spark, sf_dir):
    return events_as_clicks(spark, sf_dir).select("rid", timeparts.mirror("t").alias("mirrored"))


@query(
    "pair_interactions",
    """ SELECT p_partkey, round(p_size * p_retailprice, 6) AS "inter_p_size_p_retailprice*",
        round(p_size / NULLIF(p_retailprice, 0), 6) AS "inter_p_size_p_retailprice/",
        round(p_size + p_retailprice, 6) AS "inter_p_size_p_retailprice+",
        round(p_size - p_retailprice, 6) AS "inter_p_size_p_retailprice-" FROM part""",
    views="",
)
def pair_interactions(spark, sf_dir):
    made = scalars.add_interactions(table(spark, sf_dir, "part"), "p_size", "p_retailprice")
    names = [c for c in made.columns if c.startswith("inter_")]
    return made.select("p_partkey", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in names])


@query(
    "numbered_interactions",
    """ SELECT rid, hour * minute AS "inter_0_hour_minute*", round(hour / NULLIF(minute, 0), 6) AS "inter_0_hour_minute/",
        hour + minute AS "inter_0_hour_minute+", hour - minute AS "inter_0_hour_minute-",
        hour * app AS "inter_1_hour_app*", round(hour / NULLIF(app, 0), 6) AS "inter_1_hour_app/",
        hour + app AS "inter_1_hour_app+", hour - app AS "inter_1_hour_app-",
        minute * app AS "inter_2_minute_app*", round(minute / NULLIF(app, 0), 6) AS "inter_2_minute_app/",
        minute + app AS "inter_2_minute_app+", minute - app AS "inter_2_minute_app-" FROM clicks""",
)
def numbered_interactions(spark, sf_dir):
    made = scalars.add_all_interactions(events_as_clicks(spark, sf_dir), ["hour", "minute", "app"])
    names = [c for c in made.columns if c.startswith("inter_")]
    rounded = [F.round(F.col(f"`{c}`"), 6).alias(c) if c.endswith("/") else F.col(f"`{c}`") for c in names]
    return made.select("rid", *rounded)


@query(
    "text_keys",
    """ SELECT rid, ip::VARCHAR || '_' || app::VARCHAR || '_' || device::VARCHAR || '_' || os::VARCHAR AS category
        FROM clicks""",
)
def text_keys(spark, sf_dir):
    return events_as_clicks(spark, sf_dir).select("rid", scalars.text_key(["ip", "app", "device", "os"]).alias("category"))


@query(
    "hash_buckets",
    f""" SELECT rid, ('0x' || substr(md5(concat_ws('_', ip, app, device, os)), 1, 15))::BIGINT % {scalars.HASH_BUCKETS} AS bucket FROM clicks""",
)
def hash_buckets(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    return clicks.select("rid", scalars.hash_bucket(["ip", "app", "device", "os"]).alias("bucket"))


@query(
    "predictor_columns",
    """ SELECT rid, app, channel, device, os, hour, is_attributed AS label FROM clicks""",
)
def predictor_columns(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    chosen = scalars.predictors(clicks, [*scalars.NOT_PREDICTORS, "rid", "t", "date", "attributed_t"])
    return clicks.select("rid", *chosen, F.col("is_attributed").alias("label"))


# ---- group sizes and distinct counts --------------------------------------------------------------------------------


@query(
    "ip_day_hour_count",
    """ SELECT rid, ip, day, hour, count(*) OVER (PARTITION BY ip, day, hour) AS ip_day_hour_count FROM clicks""",
)
def ip_day_hour_count(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    return groups.group_size(clicks, ["ip", "day", "hour"]).select("rid", "ip", "day", "hour", "ip_day_hour_count")


@query(
    "channel_count",
    """ SELECT rid, channel, count(*) OVER (PARTITION BY channel) AS channel_count FROM clicks""",
)
def channel_count(spark, sf_dir):
    return groups.group_size(events_as_clicks(spark, sf_dir), ["channel"]).select("rid", "channel", "channel_count")


@query(
    "label_count_by_ip_app",
    """, gaps AS (SELECT rid, ip, app, CASE WHEN is_attributed = 1 THEN 1 END AS y FROM clicks)
       SELECT rid, count(y) OVER (PARTITION BY ip, app) AS n_converted FROM gaps""",
)
def label_count_by_ip_app(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir).withColumn("y", F.when(F.col("is_attributed") == 1, 1))
    return groups.group_stat(clicks, ["ip", "app"], "y", "count", "n_converted").select("rid", "n_converted")


@query(
    "channel_per_ip_unique",
    """, u AS (SELECT ip, count(DISTINCT channel) AS ip_channel_unique FROM clicks GROUP BY ip)
       SELECT rid, ip_channel_unique FROM clicks JOIN u USING (ip)""",
)
def channel_per_ip_unique(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    return groups.group_stat(clicks, ["ip"], "channel", "nunique", "ip_channel_unique").select("rid", "ip_channel_unique")


@query(
    "tuples_per_ip_unique",
    """, u AS (SELECT ip, count(*) AS ip_channel_os_count_ip FROM (SELECT DISTINCT ip, channel, os FROM clicks) GROUP BY ip)
       SELECT rid, ip_channel_os_count_ip FROM clicks JOIN u USING (ip)""",
)
def tuples_per_ip_unique(spark, sf_dir):
    made = groups.group_distinct(events_as_clicks(spark, sf_dir), ["ip", "channel", "os"], ["ip"])
    return made.select("rid", "ip_channel_os_count_ip")


# ---- moments over line items ----------------------------------------------------------------------------------------

_SKEW = """CASE WHEN count({x}) >= 3 THEN CASE WHEN min({x}) = max({x}) THEN 0.0 ELSE skewness({x}) END END"""


@query(
    "lineitem_stats",
    f"""SELECT l_suppkey, l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean_qty,
        round(sum(l_quantity), 6) AS sum_qty, max(l_quantity) AS max_qty, min(l_quantity) AS min_qty,
        round(stddev_samp(l_quantity), 6) AS std_qty, round(var_samp(l_quantity), 6) AS var_qty,
        round({_SKEW.format(x='l_quantity')}, 6) AS skew_qty, count(DISTINCT l_linenumber) AS lines,
        round(median(l_extendedprice), 6) AS median_price
        FROM lineitem GROUP BY l_suppkey, l_returnflag""",
    views="",
)
def lineitem_stats(spark, sf_dir):
    items = lineitems(spark, sf_dir)
    keys = ["l_suppkey", "l_returnflag"]
    how = ["count", "mean", "sum", "max", "min", "std", "var", "skew"]
    stats = groups.group_table(items, keys, {h: stat(h, "l_quantity") for h in how})
    lines = groups.distinct_table(items, keys, ["l_linenumber"], "lines")
    medians = groups.median_table(items, keys, "l_extendedprice", "median_price")
    joined = stats.join(lines, keys).join(medians, keys)
    rounded = [F.round(h, 6).alias(f"{h}_qty") for h in ("mean", "sum", "std", "var", "skew")]
    return joined.select(
        *keys, F.col("count").alias("n"), *rounded, F.col("max").alias("max_qty"), F.col("min").alias("min_qty"),
        "lines", F.round("median_price", 6).alias("median_price"),
    )


def _attached(name, how, sql_value, digits=6):
    """One statistic of the order price by customer and status, put on every order."""
    sql = f""" , s AS (SELECT cust, status, {sql_value} AS v FROM tied GROUP BY cust, status)
              SELECT rid, round(v, {digits}) AS {name} FROM tied JOIN s USING (cust, status)"""

    @query(name, sql, views=TIED)
    def run(spark, sf_dir):
        log = orders_as_clicks(spark, sf_dir)
        made = groups.group_stat(log, ["cust", "status"], "price", how, name)
        return made.select("rid", F.round(name, digits).alias(name))

    return run


order_price_mean = _attached("order_price_mean", "mean", "avg(price)")
order_price_sum = _attached("order_price_sum", "sum", "sum(price)")
order_price_max = _attached("order_price_max", "max", "max(price)")
order_price_min = _attached("order_price_min", "min", "min(price)")
order_price_std = _attached("order_price_std", "std", "stddev_samp(price)", 6)
order_price_var = _attached("order_price_var", "var", "var_samp(price)", 0)
order_price_median = _attached("order_price_median", "median", "median(price)")
order_price_skew = _attached("order_price_skew", "skew", _SKEW.format(x="price"))


@query(
    "hour_moments_by_key",
    """, v AS (SELECT ip, day, channel, round(var_samp(hour), 6) AS ip_tchan_count, round(avg(hour), 6) AS ip_tchan_mean
               FROM clicks GROUP BY ip, day, channel)
       SELECT rid, ip_tchan_count, ip_tchan_mean FROM clicks JOIN v USING (ip, day, channel)""",
)
def hour_moments_by_key(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    names = {"var": "ip_tchan_count", "mean": "ip_tchan_mean"}
    made = groups.group_stats(clicks, ["ip", "day", "channel"], "hour", ["var", "mean"], names)
    return made.select("rid", *[F.round(n, 6).alias(n) for n in names.values()])


@query(
    "many_stats_one_key",
    f""", s AS (SELECT app, min(hour) AS app_hour_min, max(hour) AS app_hour_max, round(var_samp(hour), 6) AS app_hour_var,
               count(*) AS app_hour_size, round(avg(hour), 6) AS app_hour_mean,
               round({_SKEW.format(x='hour')}, 6) AS app_hour_skew FROM clicks GROUP BY app)
        SELECT rid, app_hour_min, app_hour_max, app_hour_var, app_hour_size, app_hour_mean, app_hour_skew
        FROM clicks JOIN s USING (app)""",
)
def many_stats_one_key(spark, sf_dir):
    how = ["min", "max", "var", "size", "mean", "skew"]
    made = groups.group_stats(events_as_clicks(spark, sf_dir), ["app"], "hour", how)
    exact = ["app_hour_min", "app_hour_max", "app_hour_size"]
    return made.select("rid", *exact, *[F.round(f"app_hour_{h}", 6).alias(f"app_hour_{h}") for h in ("var", "mean", "skew")])


@query(
    "two_level_mean",
    """, sizes AS (SELECT ip, device, app, count(*) AS n FROM clicks GROUP BY ip, device, app),
       s AS (SELECT app, round(avg(n), 6) AS two_level_mean, round(var_samp(n), 6) AS two_level_var, count(*) AS two_level_size
             FROM sizes GROUP BY app)
       SELECT rid, two_level_mean, two_level_var, two_level_size FROM clicks JOIN s USING (app)""",
)
def two_level_mean(spark, sf_dir):
    made = groups.two_level_stats(events_as_clicks(spark, sf_dir), ["ip", "device", "app"], ["app"], ["mean", "var", "size"])
    prefix = "ip_device_app_app_2level"
    return made.select(
        "rid", F.round(prefix + "mean", 6).alias("two_level_mean"), F.round(prefix + "var", 6).alias("two_level_var"),
        F.col(prefix + "size").alias("two_level_size"),
    )


@query(
    "size_ratio",
    """ SELECT rid, round(count(*) OVER (PARTITION BY app, channel) / count(*) OVER (PARTITION BY app), 6)
        AS app_channel_ratio_app FROM clicks""",
)
def size_ratio(spark, sf_dir):
    made = groups.size_ratio(events_as_clicks(spark, sf_dir), ["app", "channel"], ["app"])
    return made.select("rid", F.round("app_channel_ratio_app", 6).alias("app_channel_ratio_app"))


@query(
    "size_ratio_coarse_over_fine",
    """ SELECT rid, round(count(*) OVER (PARTITION BY app) / count(*) OVER (PARTITION BY app, channel), 6)
        AS app_ratio_app_channel FROM clicks""",
)
def size_ratio_coarse_over_fine(spark, sf_dir):
    """The direction that the wide table uses: never below 1."""
    made = groups.size_ratio(events_as_clicks(spark, sf_dir), ["app"], ["app", "channel"])
    return made.select("rid", F.round("app_ratio_app_channel", 6).alias("app_ratio_app_channel"))


@query(
    "time_span",
    """ SELECT rid, round((max(t) OVER (PARTITION BY ip, day) - min(t) OVER (PARTITION BY ip, day)) / 1e6, 6)
        AS ip_day_time_span FROM clicks""",
)
def time_span(spark, sf_dir):
    made = groups.time_span(events_as_clicks(spark, sf_dir), ["ip", "day"])
    return made.select("rid", F.round("ip_day_time_span", 6).alias("ip_day_time_span"))


@query(
    "span_to_edges",
    """ SELECT rid, round((t - min(t) OVER w) / 1e6, 6) AS ip_device_time_span_min,
        round((max(t) OVER w - t) / 1e6, 6) AS ip_device_time_span_max FROM clicks WINDOW w AS (PARTITION BY ip, device)""",
)
def span_to_edges(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    made = groups.until_last(groups.since_first(clicks, ["ip", "device"]), ["ip", "device"], base=clicks)
    names = ["ip_device_time_span_min", "ip_device_time_span_max"]
    return made.select("rid", *[F.round(n, 6).alias(n) for n in names])


@query(
    "mean_gap",
    """, s AS (SELECT os, device, round((max(t) - min(t)) / 1e6 / count(*), 6) AS os_device_timespan_average
               FROM clicks GROUP BY os, device)
       SELECT rid, os_device_timespan_average FROM clicks JOIN s USING (os, device)""",
)
def mean_gap(spark, sf_dir):
    made = groups.mean_gap(events_as_clicks(spark, sf_dir), ["os", "device"])
    return made.select("rid", F.round("os_device_timespan_average", 6).alias("os_device_timespan_average"))


@query(
    "attribution_delay",
    """, s AS (SELECT app, round(median((attributed_t - t) / 1e6 + 28800), 6) AS app_attri_minus
               FROM clicks WHERE attributed_t IS NOT NULL GROUP BY app)
       SELECT rid, app_attri_minus FROM clicks LEFT JOIN s USING (app)""",
)
def attribution_delay(spark, sf_dir):
    made = groups.attribution_delay(events_as_clicks(spark, sf_dir), ["app"])
    return made.select("rid", F.round("app_attri_minus", 6).alias("app_attri_minus"))


@query(
    "cross_log_stats",
    """, old AS (SELECT channel, device, count(is_attributed) AS n, round(avg(is_attributed), 6) AS rate,
                 sum(is_attributed)::BIGINT AS conversions FROM clicks WHERE day < 15 GROUP BY channel, device)
       SELECT rid, n, rate, conversions FROM clicks LEFT JOIN old USING (channel, device) WHERE day >= 15""",
)
def cross_log_stats(spark, sf_dir):
    clicks = events_as_clicks(spark, sf_dir)
    old, new = clicks.where("day < 15"), clicks.where("day >= 15")
    names = {"count": "n", "mean": "rate", "sum": "conversions"}
    return groups.cross_stats(old, new, ["channel", "device"], "is_attributed", names).select("rid", "n", F.round("rate", 6).alias("rate"), "conversions")


@query(
    "statistics_batch",
    """ , a AS (SELECT status, count(rid) AS status_cnt, round(avg(price), 6) AS status_price_mean,
               round(median(price), 6) AS status_price_median FROM tied GROUP BY status),
        b AS (SELECT cust, round(avg(price), 6) AS cust_price_mean FROM tied GROUP BY cust)
        SELECT rid, status_cnt, status_price_mean, status_price_median, cust_price_mean
        FROM tied JOIN a USING (status) JOIN b USING (cust)""",
    views=TIED,
)
def statistics_batch(spark, sf_dir):
    specs = [
        (["status"], "rid", "count", "status_cnt"),
        (["status"], "price", "mean", "status_price_mean"),
        (["status"], "price", "median", "status_price_median"),
        (["cust"], "price", "mean", "cust_price_mean"),
    ]
    made = groups.group_statistics(orders_as_clicks(spark, sf_dir), specs)
    rounded = ["status_price_mean", "status_price_median", "cust_price_mean"]
    return made.select("rid", "status_cnt", *[F.round(n, 6).alias(n) for n in rounded])


@query("table_overview", " SELECT count(*) AS n_rows, min(t) AS first_t, min(rid) AS first_rid FROM clicks")
def table_overview(spark, sf_dir):
    return groups.overview(events_as_clicks(spark, sf_dir))


@query(
    "lineitem_attached_stats",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
       round(avg(l_quantity) OVER (PARTITION BY l_suppkey, l_returnflag), 6) AS mean_qty,
       count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n FROM lineitem""",
    views="",
)
def lineitem_attached_stats(spark, sf_dir):
    made = groups.add_group_aggregates(
        lineitems(spark, sf_dir), ["l_suppkey", "l_returnflag"],
        {"mean_qty": F.avg("l_quantity"), "n": F.count(F.lit(1))}, LINE,
    )
    return made.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", F.round("mean_qty", 6).alias("mean_qty"), "n")
