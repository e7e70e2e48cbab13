"""Queries: ordered-window, time-range, history and smoothing features."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from clickfeat.functions.scalars import HASH_BUCKETS, fill_missing
from clickfeat.operators import groups, history, ordered, ranges, smoothing
from clickfeat.registry.base import TIED, query
from clickfeat.sources.clicklog import events_as_clicks, lineitems, orders_as_clicks

# ---- places in the time order ---------------------------------------------------------------------------------------


@query(
    "rank_from_start",
    " SELECT rid, row_number() OVER (PARTITION BY cust, status ORDER BY t, rid) - 1 AS cust_status_rank_True FROM tied",
    views=TIED,
)
def rank_from_start(spark, sf_dir):
    made = ordered.ordinal(orders_as_clicks(spark, sf_dir), ["cust", "status"])
    return made.select("rid", "cust_status_rank_True")


@query(
    "rank_from_end",
    " SELECT rid, row_number() OVER (PARTITION BY status ORDER BY t DESC, rid DESC) - 1 AS status_rank_False FROM tied",
    views=TIED,
)
def rank_from_end(spark, sf_dir):
    return ordered.ordinal(orders_as_clicks(spark, sf_dir), ["status"], ascending=False).select("rid", "status_rank_False")


@query(
    "running_ordinals",
    """ SELECT rid, row_number() OVER (PARTITION BY ip, app ORDER BY t, rid) - 1 AS prev_f,
        row_number() OVER (PARTITION BY ip, app ORDER BY t DESC, rid DESC) - 1 AS future_f FROM clicks""",
)
def running_ordinals(spark, sf_dir):
    made = ordered.running_ordinals(events_as_clicks(spark, sf_dir), ["ip", "app"], "f")
    return made.select("rid", "prev_f", "future_f")


@query(
    "normalised_rank",
    """ SELECT rid, round((row_number() OVER (PARTITION BY status ORDER BY price, rid) - 1)
        / NULLIF(count(*) OVER (PARTITION BY status) - 1, 0), 6) AS rank FROM tied""",
    views=TIED,
)
def normalised_rank(spark, sf_dir):
    made = ordered.normalised_rank(orders_as_clicks(spark, sf_dir), ["status"], ["price"])
    return made.select("rid", F.round("rank", 6).alias("rank"))


@query(
    "next_click",
    """, g AS (SELECT rid, lead(t) OVER (PARTITION BY ip, device ORDER BY t, rid) - t AS gap FROM clicks)
       SELECT rid, CAST(floor(gap / 1000000.0) AS BIGINT) AS ip_device_next_click_next FROM g""",
)
def next_click(spark, sf_dir):
    return ordered.click_gap(events_as_clicks(spark, sf_dir), ["ip", "device"]).select("rid", "ip_device_next_click_next")


@query(
    "last_click",
    """, g AS (SELECT rid, t - lag(t) OVER (PARTITION BY status ORDER BY t, rid) AS gap FROM tied)
       SELECT rid, coalesce(CAST(floor(gap / 1000000.0) AS BIGINT), 99999) AS status_next_click_last FROM g""",
    views=TIED,
)
def last_click(spark, sf_dir):
    made = ordered.click_gap(orders_as_clicks(spark, sf_dir), ["status"], "last")
    return fill_missing(made, ["status_next_click_last"]).select("rid", "status_next_click_last")


@query(
    "next_click_sentinel",
    """, s AS (SELECT *, t // 1000000 AS sec FROM clicks)
       SELECT rid, lead(sec, 1, 3000000000) OVER (PARTITION BY ip, app, device, os ORDER BY t, rid) - sec AS nextClick FROM s""",
)
def next_click_sentinel(spark, sf_dir):
    made = ordered.next_click_or_sentinel(events_as_clicks(spark, sf_dir), ["ip", "app", "device", "os"], "nextClick")
    return made.select("rid", "nextClick")


@query(
    "next_click_bucketed",
    f""", b AS (SELECT rid, t, t // 1000000 AS sec,
          ('0x' || substr(md5(concat_ws('_', ip, app, device, os)), 1, 15))::BIGINT % {HASH_BUCKETS} AS bucket FROM clicks)
        SELECT rid, lead(sec, 1, 3000000000) OVER (PARTITION BY bucket ORDER BY t, rid) - sec AS "nextClick" FROM b""",
)
def next_click_bucketed(spark, sf_dir):
    made = ordered.next_click_or_sentinel(
        events_as_clicks(spark, sf_dir), ["ip", "app", "device", "os"], "nextClick", buckets=HASH_BUCKETS
    )
    return made.select("rid", "nextClick")


@query(
    "next_click_shifted",
    """, s AS (SELECT *, t // 1000000 AS sec FROM clicks),
       n AS (SELECT rid, lead(sec, 1, 3000000000) OVER (PARTITION BY ip, device ORDER BY t, rid) - sec AS nextClick FROM s)
       SELECT rid, nextClick, lag(nextClick) OVER (ORDER BY rid) AS "nextClick_shift" FROM n""",
)
def next_click_shifted(spark, sf_dir):
    made = ordered.next_click_or_sentinel(events_as_clicks(spark, sf_dir), ["ip", "device"], "nextClick")
    return ordered.previous_in_file(made, "nextClick").select("rid", "nextClick", "nextClick_shift")


@query(
    "gap_seconds_field",
    """, g AS (SELECT rid, lead(t) OVER (PARTITION BY ip, app ORDER BY t, rid) - t AS gap FROM clicks)
       SELECT rid, CAST(floor(gap / 1000000.0) AS BIGINT) % 86400 AS ip_app_delta FROM g""",
)
def gap_seconds_field(spark, sf_dir):
    return ordered.gap_seconds_field(events_as_clicks(spark, sf_dir), ["ip", "app"]).select("rid", "ip_app_delta")


@query(
    "shifted_group_difference",
    """, g AS (SELECT rid, t - lag(t) OVER (PARTITION BY ip, device ORDER BY t, rid) AS gap FROM clicks),
       m AS (SELECT rid, lead(gap) OVER (ORDER BY rid) AS gap FROM g)
       SELECT rid, CAST(floor(gap / 1000000.0) AS BIGINT) % 86400 AS ip_device_delta FROM m""",
)
def shifted_group_difference(spark, sf_dir):
    made = ordered.shifted_group_difference(events_as_clicks(spark, sf_dir), ["ip", "device"])
    return made.select("rid", "ip_device_delta")


@query(
    "gap_hours_field",
    """, g AS (SELECT rid, lead(t) OVER (PARTITION BY ip ORDER BY t, rid) - t AS gap FROM clicks)
       SELECT rid, (CAST(floor(gap / 1000000.0) AS BIGINT) % 86400) // 3600 AS ip_click_easy FROM g""",
)
def gap_hours_field(spark, sf_dir):
    return ordered.gap_hours_field(events_as_clicks(spark, sf_dir), ["ip"]).select("rid", "ip_click_easy")


@query(
    "consecutive_difference",
    """ SELECT rid, t - lag(t) OVER (ORDER BY t, rid) AS back, lead(t) OVER (ORDER BY t, rid) - t AS ahead FROM tied""",
    views=TIED,
)
def consecutive_difference(spark, sf_dir):
    log = orders_as_clicks(spark, sf_dir)
    made = ordered.consecutive_difference(log, "t", ["t", "rid"], 0, "back")
    made = ordered.consecutive_difference(made, "t", ["t", "rid"], -1, "ahead", base=log)
    return made.select("rid", "back", "ahead")


@query(
    "group_number",
    " SELECT rid, dense_rank() OVER (ORDER BY app, channel) - 1 AS app_channel_ngroup FROM clicks",
)
def group_number(spark, sf_dir):
    return ordered.group_number(events_as_clicks(spark, sf_dir), ["app", "channel"]).select("rid", "app_channel_ngroup")


@query(
    "row_index",
    " SELECT row_number() OVER (ORDER BY t, rid) - 1 AS index_col, rid FROM tied",
    views=TIED,
)
def row_index(spark, sf_dir):
    return ordered.with_row_index(orders_as_clicks(spark, sf_dir), ["t", "rid"], "index_col").select("index_col", "rid")


@query(
    "keep_first_per_key",
    """ SELECT rid, cust, price FROM (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY rid) AS n FROM tied)
        WHERE n = 1""",
    views=TIED,
)
def keep_first_per_key(spark, sf_dir):
    return ordered.keep_first(orders_as_clicks(spark, sf_dir), ["cust"], ["rid"]).select("rid", "cust", "price")


@query(
    "dearest_orders",
    " SELECT rid, price FROM tied ORDER BY price DESC, rid LIMIT 60",
    views=TIED,
)
def dearest_orders(spark, sf_dir):
    top = ordered.top_rows(orders_as_clicks(spark, sf_dir), [F.col("price").desc(), F.col("rid")], 60)
    return top.select("rid", "price")


# ---- counts in a time range -----------------------------------------------------------------------------------------

DAY_US = 86_400_000_000
MINUTES = {"channel_2min": 120, "channel_15min": 900, "channel_30min": 1800, "channel_60min": 3600}
RECENT_SECONDS = (180, 600, 900, 1800, 3600)


def _frame_sql(keys, widths, forward):
    parts = []
    for label, seconds in widths.items():
        low, high = ("CURRENT ROW", f"{seconds * 10**6 - 1} FOLLOWING") if forward else (f"{seconds * 10**6 - 1} PRECEDING", "CURRENT ROW")
        parts.append(f'count(*) OVER (PARTITION BY {keys} ORDER BY t RANGE BETWEEN {low} AND {high}) AS "{label}"')
    return ", ".join(parts)


@query("rolling_1d", f" SELECT rid, {_frame_sql('ip', {'ip_1d': 86400, 'ip_6h': 21600}, False)} FROM clicks")
def rolling_1d(spark, sf_dir):
    made = ranges.rolling_counts(events_as_clicks(spark, sf_dir), ["ip"], {"ip_1d": 86400, "ip_6h": 21600})
    return made.select("rid", "ip_1d", "ip_6h")


@query("rolling_minutes", f" SELECT rid, {_frame_sql('channel', MINUTES, False)} FROM clicks")
def rolling_minutes(spark, sf_dir):
    return ranges.rolling_counts(events_as_clicks(spark, sf_dir), ["channel"], MINUTES).select("rid", *MINUTES)


@query("rolling_ties", f" SELECT rid, {_frame_sql('status, priority', {'n_30d': 30 * 86400}, False)} FROM tied", views=TIED)
def rolling_ties(spark, sf_dir):
    made = ranges.rolling_counts(orders_as_clicks(spark, sf_dir), ["status", "priority"], {"n_30d": 30 * 86400})
    return made.select("rid", "n_30d")


@query("forward_1d", f" SELECT rid, {_frame_sql('ip', {'ip_1d': 86400}, True)} FROM clicks")
def forward_1d(spark, sf_dir):
    return ranges.forward_rolling_counts(events_as_clicks(spark, sf_dir), ["ip"], {"ip_1d": 86400}).select("rid", "ip_1d")


@query("forward_minutes", f" SELECT rid, {_frame_sql('channel', MINUTES, True)} FROM clicks")
def forward_minutes(spark, sf_dir):
    return ranges.forward_rolling_counts(events_as_clicks(spark, sf_dir), ["channel"], MINUTES).select("rid", *MINUTES)


@query("forward_ties", f" SELECT rid, {_frame_sql('status', {'n_7d': 7 * 86400}, True)} FROM tied", views=TIED)
def forward_ties(spark, sf_dir):
    made = ranges.forward_rolling_counts(orders_as_clicks(spark, sf_dir), ["status"], {"n_7d": 7 * 86400})
    return made.select("rid", "n_7d")


def _one_sided_sql(keys, seconds, name, forward=False):
    order = f"PARTITION BY {keys} ORDER BY t RANGE BETWEEN"
    tie = f"row_number() OVER (PARTITION BY {keys}, t ORDER BY rid)"
    if forward:
        return f'count(*) OVER ({order} CURRENT ROW AND {seconds * 10**6} FOLLOWING) - {tie} AS "{name}"'
    return (
        f"count(*) OVER ({order} {seconds * 10**6} PRECEDING AND CURRENT ROW) "
        f'- count(*) OVER (PARTITION BY {keys}, t) + {tie} - 1 AS "{name}"'
    )


@query("recent_excl_self", f" SELECT rid, {_one_sided_sql('cust', 90 * 86400, 'recent_90d')} FROM tied", views=TIED)
def recent_excl_self(spark, sf_dir):
    return ranges.recent_counts(orders_as_clicks(spark, sf_dir), ["cust"], {"recent_90d": 90 * 86400}).select("rid", "recent_90d")


@query("recent_excl_self_ties", f" SELECT rid, {_one_sided_sql('status', 2 * 86400, 'recent_2d')} FROM tied", views=TIED)
def recent_excl_self_ties(spark, sf_dir):
    return ranges.recent_counts(orders_as_clicks(spark, sf_dir), ["status"], {"recent_2d": 2 * 86400}).select("rid", "recent_2d")


@query(
    "recent_channel_clicks",
    " SELECT rid, " + ", ".join(_one_sided_sql("channel", s, f"recent_click_cnt_{s}") for s in RECENT_SECONDS) + " FROM clicks",
)
def recent_channel_clicks(spark, sf_dir):
    widths = {f"recent_click_cnt_{s}": s for s in RECENT_SECONDS}
    return ranges.recent_counts(events_as_clicks(spark, sf_dir), ["channel"], widths).select("rid", *widths)


@query(
    "recent_with_edge_mark",
    f""", c AS (SELECT rid, {_one_sided_sql('cust, status', 365 * 86400, 'n')},
          row_number() OVER (ORDER BY cust, status, t, rid) AS place FROM tied)
          SELECT rid, CASE WHEN place = 1 THEN -1 ELSE n END AS recent_365d FROM c""",
    views=TIED,
)
def recent_with_edge_mark(spark, sf_dir):
    made = ranges.recent_counts(orders_as_clicks(spark, sf_dir), ["cust", "status"], {"recent_365d": 365 * 86400}, mark_edge=True)
    return made.select("rid", "recent_365d")


@query(
    "recent_in_run",
    f""", flagged AS (SELECT *, CASE WHEN lag(priority) OVER w IS DISTINCT FROM priority THEN 1 ELSE 0 END AS changed
          FROM tied WINDOW w AS (PARTITION BY status ORDER BY t, rid)),
          runs AS (SELECT *, sum(changed) OVER (PARTITION BY status ORDER BY t, rid ROWS UNBOUNDED PRECEDING) AS run FROM flagged)
          SELECT rid, {_one_sided_sql('status, run', 86400, 'run_1d')}, {_one_sided_sql('status, run', 7 * 86400, 'run_7d')}
          FROM runs""",
    views=TIED,
)
def recent_in_run(spark, sf_dir):
    widths = {"run_1d": 86400, "run_7d": 7 * 86400}
    return ranges.recent_counts_in_run(orders_as_clicks(spark, sf_dir), ["status"], ["priority"], widths).select("rid", *widths)


@query(
    "future_excl_self",
    f""" SELECT rid, {_one_sided_sql('cust', 120 * 86400, 'future_120d', True)} FROM tied""",
    views=TIED,
)
def future_excl_self(spark, sf_dir):
    return ranges.future_counts(orders_as_clicks(spark, sf_dir), ["cust"], {"future_120d": 120 * 86400}).select("rid", "future_120d")


@query(
    "future_excl_self_ties",
    f""", c AS (SELECT rid, {_one_sided_sql('status', 86400, 'n', True)},
          row_number() OVER (ORDER BY status DESC, t DESC, rid DESC) AS place FROM tied)
          SELECT rid, CASE WHEN place = 1 THEN -1 ELSE n END AS future_1d FROM c""",
    views=TIED,
)
def future_excl_self_ties(spark, sf_dir):
    made = ranges.future_counts(orders_as_clicks(spark, sf_dir), ["status"], {"future_1d": 86400}, mark_edge=True)
    return made.select("rid", "future_1d")


# ---- earlier days ---------------------------------------------------------------------------------------------------

_DAILY = """, daily AS (SELECT {keys}, date, count(*) AS n, sum(is_attributed)::BIGINT AS c FROM clicks GROUP BY {keys}, date),
prev AS (SELECT {keys}, CAST(date + INTERVAL 1 DAY AS DATE) AS date, n, c FROM daily)"""


@query(
    "prev_day_stat",
    _DAILY.format(keys="ip") + """ SELECT rid, n AS ip_last_day_count, round(c / n, 6) AS ip_last_day_ratio
    FROM clicks LEFT JOIN prev USING (ip, date)""",
)
def prev_day_stat(spark, sf_dir):
    made = history.last_day_stat(events_as_clicks(spark, sf_dir), ["ip"])
    return made.select("rid", "ip_last_day_count", F.round("ip_last_day_ratio", 6).alias("ip_last_day_ratio"))


@query(
    "prev_day_ratio",
    _DAILY.format(keys="channel, device") + """ SELECT rid, round(c / (n + 100), 6) AS channel_device_last_day_ratio
    FROM clicks LEFT JOIN prev USING (channel, device, date)""",
)
def prev_day_ratio(spark, sf_dir):
    name = "channel_device_last_day_ratio"
    made = history.last_day_ratio(events_as_clicks(spark, sf_dir), ["channel", "device"])
    return made.select("rid", F.round(name, 6).alias(name))


@query(
    "prev_day_log_count",
    _DAILY.format(keys="channel") + """ SELECT rid, round(ln(1 + n), 6) AS channel_last_day_count
    FROM clicks LEFT JOIN prev USING (channel, date)""",
)
def prev_day_log_count(spark, sf_dir):
    name = "channel_last_day_count"
    return history.last_day_count(events_as_clicks(spark, sf_dir), ["channel"]).select("rid", F.round(name, 6).alias(name))


_HISTORY = """, daily AS (SELECT ip, channel, date, count(is_attributed) AS n, sum(is_attributed)::BIGINT AS c
    FROM clicks GROUP BY ip, channel, date),
h AS (SELECT ip, channel, date, sum(n) OVER w AS n, sum(c) OVER w AS c FROM daily
    WINDOW w AS (PARTITION BY ip, channel ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING))"""


@query(
    "history_cvr",
    _HISTORY + """ SELECT rid, n::BIGINT AS ip_channel_cntx, round(c / n, 6) AS ip_channel_cvrx, c::BIGINT AS ip_channel_cvtimesx
    FROM clicks LEFT JOIN h USING (ip, channel, date)""",
)
def history_cvr(spark, sf_dir):
    made = history.history(events_as_clicks(spark, sf_dir), [["ip", "channel"]])
    return made.select("rid", "ip_channel_cntx", F.round("ip_channel_cvrx", 6).alias("ip_channel_cvrx"), "ip_channel_cvtimesx")


@query(
    "history_cvr_of_days",
    _HISTORY + """ SELECT rid, CASE WHEN day BETWEEN 8 AND 10 THEN n::BIGINT END AS ip_channel_cntx,
    CASE WHEN day BETWEEN 8 AND 10 THEN round(c / n, 6) END AS ip_channel_cvrx,
    CASE WHEN day BETWEEN 8 AND 10 THEN c::BIGINT END AS ip_channel_cvtimesx
    FROM clicks LEFT JOIN h USING (ip, channel, date)""",
)
def history_cvr_of_days(spark, sf_dir):
    days = [datetime.date(2024, 1, d) for d in (8, 9, 10)]
    made = history.history_of_days(events_as_clicks(spark, sf_dir), [["ip", "channel"]], days)
    return made.select("rid", "ip_channel_cntx", F.round("ip_channel_cvrx", 6).alias("ip_channel_cvrx"), "ip_channel_cvtimesx")


# ---- smoothing ------------------------------------------------------------------------------------------------------


def supplier_counts(spark, sf_dir, counted):
    """Items per supplier and how many of them are ``counted``."""
    counts = {"imps": F.count(F.lit(1)), "clks": F.count(F.when(counted, 1))}
    return groups.group_table(lineitems(spark, sf_dir), ["l_suppkey"], counts)


def _smoothed(counts):
    prior = smoothing.fit_beta_prior(counts, "imps", "clks")
    return counts.select("l_suppkey", "imps", "clks", F.round(prior.rate("imps", "clks"), 6).alias("smoothed"))


def _smoothed_sql(counted: str) -> str:
    """The pooled rate where the slope in the spread is not positive, else the fixed point of the plain iteration."""
    return f"""WITH RECURSIVE c AS (SELECT l_suppkey, count(*) AS imps, count(*) FILTER ({counted}) AS clks
         FROM lineitem GROUP BY l_suppkey),
       pool AS (SELECT sum(clks) / sum(imps) AS p, sum(clks * (clks - 1)) AS cc, sum((imps - clks) * (imps - clks - 1)) AS ss,
                sum(imps * (imps - 1)) AS nn FROM c),
       spread AS (SELECT p, p > 0 AND p < 1 AND cc / nullif(p, 0) + ss / nullif(1 - p, 0) - nn > 0 AS finite FROM pool),
       tails AS (
         SELECT k,
           (SELECT count(*) FROM c WHERE clks > k) AS more_clicked,
           (SELECT count(*) FROM c WHERE imps - clks > k) AS more_skipped,
           (SELECT count(*) FROM c WHERE imps > k) AS more_shown
         FROM (SELECT unnest(range((SELECT max(imps) FROM c))) AS k)),
       packed AS (SELECT list(k ORDER BY k) AS ks, list(more_clicked ORDER BY k) AS nc,
                  list(more_skipped ORDER BY k) AS ns, list(more_shown ORDER BY k) AS ni FROM tails),
       fit(i, a, b) AS (
         SELECT 0, CAST(1 AS DOUBLE), CAST(1 AS DOUBLE) FROM spread WHERE finite
         UNION ALL
         SELECT i + 1, na, nb FROM (SELECT i, a, b,
           a * list_sum(list_transform(ks, lambda k: nc[k + 1] / (a + k))) / list_sum(list_transform(ks, lambda k: ni[k + 1] / (a + b + k))) AS na,
           b * list_sum(list_transform(ks, lambda k: ns[k + 1] / (b + k))) / list_sum(list_transform(ks, lambda k: ni[k + 1] / (a + b + k))) AS nb
         FROM fit, packed) WHERE abs(na - a) >= 1e-10 OR abs(nb - b) >= 1e-10),
       last AS (SELECT a, b FROM fit WHERE i = (SELECT max(i) FROM fit))
       SELECT l_suppkey, imps, clks, round(CASE WHEN finite THEN (clks + a) / (imps + a + b) ELSE p END, 6) AS smoothed
       FROM c CROSS JOIN spread LEFT JOIN last ON true"""


@query("smoothed_return_rate", _smoothed_sql("l_returnflag = 'R'"), views="")
def smoothed_return_rate(spark, sf_dir):
    """The rate at which the items of a supplier come back. It differs less between suppliers than chance makes it."""
    return _smoothed(supplier_counts(spark, sf_dir, F.col("l_returnflag") == "R"))


@query("smoothed_first_lines_rate", _smoothed_sql("l_linenumber <= l_suppkey % 8"), views="")
def smoothed_first_lines_rate(spark, sf_dir):
    """The rate of line numbers up to one of 0 to 7 per supplier: rates that do differ, so that the prior is finite."""
    return _smoothed(supplier_counts(spark, sf_dir, F.col("l_linenumber") <= F.col("l_suppkey") % 8))


@query(
    "smoothing_rounds",
    """WITH c AS (SELECT l_suppkey, count(*) AS imps, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY l_suppkey)
       SELECT false AS first_lines_pooled, true AS first_lines_ended, true AS returns_pooled, round(sum(r) / sum(imps), 6) AS returned FROM c""",
    views="",
)
def smoothing_rounds(spark, sf_dir):
    """Both fits come to rest in fewer than twenty rounds; the one at the binomial limit needs none."""
    lines = smoothing.fit_beta_prior(supplier_counts(spark, sf_dir, F.col("l_linenumber") <= F.col("l_suppkey") % 8), "imps", "clks", max_rounds=19)
    back = smoothing.fit_beta_prior(supplier_counts(spark, sf_dir, F.col("l_returnflag") == "R"), "imps", "clks")
    values = {"first_lines_pooled": lines.pooled is not None, "first_lines_ended": lines.ended, "returns_pooled": back.rounds == 0}
    return lineitems(spark, sf_dir).limit(1).select(*[F.lit(v).alias(n) for n, v in values.items()], F.round(F.lit(back.pooled), 6).alias("returned"))
