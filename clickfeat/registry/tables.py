"""Queries: the feature runs of ``plans.jobs`` as whole tables, with SQL generated from the same feature lists."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.naming import ROW_ID
from clickfeat.operators import groups, history, ordered, relational
from clickfeat.plans import catalog, jobs, wide
from clickfeat.plans.features import Feature, size, statistic
from clickfeat.registry.base import query
from clickfeat.registry.relational import _BOTH, train_and_test
from clickfeat.sources.clicklog import TEST_SCHEMA, TRAIN_SCHEMA, events_as_clicks, orders_as_impressions, prepare, read_csv
from clickfeat.sources.positions import load_csv
from clickfeat.sources.store import run_store, write_csv, write_parquet

# ---- SQL of a feature -----------------------------------------------------------------------------------------------


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


_AGGREGATES = {"mean": "avg", "var": "var_samp", "median": "median"}


def _sql_value(f: Feature, log: str) -> tuple[str, str]:
    """A select expression, and the CTE it needs (or nothing)."""
    keys, over = _names(f.keys), f"OVER (PARTITION BY {_names(f.keys)})"
    timed = f"OVER (PARTITION BY {keys} ORDER BY t, rid)"
    if f.kind == "size":
        return f"count(*) {over}", ""
    if f.kind == "count":
        return f'count("{f.value}") {over}', ""
    if f.kind == "stat":
        return f'round({_AGGREGATES[f.how]}("{f.value}") {over}, 6)', ""
    if f.kind == "span":
        return f"(max(t) {over} - min(t) {over}) / 1e6", ""
    if f.kind == "mean_gap":
        return f"(max(t) {over} - min(t) {over}) / 1e6 / count(*) {over}", ""
    if f.kind == "ordinal":
        order = "t, rid" if f.how == "first" else "t DESC, rid DESC"
        return f"row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1", ""
    if f.kind == "gap":
        gap = f"lead(t) {timed} - t" if f.how == "next" else f"t - lag(t) {timed}"
        return f"CAST(floor(({gap}) / 1000000.0) AS BIGINT)", ""
    if f.kind == "delta":
        return f"CAST(floor((lead(t) {timed} - t) / 1000000.0) AS BIGINT) % 86400", ""
    if f.kind == "sentinel":
        return f"coalesce(lead(t // 1000000) {timed}, 3000000000) - t // 1000000", ""
    if f.kind == "ratio":
        return f"round(count(*) {over} / count(*) OVER (PARTITION BY {_names(f.of)}), 6)", ""
    on = " AND ".join(f'x."{k}" = l."{k}"' for k in f.keys)
    if f.kind == "distinct":
        inner = f"SELECT DISTINCT {_names(f.of)} FROM {log}"
        cte = f"SELECT {keys}, count(*) AS v FROM ({inner}) GROUP BY {keys}"
    elif f.kind == "two_level":
        inner = f"SELECT {_names(f.of)}, count(*) AS n FROM {log} GROUP BY {_names(f.of)}"
        cte = f"SELECT {keys}, round({_AGGREGATES[f.how]}(n), 6) AS v FROM ({inner}) GROUP BY {keys}"
    else:
        cte = f"""SELECT {keys}, CAST(date + INTERVAL 1 DAY AS DATE) AS date,
            round(sum(is_attributed) / (count(*) + 100), 6) AS v FROM {log} GROUP BY {keys}, date"""
        on += " AND x.date = l.date"
    return f'(SELECT v FROM "{f.name}_t" x WHERE {on})', f'"{f.name}_t" AS ({cte})'


def table_sql(features: Sequence[Feature], columns: Sequence[str], log: str = "clicks", fill: dict[str, int] | None = None) -> tuple[str, str]:
    """CTEs (each after a comma) and a SELECT for a table of ``columns`` and ``features``."""
    values, ctes = [], []
    for f in features:
        value, cte = _sql_value(f, log)
        if fill and f.name in fill:
            value = f"coalesce({value}, {fill[f.name]})"
        values.append(f'{value} AS "{f.name}"')
        if cte:
            ctes.append(cte)
    listed = ", ".join([f'l."{c}"' for c in columns] + values)
    return "".join(f", {c}" for c in ctes), f" SELECT {listed} FROM {log} l"


def rounded(df: DataFrame, features: Sequence[Feature], columns: Sequence[str]) -> DataFrame:
    """Columns and features; statistics, whose last digits depend on the order of addition, cut to six digits."""
    types = dict(df.dtypes)
    inexact = {f.name for f in features if f.kind not in ("span", "mean_gap") and types[f.name] == "double"}
    return df.select(*columns, *[F.round(f.name, 6).alias(f.name) if f.name in inexact else F.col(f.name) for f in features])


# ---- the runs -------------------------------------------------------------------------------------------------------

_wide_ctes, _wide_select = table_sql(
    catalog.WIDE, ["rid", "app", "channel", "is_attributed"], fill={f.name: 99999 for f in catalog.GAPS}
)


@query(
    "training_table",
    f"""{_wide_ctes}, wide AS ({_wide_select})
    SELECT *, round(median(ip_count) OVER (PARTITION BY app), 6) AS ip_count_app_median,
    round(count(*) OVER (PARTITION BY app) / count(*) OVER (PARTITION BY app, channel), 6) AS ratio1 FROM wide""",
)
def training_table(spark, sf_dir):
    log = events_as_clicks(spark, sf_dir)
    made = jobs.training_table(log, run_store(spark))
    return rounded(made, [*catalog.WIDE, *catalog.DERIVED], ["rid", "app", "channel", "is_attributed"])


_local = """, local AS (SELECT w.* EXCLUDE (date), c.os, c.t, CAST(extract(day FROM c.click_time + INTERVAL 8 HOUR) AS INTEGER) AS day,
    CAST(extract(hour FROM c.click_time + INTERVAL 8 HOUR) AS INTEGER) AS hour FROM whole w JOIN clicks c USING (rid))"""
_counts_ctes, _counts_select = table_sql(catalog.COUNTS_ALL_ROWS, ["rid", "click_id"], "local")


@query(
    "counts_of_both",
    f"""{_BOTH}{_local}{_counts_ctes}, made AS ({_counts_select})
    SELECT * EXCLUDE (click_id), CASE WHEN click_id IS NULL THEN 'train' ELSE 'test' END AS part FROM made""",
)
def counts_of_both(spark, sf_dir):
    train, test = jobs.counts_of_both(*train_and_test(spark, sf_dir), run_store(spark))
    return relational.union_like(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


_selected_ctes, _selected_select = table_sql(catalog.SELECTED, ["rid"])


@query(
    "selected_features",
    f"""{_selected_ctes}, made AS ({_selected_select})
    SELECT *, lag("nextClick") OVER (ORDER BY rid) AS "nextClick_shift" FROM made""",
)
def selected_features(spark, sf_dir):
    made = jobs.selected_features(events_as_clicks(spark, sf_dir), run_store(spark))
    return rounded(made, catalog.SELECTED, ["rid", "nextClick_shift"])


_delta_ctes, _delta_select = table_sql([*catalog.DELTAS, *catalog.RUNNING], ["rid"])


_DELTAS_SQL = f"""{_delta_ctes}, made AS ({_delta_select}),
    g AS (SELECT rid, t - lag(t) OVER (PARTITION BY ip, os, app ORDER BY t, rid) AS gap FROM clicks),
    m AS (SELECT rid, CAST(floor((lead(gap) OVER (ORDER BY rid)) / 1000000.0) AS BIGINT) % 86400 AS ip_os_app_delta FROM g)
    SELECT * FROM made JOIN m USING (rid)"""


@query("deltas_and_places", _DELTAS_SQL)
def deltas_and_places(spark, sf_dir):
    return jobs.deltas_and_places(events_as_clicks(spark, sf_dir), run_store(spark))


@query("deltas_over_bucketed_log", _DELTAS_SQL)
def deltas_over_bucketed_log(spark, sf_dir):
    """The same over a log stored in buckets of its ip."""
    store = run_store(spark)
    return jobs.deltas_and_places(jobs.bucketed_log(events_as_clicks(spark, sf_dir), store), store)


def _history_sql() -> str:
    ctes, picks, joins = [], [], []
    for keys in catalog.HISTORY_KEYS:
        name, listed = "_".join(keys), ", ".join(keys)
        ctes.append(f""", "h_{name}" AS (SELECT {listed}, date, CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(c) OVER w AS BIGINT) AS c
            FROM (SELECT {listed}, date, count(is_attributed) AS n, sum(is_attributed)::BIGINT AS c FROM clicks GROUP BY {listed}, date)
            WINDOW w AS (PARTITION BY {listed} ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING))""")
        h = f'"h_{name}"'
        picks += [f"{h}.n AS {name}_cntx", f"round({h}.c / {h}.n, 6) AS {name}_cvrx", f"{h}.c AS {name}_cvtimesx"]
        joins.append(f" LEFT JOIN {h} ON " + " AND ".join(f"l.{k} = {h}.{k}" for k in [*keys, "date"]))
    return "".join(ctes) + f" SELECT l.rid, {', '.join(picks)} FROM clicks l" + "".join(joins)


@query("history_features", _history_sql())
def history_features(spark, sf_dir):
    made = jobs.history_features(events_as_clicks(spark, sf_dir), run_store(spark))
    rates = [c for c in made.columns if c.endswith("_cvrx")]
    others = [c for c in made.columns if c.endswith(("_cntx", "_cvtimesx"))]
    return made.select("rid", *others, *[F.round(c, 6).alias(c) for c in rates])


_RECENT = ", ".join(
    f"""least(count(*) OVER (PARTITION BY ip, device ORDER BY t RANGE BETWEEN {s * 10**6} PRECEDING AND CURRENT ROW) - 1,
    row_number() OVER (PARTITION BY ip, device, run ORDER BY t, rid) - 1) AS recent_click_cnt_{s}"""
    for s in catalog.RECENT_SECONDS
)


@query(
    "recent_features",
    f""", flagged AS (SELECT *, CASE WHEN lag(os) OVER w IS DISTINCT FROM os THEN 1 ELSE 0 END AS changed FROM clicks
          WINDOW w AS (PARTITION BY ip, device ORDER BY t, rid)),
        runs AS (SELECT *, sum(changed) OVER (PARTITION BY ip, device ORDER BY t, rid ROWS UNBOUNDED PRECEDING) AS run FROM flagged)
        SELECT rid, {_RECENT} FROM runs""",
)
def recent_features(spark, sf_dir):
    made = jobs.recent_features(events_as_clicks(spark, sf_dir), ["ip", "device"], ["os"])
    return made.select("rid", *catalog.recent_widths())


def _rolling_sql(label: str, forward: bool, keys: tuple[str, ...] = ("app", "channel")) -> str:
    frames = []
    for name, seconds in catalog.rolling_widths(keys, label).items():
        reach = seconds * 10**6 - 1
        frame = f"CURRENT ROW AND {reach} FOLLOWING" if forward else f"{reach} PRECEDING AND CURRENT ROW"
        frames.append(f"count(*) OVER (PARTITION BY day > 20, {', '.join(keys)} ORDER BY t RANGE BETWEEN {frame}) AS {name}")
    return f" SELECT rid, {', '.join(frames)} FROM clicks"


@query("rolling_features", _rolling_sql("last_time_click", False))
def rolling_features(spark, sf_dir):
    return jobs.rolling_features(train_and_test(spark, sf_dir), ["app", "channel"])


@query("rolling_forward_features", _rolling_sql("future_click", True))
def rolling_forward_features(spark, sf_dir):
    return jobs.rolling_features(train_and_test(spark, sf_dir), ["app", "channel"], forward=True)


@query("rolling_forward_three_keys", _rolling_sql("future_click", True, ("ip", "device", "os")))
def rolling_forward_three_keys(spark, sf_dir):
    return jobs.rolling_features(train_and_test(spark, sf_dir), ["ip", "device", "os"], forward=True)


_IMPRESSIONS = """
impressions AS (SELECT o_orderkey AS instance_id, o_custkey AS user_id, o_orderkey % 97 AS item_id, o_custkey % 31 AS shop_id,
  o_orderkey % 13 AS context_page_id, o_custkey % 5 AS shop_review_num_level, o_orderkey % 7 AS shop_star_level,
  o_orderkey % 11 AS item_sales_level, c % 101 / 100 AS shop_review_positive_rate, c % 53 / 50 AS shop_score_service,
  c % 29 / 25 AS shop_score_delivery, c % 17 / 20 AS shop_score_description
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS c FROM orders))"""


def _impression_sql() -> str:
    how = {"count": "count({0})", "mean": "round(avg({0}), 6)", "median": "round(median({0}), 6)"}
    by_keys: dict[tuple[str, ...], list[str]] = {}
    for keys, value, stat, name in catalog.IMPRESSION_STATISTICS:
        by_keys.setdefault(keys, []).append(f"{how[stat].format(value)} AS {name}")
    ctes = "".join(
        f", s{i} AS (SELECT {', '.join(k)}, {', '.join(made)} FROM impressions GROUP BY {', '.join(k)})"
        for i, (k, made) in enumerate(by_keys.items())
    )
    joins = " ".join(f"JOIN s{i} USING ({', '.join(k)})" for i, k in enumerate(by_keys))
    pairs = []
    for n, (x, y) in enumerate(combinations(catalog.SCORES, 2)):
        for sign in "*+-":
            pairs.append(f'round({x} {sign} {y}, 6) AS "inter_{n}_{x}_{y}{sign}"')
        pairs.append(f'round({x} / nullif({y}, 0), 6) AS "inter_{n}_{x}_{y}/"')
    names = [name for *_, name in catalog.IMPRESSION_STATISTICS]
    return f"{ctes} SELECT instance_id, {', '.join(names + pairs)} FROM impressions {joins}"


@query("impression_statistics", _impression_sql(), views=_IMPRESSIONS)
def impression_statistics(spark, sf_dir):
    made = jobs.impression_statistics(orders_as_impressions(spark, sf_dir), "instance_id")
    counts = [name for _, _, how, name in catalog.IMPRESSION_STATISTICS if how == "count"]
    values = [c for c in made.columns if c.startswith("inter_")]
    values += [name for _, _, how, name in catalog.IMPRESSION_STATISTICS if how != "count"]
    return made.select("instance_id", *counts, *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in values])


@query(
    "counts_written_by_part",
    f"""{_BOTH}{_local}{_counts_ctes}, made AS ({_counts_select})
    SELECT 'train' AS part, count(*) AS n, sum(ip_count)::BIGINT AS ips FROM made WHERE click_id IS NULL
    UNION ALL SELECT 'test', count(*), sum(ip_count)::BIGINT FROM made WHERE click_id IS NOT NULL""",
)
def counts_written_by_part(spark, sf_dir):
    parts = jobs.write_counts_of_both(*train_and_test(spark, sf_dir), run_store(spark))
    sums = [df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.sum("ip_count").alias("ips")) for name, df in parts.items()]
    return relational.union_like(*sums)


def _log_lines(spark, sf_dir) -> DataFrame:
    """The clicks as text columns of the train schema."""
    clicks = events_as_clicks(spark, sf_dir).withColumns(
        {
            "channel": F.col("device") * 10 + F.col("os"),
            "click_time": F.date_trunc("second", F.col("click_time")).cast("timestamp_ntz"),
            "attributed_time": F.lit(None).cast("timestamp_ntz"),
        }
    )
    columns = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c.endswith("_time") else F.col(c).cast("string") for c in TRAIN_SCHEMA.names]
    return clicks.select(ROW_ID, *columns)


def _written_log(spark, sf_dir) -> str:
    """The clicks as a CSV file of the train schema, and its path."""
    path = run_store(spark).path("log-csv")
    write_csv(_log_lines(spark, sf_dir).drop(ROW_ID), path)
    return path


@query(
    "csv_log_counts",
    """ SELECT ip, app, device * 10 + os AS channel, day, hour, count(*) AS n, sum(is_attributed)::BIGINT AS converted
        FROM clicks GROUP BY ALL""",
)
def csv_log_counts(spark, sf_dir):
    """The log written as CSV, read back by its schema, and counted."""
    log = prepare(read_csv(spark, _written_log(spark, sf_dir), TRAIN_SCHEMA))
    keys = ["ip", "app", "channel", "day", "hour"]
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("is_attributed").alias("converted"))


def _flawed_files(spark, sf_dir) -> str:
    """The clicks as several CSV files without an id, each line twice, every hundredth one with a text as its app, and their path."""
    flawed = _log_lines(spark, sf_dir).withColumn("app", F.when(F.col(ROW_ID) % 100 == 7, "x").otherwise(F.col("app")))
    twice = flawed.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    path = run_store(spark).path("flawed-csv")
    files = twice.repartitionByRange(5, ROW_ID, "_copy").sortWithinPartitions(ROW_ID, "_copy")
    write_csv(files, path, TRAIN_SCHEMA.names)
    return path


_TWICE = """, lines AS (SELECT c.rid, row_number() OVER (ORDER BY c.rid, copy) - 1 AS place, ip, app, device, os, is_attributed, click_time
  FROM clicks c, (VALUES (0), (1)) v(copy))"""


@query(
    "csv_file_row_index",
    f"""{_TWICE} SELECT place AS rid, ip, app, device, os, is_attributed, date_trunc('second', click_time) AS click_time
        FROM lines WHERE rid % 100 <> 7""",
)
def csv_file_row_index(spark, sf_dir):
    """A log without an id, read from several files: rows are numbered by their place in the files."""
    log, _ = load_csv(spark, _flawed_files(spark, sf_dir), TRAIN_SCHEMA, run_store(spark))
    return log.select(ROW_ID, "ip", "app", "device", "os", "is_attributed", "click_time")


@query(
    "csv_rejected_lines",
    f"""{_TWICE} SELECT rid % 100 <> 7 AS fits, count(*) AS n, min(place) AS first_rid, max(place) AS last_rid,
        sum(ip)::BIGINT AS ips FROM lines GROUP BY fits""",
)
def csv_rejected_lines(spark, sf_dir):
    """Lines that fit the schema and lines that do not; the ip of a rejected line is read from its text."""
    good, bad = load_csv(spark, _flawed_files(spark, sf_dir), TRAIN_SCHEMA, run_store(spark))
    told = bad.select(ROW_ID, F.split("line", ",")[0].cast("long").alias("ip"), F.lit(False).alias("fits"))
    both = told.unionByName(good.select(ROW_ID, "ip", F.lit(True).alias("fits")))
    counts = {"n": F.count(F.lit(1)), "first_rid": F.min(ROW_ID), "last_rid": F.max(ROW_ID), "ips": F.sum("ip")}
    return both.groupBy("fits").agg(*[c.alias(n) for n, c in counts.items()])


def _train_and_test_files(spark, sf_dir) -> tuple[str, str]:
    """Clicks up to day 20 as files of the train schema, later ones as files of the test schema; no row id in either."""
    lines, paths = _log_lines(spark, sf_dir), []
    day = F.dayofmonth(F.col("click_time").cast("timestamp_ntz"))
    parts = (("train", day <= 20, TRAIN_SCHEMA.names), ("test", day > 20, TEST_SCHEMA.names))
    for name, chosen, columns in parts:
        path = run_store(spark).path(f"{name}-files")
        files = lines.where(chosen).withColumn("click_id", F.col(ROW_ID).cast("string")).repartitionByRange(4, ROW_ID).sortWithinPartitions(ROW_ID)
        write_csv(files, path, columns)
        paths.append(path)
    return tuple(paths)


@query(
    "csv_train_test_features",
    """, numbered AS (SELECT *, row_number() OVER (ORDER BY day > 20, rid) - 1 AS place, t // 1000000 AS s FROM clicks)
       SELECT place AS rid, CASE WHEN day > 20 THEN rid END AS click_id, CASE WHEN day <= 20 THEN is_attributed END AS is_attributed,
         count(*) OVER (PARTITION BY ip, day, hour) AS ip_day_hour_count,
         row_number() OVER (PARTITION BY app, device ORDER BY s, place) - 1 AS app_device_rank_True,
         lead(s) OVER (PARTITION BY ip, os ORDER BY s, place) - s AS ip_os_next_click_next FROM numbered""",
)
def csv_train_test_features(spark, sf_dir):
    """From train and test files without row ids to features over both: counts, places and gaps."""
    train, test, _ = jobs.logs_from_csv(spark, *_train_and_test_files(spark, sf_dir), run_store(spark))
    log = relational.union_logs(train, test)
    made = groups.group_size(log, ["ip", "day", "hour"])
    made = ordered.ordinal(made, ["app", "device"], base=log)
    made = ordered.click_gap(made, ["ip", "os"], base=log)
    return made.select(ROW_ID, "click_id", "is_attributed", "ip_day_hour_count", "app_device_rank_True", "ip_os_next_click_next")


@query("csv_limited_scan", " SELECT least(count(*), 500) AS n, 3 AS n_columns FROM clicks")
def csv_limited_scan(spark, sf_dir):
    """A trial scan of some columns of the first rows of a file."""
    few = read_csv(spark, _written_log(spark, sf_dir), TRAIN_SCHEMA, ["ip", "app", "click_time"], 500)
    return few.agg(F.count(F.lit(1)).alias("n"), F.lit(len(few.columns)).alias("n_columns"))


def _closed(keys: str, seconds: int, forward: bool) -> str:
    frame = f"CURRENT ROW AND {seconds * 10**6} FOLLOWING" if forward else f"{seconds * 10**6} PRECEDING AND CURRENT ROW"
    return f"count(*) OVER (PARTITION BY {keys} ORDER BY t RANGE BETWEEN {frame}) - 1"


_USER_ITEM = ", ".join(
    [f"{_closed('ip, channel', s, False)} AS recent_ip_channel_{s}" for s in catalog.USER_ITEM_SECONDS]
    + [f"{_closed('ip', s, True)} AS real_feature_ip_timerange_{s}" for s in catalog.USER_FIELD_SECONDS]
)


@query("user_item_features", f" SELECT rid, {_USER_ITEM} FROM clicks")
def user_item_features(spark, sf_dir):
    made = jobs.user_item_features(events_as_clicks(spark, sf_dir), "ip", "channel")
    return made.select("rid", *[c for c in made.columns if c.startswith(("recent_", "real_feature_"))])


@query(
    "stored_feature_tables",
    """, a AS (SELECT app, count(*) AS app_count, round(avg(hour), 6) AS app_hour_mean FROM clicks GROUP BY app)
       SELECT rid, app_count, app_hour_mean FROM clicks JOIN a USING (app)""",
)
def stored_feature_tables(spark, sf_dir):
    """Written once, read back by name: the second call finds the first one's tables."""
    log, store = events_as_clicks(spark, sf_dir), run_store(spark)
    features = [size("app"), statistic("mean", "hour", "app")]
    for _ in range(2):
        made = wide.build(log, features, store, "stored", columns=["rid"])
    return rounded(made, features, ["rid"])


@query(
    "appended_daily_history",
    """, d AS (SELECT ip, date, count(is_attributed) AS n, sum(is_attributed)::BIGINT AS c FROM clicks GROUP BY ip, date)
       SELECT ip, date, CAST(sum(n) OVER w AS BIGINT) AS ip_cntx, round(sum(c) OVER w / sum(n) OVER w, 6) AS ip_cvrx,
         CAST(sum(c) OVER w AS BIGINT) AS ip_cvtimesx FROM d
       WINDOW w AS (PARTITION BY ip ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
)
def appended_daily_history(spark, sf_dir):
    """Earlier days of a log that arrives in files: the first call reads the first days, the second one only the new file."""
    log, store = events_as_clicks(spark, sf_dir).select("ip", "date", "is_attributed"), run_store(spark)
    paths: list[str] = []
    for name, part in (("first", relational.between_days(_dated(log), 1, 20)), ("then", relational.between_days(_dated(log), 21, 31))):
        write_parquet(part.drop("day"), store.path(f"log-{name}"))
        paths += store.get(f"log-{name}").inputFiles()
        daily = store.merged("daily", paths, lambda files: spark.read.parquet(*files), ["ip", "date"], history.daily_sums())
    made = history.history_of_daily(daily, ["ip"])
    return made.withColumn("ip_cvrx", F.round("ip_cvrx", 6))


def _dated(log: DataFrame) -> DataFrame:
    return log.withColumn("day", F.dayofmonth("date"))
