"""The list of named queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CLICKS = """
clicks0 AS (
  SELECT event_id AS rid, user_id AS ip, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS app,
         event_type AS channel, CAST(event_id % 3 AS INTEGER) AS device, CAST(event_id % 5 AS INTEGER) AS os,
         ts AS click_time, epoch_us(ts) AS t, CAST(ts AS DATE) AS date,
         CAST(extract(day FROM ts) AS INTEGER) AS day, CAST(extract(hour FROM ts) AS INTEGER) AS hour,
         CAST(extract(minute FROM ts) AS INTEGER) AS minute,
         CASE WHEN value >= 50 THEN 1 ELSE 0 END AS is_attributed,
         CASE WHEN value >= 50 THEN epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) END AS attributed_t
  FROM events),
clicks AS (
  SELECT *, CAST(4 * hour + minute // 15 AS INTEGER) AS "15min", CAST(20 * hour + minute // 3 AS INTEGER) AS "3min",
         CAST(2 * hour + minute // 30 AS INTEGER) AS "30min" FROM clicks0)"""

TIED = """
tied AS (
  SELECT o_orderkey AS rid, o_custkey AS cust, o_orderstatus AS status, o_orderpriority AS priority,
         o_totalprice AS price, epoch_us(o_orderdate) AS t FROM orders)"""


def query(name: str, sql: str | None = None, views: str = CLICKS) -> Callable[[Query], Query]:
    """Register a query. ``sql`` follows the ``views`` CTEs; a text starting with a comma adds more CTEs."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = f"WITH {views}{sql}" if views else sql
        return run

    return add
