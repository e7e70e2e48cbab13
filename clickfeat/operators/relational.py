"""Joins, splits and unions of logs and feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.naming import ROW_ID, as_list
from clickfeat.operators.ordered import keep_first
from clickfeat.operators.slices import salted_join

REPORT_KEYS = ("ip", "app", "device", "os", "channel", "click_time")


def left_merge(rows: DataFrame, table: DataFrame, on: str | Sequence[str], rid: str = ROW_ID) -> DataFrame:
    """Row id and the non-key columns of ``table`` for every row. ``table`` has one row per key."""
    keys = as_list(on)
    made = [c for c in table.columns if c not in keys]
    return salted_join(rows.select(*dict.fromkeys([rid, *keys])), table, keys, [rid]).select(rid, *made)


def inner_merge(rows: DataFrame, feature: DataFrame, drop: Sequence[str] = (), rid: str = ROW_ID) -> DataFrame:
    """Inner join of two tables on their unique row id, without the ``drop`` columns."""
    return rows.join(feature, rid, "inner").drop(*drop)


def left_on_id(rows: DataFrame, feature: DataFrame, rid: str = ROW_ID) -> DataFrame:
    return rows.join(feature, rid, "left")


def zip_features(rows: DataFrame, features: Sequence[DataFrame], rid: str = ROW_ID) -> DataFrame:
    """Side-by-side columns of several one-row-per-id tables, matched by row id."""
    return reduce(lambda left, right: left.join(right, rid, "left"), features, rows)


def union_logs(*logs: DataFrame) -> DataFrame:
    """All rows of logs with differing columns; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def union_like(*tables: DataFrame) -> DataFrame:
    """All rows of tables with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def stack_features(tables: Sequence[DataFrame]) -> DataFrame:
    """One-feature tables below each other: as many rows as all of them, one filled feature column per row."""
    return union_logs(*tables)


def labelled(df: DataFrame, label: str = "is_attributed") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def unlabelled(df: DataFrame, click_id: str = "click_id") -> DataFrame:
    """Rows of the test part: those that carry a click id."""
    return df.where(F.col(click_id).isNotNull())


def on_day(df: DataFrame, value, day: str = "day") -> DataFrame:
    return df.where(F.col(day) == value)


def between_days(df: DataFrame, first, last, day: str = "day") -> DataFrame:
    return df.where(F.col(day).between(first, last))


def before_day(df: DataFrame, value, day: str = "day") -> DataFrame:
    return df.where(F.col(day) < value)


def split_at(df: DataFrame, cutoff: str | Column, timestamp: str = "click_time") -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff time and rows from it on."""
    bound = F.lit(cutoff).cast("timestamp_ntz") if isinstance(cutoff, str) else cutoff
    return df.where(F.col(timestamp) < bound), df.where(F.col(timestamp) >= bound)


def split_days(df: DataFrame, train: tuple, validate, score, day: str = "day", label: str = "is_attributed") -> dict[str, DataFrame]:
    """The four parts of the modelling run, by day of the month or, with ``day="date"``, by date."""
    return {
        "all_labelled": labelled(df, label),
        "train": between_days(df, *train, day),
        "validate": on_day(df, validate, day),
        "score": on_day(df, score, day),
    }


def project_scores(
    clicks: DataFrame, scored: DataFrame, score: str, on: Sequence[str] = REPORT_KEYS, click_id: str = "click_id", rid: str = ROW_ID
) -> DataFrame:
    """Score of every reported click, matched on the click's columns, one row per click id.

    Scored rows with equal columns are reduced to the first by row id before the join, so the join cannot fan out.
    """
    one_score = keep_first(scored.select(*on, score, rid), on, [rid]).drop(rid)
    return salted_join(keep_first(clicks, [click_id], [rid]), one_score, on, [click_id]).select(click_id, score)
