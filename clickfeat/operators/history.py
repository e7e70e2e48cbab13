"""Statistics of earlier days.

The log is first reduced to one row per key and day (partial aggregation, so hot keys shrink before the shuffle).
Lagging and running sums work on that table, whose groups are at most as long as the calendar. ``base`` is the log ``df`` was derived from row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.functions.scalars import log_count
from clickfeat.naming import ROW_ID, feature_name
from clickfeat.operators.groups import attach, group_table
from clickfeat.operators.slices import any_null

PRIOR_CLICKS = 100


def daily_sums(label: str = "is_attributed") -> dict[str, tuple[str, Column]]:
    """The columns of ``daily_table`` as mergeable aggregates of ``FeatureStore.merged``."""
    converted = F.coalesce(F.col(label).cast("long"), F.lit(0))
    return {"_clicks": ("count", F.lit(1)), "_labelled": ("count", F.col(label)), "_converted": ("sum", converted)}


def daily_table(df: DataFrame, keys: Sequence[str], label: str = "is_attributed", day: str = "date") -> DataFrame:
    """Clicks, labelled clicks and conversions per key and day."""
    return group_table(
        df,
        [*keys, day],
        {
            "_clicks": F.count(F.lit(1)),
            "_labelled": F.count(label),
            "_converted": F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)),
        },
    )


KEY_SET = "_set"


def daily_lattice(df: DataFrame, key_sets: Sequence[Sequence[str]], label: str = "is_attributed", day: str = "date") -> DataFrame:
    """``daily_table`` of several key sets from one pass over the rows: one aggregation over grouping sets.

    ``_set`` is the place of the key set in ``key_sets``; keys of other sets are NULL.
    """
    keys = list(dict.fromkeys(k for s in key_sets for k in s))
    made = df.groupingSets([[F.col(k) for k in [*s, day]] for s in key_sets], *keys, day).agg(
        F.grouping_id().alias("_id"),
        F.count(F.lit(1)).alias("_clicks"),
        F.count(label).alias("_labelled"),
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("_converted"),
    )
    number, complete = F.lit(None).cast("int"), F.lit(False)
    for place, s in enumerate(key_sets):
        # One bit per key, first key highest, set where the key is not of the set; the day is of every set.
        bits = sum(1 << (len(keys) - i) for i, k in enumerate(keys) if k not in s)
        number = F.when(F.col("_id") == bits, place).otherwise(number)
        complete = F.when(F.col("_id") == bits, ~any_null([*s, day])).otherwise(complete)
    return made.where(complete).select(number.alias(KEY_SET), *keys, day, "_clicks", "_labelled", "_converted")


def history_lattice(df: DataFrame, key_sets: Sequence[Sequence[str]], label: str = "is_attributed", day: str = "date") -> DataFrame:
    """``history_table`` of several key sets as one table, from one pass over the rows: ``_set``, keys, day, ``cnt``, ``cvr``, ``cvt``."""
    keys = list(dict.fromkeys(k for s in key_sets for k in s))
    earlier = Window.partitionBy(KEY_SET, *keys).orderBy(F.unix_date(day)).rangeBetween(Window.unboundedPreceding, -1)
    summed = daily_lattice(df, key_sets, label, day).withColumns({"cnt": F.sum("_labelled").over(earlier), "cvt": F.sum("_converted").over(earlier)})
    return summed.select(KEY_SET, *keys, day, "cnt", F.try_divide("cvt", "cnt").alias("cvr"), "cvt")


def history_of_set(lattice: DataFrame, place: int, keys: Sequence[str], day: str = "date") -> DataFrame:
    """The rows of one key set with the columns of ``history_table``."""
    names = {"cnt": "cntx", "cvr": "cvrx", "cvt": "cvtimesx"}
    return lattice.where(F.col(KEY_SET) == place).select(*keys, day, *[F.col(c).alias(feature_name(keys, n)) for c, n in names.items()])


def _previous_day(df, keys, features, label, day, rid, base):
    base = df if base is None else base
    lagged = daily_table(base, keys, label, day).withColumn(day, F.date_add(day, 1))
    return attach(df, lagged.select(*keys, day, *[c.alias(n) for n, c in features.items()]), [*keys, day], rid, base)


def last_day_stat(df: DataFrame, keys: Sequence[str], label: str = "is_attributed", day: str = "date", rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Clicks and conversion ratio of the key on the day before."""
    features = {
        feature_name(keys, "last_day_count"): F.col("_clicks"),
        feature_name(keys, "last_day_ratio"): F.col("_converted") / F.col("_clicks"),
    }
    return _previous_day(df, keys, features, label, day, rid, base)


def last_day_ratio(df: DataFrame, keys: Sequence[str], prior: int = PRIOR_CLICKS, label: str = "is_attributed", day: str = "date", rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Conversions over clicks plus ``prior`` of the key on the day before."""
    features = {feature_name(keys, "last_day_ratio"): F.col("_converted") / (F.col("_clicks") + prior)}
    return _previous_day(df, keys, features, label, day, rid, base)


def last_day_count(df: DataFrame, keys: Sequence[str], label: str = "is_attributed", day: str = "date", rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Logarithm of one plus the clicks of the key on the day before."""
    return _previous_day(df, keys, {feature_name(keys, "last_day_count"): log_count("_clicks")}, label, day, rid, base)


def history_table(df: DataFrame, keys: Sequence[str], label: str = "is_attributed", day: str = "date") -> DataFrame:
    """Per key and day: labelled clicks, conversion rate and conversions over all earlier days."""
    return history_of_daily(daily_table(df, keys, label, day), keys, day)


def history_of_daily(daily: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """``history_table`` from a table in the form of ``daily_table``, which may be merged from stored parts."""
    earlier = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(Window.unboundedPreceding, -1)
    summed = daily.withColumns(
        {"_cnt": F.sum("_labelled").over(earlier), "_cvt": F.sum("_converted").over(earlier)}
    )
    # A key whose earlier rows are all unlabelled counts 0 with no rate.
    return summed.select(
        *keys,
        day,
        F.col("_cnt").alias(feature_name(keys, "cntx")),
        F.try_divide("_cvt", "_cnt").alias(feature_name(keys, "cvrx")),
        F.col("_cvt").alias(feature_name(keys, "cvtimesx")),
    )


def history(df: DataFrame, key_sets: Sequence[Sequence[str]], label: str = "is_attributed", day: str = "date", rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Click count, conversion rate and conversions over all earlier days, for each key set."""
    base = df if base is None else base
    for keys in key_sets:
        df = attach(df, history_table(base, keys, label, day), [*keys, day], rid, base)
    return df


def history_of_days(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    days: Sequence,
    label: str = "is_attributed",
    day: str = "date",
    rid=ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """As ``history`` for rows of the listed days only; other rows keep NULL."""
    made = history(df, key_sets, label, day, rid, base)
    listed = F.col(day).isin(list(days))
    return made.select(*df.columns, *[F.when(listed, F.col(c)).alias(c) for c in made.columns if c not in df.columns])
