"""Whole-group features: every row receives a statistic of all rows that share its key.

The statistic is a ``groupBy`` (partial aggregation before the shuffle); it is put on the rows with ``salted_join``.
Rows with a NULL in the key receive NULL.

``base`` is the log ``df`` was derived from row by row. Statistics are computed on it, so a chain of features reads
the log once per feature instead of repeating the chain; it defaults to ``df``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.functions.stats import stat
from clickfeat.functions.timeparts import gap_seconds, shift_hours
from clickfeat.naming import ROW_ID, TIME, as_list, feature_name
from clickfeat.operators.slices import SlicedRows, all_slices, earlier_slices, fits_one_slice, salted_join, with_keys
from clickfeat.sources.store import run_store

ATTRIBUTION_SHIFT_HOURS = 8


def attach(
    df: DataFrame, table: DataFrame, keys: Sequence[str], rid: str | Sequence[str] = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Left join of a one-row-per-key table; only its non-key columns are added."""
    return salted_join(df, table, as_list(keys), as_list(rid), base)


def group_table(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """One row per complete key."""
    return with_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def add_group_aggregates(
    df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Several aggregates of one key with a single shuffle of the rows."""
    base = df if base is None else base
    return attach(df, group_table(base, keys, aggregates), keys, rid, base)


def group_size(df: DataFrame, keys: Sequence[str], name: str | None = None, rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Number of rows in the group."""
    return add_group_aggregates(df, keys, {name or feature_name(keys, "count"): F.count(F.lit(1))}, rid, base)


def group_stat(
    df: DataFrame, keys: Sequence[str], value: str, how: str, name: str | None = None, rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Statistic ``how`` of ``value`` in the group: count, mean, sum, min, max, var, std, skew, median or nunique."""
    return group_stats(df, keys, value, [how], {how: name} if name else None, rid, base)


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    how: Sequence[str],
    names: dict[str, str] | None = None,
    rid=ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Several statistics of one value column."""
    label = {h: (names or {}).get(h) or "_".join([*keys, value, h]) for h in how}
    return group_statistics(df, [(keys, value, h, label[h]) for h in how], rid, base)


def group_statistics(
    df: DataFrame, specs: Sequence[tuple[Sequence[str], str, str, str]], rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """A list of ``(keys, value, how, name)`` statistics, one shuffle of the rows per distinct key."""
    base = df if base is None else base
    by_keys: dict[tuple[str, ...], list[tuple[str, str, str]]] = {}
    for keys, value, how, name in specs:
        by_keys.setdefault(tuple(keys), []).append((value, how, name))
    for keys, wanted in by_keys.items():
        df = attach(df, _statistics_table(base, list(keys), wanted), keys, rid, base)
    return df


def _statistics_table(df: DataFrame, keys: list[str], wanted: Sequence[tuple[str, str, str]]) -> DataFrame:
    plain = {name: stat(how, value) for value, how, name in wanted if how not in ("median", "nunique")}
    # Size is always present, so every key has its row even when all values are NULL.
    table = group_table(df, keys, {**plain, "_size": F.count(F.lit(1))})
    for value, how, name in wanted:
        if how == "median":
            table = table.join(median_table(df, keys, value, name), keys, "left")
        elif how == "nunique":
            table = table.join(distinct_table(df, keys, [value], name), keys, "left")
    return table.select(*keys, *[name for _, _, name in wanted])


def distinct_table(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """Number of distinct ``values`` tuples per key; tuples with a NULL do not count.

    The ``distinct`` shuffles on key and value together, so a hot key is already spread when it is counted.
    """
    pairs = with_keys(df, keys).select(*keys, *values).distinct()
    complete = F.lit(True)
    for value in values:
        complete = complete & F.col(value).isNotNull()
    return pairs.groupBy(*keys).agg(F.count(F.when(complete, 1)).alias(name))


def group_distinct(
    df: DataFrame, of: Sequence[str], other: Sequence[str], name: str | None = None, rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Number of distinct ``of`` tuples in each ``other`` group (``other`` is part of ``of``)."""
    name = name or "_".join([*of, "count", *other])
    base = df if base is None else base
    return attach(df, distinct_table(base, other, _rest(of, other), name), other, rid, base)


def _rest(of: Sequence[str], other: Sequence[str]) -> list[str]:
    missing = [k for k in other if k not in of]
    if missing:
        raise ValueError(f"{missing} not among the columns {list(of)}")
    return [k for k in of if k not in other]


# A median is narrowed down by so many leading bits of the value at a time.
MEDIAN_BITS = 16
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def _as_ordered_long(value: Column, kind: str) -> Column:
    """A long that sorts as the value does. A double's bits do so once those of negative values are turned round."""
    if kind in WHOLE_TYPES:
        return value.cast("long")
    # Adding zero makes one zero of the two.
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)


def _from_ordered_long(ordered: Column, kind: str) -> Column:
    if kind in WHOLE_TYPES:
        return ordered
    bits = F.when(ordered < 0, ordered.bitwiseXOR(F.lit(2**63 - 1))).otherwise(ordered)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def narrowed_median_table(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact interpolated median per key, without sorting or exchanging the values.

    The rows of a key are counted by the leading bits of the value; running counts over these buckets, at most 65,536 a key, tell in
    which one the middle rows lie, and only rows of that bucket are counted by the next bits. Four rounds reach the value.
    Each round reads the log once and exchanges counts. The buckets looked for, at most two per key, are written after a
    round; they are broadcast where they are few.
    """
    spark, kind, keys = df.sparkSession, dict(df.dtypes)[value], list(keys)
    store, limit = run_store(spark), int(spark.conf.get("spark.clickfeat.broadcastRows", "200000"))
    rows = with_keys(df, [*keys, value]).select(*keys, _as_ordered_long(F.col(value), kind).alias("_long"))
    wanted = None
    for level, shift in enumerate(range(64 - MEDIAN_BITS, -1, -MEDIAN_BITS)):
        bucket = F.shiftright("_long", shift).alias("_bucket")
        if wanted is None:
            counted = rows.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))
            of_key = Window.partitionBy(*keys)
            total = F.sum("_n").over(of_key)
            ranks = F.array(F.floor((total + 1) / 2).cast("long"), (F.floor(total / 2) + 1).cast("long"))
            found = counted.withColumns({"_ranks": ranks, "_parent": F.lit(0).cast("long")})
        else:
            few = wanted.count() <= limit
            near = rows.withColumn("_parent", F.shiftright("_long", shift + MEDIAN_BITS))
            near = near.join(F.broadcast(wanted) if few else wanted, [*keys, "_parent"])
            found = near.groupBy(*keys, "_parent", "_ranks", bucket).agg(F.count(F.lit(1)).alias("_n"))
        order = Window.partitionBy(*keys, "_parent").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(order), F.lit(0))
        # Ranks are those of the lower and the upper middle row inside the bucket; 0 stands for a middle row elsewhere.
        here = found.withColumn("_before", before).withColumn(
            "_ranks",
            F.transform("_ranks", lambda r: F.when((r > F.col("_before")) & (r <= F.col("_before") + F.col("_n")), r - F.col("_before")).otherwise(0)),
        )
        kept = here.where(F.exists("_ranks", lambda r: r > 0)).select(*keys, F.col("_bucket").alias("_parent"), "_ranks")
        wanted = store.get_or_compute(f"{name}-median-{level}", lambda kept=kept: kept)
    told = wanted.withColumn("_value", _from_ordered_long(F.col("_parent"), kind))
    middle = [F.max(F.when(F.col("_ranks")[i] > 0, F.col("_value"))) for i in (0, 1)]
    return told.groupBy(*keys).agg(((middle[0] + middle[1]) / 2.0).alias(name))


def median_table(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact interpolated median per key.

    Numbers of a log above one slice are narrowed down (``narrowed_median_table``). Otherwise equal values are first counted
    together; then a running count in value order finds the middle one or two, sliced where the values are cut.
    """
    if not fits_one_slice(df) and dict(df.dtypes)[value] in (*WHOLE_TYPES, "float", "double"):
        return narrowed_median_table(df, keys, value, name)
    counted = with_keys(df, [*keys, value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    sliced = SlicedRows(counted, keys, [value])
    upto = sliced.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sliced.rows.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(sliced.window())})
    rows = sliced.carry(
        rows,
        {"_part": F.sum("_n")},
        lambda w: {"_before": F.sum("_part").over(earlier_slices(w)), "_total": F.sum("_part").over(all_slices(w))},
    )
    last = F.col("_upto") + F.coalesce("_before", F.lit(0))
    first = last - F.col("_n") + 1
    total = F.coalesce("_total", "_all")
    lower, upper = F.floor((total + 1) / 2), F.floor(total / 2) + 1

    def value_at(place: Column) -> Column:
        return F.max(F.when(place.between(first, last), F.col(value)))

    return rows.groupBy(*keys).agg(((value_at(lower) + value_at(upper)) / 2.0).alias(name))


def two_level_table(df: DataFrame, of: Sequence[str], other: Sequence[str], how: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Statistics over the sizes of the ``of`` groups inside each ``other`` group."""
    sizes = group_table(df, of, {"_size": F.count(F.lit(1))})
    return sizes.groupBy(*other).agg(*[stat(h, "_size").alias(names[h]) for h in how])


def two_level_stats(
    df: DataFrame, of: Sequence[str], other: Sequence[str], how: Sequence[str] = ("var", "size"), rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    _rest(of, other)
    names = {h: "_".join([*of, *other, "2level" + h]) for h in how}
    base = df if base is None else base
    return attach(df, two_level_table(base, of, other, how, names), other, rid, base)


def size_ratio(
    df: DataFrame, of: Sequence[str], other: Sequence[str], name: str | None = None, rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Size of the row's ``of`` group over the size of its ``other`` group."""
    name = name or "_".join([*of, "ratio", *other])
    base = df if base is None else base
    counted = group_size(group_size(df, of, "_of", rid, base), other, "_other", rid, base)
    return counted.select(*df.columns, F.try_divide("_of", "_other").alias(name))


def time_span(df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Seconds between first and last click of the group."""
    name = name or feature_name(keys, "time_span")
    return add_group_aggregates(df, keys, {name: gap_seconds(F.max(t), F.min(t))}, rid, base)


def mean_gap(df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Time span of the group over its size."""
    name = name or feature_name(keys, "timespan_average")
    return add_group_aggregates(df, keys, {name: gap_seconds(F.max(t), F.min(t)) / F.count(F.lit(1))}, rid, base)


def since_first(df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Seconds since the first click of the group."""
    name = name or feature_name(keys, "time_span_min")
    found = add_group_aggregates(df, keys, {"_first": F.min(t)}, rid, base)
    return found.select(*df.columns, gap_seconds(t, "_first").alias(name))


def until_last(df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid=ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Seconds until the last click of the group."""
    name = name or feature_name(keys, "time_span_max")
    found = add_group_aggregates(df, keys, {"_last": F.max(t)}, rid, base)
    return found.select(*df.columns, gap_seconds("_last", t).alias(name))


def attribution_delay(
    df: DataFrame,
    keys: Sequence[str],
    name: str | None = None,
    t: str = TIME,
    attributed: str = "attributed_t",
    rid=ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Median seconds from click to conversion in the group, after the zone shift of the conversion time."""
    name = name or "_".join(keys) + "_attri_minus"
    base = df if base is None else base
    delays = base.withColumn("_delay", gap_seconds(shift_hours(attributed, ATTRIBUTION_SHIFT_HOURS), t))
    return attach(df, median_table(delays, keys, "_delay", name), keys, rid, base)


def cross_stats(
    history: DataFrame, df: DataFrame, keys: Sequence[str], value: str, names: dict[str, str], rid=ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Statistics (``how`` -> name) computed on one table, put on the rows of another."""
    return attach(df, group_table(history, keys, {n: stat(h, value) for h, n in names.items()}), keys, rid, base)


def overview(df: DataFrame, t: str = TIME, rid: str = ROW_ID) -> DataFrame:
    """Row count, first time and smallest row id of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("first_t"), F.min(rid).alias("first_rid"))
