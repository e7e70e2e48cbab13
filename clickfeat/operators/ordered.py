"""Features that depend on a row's place in the time order of its group.

Order is always ``t`` then ``rid``, so ties have one answer. Groups are cut into slices (see ``slices``): a window
runs inside each slice and one small carried row per slice supplies what lies before or after it.

``base`` is the log ``df`` was derived from row by row; it must hold the columns the feature reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.scalars import hash_bucket
from clickfeat.functions.timeparts import epoch_seconds, hours_field, seconds_field, whole_seconds
from clickfeat.naming import ROW_ID, TIME, as_list, feature_name
from clickfeat.operators.slices import SlicedRows, all_slices, any_null, earlier_slices, fits_one_slice, salted_join, with_keys
from clickfeat.sources.store import run_store

NO_NEXT_CLICK_SECOND = 3_000_000_000


def place_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], place: str, size: str, base: DataFrame | None = None
) -> DataFrame:
    """0-based place of the row in its group and the size of the group."""
    sliced = SlicedRows(df, keys, order, base)
    rows = sliced.rows.withColumns(
        {"_place": F.row_number().over(sliced.ordered()) - 1, "_in_slice": F.count(F.lit(1)).over(sliced.window())}
    )
    rows = sliced.carry(
        rows,
        {"_part": F.count(F.lit(1))},
        lambda w: {"_before": F.sum("_part").over(earlier_slices(w)), "_total": F.sum("_part").over(all_slices(w))},
    )
    return sliced.finish(
        rows,
        {place: F.col("_place") + F.coalesce("_before", F.lit(0)), size: F.coalesce("_total", "_in_slice")},
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    step: int = 1,
    order: Sequence[str] = (TIME, ROW_ID),
    base: DataFrame | None = None,
) -> DataFrame:
    """``value`` of the next (``step=1``) or previous (``step=-1``) row of the group; NULL at the end."""
    if step not in (1, -1):
        raise ValueError("step must be 1 or -1")
    shift, edge, edge_by = (F.lead, F.min, F.min_by) if step == 1 else (F.lag, F.max, F.max_by)
    sliced = SlicedRows(df, keys, order, base)
    # Value of the slice's outermost row. A long or date as aggregate state stays in the hash aggregation; a struct
    # would sort the rows first.
    if value == order[0]:
        outermost = edge(value)
    elif len(order) == 1:
        outermost = edge_by(value, order[0])
    else:
        outermost = edge_by(value, F.struct(*order))
    # A boxed value tells "no neighbour in this slice" from "neighbour holds NULL".
    rows = sliced.rows.withColumn("_near", shift(F.struct(F.col(value).alias("v"))).over(sliced.ordered()))
    rows = sliced.carry(
        rows, {"_edge": outermost}, lambda w: {"_far": shift(F.struct(F.col("_edge").alias("v"))).over(w)}
    )
    return sliced.finish(rows, {name: F.coalesce("_near", "_far")["v"]})


def timeline(df: DataFrame, keys: Sequence[str], t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None) -> DataFrame:
    """Place, group size and times of the neighbours (``_at _of _prev_t _next_t``) in one pass over the key."""
    sliced = SlicedRows(df, keys, [t, rid], base)
    order = sliced.ordered()
    rows = sliced.rows.withColumns(
        {
            "_place": F.row_number().over(order) - 1,
            "_in_slice": F.count(F.lit(1)).over(sliced.window()),
            "_before_t": F.lag(t).over(order),
            "_after_t": F.lead(t).over(order),
        }
    )
    rows = sliced.carry(
        rows,
        {"_part": F.count(F.lit(1)), "_first_t": F.min(t), "_last_t": F.max(t)},
        lambda w: {
            "_before": F.sum("_part").over(earlier_slices(w)),
            "_total": F.sum("_part").over(all_slices(w)),
            "_far_before": F.lag("_last_t").over(w),
            "_far_after": F.lead("_first_t").over(w),
        },
    )
    return sliced.finish(
        rows,
        {
            "_at": F.col("_place") + F.coalesce("_before", F.lit(0)),
            "_of": F.coalesce("_total", "_in_slice"),
            "_prev_t": F.coalesce("_before_t", "_far_before"),
            "_next_t": F.coalesce("_after_t", "_far_after"),
        },
    )


def ordinal(
    df: DataFrame,
    keys: Sequence[str],
    ascending: bool = True,
    name: str | None = None,
    t: str = TIME,
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Number of earlier rows in the group, or of later rows when not ``ascending``."""
    name = name or feature_name(keys, f"rank_{ascending}")
    placed = place_in_group(df, keys, [t, rid], "_at", "_of", base)
    value = F.col("_at") if ascending else F.col("_of") - 1 - F.col("_at")
    return placed.select(*df.columns, value.cast("long").alias(name))


def running_ordinals(
    df: DataFrame, keys: Sequence[str], tag: str, t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """``prev_<tag>`` and ``future_<tag>``: rows before and after this one in the group."""
    placed = place_in_group(df, keys, [t, rid], "_at", "_of", base)
    return placed.select(
        *df.columns,
        F.col("_at").cast("long").alias(f"prev_{tag}"),
        (F.col("_of") - 1 - F.col("_at")).cast("long").alias(f"future_{tag}"),
    )


def normalised_rank(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    ascending: bool = True,
    name: str = "rank",
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Place in the group scaled to 0..1; NULL for a group of one. Ties are split by row id."""
    placed = place_in_group(df, keys, [*by, rid], "_at", "_of", base)
    place = F.col("_at") if ascending else F.col("_of") - 1 - F.col("_at")
    return placed.select(*df.columns, F.try_divide(place, F.col("_of") - 1).alias(name))


def _gap(df: DataFrame, keys: Sequence[str], step: int, t: str, rid: str, base: DataFrame | None, make) -> DataFrame:
    found = neighbour(df, keys, t, "_near_t", step, (t, rid), base)
    gap = F.col("_near_t") - F.col(t) if step == 1 else F.col(t) - F.col("_near_t")
    return found.select(*df.columns, make(gap))


def click_gap(
    df: DataFrame,
    keys: Sequence[str],
    which: str = "next",
    name: str | None = None,
    t: str = TIME,
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Whole seconds to the ``next`` or since the ``last`` click of the group; NULL at the end."""
    name = name or feature_name(keys, f"next_click_{which}")
    step = {"next": 1, "last": -1}[which]
    return _gap(df, keys, step, t, rid, base, lambda gap: whole_seconds(gap).alias(name))


def gap_seconds_field(
    df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Seconds-of-day part of the gap to the next click; whole days are dropped."""
    return _gap(df, keys, 1, t, rid, base, lambda gap: seconds_field(gap).alias(name or feature_name(keys, "delta")))


def gap_hours_field(
    df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Hour-of-day part of the gap to the next click."""
    return _gap(df, keys, 1, t, rid, base, lambda gap: hours_field(gap).alias(name or feature_name(keys, "click_easy")))


def consecutive_difference(
    df: DataFrame, value: str, order: Sequence[str], shift: int = 0, name: str = "difference", keys: Sequence[str] = (), base: DataFrame | None = None
) -> DataFrame:
    """Difference to the previous row in sorted order (``shift=0``) or of the next row to this one (``shift=-1``)."""
    found = neighbour(df, keys, value, "_near", {0: -1, -1: 1}[shift], order, base)
    made = F.col(value) - F.col("_near") if shift == 0 else F.col("_near") - F.col(value)
    return found.select(*df.columns, made.alias(name))


def next_click_or_sentinel(
    df: DataFrame,
    keys: Sequence[str],
    name: str | None = None,
    t: str = TIME,
    rid: str = ROW_ID,
    buckets: int | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Seconds to the next click of the key; the last click counts to second 3,000,000,000.

    ``buckets`` groups by a hash of the key instead of the key itself (``scalars.HASH_BUCKETS`` is the usual number).
    """
    name = name or feature_name(keys, "hash_click")
    grouped = list(keys)
    log, base = df, df if base is None else base
    if buckets:
        grouped, bucket = ["_bucket"], hash_bucket(keys, buckets)
        log, base = log.withColumn("_bucket", bucket), base.withColumn("_bucket", bucket)
    found = neighbour(log, grouped, t, "_next_t", 1, (t, rid), base)
    gap = F.coalesce(epoch_seconds("_next_t"), F.lit(NO_NEXT_CLICK_SECOND)) - epoch_seconds(t)
    return found.select(*df.columns, F.when(~any_null(keys), gap).alias(name))


def written_if_cut(derived: DataFrame, base: DataFrame, name: str) -> DataFrame:
    """A table derived from ``base`` by an exchange, written where it will be cut: cuts, rows and carried rows then read the
    written table instead of deriving it three times."""
    if fits_one_slice(base):
        return derived
    return run_store(base.sparkSession).get_or_compute(name, lambda: derived)


def previous_in_file(df: DataFrame, value: str, name: str | None = None, rid: str = ROW_ID) -> DataFrame:
    """Value of the row before, in row-id order over the whole table."""
    return neighbour(df, [], value, name or f"{value}_shift", -1, (rid,))


def shifted_group_difference(
    df: DataFrame, keys: Sequence[str], name: str | None = None, t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Gap since the group's previous click, taken from the next row of the whole table; seconds-of-day part."""
    name = name or feature_name(keys, "delta")
    base = df if base is None else base
    stepped = neighbour(base.select(*dict.fromkeys([*keys, t, rid])), keys, t, "_prev_t", -1, (t, rid))
    steps = written_if_cut(stepped.select(rid, (F.col(t) - F.col("_prev_t")).alias("_diff")), base, "steps")
    moved = neighbour(steps, [], "_diff", "_moved", 1, (rid,))
    return df.join(moved.select(rid, seconds_field(F.col("_moved")).alias(name)), rid, "left")


def group_numbers(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys with their 0-based number in key order. The order is cut into slices; no task sees all keys."""
    distinct = written_if_cut(with_keys(df, keys).select(*keys).distinct(), df, "distinct")
    placed = place_in_group(distinct, [], list(keys), "_at", "_of")
    return placed.select(*keys, F.col("_at").cast("long").alias("_number"))


def group_number(
    df: DataFrame, keys: Sequence[str], name: str | None = None, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    base = df if base is None else base
    table = group_numbers(base, keys).withColumnRenamed("_number", name or feature_name(keys, "ngroup"))
    return salted_join(df, table, list(keys), as_list(rid), base)


def with_row_index(df: DataFrame, order: Sequence[str], name: str = ROW_ID) -> DataFrame:
    """0-based row number over the whole table in a unique order, found slice by slice."""
    placed = place_in_group(df, [], order, "_at", "_of")
    return placed.select(F.col("_at").cast("long").alias(name), *df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key. Aggregated before the shuffle, so many copies of one key stay cheap."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def top_rows(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` first rows of an order."""
    return df.orderBy(*by).limit(n)
